"""Which rows a sheet has: gaps between physical rows, and where each sheet ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.relations import GRID_COLUMNS, GRID_FIELDS

# Rows of one sheet handled together when looking for gaps.
BAND_ROWS = 65_536


def _band_ends(rows: DataFrame) -> DataFrame:
    """Last row of each band of each sheet; all that has to be known across bands."""
    return rows.groupBy("file", "sheet_idx", F.expr(f"row div {BAND_ROWS} AS _band")).agg(
        F.max("row").alias("_last"), F.first("sheet_name").alias("sheet_name"), F.first("date1904").alias("date1904")
    )


def add_gaps(rows: DataFrame) -> DataFrame:
    """Adds ``gap``: the number of absent rows right above each row of ``rows(file, sheet_idx, row, …)``.

    Sheets are worked on in bands of rows, so a large sheet spreads over many tasks; only the last row of
    each band is looked at across bands.
    """
    before = _band_ends(rows).selectExpr(
        "file", "sheet_idx", "_band", "lag(_last, 1, -1L) OVER (PARTITION BY file, sheet_idx ORDER BY _band) AS _before"
    )
    within = rows.withColumn("_band", F.expr(f"row div {BAND_ROWS}")).withColumn(
        "_prev", F.expr("lag(row) OVER (PARTITION BY file, sheet_idx, _band ORDER BY row)")
    )
    gap = "greatest(row - coalesce(_prev, _before) - 1, 0L) AS gap"
    kept = [c for c in rows.columns if c != "gap"]
    return within.join(before, ["file", "sheet_idx", "_band"]).selectExpr(*kept, gap)


def end_rows(sheets: DataFrame) -> DataFrame:
    """End rows from ``sheets(file, sheet_idx, sheet_name, date1904, last_row)``."""
    given = {"row": "last_row", "gap": "0", "cells": "NULL", "fills": "NULL"}
    return sheets.selectExpr(*[f"cast({given.get(n, n)} AS {t}) AS {n}" for n, t in GRID_FIELDS])


def close_sheets(rows: DataFrame) -> DataFrame:
    """Rows (without ``gap``) → grid: gaps worked out, and one end row per sheet.

    The rows are passed over twice, the second time for their keys only: gaps and ends share one aggregate.
    """
    last = _band_ends(rows).groupBy("file", "sheet_idx").agg(
        F.first("sheet_name").alias("sheet_name"), F.first("date1904").alias("date1904"), F.max("_last").alias("last_row")
    )
    return add_gaps(rows).select(*GRID_COLUMNS).unionByName(end_rows(last))


def spread_rows(frame: DataFrame, low: str, high: str, at: str = "_at") -> DataFrame:
    """One record per number from ``low`` to ``high``, as column ``at``; none where ``low`` is above ``high``.

    Goes by way of bands, so that no array is longer than a band however far apart the two are.
    """
    kept = [f"`{c}`" for c in frame.columns]
    # Rounded down, not to zero: the end row of a sheet may lie above the table, at a negative row.
    first, last = f"floor(({low}) / {BAND_ROWS}D)", f"floor(({high}) / {BAND_ROWS}D)"
    bands = frame.filter(f"{low} <= {high}").selectExpr(*kept, f"explode(sequence({first}, {last})) AS _band")
    inside = f"sequence(greatest({low}, _band * {BAND_ROWS}), least({high}, _band * {BAND_ROWS} + {BAND_ROWS - 1}))"
    return bands.selectExpr(*kept, f"explode({inside}) AS {at}")


def row_spine(grid: DataFrame, first_data_row: int) -> DataFrame:
    """One record per table row of each sheet: physical rows, the absent ones between, and for a sheet
    without any data row a single record. Adds ``physical``; absent rows have no cells.

    Needs no join: each row brings the absent rows right above it.
    """
    low = first_data_row
    kept = [c for c in grid.columns if c not in ("row", "gap", "cells", "fills")]
    wanted = grid.filter(f"CASE WHEN cells IS NULL THEN row < {low} ELSE row >= {low} END")
    top = f"CASE WHEN cells IS NULL THEN row ELSE greatest(row - greatest(gap, 0L), {low}L) END"
    marked = spread_rows(wanted, top, "row").selectExpr(
        *kept, "_at", "cells", "fills", "cells IS NOT NULL AND gap >= 0 AND _at = row AS physical"
    )
    return marked.selectExpr(
        *kept, "_at AS row", "physical",
        "CASE WHEN physical THEN cells END AS cells", "CASE WHEN physical THEN fills END AS fills",
    )
