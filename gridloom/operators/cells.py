"""Between grid rows (an array of cells per row) and cells in long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.cells import CELL_FIELDS, FILL_TYPE, apply_fills
from gridloom.operators.spine import close_sheets


def grid_cells(grid: DataFrame, fill: bool = False) -> DataFrame:
    """``cells(file, sheet_idx, sheet_name, row, col, kind, num, bool, str, is_date, formula)`` of a grid."""
    cells = apply_fills("cells", "fills") if fill else "cells"
    exploded = grid.filter("cells IS NOT NULL").selectExpr(
        "file", "sheet_idx", "sheet_name", "row", f"explode({cells}) AS _c"
    )
    return exploded.selectExpr(
        "file", "sheet_idx", "sheet_name", "row", *[f"_c.{n} AS {n}" for n, _ in CELL_FIELDS]
    )


def cells_to_grid(cells: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Grid of a long cell relation; ``rows(file, sheet_idx, sheet_name, row)`` adds rows without cells.

    One shuffle by row. A group is one row, so no key grows beyond the width of a sheet.
    """
    fields = ", ".join(f"'{n}', cast({n} AS {t})" for n, t in CELL_FIELDS)
    keyed = cells.selectExpr("file", "sheet_idx", "sheet_name", "row", f"named_struct({fields}) AS _c")
    if rows is not None:
        bare = rows.select("file", "sheet_idx", "sheet_name", "row", F.lit(None).cast(keyed.schema["_c"].dataType).alias("_c"))
        keyed = keyed.unionByName(bare)
    physical = (
        keyed.groupBy("file", "sheet_idx", "sheet_name", "row")
        .agg(F.expr("array_sort(collect_list(_c)) AS cells"))
        # Of several cells in one column the last in order counts.
        .withColumn("cells", F.expr("filter(cells, (c, i) -> coalesce(get(cells, i + 1).col <> c.col, true))"))
        .selectExpr("*", "false AS date1904", f"cast(NULL AS array<{FILL_TYPE}>) AS fills")
    )
    return close_sheets(physical)
