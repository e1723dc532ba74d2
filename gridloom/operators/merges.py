"""Merged regions over a grid that does not have them filled yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.cells import CELL_TYPE, FILL_TYPE, cell_at
from gridloom.operators.spine import spread_rows
from gridloom.relations import GRID_COLUMNS

# A band is 2**BAND_BITS rows; a band of the next level is as many bands of the one below.
BAND_BITS = 6

# Levels of bands: a region lies in at most 65 bands of its level, however tall it is, up to 2**36 rows.
LEVELS = 5

_KEYS = ["file", "sheet_idx"]

# The first of the absent rows right above a row, or the row itself.
_TOP = "CASE WHEN cells IS NULL THEN row ELSE row - greatest(gap, 0L) END"


def fill_merged(grid: DataFrame, merges: DataFrame) -> DataFrame:
    """Gives each row the regions of ``merges(file, sheet_idx, r0, c0, r1, c1)`` that cover it.

    Regions are indexed by bands of rows: a region is listed in the few bands, of a level that suits its height, that it
    touches, and each band of 64 rows that the sheet has gathers the lists of the bands around it, sorted. A row then
    picks its regions from its band's list. So a tall region costs a record per band of rows that exists, not per row,
    and nothing is compared with all regions of a sheet.

    Absent rows between a sheet's rows become rows of it where a region covers them; below the last row there is nothing
    to fill. Of overlapping regions the first counts: by ``place``, if ``merges`` has that column (any type that can be
    ordered), else by (r0, c0). A band's list is as long as regions touch its 64 rows: regions that do not overlap are at
    most 64 times the sheet's columns. An empty ``merges`` leaves the grid's cells as they are.
    """
    rows = _explicit_rows(grid).withColumn("_band", F.expr(f"shiftright(row, {BAND_BITS})"))
    lists = _band_lists(_bands(grid), _filled(grid, merges))
    covering = "transform(filter(_regions, x -> x.r0 <= row AND x.r1 >= row), x -> x.fill)"
    joined = rows.join(lists, [*_KEYS, "_band"], "left").withColumn("_fills", F.expr(covering))
    covered = "coalesce(size(_fills), 0) > 0"
    return joined.selectExpr(
        *_replaced(gap=f"CASE WHEN {covered} THEN 0L ELSE gap END",
                   fills=f"CASE WHEN cells IS NOT NULL THEN CASE WHEN {covered} THEN _fills ELSE fills END END")
    )


def _filled(grid: DataFrame, merges: DataFrame) -> DataFrame:
    """The regions as (file, sheet_idx, r0, r1, place, fill), ``fill`` with the cell at their upper left."""
    first = grid.filter("cells IS NOT NULL AND gap >= 0").selectExpr(*_KEYS, "row AS _top", "cells")
    # What a generator gives is no literal: were all keys literals, the equi-join would be planned as a cross join.
    tops = merges.filter("r0 <= r1").withColumn("_top", F.expr("explode(array(cast(r0 AS bigint)))"))
    place = "place" if "place" in merges.columns else "0 AS place"
    fill = (
        "named_struct('c0', cast(c0 AS int), 'c1', cast(c1 AS int), "
        f"'cell', cast({cell_at('cells', 'c0')} AS {CELL_TYPE})) AS fill"
    )
    return tops.join(first, [*_KEYS, "_top"], "left").selectExpr(*_KEYS, "_top AS r0", "cast(r1 AS bigint) AS r1", place, fill)


def _bands(grid: DataFrame) -> DataFrame:
    """(file, sheet_idx, _band): the bands that the grid's rows, absent ones included, lie in. Rows that reach over the same
    bands are brought together before these are listed."""
    spans = grid.selectExpr(*_KEYS, f"shiftright({_TOP}, {BAND_BITS}) AS _low", f"shiftright(row, {BAND_BITS}) AS _high").distinct()
    return spread_rows(spans, "_low", "_high", "_at").selectExpr(*_KEYS, "_at AS _band").distinct()


def _band_lists(around: DataFrame, regions: DataFrame) -> DataFrame:
    """(file, sheet_idx, _band, _regions): of each band, the regions that touch it, in order."""
    # A region is as tall as at most 64 bands of its level.
    tall = " ".join(f"WHEN r1 - r0 < {1 << BAND_BITS * (k + 2)}L THEN {k}" for k in range(LEVELS - 1))
    within = f"shiftright({{}}, {BAND_BITS} * (_level + 1))"
    listed = regions.withColumn("_level", F.expr(f"CASE {tall} ELSE {LEVELS - 1} END")).withColumn(
        "_at", F.expr(f"explode(sequence({within.format('r0')}, {within.format('r1')}))"))
    bands = around.withColumn("_level", F.expr(f"explode(sequence(0, {LEVELS - 1}))"))
    placed = bands.withColumn("_at", F.expr(f"shiftright(_band, {BAND_BITS} * _level)"))
    met = placed.join(listed, [*_KEYS, "_level", "_at"]).filter(
        f"r0 < shiftleft(_band + 1, {BAND_BITS}) AND r1 >= shiftleft(_band, {BAND_BITS})")
    # Sorted by place, then by where regions start; columns stand first in a fill.
    return met.groupBy(*_KEYS, "_band").agg(
        F.expr("array_sort(collect_list(named_struct('place', place, 'r0', r0, 'c0', fill.c0, 'r1', r1, 'fill', fill))) AS _regions"))


def _explicit_rows(grid: DataFrame) -> DataFrame:
    """The grid with each absent row above another as a row of its own."""
    here = "_at = row"
    empty, unfilled = f"cast(array() AS array<{CELL_TYPE}>)", f"cast(NULL AS array<{FILL_TYPE}>)"
    return spread_rows(grid, _TOP, "row").selectExpr(
        *_replaced(row="_at", gap=f"CASE WHEN cells IS NULL THEN gap WHEN {here} AND gap >= 0 THEN 0L ELSE -1L END",
                   cells=f"CASE WHEN {here} THEN cells ELSE {empty} END",
                   fills=f"CASE WHEN {here} THEN fills ELSE {unfilled} END")
    )


def _replaced(**changed: str) -> list[str]:
    return [f"{changed[c]} AS {c}" if c in changed else c for c in GRID_COLUMNS]
