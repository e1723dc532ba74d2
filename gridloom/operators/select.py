"""Which sheets, and where on them the table starts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.errors import NO_SHEET, WorkbookError
from gridloom.functions.a1 import parse_a1
from gridloom.functions.cells import moved_cell
from gridloom.functions.text import text


def sheet_wanted(name: str, idx: str, pattern: str) -> str:
    """Whether a sheet is asked for: the first one, or every one whose whole name matches."""
    if not pattern.strip():
        return f"{idx} = 0"
    return rf"rlike({name}, {text(rf'\A(?:{pattern})\z')})"


def select_sheets(grid: DataFrame, pattern: str = "") -> DataFrame:
    """The first sheet of each workbook, or all whose whole name matches ``pattern``."""
    return grid.filter(sheet_wanted("sheet_name", "sheet_idx", pattern))


def require_sheets(rows: DataFrame, grid: DataFrame, pattern: str) -> DataFrame:
    """``rows``, or the error that a workbook of the grid has no sheet asked for, raised when the rows are read.

    Looks at the end rows only, one per sheet, and adds no row.
    """
    missing = f"raise_error(concat('{NO_SHEET}: ', coalesce(file, '')))"
    checked = grid.filter("cells IS NULL").groupBy("file").agg(
        F.expr(f"max({sheet_wanted('sheet_name', 'sheet_idx', pattern)}) AS found")
    ).filter(f"CASE WHEN coalesce(found, false) THEN false ELSE cast({missing} AS boolean) END")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema]
    return rows.union(checked.select(*nothing))


def first_sheet(grid: DataFrame) -> DataFrame:
    """Rows of the first sheet of the first file. A small job over the end rows finds out which that is."""
    first = grid.filter("cells IS NULL").agg(F.expr("min(named_struct('file', file, 'sheet_idx', sheet_idx)) AS s")).first()["s"]
    if first is None:
        raise WorkbookError(NO_SHEET)
    return grid.filter(f"file = {text(first['file'])} AND sheet_idx = {first['sheet_idx']}")


def anchor(grid: DataFrame, address: str = "A1") -> DataFrame:
    """The grid seen from ``address``: that cell becomes row 0, column 0; all above and left of it goes."""
    top, left = parse_a1(address)
    if (top, left) == (0, 0):
        return grid
    changed = {}
    if top:
        grid = grid.filter(f"cells IS NULL OR row >= {top}")
        changed["row"] = f"row - {top}"
        changed["gap"] = f"CASE WHEN cells IS NULL THEN 0 ELSE least(gap, row - {top}) END"
    if left:
        changed["cells"] = (
            f"transform(filter(cells, c -> c.col >= {left}), c -> {moved_cell('c', f'c.col - {left}')})"
        )
        changed["fills"] = (
            f"transform(filter(fills, f -> f.c1 >= {left}), "
            f"f -> named_struct('c0', greatest(f.c0 - {left}, 0), 'c1', f.c1 - {left}, 'cell', f.cell))"
        )
    return grid.selectExpr(*[f"{changed[c]} AS {c}" if c in changed else f"`{c}`" for c in grid.columns])
