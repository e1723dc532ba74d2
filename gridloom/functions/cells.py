"""The cell value: one struct, the same in every relation of the package.

Of ``num``, ``bool`` and ``str`` only the one that belongs to the kind is set: ``str`` for texts, errors and
shown formulas, none for a blank. ``is_date`` is never null, and true only for numbers from zero up.
"""

from __future__ import annotations

from gridloom.functions.dates import serial_to_timestamp
from gridloom.functions.text import text

CELL_FIELDS = (
    ("col", "int"),
    ("kind", "string"),      # blank | bool | num | str | error | formula
    ("num", "double"),
    ("bool", "boolean"),
    ("str", "string"),
    ("is_date", "boolean"),
    ("formula", "string"),
)
CELL_TYPE = "struct<" + ",".join(f"{n}:{t}" for n, t in CELL_FIELDS) + ">"
# A fill says: on this row, columns c0..c1 show the content of another cell.
FILL_TYPE = f"struct<c0:int,c1:int,cell:{CELL_TYPE}>"
# How a cell without date or boolean nature is filled in.
_DEFAULTS = {"is_date": "false"}


def cell(col: int | str, kind: str, **values: str) -> str:
    """A cell struct of ``kind``; ``values`` are expressions for its other fields."""
    values = {**_DEFAULTS, **values, "col": str(col), "kind": text(kind)}
    parts = ", ".join(f"'{n}', cast({values.get(n, 'NULL')} AS {t})" for n, t in CELL_FIELDS)
    return f"named_struct({parts})"


def moved_cell(c: str, col: str) -> str:
    """Cell ``c`` in another column."""
    rest = ", ".join(f"'{n}', {c}.{n}" for n, _ in CELL_FIELDS[1:])
    return f"named_struct('col', cast({col} AS int), {rest})"


def cell_at(cells: str, col: int | str) -> str:
    """The cell in grid column ``col`` of a row, or null.

    Rows are nearly always without holes, so the distance from the first cell is the index to try; a
    row with holes is searched.
    """
    guess = f"get({cells}, {col} - get({cells}, 0).col)"
    search = f"get(filter({cells}, c -> c.col = {col}), 0)"
    return f"CASE WHEN {guess}.col = {col} THEN {guess} ELSE {search} END"


def dense_cells(cells: str, width: int) -> str:
    """Cells of a row so that grid column *i* is element *i*, for *i* below ``width``.

    Cells come in column order, one per column; if the last one's column is its own index there are no holes
    and the row is taken as it is. Otherwise cells without a kind are put into the holes.
    """
    size = f"size({cells})"
    hole = ", ".join(f"'{n}', cast({'k' if n == 'col' else 'NULL'} AS {t})" for n, t in CELL_FIELDS)
    missing = f"array_except(sequence(0, {max(width, 1) - 1}), transform({cells}, c -> c.col))"
    return (
        f"CASE WHEN get({cells}, {size} - 1).col = {size} - 1 THEN {cells} "
        f"ELSE sort_array(concat({cells}, transform({missing}, k -> named_struct({hole})))) END"
    )


def apply_fills(cells: str, fills: str) -> str:
    """Cells of a row after its merged regions are filled; untouched where there are none. Where regions overlap, the
    first in the list counts."""
    kept = f"filter({cells}, c -> NOT exists({fills}, f -> c.col BETWEEN f.c0 AND f.c1))"
    free = f"filter(sequence(f.c0, f.c1), k -> NOT exists(slice({fills}, 1, i), g -> k BETWEEN g.c0 AND g.c1))"
    spread = f"transform({fills}, (f, i) -> transform({free}, k -> {moved_cell('f.cell', 'k')}))"
    return (
        f"CASE WHEN coalesce(size({fills}), 0) <= 0 THEN {cells} "
        f"ELSE sort_array(concat({kept}, flatten({spread}))) END"
    )


def cell_text(c: str, date1904: str = "false") -> str:
    """How a cell reads as header text; null for a blank or missing cell."""
    day = f"date_format({serial_to_timestamp(f'{c}.num', date1904)}, 'dd-MMM-yyyy')"
    return (
        f"CASE {c}.kind WHEN 'str' THEN {c}.str WHEN 'error' THEN {c}.str WHEN 'formula' THEN {c}.str "
        f"WHEN 'bool' THEN upper(cast({c}.bool AS string)) "
        f"WHEN 'num' THEN CASE WHEN {c}.is_date THEN {day} ELSE cast({c}.num AS string) END END"
    )


def cell_type(c: str) -> str:
    """What a cell says about its column's type; null where it says nothing."""
    return (
        f"CASE WHEN {c}.kind IS NULL OR {c}.kind IN ('blank', 'error') THEN NULL WHEN {c}.kind = 'bool' THEN 'boolean' "
        f"WHEN {c}.kind = 'num' THEN CASE WHEN {c}.is_date THEN 'timestamp' ELSE 'double' END ELSE 'string' END"
    )


def resolved_type(types: str) -> str:
    """One distinct type → that type; none or several → string."""
    return f"CASE WHEN size({types}) = 1 THEN get({types}, 0) ELSE 'string' END"
