"""Any table as a grid, so that every grid operator also runs on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.errors import WorkbookError
from gridloom.functions.a1 import parse_a1
from gridloom.functions.cells import CELL_TYPE, FILL_TYPE, cell
from gridloom.functions.dates import timestamp_to_serial
from gridloom.functions.text import name, text
from gridloom.operators.spine import close_sheets, end_rows
from gridloom.plans.scratch import written
from gridloom.relations import GRID_COLUMNS

# Rows numbered in one window without further ado, as many as a real sheet can have; above it, ranges of the key are numbered apart.
PLAIN_WINDOW_ROWS = 1_048_576
# Rows of such a range, about.
RANGE_ROWS = 131_072
# Sheets of one workbook that may be found out on the driver.
MAX_SHEETS = 4096


def to_cell(value: str, dtype: T.DataType, col: int) -> str:
    """A table value as a cell: numbers → num, text → str, times → num that is a date; null → blank."""
    if isinstance(dtype, T.BooleanType):
        made = cell(col, "bool", bool=value)
    elif isinstance(dtype, T.NumericType):
        made = cell(col, "num", num=value)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        serial = timestamp_to_serial(value)
        made = cell(col, "num", num=serial, is_date=f"{serial} >= 0")
    else:
        made = cell(col, "str", str=value)
    return f"CASE WHEN {value} IS NOT NULL THEN {made} ELSE {cell(col, 'blank')} END"


def number_rows(df: DataFrame, sheet: str, order_by: list[str], unique: bool = False,
                plain_rows: int = PLAIN_WINDOW_ROWS, count: int | None = None) -> DataFrame:
    """Adds ``_n``: 1, 2, 3 … in key order within each ``sheet``; ``unique`` says no two rows share a key.

    A table too large for one window per sheet is sorted by ranges of (sheet, key) and written once. Each range is numbered
    on its own and moved by the rows before it, so a sheet with a third of all rows spreads like any other.
    ``count`` saves counting the rows where it is known.
    """
    # The hash of the whole row keeps the order of rows with equal keys fixed.
    keys = order_by if unique else [*order_by, f"xxhash64({', '.join(name(c) for c in df.columns)})"]
    n = df.count() if count is None else count
    if n <= plain_rows:
        return df.selectExpr("*", f"cast(row_number() OVER (PARTITION BY {sheet} ORDER BY {', '.join(keys)}) AS bigint) AS _n")
    sheeted = df.selectExpr("*", f"{sheet} AS _s", *[f"{k} AS _k{i}" for i, k in enumerate(keys)])
    order = ["_s", *[f"_k{i}" for i in range(len(keys))]]
    ranges = -(-n // min(plain_rows, RANGE_ROWS))
    # Written, as ranges are cut anew, and maybe elsewhere, each time a frame is worked out.
    ranged = sheeted.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = written(ranged.selectExpr(*[name(c) for c in df.columns], "_s", "monotonically_increasing_id() AS _id"), "numbered")
    # A task numbers its rows one by one, from a multiple of 2**33 on. One record per task and sheet that meet.
    starts = placed.groupBy("_s", F.expr("shiftright(_id, 33) AS _r")).agg(F.min("_id").alias("_first"), F.count("*").alias("_many"))
    before = "sum(_many) OVER (PARTITION BY _s ORDER BY _r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = starts.selectExpr("_s", "_r", f"coalesce({before}, 0L) - _first + 1 AS _move")
    moved = placed.withColumn("_r", F.expr("shiftright(_id, 33)")).alias("p").join(offsets.alias("o"), F.expr("p._r = o._r AND p._s <=> o._s"))
    return moved.selectExpr(*[f"p.{name(c)}" for c in df.columns], "p._id + o._move AS _n")


def _sheet_sizes(df: DataFrame, sheet: str, sheets: list[str] | None) -> dict[str, int]:
    """Rows per sheet, in workbook order: one aggregate, one record per sheet on the driver."""
    if sheets is None and sheet.startswith("'"):
        sheets = [sheet.strip("'")]
    if sheets is not None and len(sheets) == 1:
        return {sheets[0]: df.count()}
    found = df.groupBy(F.expr(sheet).alias("s")).count().orderBy("s").limit(MAX_SHEETS + 1).collect()
    if len(found) > MAX_SHEETS:
        raise WorkbookError(f"A workbook of more than {MAX_SHEETS} sheets is not supported")
    sizes = {r["s"]: r["count"] for r in found}
    return sizes if sheets is None else {s: sizes.get(s, 0) for s in sheets}


def table_to_grid(
    df: DataFrame,
    *,
    sheet: str = "'Sheet1'",
    sheets: list[str] | None = None,
    order_by: list[str] | None = None,
    unique: bool = False,
    row: str | None = None,
    dense: bool = False,
    cells: list[str] | None = None,
    header: bool | list[list[str | None]] = True,
    at: str = "A1",
    file: str = "table",
    plain_rows: int = PLAIN_WINDOW_ROWS,
) -> DataFrame:
    """The rows of ``df`` as a grid. ``sheet``, ``order_by``, ``row`` and ``cells`` are SQL expressions over ``df``.

    ``sheet`` names the sheet of each row (``sheets``: all names in workbook order; empty sheets may be
    among them). Rows are placed in order of ``order_by`` from the row below the header, or at the
    zero-based position ``row`` gives, gaps and all (``dense`` promises there are none). With neither, rows keep the order they are read in and
    nothing is shuffled; their positions then rise but are not consecutive, so that a schema has to be given
    or inferred from all rows. ``cells`` replaces the default of one cell per column; ``header`` may give
    several rows of texts. ``at`` shifts the whole table.
    """
    top, left = parse_a1(at)
    if cells is None:
        cells = [to_cell(name(f.name), f.dataType, left + i) for i, f in enumerate(df.schema)]
    titles = ([list(df.columns)] if header else []) if isinstance(header, bool) else header
    first = top + len(titles)
    sizes = None if row is not None and sheets else _sheet_sizes(df, sheet, sheets)
    sheets = list(sizes) if sizes is not None else sheets
    known = f"array({', '.join(text(s) for s in sheets)})"
    index = f"cast(array_position({known}, _sheet) - 1 AS int)"

    def placed(frame: DataFrame, position: str, made: str, gap: str | None) -> DataFrame:
        return frame.selectExpr(
            f"{text(file)} AS file", f"{index} AS sheet_idx", "_sheet AS sheet_name", f"cast({position} AS bigint) AS row",
            *([] if gap is None else [f"cast({gap} AS bigint) AS gap"]),
            "false AS date1904", f"{made} AS cells", f"cast(NULL AS array<{FILL_TYPE}>) AS fills",
        )

    named = df.selectExpr("*", f"{sheet} AS _sheet")
    made = f"array({', '.join(cells)})"
    known_gaps = row is None or dense
    if row is not None:
        body = placed(named, f"({row})", made, "0" if dense else None)
    else:
        # Numbers start at 1, the first row below the header at ``first``.
        shift = f" + {first - 1}" if first != 1 else ""
        gap = "0" if titles else f"CASE WHEN _n = 1 THEN {top} ELSE 0 END"
        if order_by:
            numbered = number_rows(named, "_sheet", order_by, unique, plain_rows, sum(sizes.values()))
        else:
            numbered = named.selectExpr("*", "monotonically_increasing_id() + 1 AS _n")
        body = placed(numbered, f"_n{shift}", made, gap)

    names = df.sparkSession.range(1).selectExpr(f"explode({known}) AS _sheet")
    rows = body
    for i, texts in enumerate(titles):
        line = ", ".join(
            cell(left + j, "blank") if t is None else cell(left + j, "str", str=text(t)) for j, t in enumerate(texts)
        )
        gap = (str(top) if i == 0 else "0") if known_gaps else None
        rows = rows.unionByName(placed(names, str(top + i), f"cast(array({line}) AS array<{CELL_TYPE}>)", gap))
    if not known_gaps:
        return close_sheets(rows)
    ends = names.selectExpr(
        f"{text(file)} AS file", f"{index} AS sheet_idx", "_sheet AS sheet_name", "false AS date1904"
    )
    if row is None:
        last = ", ".join(f"{n}L" for n in sizes.values())
        ends = ends.selectExpr("*", f"get(array({last}), sheet_idx) + {first - 1} AS last_row")
    else:
        deepest = body.groupBy("sheet_name").agg(F.max("row").alias("_last"))
        ends = ends.join(deepest, "sheet_name", "left").selectExpr("*", f"coalesce(_last, {first - 1}) AS last_row")
    return rows.select(*GRID_COLUMNS).unionByName(end_rows(ends))
