"""Grid rows → table rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridloom.functions.cells import apply_fills, dense_cells
from gridloom.functions.coerce import coerce, coerce_match
from gridloom.functions.text import name
from gridloom.operators.infer import SHEET_NAME_COLUMN
from gridloom.operators.spine import row_spine
from gridloom.options import WorkbookOptions


def schema_match(fields: list[tuple[str, T.StructField]], physical: str = "physical") -> str:
    """Whether a row is present and every one of its data cells (cell, field) fits its field."""
    return " AND ".join([physical, *[f"({coerce_match(c, f.dataType, f.nullable)})" for c, f in fields]])


def assemble_rows(grid: DataFrame, schema: T.StructType, options: WorkbookOptions, keep: list[str] = ()) -> DataFrame:
    """Table rows of an anchored grid: field *i* of ``schema`` reads grid column *i*.

    Each row is worked out from its own cells, so there is no shuffle, and the expressions of columns
    nobody asks for are pruned. ``keep`` names further grid columns to append.
    """
    flag = (options.schema_match_column_name or "").lower()

    def is_sheet_name(f):
        return f.name == SHEET_NAME_COLUMN and options.include_sheet_name

    def is_flag(f):
        return flag != "" and f.name.lower() == flag

    data = [(f"_c{i}", f) for i, f in enumerate(schema) if not (is_sheet_name(f) or is_flag(f))]
    kept = [name(c) for c in keep]
    filled = row_spine(grid, options.header_row_count).selectExpr(
        "sheet_name", "physical", "date1904", *kept, f"{apply_fills('cells', 'fills')} AS cells"
    ).selectExpr("sheet_name", "physical", "date1904", *kept, f"{dense_cells('cells', len(schema))} AS cells")
    picked = filled.selectExpr(
        "sheet_name", "physical", "date1904", *kept, *[f"get(cells, {c[2:]}) AS {c}" for c, _ in data]
    )
    out = []
    for i, f in enumerate(schema):
        if is_sheet_name(f):
            value = "sheet_name"
        elif is_flag(f):
            value = schema_match(data)
        else:
            value = coerce(f"_c{i}", f.dataType, options.null_value, "date1904")
        out.append(f"{value} AS {name(f.name)}")
    return picked.selectExpr(*out, *kept)
