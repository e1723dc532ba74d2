"""The schema of a table: names and types from the first sheet, plus the columns options add."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridloom.errors import WorkbookError
from gridloom.operators.headers import column_profile, table_columns
from gridloom.options import WorkbookOptions

SHEET_NAME_COLUMN = "_SheetName"  # fixed value

_TYPES = {
    "boolean": T.BooleanType(), "double": T.DoubleType(), "string": T.StringType(), "timestamp": T.TimestampType(),
}


def infer_types(grid: DataFrame, options: WorkbookOptions) -> DataFrame:
    """``position, type`` of the table on one anchored sheet."""
    return table_columns(column_profile(grid, options), options).select("position", "type")


def infer_schema(grid: DataFrame, options: WorkbookOptions) -> T.StructType:
    """Schema of the table on one anchored sheet. Runs one job; collects one record per column."""
    found = table_columns(column_profile(grid, options), options).orderBy("position").collect()
    if not found:
        raise WorkbookError("No data found on first row")
    repeated = sorted(n for n, k in Counter(r["name"] for r in found).items() if k > 1)
    if repeated:
        raise WorkbookError("Column names appear more than once in the header: " + ", ".join(repeated))
    schema = T.StructType([T.StructField(r["name"], _TYPES[r["type"]], True) for r in found])
    if options.include_sheet_name:
        schema = schema.add(T.StructField(SHEET_NAME_COLUMN, T.StringType(), False))
    flag = options.schema_match_column_name
    if flag is not None:
        if any(f.name.lower() == flag.lower() for f in schema):
            raise WorkbookError(
                "The specified schema match column conflicts with a column of the same name in the data set."
            )
        schema = schema.add(T.StructField(flag, T.BooleanType(), False))
    return schema


def check_flag(schema: T.StructType, options: WorkbookOptions) -> None:
    """Raises unless a given schema holds the schema match column, as a boolean."""
    flag = options.schema_match_column_name
    if flag is None:
        return
    field = next((f for f in schema if f.name.lower() == flag.lower()), None)
    if field is None:
        raise WorkbookError("The specified schema match column does not exist within the schema.")
    if not isinstance(field.dataType, T.BooleanType):
        raise WorkbookError("The specified schema match column is not defined as a boolean type.")
