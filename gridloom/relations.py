"""The relations every module of the package agrees on."""

from __future__ import annotations

from pyspark.sql.types import StructType

from gridloom.functions.cells import CELL_TYPE, FILL_TYPE

# The grid: one row per physical sheet row, and one more (cells null) where a sheet ends.
GRID_FIELDS = (
    ("file", "string"),
    ("sheet_idx", "int"),
    ("sheet_name", "string"),
    ("row", "bigint"),          # zero-based; on the end row, the last physical row or -1
    ("gap", "bigint"),          # absent rows right above this one; -1: this row itself is absent
    ("date1904", "boolean"),
    ("cells", f"array<{CELL_TYPE}>"),
    ("fills", f"array<{FILL_TYPE}>"),   # regions merged over this row, with their content
)
GRID_COLUMNS = tuple(n for n, _ in GRID_FIELDS)

# What Spark's scan of binary files gives; any further column is a partition column.
FILE_COLUMNS = ("path", "modificationTime", "length", "content")


def grid_schema() -> StructType:
    return StructType.fromDDL(", ".join(f"{n} {t}" for n, t in GRID_FIELDS))
