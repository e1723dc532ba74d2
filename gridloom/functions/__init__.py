"""Expressions of the package, as Spark SQL text.

Each function takes the text of its arguments (a column name, ``c.num`` …) and returns the text of an
expression, for ``selectExpr`` and ``F.expr``. One parse then builds a whole expression, where the Column API
would make a call into the JVM for every part of it: planning a wide table takes a fraction of the time.
"""

from gridloom.functions.a1 import a1_column, a1_to_rc, column_letters, parse_a1
from gridloom.functions.cells import CELL_TYPE, FILL_TYPE, apply_fills, cell, cell_at, cell_text
from gridloom.functions.coerce import coerce, coerce_match
from gridloom.functions.dates import (
    is_date_format, serial_to_date, serial_to_iso, serial_to_timestamp, timestamp_to_serial,
)
from gridloom.functions.names import clean_name
from gridloom.functions.text import name, text

__all__ = [
    "CELL_TYPE", "FILL_TYPE", "a1_column", "a1_to_rc", "apply_fills", "cell", "cell_at", "cell_text",
    "clean_name", "coerce", "coerce_match", "column_letters", "is_date_format", "name", "parse_a1",
    "serial_to_date", "serial_to_iso", "serial_to_timestamp", "text", "timestamp_to_serial",
]
