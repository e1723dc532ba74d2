"""Cell → value of a target type, and whether the cell fits that type."""

from __future__ import annotations

from pyspark.sql import types as T

from gridloom.functions.dates import serial_to_date, serial_to_iso, serial_to_timestamp
from gridloom.functions.text import text

# Ranges of the whole number types; a number beyond becomes the end it passed.
INT_RANGE = ("int", -2_147_483_648, 2_147_483_647)
LONG_RANGE = ("bigint", -9_223_372_036_854_775_808, 9_223_372_036_854_775_807)


def _narrow(num: str, dtype: str, low: int, high: int) -> str:
    """Cut the fraction and stay within the type's range."""
    return (
        f"CASE WHEN {num} >= {high}D THEN cast('{high}' AS {dtype}) "
        f"WHEN {num} <= {low}D THEN cast('{low}' AS {dtype}) ELSE cast({num} AS {dtype}) END"
    )


def coerce(c: str, dtype: T.DataType, null_value: str | None = None, date1904: str = "false") -> str:
    """Value of cell struct ``c`` as ``dtype``; null where the cell does not fit.

    Leans on a cell having only the field of its kind set, to keep the generated code small: past 8 KB a
    method is no longer compiled, and a table of many text columns gets there soon.
    """
    num = f"{c}.num"
    if isinstance(dtype, T.StringType):
        shown = f"{c}.str"
        if null_value is not None:
            shown = f"CASE WHEN {c}.kind <> 'str' OR lower({c}.str) <> lower({text(null_value)}) THEN {c}.str END"
        # As a lambda the rare and long date branch stays out of the generated code, and the projection is
        # generated as many small methods instead of being fused into one.
        day = f"get(transform(array({num}), n -> {serial_to_iso('n', date1904)}), 0)"
        number = f"CASE WHEN {c}.is_date THEN {day} ELSE cast({num} AS string) END"
        return f"CASE WHEN {c}.kind <> 'error' THEN coalesce({shown}, {number}, cast({c}.bool AS string)) END"
    if isinstance(dtype, T.BooleanType):
        return f"{c}.bool"
    if isinstance(dtype, T.TimestampType):
        return f"CASE WHEN {c}.is_date THEN {serial_to_timestamp(num, date1904)} END"
    if isinstance(dtype, T.DateType):
        return f"CASE WHEN {c}.is_date THEN {serial_to_date(num, date1904)} END"
    value = {
        T.DoubleType: num,
        T.FloatType: f"cast({num} AS float)",
        T.IntegerType: _narrow(num, *INT_RANGE),
        T.LongType: _narrow(num, *LONG_RANGE),
    }.get(type(dtype))
    return value or f"cast(NULL AS {dtype.simpleString()})"


def coerce_match(c: str, dtype: T.DataType, nullable: bool = True) -> str:
    """Whether cell ``c`` fits a field of this type; never null."""
    if isinstance(dtype, T.StringType):
        return "true" if nullable else f"coalesce({c}.kind NOT IN ('blank', 'error'), false)"
    if isinstance(dtype, T.BooleanType):
        fits = f"{c}.kind = 'bool'"
    elif isinstance(dtype, (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)):
        fits = f"{c}.kind = 'num'"
    elif isinstance(dtype, (T.TimestampType, T.DateType)):
        fits = f"{c}.is_date"
    else:
        fits = "false"
    if nullable:
        return f"coalesce({fits} OR {c}.kind IN ('blank', 'error'), true)"
    return f"coalesce({fits}, false)"
