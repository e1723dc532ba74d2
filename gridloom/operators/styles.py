"""Which numbers are dates, when the style of a cell is still an index into format tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridloom.functions.dates import is_date_format


def classify_dates(cells: DataFrame, styles: DataFrame, formats: DataFrame, style: str = "style") -> DataFrame:
    """Sets ``is_date`` from ``styles(file, style, format_id)`` and ``formats(file, format_id, code)``.

    The two tables are settled first, on their own, and only the styles that are dates are joined. A number
    below zero is never a date.
    """
    dates = (
        styles.join(formats, ["file", "format_id"], "left")
        .filter(is_date_format("format_id", "code"))
        .selectExpr("file", f"style AS {style}", "true AS _date")
    )
    is_date = "coalesce(kind = 'num' AND _date AND num >= 0, false)"
    return cells.join(dates, ["file", style], "left").selectExpr(
        *[f"{is_date} AS is_date" if c == "is_date" else c for c in cells.columns if c != style]
    )
