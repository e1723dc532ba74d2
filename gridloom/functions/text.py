"""Python values as SQL text."""

from __future__ import annotations


def text(value: str | None) -> str:
    """A string literal that reads the same under every setting of the SQL parser."""
    if value is None:
        return "cast(NULL AS string)"
    if "\\" in value or "'" in value:
        return f"decode(unhex('{value.encode().hex()}'), 'UTF-8')"
    return f"'{value}'"


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"
