"""Texts kept in a table of their own and referred to by number."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Cells without a text to look up are spread this wide.
SPREAD = 1 << 20


def resolve_strings(cells: DataFrame, strings: DataFrame, index: str = "sid") -> DataFrame:
    """Sets ``str`` (and ``kind``) of the cells with an ``index`` from ``strings(file, idx, text)``.

    A text may be used by very many cells: these are the join's large side, whose skewed partitions Spark
    splits at run time. Where the table is small at run time the join becomes a broadcast and moves no cells.
    """
    salted = cells.selectExpr(
        "*",
        f"cast(pmod(xxhash64(sheet_idx, row, col), CASE WHEN {index} IS NOT NULL THEN 1 ELSE {SPREAD} END) AS int) AS _salt",
    )
    table = strings.selectExpr("file", f"idx AS {index}", "text AS _text", "0 AS _salt")
    changed = {
        "str": f"CASE WHEN {index} IS NOT NULL THEN _text ELSE str END",
        "kind": f"CASE WHEN {index} IS NOT NULL THEN 'str' ELSE kind END",
    }
    return salted.join(table, ["file", index, "_salt"], "left").selectExpr(
        *[f"{changed.get(c, c)} AS {c}" for c in cells.columns if c != index]
    )
