"""Formula cells: their stored result, or their text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.cells import cell
from gridloom.functions.references import shift_formula

# Cells without a shared formula are spread this wide.
SPREAD = 1 << 20


def formula_view(grid: DataFrame, evaluate: bool) -> DataFrame:
    """``evaluate``: formula cells show the result stored with them; otherwise they show their text."""
    if evaluate:
        return grid
    shown = cell("c.col", "formula", str="c.formula", formula="c.formula")
    as_text = f"transform(cells, c -> CASE WHEN c.formula IS NOT NULL THEN {shown} ELSE c END)"
    return grid.withColumn("cells", F.expr(as_text))


def shift_references(text: Column, rows: Column, cols: Column) -> Column:
    """Formula text with its relative references moved; an Arrow-batched Python function."""

    @F.pandas_udf("string")
    def moved(text: pd.Series, rows: pd.Series, cols: pd.Series) -> pd.Series:
        return pd.Series(
            [shift_formula(t, int(r), int(c)) if t is not None else None for t, r, c in zip(text, rows, cols)],
            dtype=object,
        )

    return moved(text, rows, cols)


def expand_shared_formulas(cells: DataFrame, group: str = "shared_id") -> DataFrame:
    """Gives every member of a shared formula its own text.

    The one cell of a group that has the text is joined to the others, and the text moved by the distance
    between them. One formula may cover a whole column: the members are the join's large side, whose skewed
    partitions Spark splits at run time, however large they are.
    """
    keys = ["file", "sheet_idx", group]
    salted = cells.selectExpr(
        "*", f"cast(pmod(xxhash64(row, col), CASE WHEN {group} IS NOT NULL THEN 1 ELSE {SPREAD} END) AS int) AS _salt"
    )
    masters = (
        cells.filter(f"{group} IS NOT NULL AND formula IS NOT NULL")
        .groupBy(*keys)
        .agg(F.expr("min(named_struct('row', row, 'col', col, 'formula', formula)) AS _m"))
        .selectExpr(*keys, "_m", "0 AS _salt")
    )
    joined = salted.join(masters, [*keys, "_salt"], "left").withColumn(
        "_moved",
        shift_references(F.expr("CASE WHEN formula IS NULL THEN _m.formula END"),
                         F.expr("coalesce(row - _m.row, 0)"), F.expr("coalesce(col - _m.col, 0)")),
    )
    return joined.selectExpr(*["coalesce(formula, _moved) AS formula" if c == "formula" else c for c in cells.columns])
