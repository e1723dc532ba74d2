"""Every query against its SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import SMALLEST, entry, oracle_sql, queries
from contract.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALLEST}/{t}.parquet'")
    return con


def shape(pdf: pd.DataFrame) -> list:
    pdf = pdf[sorted(pdf.columns)]

    def plain(x):
        if x is None or pd.isna(x):
            return None
        if hasattr(x, "item"):
            x = x.item()
        if isinstance(x, float):
            return int(x) if x.is_integer() else round(x, 6)
        return x if isinstance(x, (int, bool, str)) else str(pd.Timestamp(x))

    return sorted((tuple(plain(x) for x in r) for r in pdf.itertuples(index=False)), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = queries()[name](spark, SMALLEST).toPandas()
    expected = duck.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert shape(got) == shape(expected)


def test_entry(spark):
    # The smallest tables hold orders of all three years.
    assert entry(spark).count() == 3
