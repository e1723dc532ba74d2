"""Whitening against numpy on whole vectors in Python's integers."""

import math

import numpy as np
import pytest

from __spark_entry__ import SMALLEST
from gridloom.llm import whitening
from gridloom.llm.queries import QUERIES
from gridloom.llm.whitening import whitened_vectors

SCHEMA = "vec_id long, embedding array<double>, id long, x string, at long, v double"


def brute(vectors, components):
    """(n, parts, {place: (deviation, projections)}) by numpy over the distinct whole vectors."""
    whole = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in enumerate(vectors)
             if v and all(c is not None and math.isfinite(c) and abs(64 * c) < 2**62 for c in v)}
    sizes = [len(x) for x in whole.values()]
    dim = max(set(sizes), key=lambda d: (sizes.count(d), d), default=0)
    whole = {i: x for i, x in whole.items() if len(x) == dim}
    fit = sorted({tuple(x) for x in whole.values()})
    n = len(fit)
    if not n:
        return 0, [], {}
    sums = [sum(c) for c in zip(*fit)]
    far = {i: [n * c - s for c, s in zip(x, sums)] for i, x in whole.items()}
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in fit]).reshape(n, -1)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-11 * values.sum()).sum()))
    out = {i: (sum(d * d for d in f), np.array([d / n for d in f]) @ axes[:, :k] / np.sqrt(values[:k])) for i, f in far.items()}
    return n, values[:k] / max(values.sum(), 1e-300), out


def check(spark, vectors, components=16):
    rows = [(i, v, -i, "x", 7, 0.5) for i, v in enumerate(vectors)]
    got = whitened_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), components)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.toPandas()
    n, parts, expected = brute(vectors, components)
    if not len(parts):
        assert not len(got)
        return got
    assert set(got.n) == {n} and sorted(got.vec_id.unique()) == sorted(expected) and len(got) == len(expected) * len(parts)
    assert got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-4
    mine = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    theirs = np.array([expected[i][1] for i in sorted(expected)])
    sign = np.sign((mine * theirs).sum(axis=0))
    assert np.allclose(mine * sign, theirs, atol=1e-7)
    assert np.allclose(got.groupby("component").explained.first(), parts, rtol=1e-4)
    for i, d in zip(got.vec_id, got.deviation):
        exact = expected[i][0]
        assert int(d) == exact if exact < 2**63 else d is None or math.isnan(d)
    return got


def random_vectors(seed, n, dim, spread=1.0):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, dim)) * np.linspace(spread, 0.2, dim)).tolist()


def test_query(spark):
    """All given vectors, as the contract asks."""
    rows = spark.read.parquet(f"{SMALLEST}/embeddings.parquet").orderBy("vec_id").collect()
    n, parts, expected = brute([r["embedding"] for r in rows], 16)
    got = QUERIES["op12_whitening"](spark, SMALLEST).toPandas().sort_values(["vec_id", "component"])
    assert set(got.n) == {n} and len(got) == 16 * len(expected) and got.identity_error.max() < 1e-4
    assert got.deviation.tolist() == [expected[i][0] for i in sorted(expected) for _ in range(16)]
    mine = got.whitened.to_numpy().reshape(-1, 16)
    theirs = np.array([expected[i][1] for i in sorted(expected)])
    assert np.allclose(mine * np.sign((mine * theirs).sum(axis=0)), theirs, atol=1e-7)
    assert np.allclose(got.explained.to_numpy()[:16], parts, rtol=1e-4)


def test_left_out_and_repeated(spark):
    bad = [None, [], [None] * 5, [1.0, math.nan, 0.0, 0.0, 0.0], [math.inf] * 5, [1e300] * 5, [1.0, 2.0], [1.0] * 7]
    given = random_vectors(1, 60, 5)
    check(spark, [*given, *bad, *given[:3] * 4, *[given[7]] * 30])


def test_fewer_components(spark):
    assert check(spark, random_vectors(2, 40, 6), 3).component.max() == 3
    flat = [[a, a, 1.0] for a, in random_vectors(3, 30, 1, 5.0)]  # one direction only
    assert set(check(spark, flat).component) == {1}


def test_blocks(spark, monkeypatch):
    """Small blocks, dealt to several tasks, and rows over several block matrices."""
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 16)
    monkeypatch.setattr(whitening, "TASK_ENTRIES", 32)
    monkeypatch.setattr(whitening, "MATRIX_ROWS", 24)
    check(spark, random_vectors(4, 90, 4))


def test_large_entries(spark):
    """Sums and squares beyond 64 bits: exact, or null where the result does not fit."""
    check(spark, [[c * 3e16 for c in v] for v in np.clip(random_vectors(5, 50, 3), -2, 2).tolist()])


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, []]])
def test_nothing_to_whiten(spark, vectors):
    check(spark, vectors)
