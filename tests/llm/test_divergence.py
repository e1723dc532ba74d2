"""Distances between sources and their overused terms, against plain loops."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridloom.llm import divergence
from gridloom.llm.divergence import source_divergence

SCHEMA = "doc_id long, text string, lang string, source string, value string, rank string"


def brute(rows, min_docs, top):
    """Part, item, value and rank of each group, worked out term by term."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        groups[lang].add(source)
        count[lang, source].update(words)
        seen[lang].update(set(words))
    out = set()
    for lang, sources in groups.items():
        kept = {w for w, n in seen[lang].items() if n >= min_docs}
        whole = sum((count[lang, s] for s in sources), Counter())

        def shares(c):
            n = sum(c[w] for w in kept)
            return {w: 1 + 10**9 * (c[w] + 5) // (n + 5 * len(kept)) for w in kept}

        p, q = {s: shares(count[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = [(-sum(abs(p[s][w] - p[o][w]) for w in kept), o.encode()) for o in sources if o != s]
            terms = [(q[w] - p[s][w], w.encode()) for w in kept if count[lang, s][w] and p[s][w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(found)}
    return out


def found(spark, rows, min_docs, top):
    docs = spark.createDataFrame([(i, *r, "x", "y") for i, r in enumerate(rows)], SCHEMA)
    got = source_divergence(docs.repartition(3), min_docs, top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    return [tuple(r) for r in got.collect()]


def texts(seed, n, sources, words):
    rng = np.random.default_rng(seed)
    for _ in range(n):
        lang = ["de", "en"][rng.integers(2)]
        s = int(rng.integers(sources) * rng.random())
        yield " ".join(words[int(k * rng.random())] for k in rng.integers(1, len(words), rng.integers(0, 30))), lang, f"s{s}"


WORDS = ["Straße", "strasse", "ZEBRA", "zebra", "été", "a", "b", "c", "\U0001f600", "￮", "don't", "x1y", "z" * 500, *[f"w{chr(97 + i)}" for i in range(26)]]


@pytest.mark.parametrize("block,held", [(512, 1 << 18), (2, 16)])
def test_brute_force(spark, monkeypatch, block, held):
    """Also where sources take several blocks, and tasks hand on what they hold after a few rows."""
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "CHUNK_ROWS", 20 if block == 2 else 100_000)
    monkeypatch.setattr(divergence, "HELD_ROWS", held)
    monkeypatch.setattr(divergence, "HELD_BYTES", 1 << 25 if held > 100 else 100)
    rows = [*texts(1, 300, 6, WORDS), (None, None, None), ("", "xx", None), ("only one", "fr", "s1"), *[("Copy copy", "en", "s0")] * 5]
    for min_docs, top in ((3, 4), (1, 2), (10_000, 5)):
        got = found(spark, rows, min_docs, top)
        assert len(got) == len(set(got)) and set(got) == brute(rows, min_docs, top)


def test_ties(spark):
    """Terms with the same counts rank in UTF-8 order, which is not that of UTF-16."""
    rows = [("\U0001f600 ￮ z a", "en", "s0"), ("b b b b b b", "en", "s1")]
    assert set(found(spark, rows, 1, 3)) == brute(rows, 1, 3)
    assert [r[3] for r in sorted(found(spark, rows, 1, 4), key=lambda r: r[5]) if r[1:3] == ("s0", "term")] == ["a", "z", "￮", "\U0001f600"]


def test_empty(spark):
    assert found(spark, [], 1, 5) == []
    assert found(spark, [(None, "en", "s0")], 1, 5) == []


def test_long_text(spark):
    rows = [("ab cd " * 400_000, "en", "s0"), ("ab x", "en", "s1")]
    assert set(found(spark, rows, 1, 5)) == brute(rows, 1, 5)


@pytest.mark.parametrize("seed", range(20))
def test_skyband(seed):
    """The points dominated by fewer than k others, also when merged from parts."""
    rng = np.random.default_rng(seed)
    size, k = int(rng.integers(1, 900)), int(rng.integers(1, 8))
    n, total = rng.integers(0, 12, size), rng.integers(0, 12, size)
    place = rng.permutation(size)
    over = (n >= n[:, None]) & (total <= total[:, None]) & (place < place[:, None])
    expected = set(np.flatnonzero(over.sum(axis=1) < k).tolist())
    assert set(divergence.skyband(n, total, place, k).tolist()) == expected
    parts = [np.arange(i, size, 3) for i in range(3)]
    some = np.concatenate([p[divergence.skyband(n[p], total[p], place[p], k)] for p in parts])
    assert set(some[divergence.skyband(n[some], total[some], place[some], k)].tolist()) == expected
