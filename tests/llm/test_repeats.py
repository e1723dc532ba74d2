"""Repeated passages against every pair of stretches compared."""

import random
from collections import defaultdict

import pytest

from gridloom.llm.repeats import LEAST, cut_repeats, repeated_passages


def brute(rows):
    """{id: (repeated words, words that can go)} by a table of all stretches."""
    words = [(i, (t or "").lower().split()) for i, t in rows]
    where = defaultdict(set)
    for i, w in words:
        for s in range(len(w) - LEAST + 1):
            where[tuple(w[s:s + LEAST])].add((i, s))
    under, later, first = defaultdict(set), defaultdict(set), defaultdict(set)
    for places in where.values():
        if len(places) > 1:
            for i, s in places:
                span = range(s, s + LEAST)
                under[i].update(span)
                (first if (i, s) == min(places) else later)[i].update(span)
    return {i: (under[i], later[i] - first[i]) for i in under}


def corpus(seed=3):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdef") for _ in range(3))
    passages = [[word() for _ in range(n)] for n in (50, 51, 60, 120, 49, 300)]
    rows = []
    for i in range(160):
        w = [word() for _ in range(rnd.randint(0, 200))]
        for _ in range(rnd.randint(0, 2)):
            p = rnd.choice(passages)
            a = rnd.randint(0, max(0, len(p) - 55)) if rnd.random() < 0.4 else 0
            at = rnd.randint(0, len(w))
            w[at:at] = p[a:a + rnd.randint(45, 400)]
        rows.append((i, rnd.choice([" ", "\n"]).join(w)))
    line = " ".join(word() for _ in range(20))
    rows += [(200, " ".join([line] * 12)), (201, line), (202, rows[7][1]), (203, rows[7][1].upper()), (204, None), (205, ""), (206, " \n")]
    return rows


def spread(spans):
    return {p for x in spans for p in range(x["start"], x["start"] + x["length"])}


@pytest.mark.parametrize("parts", [1, 7])
def test_repeats_and_cuts(spark, parts):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, at int, h long, cuts int").repartition(parts)
    found = {r["doc_id"]: r for r in repeated_passages(docs).collect()}
    expected = brute(rows)
    assert set(found) == set(expected)
    for i, (under, gone) in expected.items():
        assert spread(found[i]["repeats"]) == under
        assert spread(found[i]["cuts"]) == gone


def test_cutting_leaves_one_of_each(spark):
    rows = corpus(5)
    docs = spark.createDataFrame(rows + [(None, "x")], "doc_id long, text string")
    left = {r["doc_id"]: r["text"] for r in cut_repeats(docs, repeated_passages(docs)).collect()}
    assert len(left) == len(rows) + 1 and left[None] == "x"
    for i, t in rows:
        gone = brute(rows).get(i, (set(), set()))[1]
        kept = [w for k, w in enumerate((t or "").split()) if k not in gone]
        assert (left[i] or "").split() == kept
        assert gone or left[i] == t


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repeated_passages(docs).collect() == []
