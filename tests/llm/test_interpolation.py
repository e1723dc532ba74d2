"""Language-model scores against the same model in plain dicts."""

import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from __spark_entry__ import SMALLEST
from gridloom.llm import interpolation
from gridloom.llm.interpolation import interpolated_scores
from gridloom.llm.queries import QUERIES
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, train boolean, n string, row string, chunk long, score double"


def tokens(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower)), "</s> "]


def counts(texts):
    """N-grams of up to three tokens, and how often each context of one or two is followed by something."""
    grams, contexts = Counter(), Counter()
    for text in texts:
        said = ["<s> ", "<s> ", *tokens(text)]
        for i in range(2, len(said)):
            for k in (1, 2, 3):
                grams[tuple(said[i - k + 1:i + 1])] += 1
            for k in (1, 2):
                contexts[tuple(said[i - k:i])] += 1
    return grams, contexts


def size(grams):
    words = [n for g, n in grams.items() if len(g) == 1]
    return sum(words), len(words)


def pieces_of(text, grams, contexts, n):
    said = ["<s> ", "<s> ", *tokens(text)]
    for i in range(2, len(said)):
        pair, one = contexts[tuple(said[i - 2:i])], contexts[(said[i - 1],)]
        yield (grams[(said[i],)] / max(n, 1), grams[tuple(said[i - 1:i + 1])] / max(one, 1), grams[tuple(said[i - 2:i + 1])] / max(pair, 1),
               one.bit_length(), pair.bit_length())


def learn(held, grams, contexts):
    """Weights by expectation and maximisation, token by token."""
    n, v = size(grams)
    rows = [p for text in held for p in pieces_of(text, grams, contexts, n)]
    three, two, one = [0.0] + [0.5] * 63, [0.0] + [0.5] * 63, 0.5
    for _ in range(interpolation.ROUNDS if rows else 0):
        k3, n3, k2, n2, k1, n1 = Counter(), Counter(), Counter(), Counter(), 0.0, 0.0
        for m1, m2, m3, b2, b3 in rows:
            p1 = one * m1 + (1 - one) / (v + 1)
            p2 = two[b2] * m2 + (1 - two[b2]) * p1
            r3 = three[b3] * m3 / (three[b3] * m3 + (1 - three[b3]) * p2)
            r2 = two[b2] * m2 / p2
            k3[b3] += r3
            n3[b3] += 1
            k2[b2] += (1 - r3) * r2
            n2[b2] += 1 - r3
            k1 += (1 - r3) * (1 - r2) * one * m1 / p1
            n1 += (1 - r3) * (1 - r2)

        def filled(k, n):
            out, last = [0.0], 0.5
            for b in range(1, 64):
                if n[b] > 0:
                    last = min(max(k[b] / n[b], 1e-6), 1 - 1e-6)
                out.append(last)
            return out

        new3, new2, new1 = filled(k3, n3), filled(k2, n2), min(max(k1 / max(n1, 1e-300), 1e-6), 1 - 1e-6)
        change = max(abs(a - b) for a, b in zip([*new3, *new2, new1], [*three, *two, one]))
        three, two, one = new3, new2, new1
        if change < interpolation.ENOUGH:
            break
    return three, two, one


def brute(texts, train, held):
    """n_tokens, n_known, train_tokens, base_score and score of each text."""
    three, two, one = learn([t for t, h in zip(texts, held) if h], *counts(t for t, k, h in zip(texts, train, held) if k and not h))
    grams, contexts = counts(t for t, k in zip(texts, train) if k)
    n, v = size(grams)
    one = one if n else 0.0
    for text in texts:
        score = 0.0
        for m1, m2, m3, b2, b3 in pieces_of(text, grams, contexts, n):
            p = one * m1 + (1 - one) / (v + 1)
            p = two[b2] * m2 + (1 - two[b2]) * p
            score += math.log10(three[b3] * m3 + (1 - three[b3]) * p)
        said = [grams[(w,)] for w in tokens(text)]
        yield len(said), sum(c > 0 for c in said), n, sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in said), score


def check(got, expected):
    assert got[:3] == expected[:3]
    assert got[3:] == pytest.approx(expected[3:], rel=1e-9, abs=1e-9)


def held_ids(spark, ids):
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    return {r[0] for r in frame.where(f"pmod(xxhash64(doc_id, 13), {interpolation.HELD}) = 0").collect()}


def run(spark, texts, train):
    rows = [(i, t, k, "x", "y", 3, 0.5) for i, (t, k) in enumerate(zip(texts, train))]
    got = interpolated_scores(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("train"))
    assert got.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = {r[0]: tuple(r)[1:] for r in got.collect()}
    chosen = held_ids(spark, range(len(texts)))
    expected = list(brute(texts, [bool(k) for k in train], [bool(k) and i in chosen for i, k in enumerate(train)]))
    assert sorted(got) == list(range(len(texts)))
    for i, row in enumerate(expected):
        check(got[i], row)
    return got


def test_query(spark):
    """All given documents; the model tells them better than single words do, those set aside too."""
    rows = spark.read.parquet(f"{SMALLEST}/documents.parquet").orderBy("doc_id").collect()
    ids, texts = [r["doc_id"] for r in rows], [r["text"] for r in rows]
    train, chosen = [zlib.crc32(str(i).encode()) % 10 != 0 for i in ids], held_ids(spark, ids)
    got = {r["doc_id"]: r for r in QUERIES["op13_lm_scores"](spark, SMALLEST).collect()}
    assert sorted(got) == ids
    for i, k, row in zip(ids, train, brute(texts, train, [k and i in chosen for i, k in zip(ids, train)])):
        assert got[i]["held_out"] == (not k)
        check(tuple(got[i])[2:], row)
    held = [i for i, k in zip(ids, train) if not k]
    assert sum(got[i]["score"] for i in held) > sum(got[i]["base_score"] for i in held)


TEXTS = [None, "", " \t\n", "A", "a b", "the Cat sat", "the cat sat on the mat", "the dog sat", "the dog sat on the dog", "\x00 été ÉTÉ été", "</s> <s>"]


def test_edge_cases(spark):
    """Null, empty and repeated texts, unknown words, null in ``train``, clashing names."""
    texts = [t for t in TEXTS for _ in range(6)] + ["the cat " * k for k in range(40)]
    run(spark, texts, [[True, True, None, False, True, True][i % 6] for i in range(len(texts))])


@pytest.mark.parametrize("piece", [5, 40])
def test_pieces(spark, monkeypatch, piece):
    """Texts cut into many pieces and chunks score as if they were not."""
    monkeypatch.setattr(interpolation, "PIECE_BYTES", piece)
    monkeypatch.setattr(interpolation, "CHUNK_BYTES", 3 * piece)
    monkeypatch.setattr(interpolation, "RANGE_BYTES", 1000 * piece)
    texts = ["one two three four five six seven " * (1 + i % 5) + f"w{i % 3}" for i in range(30)] + TEXTS
    run(spark, texts, [i % 7 > 0 for i in range(len(texts))])


def test_nothing_to_learn_from(spark):
    got = run(spark, ["a b c", None], [False, None])
    assert got[0][:3] == (4, 0, 0) and got[0][3:] == (0.0, 0.0)
    run(spark, [], [])


def test_repeated_ids_and_null_ids(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "c"), (None, "a"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = interpolated_scores(docs, F.lit(True)).collect()
    assert sorted((r["doc_id"] is None, r["n_tokens"]) for r in got) == [(False, 2), (False, 3), (False, 3), (True, 1), (True, 2)]
    assert {r["train_tokens"] for r in got} == {11}


def traced(make):
    tracemalloc.start()
    try:
        found = make()
        return found, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def many_words(n, seed):
    return " ".join(f"{x:05x}" for x in np.random.default_rng(seed).integers(0, 1 << 18, n).tolist())


def test_room_for_the_ngrams_of_a_chunk():
    """A task has about three arrays of a chunk's n-grams (of 8 bytes each) at once, not six or more."""
    texts = [many_words(100_000, k) for k in range(4)]
    lead, last, train = np.zeros(4, np.int64), np.ones(4, bool), np.array([True, True, False, True])
    (names, n), most = traced(lambda: interpolation.Grams(pa.array(texts), lead, last).distinct(train))
    assert most < 5 * 24 * 400_000
    learned = Counter(t for k, text in enumerate(texts) if train[k] for t in text.split())
    assert sorted(n[names & np.uint64(3) == 1].tolist()) == sorted([*learned.values(), 3, *[0] * (len(set(texts[2].split()) - set(learned)))])
    assert (np.diff(names.astype(object)) > 0).all()


def test_room_for_a_range_of_ngrams():
    """Summing a range takes a few arrays of its n-grams, and finds the counts of the others in the order sent."""
    rng, size = np.random.default_rng(2), 100_000
    rows, own = [], []
    for chunk in range(4):
        names = np.unique(rng.integers(0, 1 << 17, size, dtype=np.uint64) << np.uint64(2)) + np.uint64(1)
        own.append(dict(zip(names.tolist(), rng.integers(0, 9, len(names)).tolist())))
        counts = np.array([*own[-1].values()])
        rows.append((chunk, 0, len(names), interpolation.packed(np.diff(names, prepend=np.uint64(0))), interpolation.packed(counts)))
    sent = pa.table({name: pa.array(c) for name, c in zip(("chunk", "at", "size", "names", "own"), zip(*rows))})
    told, most = traced(lambda: interpolation.sum_counts(sent))
    total, left = Counter(), Counter()
    for chunk, counts in enumerate(own):
        total.update(counts)
        left.update({} if chunk % 2 else counts)
    for chunk, row in enumerate(told.to_pylist()):
        assert interpolation.unpacked(row["others"], len(own[chunk])).tolist() == [total[x] - k for x, k in own[chunk].items()]
        if chunk % 2:
            assert interpolation.unpacked(row["rest"], len(own[chunk])).tolist() == [left[x] for x in own[chunk]]
        else:
            assert row["rest"] is None
    assert told["sums"][0].as_py() == [sum(total.values()), sum(x > 0 for x in total.values()), sum(total.values()) - sum(left.values()), sum(x > 0 for x in left.values())]
    assert most < 7 * 8 * sum(map(len, own))
