"""The network of the toxicity classifier against plain loops: its scores, and the slopes that it learns by."""

import numpy as np
import pyarrow as pa
import pytest

from gridloom.llm import toxicity
from gridloom.llm.toxicity import EACH, PAD, Network, word_ids
from tests.llm.test_operators import ODD, documents

TEXTS = ["one two three four", "", "vile", "plain words here", None, "vile words", "one two, three. four five six seven", " . "]


def plain(net):
    """The network's parameters, in double precision."""
    return {"words": net.words.astype(float), "out": net.out.astype(float), "bias": net.bias.astype(float),
            **{f"filter{f}": x.astype(float) for f, x in enumerate(net.filters)}, **{f"shift{f}": x.astype(float) for f, x in enumerate(net.shifts)}}


def logit(given, words):
    """Of one text, word by word; what lies beyond its end is nothing."""
    vectors = [sum(given["words"][k] for k in parts) for parts in words]
    total = given["bias"][0]
    for f in range(len(toxicity.FILTERS)):
        weights, shift = given[f"filter{f}"], given[f"shift{f}"]
        heard = [sum(vectors[p + j] @ weights[j] for j in range(len(weights)) if p + j < len(vectors)) for p in range(len(vectors))]
        if heard:
            total += np.maximum(0, np.max(heard, axis=0) + shift) @ given["out"][f * EACH:(f + 1) * EACH]
    return total


def loss(given, texts, labels, weight):
    z = np.array([logit(given, words) for words in texts])
    return float(np.mean(weight * (np.log1p(np.exp(z)) - labels * z)))


def lively():
    net, rng = Network(seed=3), np.random.default_rng(4)
    net.bias[:] = 0.3
    for shift in net.shifts:
        shift[:] = rng.normal(0, 0.1, EACH)
    return net


def split(ids, first):
    return [ids[a:b] for a, b in zip(first[:-1], first[1:])]


@pytest.mark.parametrize("texts", [TEXTS, TEXTS[::-1], ["vile"], [""], [None, ""], []])
def test_scores(texts):
    net = lively()
    ids, first = word_ids(pa.array(texts, pa.string()))
    assert np.allclose(net.logits(ids, first), [logit(plain(net), words) for words in split(ids, first)], atol=1e-5)


def test_slices(monkeypatch):
    """However texts are sliced, each has the score it has alone."""
    net = lively()
    texts = TEXTS * 5
    alone = np.concatenate([net.logits(*word_ids(pa.array([t], pa.string()))) for t in texts])
    for size in (1, 3, 7, 1 << 16):
        monkeypatch.setattr(toxicity, "SLICE_WORDS", size)
        assert np.allclose(net.logits(*word_ids(pa.array(texts))), alone, atol=1e-5)


def test_slopes():
    net = lively()
    ids, first = word_ids(pa.array(TEXTS))
    ids[5] = PAD  # a word that too few texts have
    texts, rng = split(ids, first), np.random.default_rng(5)
    labels, weight = np.array([0, 1, 1, 0, 0, 1, 0, 1.0]), rng.uniform(0.5, 2, len(TEXTS))
    given, found = plain(net), net.gradients(ids, first, labels, weight)
    owner = {id(net.words): "words", id(net.out): "out", id(net.bias): "bias"}
    owner |= {id(x): f"filter{f}" for f, x in enumerate(net.filters)} | {id(x): f"shift{f}" for f, x in enumerate(net.shifts)}
    assert sorted(owner[id(p)] for p, _, _ in found) == sorted(given)
    for param, grad, rows in found:
        whole = np.zeros(param.shape)
        whole[rows] = grad
        name = owner[id(param)]
        places = [tuple(p) for p in np.argwhere(np.abs(whole) > 0)] + [tuple(rng.integers(0, n) for n in param.shape) for _ in range(5)]
        for at in (places[k] for k in rng.permutation(len(places))[:40]):
            if name == "words" and at[0] == PAD:
                continue
            before, sides = given[name][at], []
            for step in (1e-6, -1e-6):
                given[name][at] = before + step
                sides.append(loss(given, texts, labels, weight))
            given[name][at] = before
            assert whole[at] == pytest.approx((sides[0] - sides[1]) / 2e-6, rel=2e-3, abs=2e-6), (name, at)


def test_training_lowers_the_loss():
    texts = split(*word_ids(pa.array([f"plain {w} words" + " vile" * (k % 2) for k, w in enumerate("abcdefgh" * 8)])))
    labels, net = np.array([0.0, 1.0] * 32), Network()
    before = loss(plain(net), texts, labels, 1)
    net.fit(texts, labels)
    assert loss(plain(net), texts, labels, 1) < before / 4
    assert not net.words[PAD].any()


def test_neighbours_change_no_score(spark):
    """A document's score is its text's alone, whatever documents it is read with."""
    docs = documents(spark, [*ODD, *((100 + k, f"plain w{k % 7} here" + " vile" * (k % 2), "en") for k in range(200))])
    labels = spark.createDataFrame([(100 + k, k % 2) for k in range(200)], "doc_id long, toxic int")
    model = toxicity.learn_toxicity(docs, labels)
    known = docs.where("doc_id >= 100")
    together = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(known.coalesce(1), model).collect()}
    apart = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(known.orderBy("text", "doc_id").repartition(7), model).collect()}
    assert together == pytest.approx(apart, abs=1e-5)


def test_all_labelled_documents_are_learned_from(spark):
    """Where there are more than the driver takes, tasks learn from every row: words, classes, languages and thresholds
    are those of all, however the rows are dealt, and what only few documents show is learned too."""
    rare = [(9000 + k, f"plain text here grim w{k % 11}", "en") for k in range(60)]
    rows = [(k, f"plain w{k % 7} here" + " vile" * (k % 4 == 0), ("en", "de")[k % 2]) for k in range(3000)] + rare
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(3000)] + [(i, 1) for i, _, _ in rare], "doc_id long, toxic int")
    found = []
    for frame in (docs.coalesce(1), docs.repartition(7)):
        model = toxicity.learn_toxicity(frame, labels, {1: 50, 0: 50})
        found.append({r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.score_toxicity(docs, model).collect()})
    assert all(found[0][i][0] == pytest.approx(found[1][i][0], abs=1e-5) for i in found[0])
    wrong = [i for i, (_, called) in found[0].items() if called != (i >= 9000 or i % 4 == 0)]
    assert len(wrong) <= 0.01 * len(rows)


def test_counts_of_what_is_learned_are_of_all_rows(spark, monkeypatch):
    """Counted in units of any size: rows of the table that are known, languages, thresholds."""
    rows = [(k, f"plain w{k % 400} here" + " vile" * (k % 2), ("en", "de", None)[k % 3]) for k in range(1200)]
    texts = documents(spark, rows)
    known = spark.createDataFrame([(k, k % 2) for k in range(1200)], "doc_id long, label int")
    monkeypatch.setattr(toxicity, "ROUNDS", 1)
    monkeypatch.setattr(toxicity, "UNIT_ROWS", 100)
    spread = toxicity.SpreadToxicity(texts, known, {0: 600, 1: 600})
    units = [u for b in spread.units.toArrow().to_batches() for u in toxicity.units_of(b)]
    assert len(units) > 3 and sum(len(u["labels"]) for u in units) == 1200
    seen = np.zeros(PAD + 1, int)
    for u in units:
        for d in np.flatnonzero(~u["aside"]):
            seen[np.unique(u["ids"][u["first"][d]:u["first"][d + 1]])] += 1
    model = spread.model()
    assert ((model.network.known == PAD) == (seen < toxicity.SEEN)).all()
    own = [(word_ids(pa.array([t]))[0], lang) for _, t, lang in rows]
    assert np.allclose(model.languages.weights, toxicity.Languages(*zip(*own)).weights)


def test_thresholds_of_counted_logits():
    rng = np.random.default_rng(7)
    labels, counts = rng.integers(0, 2, 200), rng.integers(1, 5, 200)
    logits = np.round(rng.normal(0, 2, 200) + labels, 1)
    whole = toxicity.best_threshold(np.repeat(logits, counts), np.repeat(labels, counts).astype(float), np.ones(counts.sum()))
    called = toxicity.counted_threshold(logits, labels, counts.astype(float))

    def f1(at):
        hit = counts[(logits > at) & (labels == 1)].sum()
        return 2 * hit / (counts[logits > at].sum() + counts[labels == 1].sum())

    assert f1(called) == f1(whole) == max(f1(x) for x in [*logits, -100])
