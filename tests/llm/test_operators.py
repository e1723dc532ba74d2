"""Unusual rows: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

import public_tokenizers
from gridloom.llm import neardup
from gridloom.llm.bloom import build_bits, log_blocks, probe
from gridloom.llm.chat import TEMPLATE, digest_conversations, format_conversations
from gridloom.llm.components import components
from gridloom.llm.decontaminate import decontaminate
from gridloom.llm.language import identify_languages, learn_profiles
from gridloom.llm.neardup import REGISTERS, check_pairs, merged, near_duplicates, similarity, sketch
from gridloom.llm.packing import best_cuts, pack
from gridloom.llm.templates import TemplateError, compile_template, escape, escape_line, parse, unescape
from gridloom.llm.tokens import LibraryTokenizer, WordTokenizer, count_tokens, spliced_count, splits_at_white_space
from gridloom.llm.topk import QueryBlock, augmented, distances, top_k
from gridloom.llm.toxicity import learn_toxicity, score_toxicity
from gridloom.llm.urls import judge_urls

LOWERED = {c: c + 32 for c in range(65, 91)}
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

#: Columns that operators use names like.
CLASH = ("h", "n", "rep", "ids", "block", "component_id", "cuts", "_text")


def documents(spark, rows):
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} int" for c in CLASH)
    return spark.createDataFrame([(*r, None, "s", *range(len(CLASH))) if len(r) == 2 else (*r, "s", *range(len(CLASH))) for r in rows], schema)


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (4, "one two"), (None, "one two three four five six"), (5, "é" * 3000), (6, "x y " * 9000)]


def test_rules(spark):
    rules = spark.createDataFrame([("com", "/", "allow"), ("b.com", "/x/", "block"), ("b.com", "/x/", "block"), ("a.b.com", "/x/y", "allow"),
                                   (None, "/", "block"), ("t.org", "", "allow"), ("t.org", "", "block")], "host string, path string, verdict string")
    urls = ["http://A.b.COM/x/y?q", "http://b.com/x/", "ftp://xb.com/x/#f", "http://b.com", "no scheme", None, "", "http://t.org?x", "b://t.org/",
            "http://u.t.org/é", "http://b.com/x/", "://.com/", "http://b.com/x/" + "a" * 9000]
    pages = spark.createDataFrame([(k, u, "r", "v") for k, u in enumerate(urls)], "page_id long, url string, rule string, verdict string")
    got = {r["page_id"]: (r["host"], r["rule"], r["verdict"]) for r in judge_urls(pages, rules, default="allow").collect()}
    assert got == {
        0: ("a.b.com", "a.b.com/x/y", "allow"), 1: ("b.com", "b.com/x/", "block"), 2: ("xb.com", "com/", "allow"), 3: ("b.com", None, "allow"),
        4: ("", None, "allow"), 5: ("", None, "allow"), 6: ("", None, "allow"), 7: ("t.org", "t.org", "block"), 8: ("t.org", "t.org", "block"),
        9: ("u.t.org", "t.org", "block"), 10: ("b.com", "b.com/x/", "block"), 11: (".com", "com/", "allow"), 12: ("b.com", "b.com/x/", "block"),
    }
    assert judge_urls(pages.limit(0), rules).count() == 0
    assert judge_urls(pages, rules.limit(0)).where("rule IS NOT NULL").count() == 0


def test_bloom(spark):
    rng = np.random.default_rng(1)
    keys = rng.integers(-2**63, 2**63 - 1, 20_000)
    power = log_blocks(len(keys))
    bits = build_bits(spark.createDataFrame([(int(k),) for k in keys[:4000]] + [(None,)], "h long"), power)
    assert probe(bits, power, keys[:4000].view(np.uint64)).all()
    assert probe(bits, power, keys[4000:].view(np.uint64)).mean() < 0.01


def found_by_hand(docs, items, n=10):
    words = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWERED))
    windows = {}
    for item, text in items:
        b = words(text)
        for k in range(max(1, len(b) - n + 1) if b else 0):
            windows.setdefault(tuple(b[k:k + n]), set()).add(item)
    out = []
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for s in range(len(w) - size + 1):
                if found := windows.get(tuple(w[s:s + size])):
                    hit.update(range(s, s + size))
                    names |= found
        out.append((i, len(w), len(hit), sorted(names)))
    return sorted(out, key=repr)


def test_leaks(spark, monkeypatch):
    rnd = random.Random(2)
    word = lambda: rnd.choice("ab cd ef gh the of in é 12 Xy".split())
    items = [(k, " ".join(word() for _ in range(rnd.choice([1, 3, 9, 10, 11, 14])))) for k in range(12)] + [(50, ""), (51, None), (52, ". , !")]
    items[0] = (0, "the the the the the the the the the the the")
    docs = [(i, " ".join(word() for _ in range(rnd.randint(0, 60)))) for i in range(40)]
    docs += [(100 + k, "x " + t.upper() + ", y") for k, (_, t) in enumerate(items) if t] + [(200, None), (201, ""), (7, "the " * 30), (202, "the")]
    given = spark.createDataFrame([(i, t, 1) for i, t in docs] + [(None, items[1][1], 1)], "doc_id long, text string, block int")
    tests = spark.createDataFrame([*items, (None, "ab cd")], "item_id long, text string")

    def got(**options):
        rows = decontaminate(given, tests, **options).collect()
        return sorted(((r["doc_id"], r["n_words"], sum(x["length"] for x in r["hits"]), r["items"]) for r in rows), key=repr)

    expected = found_by_hand(docs, items)
    assert got() == expected
    monkeypatch.setattr("gridloom.llm.decontaminate.PASS_BYTES", 100)
    monkeypatch.setattr("gridloom.llm.decontaminate.BLOCK_WORDS", 50)
    assert got() == expected
    assert decontaminate(given, tests.limit(0)).where("size(items) > 0").count() == 0
    assert decontaminate(given.limit(0), tests).count() == 0


def test_near_words(spark):
    docs = spark.createDataFrame([(1, "q b x a y c z"), (2, "a q q q q q q q b c"), (3, "c b a")], "doc_id long, text string")
    tests = spark.createDataFrame([(9, "a b c")], "item_id long, text string")
    near = decontaminate(docs, tests, reach=3).where("size(items) > 0").select("doc_id").collect()
    assert sorted(r[0] for r in near) == [1, 3]


def test_language_of_odd_texts(spark):
    docs = documents(spark, [(i, t, "en" if i == 4 else None) for i, t in ODD] + [(9, "123 456 .", "en"), (10, "der die das und nicht", "de")])
    rows = identify_languages(docs, learn_profiles(docs), keep=("h", "source")).collect()
    assert len(rows) == len(ODD) + 2
    found = {r["doc_id"]: r for r in rows}
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (1, 2, 3, 9))
    assert found[4]["lang_pred"] == "en" and found[10]["lang_pred"] == "de" and found[10]["source"] == "s"
    nothing = identify_languages(docs, learn_profiles(docs.where("false"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").lower())
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def linked_by_hand(rows, num, den):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]) > 0:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("similar", [(85, 100), (80, 100)])
def test_near_duplicates(spark, similar):
    """Groups whose members are often near the first text only, or near each other only."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    rows, i = [], 10
    for size in (1, 2, 3, 8, 60, 150):
        base = [word() for _ in range(rnd.choice([30, 120, 160]))]
        for _ in range(size):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 3, 4, 6])):
                w[rnd.randrange(len(w))] = word()
            rows.append((i, " ".join(w)))
            i += rnd.randint(1, 3)
            if rnd.random() < 0.3:
                base = w
    rnd.shuffle(rows)
    rows += [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One\ttwo"), (6, "one two three"), (7, "a b c d e"), (8, "A b c d e")]
    docs = documents(spark, [*rows, (None, rows[0][1])]).repartition(5)
    got = {r["doc_id"]: r for r in near_duplicates(docs, similar).collect()}
    expected = linked_by_hand(rows, *similar)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == expected
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())
    assert near_duplicates(docs.limit(0)).count() == 0


def test_sketches():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 4000).astype(np.uint64)
    for share in (0.2, 0.5, 0.85):
        b = np.concatenate([a[:int(4000 * 2 * share / (1 + share))], rng.integers(0, 2**63, 4000 - int(4000 * 2 * share / (1 + share))).astype(np.uint64)])
        best, may = similarity(sketch(a), sketch(b), 4000, 4000, 0.85)
        assert abs(best - share) < 0.15 and may == (share == 0.85)
    assert (merged(sketch(a[:100]), sketch(a[50:])) == sketch(a)).all() and len(sketch(a)) == REGISTERS


def test_components(spark):
    path = [(k, k + 1) for k in range(0, 30)] + [(50, 40), (60, 40), (61, 60), (7, 7), (0, 1)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(31)} | {40: 40, 50: 40, 60: 40, 61: 40}


@pytest.mark.parametrize("big, held", [(1, 1 << 20), (10**7, 1 << 20), (1, 2000)])
def test_top_k(spark, monkeypatch, big, held):
    monkeypatch.setattr("gridloom.llm.topk.QUERIES", 7)
    monkeypatch.setattr("gridloom.llm.topk.HELD", held)
    monkeypatch.setattr("gridloom.llm.topk.ANNULUS", 16)
    rng = np.random.default_rng(5)
    rows = [(int(k), [float(x) for x in v]) for k, v in zip(range(0, 600, 2), rng.normal(0, 0.3, (300, 6)) * big)]
    rows += [(k, rows[5][1]) for k in range(1001, 1100)]  # ties, many
    plain = list(rows)
    rows += [(7001, None), (7020, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (7040, [float("nan")] * 6), (7060, [float("inf")] * 6), (7080, []), (None, [1.0] * 6), (7100, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("vec_id", "embedding", "1 AS dim", "2 AS v")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in top_k(frame, "vec_id % 20 = 0").collect()}
    whole = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in plain]
    expected = {}
    for q, v in whole:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in whole if i != q)[:20]
            expected |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(scored)}
    assert got == expected
    assert top_k(frame.limit(0), "vec_id % 20 = 0").count() == 0


def test_walk_stops():
    """A query looks at its nearest annuli first, and at none after the first whose bound is beyond its k-th best."""
    vectors = np.column_stack([np.arange(400.0), np.zeros(400)])
    space = {"largest": 399.0**2, "sample": np.zeros((0, 2)), "ids": np.zeros(0, np.int64)}
    points = augmented(vectors, space["largest"])
    space["pivots"] = points[399:]
    away = distances(points, space["pivots"])[:, 0]
    order = np.argsort(away)
    rows = [{"pivot": 0, "low": away[own[0]], "high": away[own[-1]], "ids": own.tobytes(), "vectors": vectors[own].tobytes()}
            for own in np.split(order, 40)]
    block, seen = QueryBlock(np.array([399]), vectors[399:], space, 5), []
    look = block.visit
    block.visit = lambda row, open_: (seen.append(rows.index(row)), look(row, open_))
    block.walk(rows[::-1])
    assert block.found[0][:, 1].tolist() == [398, 397, 396, 395, 394]
    assert seen == list(range(len(seen))) and len(seen) < len(rows) / 2


def test_templates():
    say = compile_template("{% for m in messages %}{{ loop.index }}{% if m.role == 'a' and not loop.last %}<{% generation %}{{ m['text'] | upper }}{% endgeneration %}>"
                           "{% elif m.role in 'xy' %}x{% else %}-{% endif %}{%- set k = 'v' ~ 1 -%}{{ k }}\n{% endfor %}")
    made = list(say([{"role": "a", "text": "hi"}, {"role": "x"}, {"role": "a", "text": "no"}]))
    assert "".join(t for t, _ in made) == "1<HI>v1\n2xv1\n3-v1\n" and [t for t, learn in made if learn] == ["HI"]
    assert parse("a{{ 'b' + 'c' | upper }}{% if 1 == 2 %}x{% else %}y{% endif %}")[0].text == "abCy"  # folded into one text
    for bad in ("{% for x in y %}", "{{ x.__class__ | open }}", "{{ 1 + 'a' }}", "{% import os %}", "{{ a b }}", "{{ (a }}"):
        with pytest.raises(TemplateError):
            compile_template(bad)
    assert list(compile_template("{{ x.__class__ }}{{ x['upper'] }}")([], x="text")) == [("", False), ("", False)]
    for text in ("<|im_end|>", "\\<|", "a\\nb\n", "<\\|", "\\", "<<||>"):
        assert unescape(escape(text)) == text and unescape(escape_line(text)) == text
        assert "<|" not in escape(text) and "\n" not in escape_line(text)


def test_odd_conversations(spark):
    rows = [(1, 1, "user", "b"), (1, 0, "user", None), (1, 0, "user", "a"), (1, None, "system\n<|im_end|>", "s"), (None, 0, "assistant", "n\\"), (2, 0, None, ""),
            (3, 0, "assistant", "<|im_end|>\n"), (3, 0, "assistant", "<|im_end|>\n"), (4, 0, "assistant", "é" * 100_000)]
    talks = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")
    got = {r["conv_id"]: r for r in digest_conversations(format_conversations(talks)).collect()}
    assert {i: (r["n_turns"], r["loss_chars"]) for i, r in got.items()} == {1: (4, 0), None: (1, 2), 2: (1, 0), 3: (2, 22), 4: (1, 100_000)}
    text = "".join(r["text"] for r in format_conversations(talks).where("conv_id = 1").orderBy("part").collect())
    assert text.count("<|im_start|>") == text.count("<|im_end|>") == 4 and text.index("system") < text.index("user\na") < text.index("user\nb")
    assert digest_conversations(format_conversations(talks.limit(0), TEMPLATE)).count() == 0


def test_cuts():
    rnd = random.Random(6)
    for _ in range(100):
        n = rnd.randint(2, 30)
        places = np.cumsum([0] + [rnd.randint(1, 9) for _ in range(n)])
        costs = np.array([0] + [rnd.randint(0, 9) for _ in range(n - 1)] + [0])
        best = [0] + [10**9] * n
        for j in range(1, n + 1):
            for i in range(j):
                if places[j] - places[i] <= 12:
                    best[j] = min(best[j], best[i] + 12 - int(places[j] - places[i]) + int(costs[j]))
        cuts = best_cuts(places, costs, 12)
        where = {int(p): k for k, p in enumerate(places)}
        assert sum(12 - (b - a) + int(costs[where[b]]) for a, b in zip(cuts, cuts[1:])) == best[n]
        assert max(np.diff(cuts)) <= 12


def test_packing_of_odd_texts(spark):
    pieces = pack(documents(spark, ODD), WORD_BPE, end_id=2, window=64).collect()
    whole = LibraryTokenizer(WORD_BPE)
    expected = sorted(len(x) + 1 for x in whole.encode_batch(pa.array([t or "" for _, t in ODD])))
    assert sorted(p["doc_tokens"] for p in pieces if p["start"] == 0) == expected
    assert sum(p["length"] for p in pieces) == sum(expected) and max(p["offset"] + p["length"] for p in pieces) <= 64
    sizes = {}
    for p in pieces:
        sizes[p["sequence_id"]] = sizes.get(p["sequence_id"], 0) + p["length"]
    padding = sum(64 - n for n in sizes.values() if n & (n - 1))
    assert padding < 0.05 * sum(expected)
    assert pack(documents(spark, ODD).limit(0), WORD_BPE, end_id=2).count() == 0


def test_words_as_the_library_encodes_them():
    assert splits_at_white_space(WORD_BPE)
    assert not any(splits_at_white_space(public_tokenizers.path(x)) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    words, library = WordTokenizer(WORD_BPE), LibraryTokenizer(WORD_BPE)
    rnd = random.Random(7)
    texts = ["A. b, c!, d.,e <|endoftext|>x. é. ×. It's. don't, 3.5, a\x1cb", " ", "", "<|ENDOFTEXT|>. a", "İx İ. ", "क़क b", "½ ²a", "J̌. b"]
    texts += ["".join(rnd.choice("ab .,\n!'é×<|>3Ś ̀Ǆß日本") for _ in range(60)) for _ in range(800)]
    given = pa.array([*texts, None])
    assert [x.tolist() for x in words.encode_batch(given)] == [x.tolist() for x in library.encode_batch(given)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_splicing(name):
    path = public_tokenizers.path(name)
    for tokenizer in {WordTokenizer, LibraryTokenizer} if name.startswith("word") else {LibraryTokenizer}:
        tokenizer = tokenizer(path)
        for text in ("The quick, brown-ish fox's den.\n" * 300, "x" * 4000, "ab " * 900 + "y" * 2000 + " z" * 10, " " * 2500 + "a", "é ß 日本 <|endoftext|> " * 90):
            (n,) = tokenizer.count_batch(pa.array([text]))
            for chunk, overlap in ((1000, 64), (500, 8), (300, 1)):
                assert spliced_count(tokenizer, text, chunk, overlap)[0] == n


def test_counts_of_odd_texts(spark):
    rows = count_tokens(documents(spark, ODD), WORD_BPE, chunk=500, overlap=20).collect()
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in rows) == sorted(
        (len((t or "").encode()), len(x)) for (_, t), x in zip(ODD, LibraryTokenizer(WORD_BPE).encode_batch(pa.array([t for _, t in ODD]))))
    assert max(r["n_chunks"] for r in rows) > 10


def test_toxicity_of_odd_texts(spark):
    docs = documents(spark, [*ODD, *((100 + k, "plain words here" + " vile" * (k % 2), "en") for k in range(200))])
    labels = spark.createDataFrame([(100 + k, k % 2, 1) for k in range(200)] + [(None, 1, 1), (1, 1, 1), (4, None, 1), (4, 7, 1)], "doc_id long, toxic int, text int")
    rows = score_toxicity(docs, learn_toxicity(docs, labels)).collect()
    assert len(rows) == len(ODD) + 200 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["doc_id"] % 2) for r in rows if r["doc_id"] and r["doc_id"] >= 100)
    untaught = score_toxicity(docs, learn_toxicity(docs, labels.where("toxic = 0"))).collect()
    assert {(r["score"], r["predicted"]) for r in untaught} == {(0.0, 0)}


@pytest.mark.parametrize("n, other, both, similar", [(1000, 1171, 998, (85, 100)), (1000, 1245, 998, (80, 100))])
def test_links_at_the_largest_similarity_their_sizes_allow(n, other, both, similar):
    """Sizes whose ratio is just above the threshold: full sets decide, whatever single registers say."""
    rows = []
    for seed in range(150):
        shingles = np.random.default_rng(seed).integers(0, 2**64, n + other - both, dtype=np.uint64)
        a, b = np.sort(shingles[:n]), np.sort(shingles[n - both:])
        rows += [(seed, seed, a.tobytes(), sketch(a).tobytes(), b.tobytes(), sketch(b).tobytes()),
                 (seed, seed, b.tobytes(), sketch(b).tobytes(), a.tobytes(), sketch(a).tobytes())]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["rep", "pivot", "s1", "r1", "s2", "r2"])
    (got,) = check_pairs(*similar)([batch])
    assert similar[1] * both >= similar[0] * (n + other - both) and all(got.column("linked").to_pylist())


def test_toxicity_counts_labels_of_given_documents_only(spark, monkeypatch):
    taken = []
    monkeypatch.setattr("gridloom.llm.toxicity.ToxicityModel", lambda sample, shares: taken.append((len(sample), shares)))
    docs = documents(spark, [(k, "plain words" + " vile" * (k % 2), "en") for k in range(100)] + [(k, None, "en") for k in range(100, 200)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id long, toxic int")
    learn_toxicity(docs, labels, {1: 50, 0: 50})
    assert taken == [(100, {0: 1.0, 1: 1.0})]


def torn_groups():
    """Documents that have words in common with their group's first, and each a stretch of its own."""
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    rows = []
    for group in range(12):
        base = [word() for _ in range(150)]
        for k in range(12):
            w = list(base)
            for _ in range(rnd.choice([1, 2, 3, 5, 8])):
                w[rnd.randrange(len(w))] = word()
            rows.append((group * 100 + k, " ".join(w)))
            if rnd.random() < 0.4:
                base = w
    return rows


def test_full_sets_move_for_likely_pairs_only(spark, monkeypatch):
    """No set is sent to meet itself, nor one that the sketches rule out; places in prefixes are listed for shared shingles only."""
    moved, lists = [], []
    join, keep = neardup.with_sets, neardup.written

    def watched(pairs, *others):
        moved.append({tuple(r) for r in pairs.collect()})
        return join(pairs, *others)

    def kept(frame, what, *others, **options):
        out = keep(frame, what, *others, **options)
        if what in ("prefixes", "headed"):
            listed = next((c for c in ("before", "met") if c in out.columns), None)
            lists.append(out.selectExpr(f"size({listed}) AS n" if listed else "0 AS n").agg({"n": "sum"}).first()[0])
        return out

    monkeypatch.setattr(neardup, "with_sets", watched)
    monkeypatch.setattr(neardup, "written", kept)
    rows = torn_groups()
    got = {r["doc_id"]: r for r in near_duplicates(documents(spark, rows), (80, 100)).collect()}
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == linked_by_hand(rows, 80, 100)
    assert len(moved) == 2 and all(a != b for pairs in moved for a, b in pairs)
    assert lists and sum(lists) < 144 * 32  # a prefix has about 30 shingles; written once for each, it would have 15 times as many


def test_lists_of_shingles_are_not_broadcast(spark, tmp_path):
    """By the size of their file they would be, however long they are unfolded."""
    pairs = spark.createDataFrame([(k, 0) for k in range(40)], "rep long, pivot long")
    found = spark.createDataFrame([], "node long, component long")
    sets = spark.createDataFrame([(k, np.arange(k, k + 100, dtype=np.uint64).tobytes(), b"") for k in range(40)], "rep long, shingles binary, registers binary")
    near = neardup.rest_pairs(pairs, found, sets, 80, 100, str(tmp_path))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {(r["rep"], r["pivot"]) for r in near.collect()} >= {(a, b) for b in range(40) for a in range(b) if b - a <= 11}


def test_near_duplicates_of_repeated_ids(spark):
    """Rows of one id are one document for linking, whichever of its texts is linked."""
    rows = [(i // 2 * 2 if i % 100 < 6 else i, t) for i, t in torn_groups()]
    rows = [(i + 100 if i in (200, 400) else i, t) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, shingles(t)) for i, t in rows]
    for a, one in sets:
        for b, other in sets:
            if 100 * len(one & other) >= 80 * len(one | other):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    got = [(r["doc_id"], r["component_id"]) for r in near_duplicates(documents(spark, rows), (80, 100)).collect()]
    assert sorted(got) == sorted((i, find(i)) for i, _ in rows)
