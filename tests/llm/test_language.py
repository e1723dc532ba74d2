"""Language identification against plain dictionaries of n-grams."""

import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from __spark_entry__ import SMALLEST
from gridloom.llm.language import GRAM_BITS, PROFILE, UNKNOWN, Profiles, identify_languages, learn_profiles, letter_table
from gridloom.llm.queries import QUERIES
from gridloom.llm.words import mixed
from tests.llm.test_operators import ODD, documents


def grams(text):
    """How often each n-gram of one to three letters stands in a text; those of words' edges have a blank."""
    found = Counter()
    for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
        edged = f" {word} "
        found.update(word)
        found.update(edged[k:k + 2] for k in range(len(edged) - 1))
        found.update(edged[k:k + 3] for k in range(len(edged) - 2))
    return found


def place(gram):
    """Of two n-grams that are equally frequent, the one with the smaller number comes first."""
    code = [ord(c) for c in gram]
    number = [0, lambda: code[0], lambda: (code[0] << 21 | code[1]) + (1 << 60), lambda: (code[0] << 42 | code[1] << 21 | code[2]) ^ (1 << 63)][len(gram)]()
    return int(mixed(np.array([number], np.uint64))[0]) >> (64 - GRAM_BITS)


def ranks(counts, most):
    return {g: k for k, g in enumerate(sorted(counts, key=lambda g: (-counts[g], place(g)))[:most])}


def by_hand(learned, texts, most=PROFILE):
    """(language, score) of each text by out-of-place distance to profiles of ``learned`` (text, language)."""
    totals = defaultdict(Counter)
    for text, lang in learned:
        if lang is not None and text is not None:
            totals[lang].update(grams(text))
    profiles = {lang: ranks(counts, most) for lang, counts in sorted(totals.items()) if counts}
    for text in texts:
        own = ranks(grams(text), most)
        apart = {lang: sum(abs(p[g] - k) if g in p else most for g, k in own.items()) for lang, p in profiles.items()}
        best = min(apart, key=apart.get) if own and apart else UNKNOWN
        yield (best, 1 - apart[best] / (len(own) * most)) if best != UNKNOWN else (UNKNOWN, 0.0)


def test_query(spark):
    """Every document of the smallest table: the same language and the same distance."""
    docs = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SMALLEST}/documents.parquet'").fetchall()
    expected = by_hand([(t, lang) for i, t, lang in docs if zlib.crc32(str(i).encode()) % 3 != 1], [t for _, t, _ in docs])
    rows = {r["doc_id"]: r for r in QUERIES["op3_language_id"](spark, SMALLEST).collect()}
    assert len(rows) == len(docs)
    for (i, _, _), (lang, score) in zip(docs, expected):
        assert (rows[i]["lang_pred"], rows[i]["score"]) == (lang, pytest.approx(score, abs=1e-12)), i


@pytest.mark.parametrize("most", [3, 40, 300])
def test_other_letters_and_short_profiles(spark, most):
    given = [(10, "der die das und nicht ß", "de"), (11, "the and that not", "en"), (12, "и не что это", "ru"), (13, "と の は 日本", "ja"), (14, "abc abc", None)]
    asked = [(20, "Das ist NICHT gut"), (21, "don't and won't"), (22, "что-то"), (23, "日本の"), (24, "İstanbul 7 ça"), (25, "𝒜𝒷 x"), (26, "q")]
    learned, docs = documents(spark, given), documents(spark, [*ODD, *asked])
    rows = identify_languages(docs, learn_profiles(learned, most=most)).collect()
    texts = [t for _, t in [*ODD, *asked]]
    expected = by_hand([(t, lang) for _, t, lang in given], texts, most)
    wanted = sorted((i if i is not None else -1, lang, round(score, 9)) for (i, _), (lang, score) in zip([*ODD, *asked], expected))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["lang_pred"], round(r["score"], 9)) for r in rows) == wanted


def test_memory_does_not_follow_the_batch():
    """Some texts are worked on at a time, however many a batch holds."""
    rng = np.random.default_rng(5)
    texts = ["".join(x) for x in rng.choice(list("abcdefghij "), (600, 2000))]
    profiles, letters = Profiles([("en", k, k) for k in range(PROFILE)], PROFILE), letter_table()
    tracemalloc.start()
    names, _ = profiles.compare(texts, letters)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert names == ["en"] * len(texts)
    assert peak < 32 << 20, peak
