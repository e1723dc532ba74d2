"""Language identification by rank order: a document's most frequent n-grams against each language's."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.words import mixed
from gridloom.llm.workers import tidied

#: Most frequent n-grams (of one to three letters) that make a profile.
PROFILE = 300

#: Documents of a language that its profile is learned from, about; all where there are fewer.
FIT_ROWS = 2000

#: Characters worked on at once, each of which takes about 120 bytes; bits that tell n-grams apart (documents of a slice have the others).
SLICE_CHARS, GRAM_BITS = 1 << 17, 40

UNKNOWN = "und"


def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SLICE_CHARS``; a longer text is a range of its own."""
    first, size = 0, 0
    for k, x in enumerate(texts):
        if k > first and size + len(x) > SLICE_CHARS:
            yield first, k
            first, size = k, 0
        size += len(x)
    if texts:
        yield first, len(texts)


def gram_counts(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, n-gram, how often) of all n-grams of some texts, by text and n-gram.

    Texts are lowered; what is no letter ends a word. Two and three letters may have a word's edge first or last.
    """
    lowered = [x.lower() for x in texts]
    code = np.frombuffer(" ".join(["", *lowered, ""]).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    inside = letters[code.astype(np.int64)]
    code = np.where(inside, code, np.uint64(32))
    bounds = np.cumsum([1, *(len(x) + 1 for x in lowered)])
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(bounds))
    doc = np.concatenate([doc[:1], doc, doc[-1:]])[:len(code)]
    one = np.flatnonzero(inside)
    two = np.flatnonzero(inside[:-1] | inside[1:])
    owner = two + ~inside[:-1][two]  # the letter of the pair, the first if both are
    grams = np.concatenate([
        mixed(code[one]), mixed((code[two] << np.uint64(21) | code[two + 1]) + np.uint64(1 << 60)),
        mixed((code[one - 1] << np.uint64(42) | code[one] << np.uint64(21) | code[one + 1]) ^ np.uint64(1 << 63)),
    ]) >> np.uint64(64 - GRAM_BITS)
    keys = np.sort(np.concatenate([doc[one], doc[owner], doc[one]]) << np.uint64(GRAM_BITS) | grams)
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    count = np.diff(np.append(heads, len(keys)))
    found = keys[heads]
    return (found >> np.uint64(GRAM_BITS)).astype(np.int64), (found & np.uint64((1 << GRAM_BITS) - 1)).astype(np.int64), count


def ranked(doc: np.ndarray, gram: np.ndarray, count: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, n-gram, rank) of each text's ``most`` frequent n-grams; equally frequent ones by n-gram."""
    order = np.argsort((doc << 40) - np.minimum(count, (1 << 40) - 1), kind="stable")
    first = np.searchsorted(doc, doc)
    rank = np.arange(len(doc)) - first  # order keeps texts together, so the same as before sorting
    kept = rank < most
    return doc[kept], gram[order][kept], rank[kept]


class Profiles:
    """Each language's n-grams by rank, ready to be compared with."""

    def __init__(self, rows: list[tuple[str, int, int]], most: int):
        self.most = most
        self.languages = sorted({r[0] for r in rows})
        number = {x: k for k, x in enumerate(self.languages)}
        self.grams = np.unique(np.array([r[1] for r in rows], np.int64))
        self.ranks = np.full((len(self.grams) + 1, len(self.languages)), -1, np.int32)
        if rows:
            self.ranks[np.searchsorted(self.grams, [r[1] for r in rows]), [number[r[0]] for r in rows]] = [r[2] for r in rows]

    def compare(self, texts: list[str], letters: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each text. A language's distance is the sum, over the text's n-grams, of how far their
        ranks are apart; ``most`` where the language lacks one. The score is 1 less the share of the largest distance
        possible. Ties go to the language that is first in text order."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        for a, b in slices(texts):
            doc, gram, rank = ranked(*gram_counts(texts[a:b], letters), self.most)
            if not len(doc):
                continue
            at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
            at = np.where(self.grams[at] == gram, at, len(self.grams))
            theirs = self.ranks[at]
            apart = np.where(theirs < 0, self.most, np.abs(theirs - rank[:, None]))
            heads = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            distance = np.add.reduceat(apart, heads, axis=0)
            best = distance.argmin(axis=1)
            size = np.diff(np.append(heads, len(doc)))
            for d, k, s in zip(doc[heads].tolist(), best.tolist(), (1 - distance.min(axis=1) / (size * self.most)).tolist()):
                names[a + d], scores[a + d] = self.languages[k], s
        return names, scores


def learn_profiles(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
                   fit_rows: int = FIT_ROWS, most: int = PROFILE) -> Profiles:
    """Profiles of all languages that ``labelled`` names (rows without a language, text or id are passed over).

    Of each language about ``fit_rows`` documents are taken, by a hash of their id; their n-grams are counted by Spark,
    and what comes to the driver is ``most`` n-grams a language.
    """
    known = labelled.where(f"`{lang_col}` IS NOT NULL AND `{text_col}` IS NOT NULL AND `{id_col}` IS NOT NULL")
    sizes = known.groupBy(lang_col).count().collect()
    if not sizes:
        return Profiles([], most)
    rates = F.create_map(*(F.lit(x) for lang, n in sizes for x in (lang, fit_rows / n)))
    taken = known.where((F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) / (1 << 20)) < rates[F.col(lang_col)])

    def count(batches) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            for lang in dict.fromkeys(langs):
                own = [texts[k] for k in np.flatnonzero(langs == lang)]
                for a, b in slices(own):
                    _, gram, n = gram_counts(own[a:b], letters)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)],
                                                     ["lang", "gram", "n"])

    counted = taken.select(F.col(lang_col).cast("string"), text_col).mapInArrow(tidied(count), "lang string, gram long, n long")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranks = totals.selectExpr("lang", "gram", "cast(row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) - 1 AS int) AS rank")
    return Profiles([tuple(r) for r in ranks.where(F.col("rank") < most).collect()], most)


def identify_languages(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text",
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: its id, ``keep`` columns, lang_pred and score (0 to 1), from the whole text alone.

    Null texts, texts without a letter, and all texts where no language was learned are ``und`` with score 0. A null id
    stays null, repeated rows give repeated rows, and no rows give none.
    """

    def predict(batches) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            names, scores = profiles.compare([x or "" for x in batch.column(0).to_pylist()], letters)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(names, pa.string()), pa.array(scores)],
                                             [*batch.schema.names[1:], "lang_pred", "score"])

    columns = [text_col, id_col, *(c for c in keep if c != id_col)]
    rows = docs.select(F.col(text_col).alias("_text"), *(F.col(c) for c in columns[1:]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(tidied(predict), f"{schema}, lang_pred string, score double")
