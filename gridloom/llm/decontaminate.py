"""Benchmark decontamination by a distributed positional inverted index.

The index is a table of blocks: each holds, for a few hundred thousand words of consecutive documents, every term with
the positions it stands at. Blocks are made where the documents are read and searched where they lie, so neither
building nor searching shuffles a posting, and a very frequent term is spread over all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.words import ALNUM, LOWER, find_words, row_slices, text_bytes, word_hashes
from gridloom.llm.workers import tidied
from gridloom.plans.scratch import written

#: Words in a phrase window.
WINDOW = 10

#: Words in a block of the index; a longer document is a block of its own.
BLOCK_WORDS = 1 << 18

#: Bytes of query texts searched for in one pass over the index; more take more passes.
PASS_BYTES = 8 << 20

#: Candidate positions looked at together.
CANDIDATES = 1 << 20

INDEX_SCHEMA = "block long, doc_ids binary, doc_starts binary, terms binary, term_starts binary, positions binary"


def term_hashes(column) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words of a text column, A-Z in lower case, and where each row's words start among them."""
    data, bounds = text_bytes(column)
    hashes, first_words = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for a, b in row_slices(bounds):
        part = LOWER[data[bounds[a]:bounds[b]]]
        starts, ends, first = find_words(part, bounds[a:b + 1] - bounds[a], ALNUM)
        hashes.append(word_hashes(part, starts, ends))
        first_words.append(first[1:] + first_words[-1][-1])
    return np.concatenate(hashes), np.concatenate(first_words)


def post(doc_ids: np.ndarray, terms: np.ndarray, first: np.ndarray) -> dict:
    """One block: a document's words stand one after the other, with a gap to the next document's, which no phrase crosses."""
    counts = np.diff(first)
    position = np.arange(len(terms)) + np.repeat(np.arange(len(counts)), counts)
    order = np.argsort(terms, kind="stable")
    ordered = terms[order]
    heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(terms) else np.zeros(0, np.int64)
    return {
        "doc_ids": doc_ids.tobytes(), "doc_starts": (first + np.arange(len(first))).tobytes(),
        "terms": ordered[heads].tobytes(), "term_starts": np.append(heads, len(terms)).astype(np.int64).tobytes(),
        "positions": position[order].astype(np.uint32).tobytes(),
    }


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all documents as a table in the shared folder. Rows with a null id are left out, as nothing could
    name them; null texts have no words; several rows of one id are several documents of that id."""

    def blocks(batches) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            terms, first = term_hashes(batch.column(1))
            for a, b in row_slices(first, BLOCK_WORDS):
                yield pa.RecordBatch.from_pylist([{"block": block} | post(ids[a:b], terms[first[a]:first[b]], first[a:b + 1] - first[a])])
                block += 1

    known = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(text_col))
    return written(known.mapInArrow(tidied(blocks), INDEX_SCHEMA), "positional-index")


class Block:
    """A row of the index, read back."""

    def __init__(self, row: dict):
        self.doc_ids = np.frombuffer(row["doc_ids"], np.int64)
        self.doc_starts = np.frombuffer(row["doc_starts"], np.int64)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.term_starts = np.frombuffer(row["term_starts"], np.int64)
        self.positions = np.frombuffer(row["positions"], np.uint32).astype(np.int64)
        self.n_words = np.diff(self.doc_starts) - 1
        owner = np.repeat(np.arange(len(self.terms)), np.diff(self.term_starts))
        self.keys = (owner << 40) | self.positions  # in order, as terms and positions are

    def look_up(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each term's number in the block (0 if it has none) and how often it stands there."""
        if not len(self.terms):
            return np.zeros(terms.shape, np.int64), np.zeros(terms.shape, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        found = self.terms[at] == terms
        return np.where(found, at, 0), np.where(found, np.diff(self.term_starts)[at], 0)

    def expand(self, number: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All positions of several terms, one list after the other, and the list each belongs to."""
        lists = np.repeat(np.arange(len(number)), count)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return self.positions[self.term_starts[number][lists] + place], lists

    def has(self, number: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Does the term stand at the position?"""
        keys = (number << 40) | position
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return (position >= 0) & (self.keys[at] == keys)

    def has_between(self, number: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Does the term stand anywhere from ``left`` to ``right``?"""
        at = np.searchsorted(self.keys, (number << 40) | left)
        return (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] <= ((number << 40) | right))

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_starts, position, "right") - 1


def phrase_hits(block: Block, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, position it starts at) of all exact occurrences.

    ``phrases``: terms, a row each; beyond a phrase's length a row repeats its last term. A phrase's lists are
    intersected from its rarest term on, each list shifted by its term's place in the phrase.
    """
    number, count = block.look_up(phrases)
    alive = np.flatnonzero(count.min(axis=1) > 0)
    number, count, lengths = number[alive], count[alive], lengths[alive]
    order = np.argsort(count, axis=1, kind="stable")
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for a, b in row_slices(np.concatenate([[0], np.cumsum(count.min(axis=1))]), CANDIDATES):
        own = np.arange(a, b)
        at, phrase = block.expand(number[own, order[own, 0]], count[own, order[own, 0]])
        phrase += a
        at = at - np.minimum(order[phrase, 0], lengths[phrase] - 1)
        for k in range(1, phrases.shape[1]):
            place = order[phrase, k]
            kept = block.has(number[phrase, place], at + np.minimum(place, lengths[phrase] - 1))
            at, phrase = at[kept], phrase[kept]
        found.append((alive[phrase], at[at >= 0]))
    return tuple(np.concatenate(x) for x in zip(*found))


def proximity_hits(block: Block, phrases: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, position of its rarest term) wherever all terms of the phrase stand within ``reach`` words of it, in any
    order and in the same document."""
    number, count = block.look_up(phrases)
    alive = np.flatnonzero(count.min(axis=1) > 0)
    number, count = number[alive], count[alive]
    order = np.argsort(count, axis=1, kind="stable")
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for a, b in row_slices(np.concatenate([[0], np.cumsum(count.min(axis=1))]), CANDIDATES):
        own = np.arange(a, b)
        at, phrase = block.expand(number[own, order[own, 0]], count[own, order[own, 0]])
        phrase += a
        doc = block.document(at)
        left = np.maximum(block.doc_starts[doc], at - reach)
        right = np.minimum(block.doc_starts[doc + 1] - 2, at + reach)
        for k in range(1, phrases.shape[1]):
            kept = block.has_between(number[phrase, order[phrase, k]], left, right)
            at, phrase, left, right = at[kept], phrase[kept], left[kept], right[kept]
        found.append((alive[phrase], at))
    return tuple(np.concatenate(x) for x in zip(*found))


def item_phrases(items: pa.Table, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct windows of all items as rows of terms, their lengths, and (phrase, item id) pairs."""
    terms, first = term_hashes(items.column(1))
    ids = items.column(0).to_numpy()
    rows, lengths, owners = [], [], []
    for k, item in enumerate(ids):
        own = terms[first[k]:first[k + 1]]
        if len(own):
            n = min(window, len(own))
            views = np.lib.stride_tricks.sliding_window_view(own, n)
            rows.append(np.concatenate([views, np.repeat(views[:, -1:], window - n, axis=1)], axis=1))
            lengths.append(np.full(len(views), n))
            owners.append(np.full(len(views), item))
    if not rows:
        return np.zeros((0, window), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.column_stack([np.concatenate(rows), np.concatenate(lengths).astype(np.uint64)])
    distinct, number = np.unique(both, axis=0, return_inverse=True)
    pairs = np.unique(np.column_stack([number.ravel(), np.concatenate(owners)]), axis=0)
    return distinct[:, :-1].copy(), distinct[:, -1].astype(np.int64), pairs[:, 0], pairs[:, 1]


def search(index: DataFrame, items: pa.Table, window: int, reach: int | None) -> DataFrame:
    """Per document of the index: its block and place there, doc_id, n_words, hit ranges of words, items found."""
    phrases, lengths, of_phrase, of_item = item_phrases(items, window)

    def found(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                if not len(block.terms) or not len(phrases):
                    which, at = np.zeros(0, np.int64), np.zeros(0, np.int64)
                elif reach is None:
                    which, at = phrase_hits(block, phrases, lengths)
                else:
                    which, at = proximity_hits(block, phrases, reach)
                n = lengths[which] if reach is None else np.ones(len(which), np.int64)
                size = int(block.doc_starts[-1]) + 1
                edges = np.bincount(at, minlength=size + 1)[:size + 1] - np.bincount(at + n, minlength=size + 1)[:size + 1]
                hit = np.concatenate([[0], (np.cumsum(edges) > 0).astype(np.int8), [0]])
                starts, ends = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1)
                owner, doc = block.document(starts), block.document(at)
                spans: list[list] = [[] for _ in block.doc_ids]
                for d, a, b in zip(owner.tolist(), (starts - block.doc_starts[owner]).tolist(), (ends - starts).tolist()):
                    spans[d].append({"start": a, "length": b})
                pairs = np.unique(np.column_stack([doc, which]), axis=0)  # sorted by phrase, as of_phrase is
                low, high = np.searchsorted(of_phrase, pairs[:, 1]), np.searchsorted(of_phrase, pairs[:, 1], "right")
                found_items: list[set] = [set() for _ in block.doc_ids]
                for d, a, b in zip(pairs[:, 0].tolist(), low.tolist(), high.tolist()):
                    found_items[d].update(of_item[a:b].tolist())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(spans), row["block"])), pa.array(np.arange(len(spans))),
                    pa.array(block.doc_ids), pa.array(block.n_words), pa.array(spans, SPANS),
                    pa.array([sorted(x) for x in found_items], pa.list_(pa.int64())),
                ], ["block", "place", "doc_id", "n_words", "hits", "items"])

    return index.mapInArrow(tidied(found), FOUND_SCHEMA)


def united(spans: list[dict]) -> list[dict]:
    """Ranges that touch or overlap made one."""
    out: list[dict] = []
    for x in sorted(spans, key=lambda x: x["start"]):
        if out and x["start"] <= out[-1]["start"] + out[-1]["length"]:
            out[-1]["length"] = max(out[-1]["length"], x["start"] + x["length"] - out[-1]["start"])
        else:
            out.append(dict(x))
    return out


def merge_passes(found: DataFrame) -> DataFrame:
    """One row per document again, from one per document and pass."""
    hit = found.groupBy("block", "place").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )

    def unite(batches):
        for batch in batches:
            hits = pa.array([united(x) for x in batch.column("hits").to_pylist()], SPANS)
            yield batch.set_column(batch.schema.get_field_index("hits"), "hits", hits)

    return hit.mapInArrow(tidied(unite), FOUND_SCHEMA)


FOUND_SCHEMA = ("block long, place long, doc_id long, n_words long, hits array<struct<start: long, length: long>>, "
                "items array<long>")


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, reach: int | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where texts of ``benchmark`` (item_id, text) stand in the documents: one row per document with doc_id, n_words,
    hits (ranges of words inside occurrences) and items (ids of items with occurrences, sorted).

    Words are runs of digits, letters and characters beyond ASCII, A-Z in lower case. A window is ``window``
    consecutive words of an item, or all words of a shorter one. With ``reach`` the match is by proximity: all words of
    a window within so many words of its rarest, in any order; hits are then the places of the rarest word.

    Null and empty texts have no words and no hits; documents or items with a null id are left out; repeated rows give
    repeated results; an empty benchmark hits nothing; columns besides id and text are ignored. Benchmark texts are
    searched for in passes of ``PASS_BYTES``, so what is sent to tasks at once is bounded whatever their number.
    """
    index = build_index(docs, id_col, text_col)
    tests = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    passes = tests.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    passes = max(1, -(-passes // PASS_BYTES))
    found = None
    for k in range(passes):
        items = tests.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == k).toArrow()
        part = search(index, items, window, reach)
        found = part if found is None else found.unionByName(part)
    return (found if passes == 1 else merge_passes(found)).select("doc_id", "n_words", "hits", "items")
