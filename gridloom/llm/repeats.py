"""Repeated passages by sparse suffix arrays over words.

Of all suffixes only those at minimiser positions are kept: of any stretch of ``LEAST`` words, the place among its first
``SPREAD`` where a run of ``GRAM`` words has the smallest fingerprint. That depends on the stretch alone, so equal
stretches keep the same suffix. Suffixes are sorted by the fingerprint of their first words; neighbours that agree are
places where something may repeat. From these, matches are extended: every stretch of ``LEAST`` words that reaches left
and right of such a place is sorted in turn, and neighbours that agree are repeats.

Both sorts are by range of (fingerprint, document, place), so that a passage in very many documents is spread over
tasks; only neighbours are compared, whatever the number of copies. Runs that cross a task's edge are settled after.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.bloom import build_bits, log_blocks, probe
from gridloom.llm.words import LOWER, NOT_SPACE, find_words, rolling_hashes, row_slices, sequence_hashes, text_bytes, word_hashes
from gridloom.llm.workers import tidied
from gridloom.plans.scratch import drop_folder, scratch_folder, written

#: Words of the shortest passage that counts, and by how much the kept suffix may lie behind its start.
LEAST, SPREAD = 50, 32

#: Words by which minimisers are chosen, and by which suffixes are first compared: what a passage has behind its minimiser.
GRAM, HEAD = 6, LEAST - SPREAD + 1


def batch_words(column) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, fingerprints of words, where each row's words start) of some rows at a time, A-Z lowered."""
    data, bounds = text_bytes(column)
    for a, b in row_slices(bounds):
        part = LOWER[data[bounds[a]:bounds[b]]]
        starts, ends, first = find_words(part, bounds[a:b + 1] - bounds[a], NOT_SPACE)
        yield a, word_hashes(part, starts, ends), first


def stretches(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every stretch of ``LEAST`` words that lies in one row: its row, its first word, its kept suffix."""
    size = np.diff(first)
    count = np.maximum(0, size - LEAST + 1)
    row = np.repeat(np.arange(len(size)), count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[row]
    if not len(start):
        return row, start, start
    grams = sequence_hashes(words, GRAM)
    views = np.lib.stride_tricks.sliding_window_view(grams, SPREAD)
    kept = np.empty(len(start), np.int64)
    for k in range(0, len(start), 1 << 15):
        kept[k:k + (1 << 15)] = views[start[k:k + (1 << 15)]].argmin(axis=1)
    return row, start, start + kept


def suffixes(texts: DataFrame) -> DataFrame:
    """(h, doc_id, at): fingerprint of the first words of each kept suffix, and its place in words."""

    def make(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for a, words, first in batch_words(batch.column(1)):
                row, start, kept = stretches(words, first)
                new = np.concatenate([[True], kept[1:] != kept[:-1]]) if len(kept) else np.zeros(0, bool)
                row, kept = row[new], kept[new]
                heads = rolling_hashes(words, HEAD)[kept]
                yield pa.RecordBatch.from_arrays([pa.array(heads.view(np.int64)), pa.array(ids[a + row]), pa.array((kept - first[row]).astype(np.int32))],
                                                 ["h", "doc_id", "at"])

    return texts.mapInArrow(tidied(make), "h long, doc_id long, at int")


def shared_heads(batches) -> Iterator[pa.RecordBatch]:
    """Of sorted suffixes: each head that two neighbours have, and, as their neighbours are elsewhere, the first and last."""
    last, held, edge = None, 0, True
    for batch in batches:
        h = batch.column(0).to_numpy()
        if not len(h):
            continue
        joined = np.concatenate([[last], h]) if last is not None else h
        heads = np.flatnonzero(np.concatenate([[True], joined[1:] != joined[:-1]]))
        count = np.diff(np.append(heads, len(joined)))
        count[0] += held - 1 if last is not None else 0
        keys = joined[heads]
        out = keys[:-1][(count[:-1] > 1) | (edge & (np.arange(len(keys) - 1) == 0))]
        if len(keys) > 1:
            edge = False
        last, held = keys[-1], int(count[-1])
        yield pa.RecordBatch.from_arrays([pa.array(out)], ["h"])
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64())], ["h"])


def extended(texts: DataFrame, bits: np.ndarray, power: int) -> DataFrame:
    """(g, doc_id, at, hashes): around each suffix whose head g is shared, the fingerprints of all stretches that keep it."""

    def make(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for a, words, first in batch_words(batch.column(1)):
                row, start, kept = stretches(words, first)
                heads = rolling_hashes(words, HEAD)[kept] if len(kept) else np.zeros(0, np.uint64)
                shared = probe(bits, power, heads)
                row, start, kept, heads = row[shared], start[shared], kept[shared], heads[shared]
                hashes = rolling_hashes(words, LEAST)[start] if len(start) else heads
                new = np.flatnonzero(np.concatenate([[True], kept[1:] != kept[:-1]])) if len(kept) else np.zeros(0, np.int64)
                made = [hashes[x:y].tobytes() for x, y in zip(new, np.append(new[1:], len(row)))]
                yield pa.RecordBatch.from_arrays([
                    pa.array(heads[new].view(np.int64)), pa.array(ids[a + row[new]]), pa.array((start[new] - first[row[new]]).astype(np.int32)),
                    pa.array(made, pa.binary())], ["g", "doc_id", "at", "hashes"])

    return texts.mapInArrow(tidied(make), "g long, doc_id long, at int, hashes binary")


def one_by_one(batches) -> Iterator[pa.RecordBatch]:
    """(g, h, doc_id, at) of each stretch of the runs."""
    for batch in batches:
        heads, ids, at = (batch.column(k).to_numpy() for k in range(3))
        runs = [np.frombuffer(x, np.int64) for x in batch.column(3).to_pylist()]
        for k in range(0, len(runs), 512):
            part = runs[k:k + 512]
            size = np.array([len(x) for x in part])
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(heads[k:k + 512], size)), pa.array(np.concatenate(part)), pa.array(np.repeat(ids[k:k + 512], size)),
                pa.array((np.repeat(at[k:k + 512], size) + place).astype(np.int32))], ["g", "h", "doc_id", "at"])


FOUND = pa.schema([("doc_id", pa.int64()), ("places", pa.binary()), ("h", pa.int64()), ("at", pa.int32()), ("many", pa.bool_())])
FOUND_DDL = "doc_id long, places binary, h long, at int, many boolean"


def packed(doc: np.ndarray, at: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    """A row per document with its repeated stretches: their places, and whether each is the passage's first."""
    order = np.lexsort((at, doc))
    doc, at, first = doc[order], at[order], first[order]
    heads = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    rows = [{"doc_id": int(doc[a]), "places": zlib.compress((np.diff(at[a:b], prepend=0) * 2 + first[a:b]).astype(np.int32).tobytes(), 1)}
            for a, b in zip(heads, np.append(heads[1:], len(doc)))]
    return pa.RecordBatch.from_pylist(rows, FOUND)


def unpacked(places: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps = np.frombuffer(zlib.decompress(places), np.int32)
    return np.cumsum(steps >> 1), (steps & 1).astype(bool)


def repeated(batches) -> Iterator[pa.RecordBatch]:
    """Of sorted stretches: those that a neighbour equals, by document.

    A run is known by its first stretch; all others in it are repeats. The task's first and last runs may go on in other
    tasks, so their first stretch is given out singly, with its fingerprint, and whether the run has more here.
    """
    ready: list[tuple] = []
    size, opening = 0, True
    run: tuple | None = None  # (h, doc, at) of the present run's first stretch
    count = 0

    def singly(h, doc, at) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"doc_id": int(doc), "h": int(h), "at": int(at), "many": count > 1}], FOUND)

    for batch in batches:
        if not len(batch):
            continue
        h, doc, at = (batch.column(k).to_numpy() for k in (1, 2, 3))
        new = np.concatenate([[run is None or h[0] != run[0]], h[1:] != h[:-1]])
        ready.append((doc[~new], at[~new], np.zeros((~new).sum(), np.int64)))
        heads = np.flatnonzero(new)
        count += int(heads[0]) if len(heads) else len(h)
        if len(heads):
            if run is not None:
                if opening:
                    yield singly(*run)
                    opening = False
                elif count > 1:
                    ready.append((np.array([run[1]]), np.array([run[2]]), np.ones(1, np.int64)))
            sizes = np.diff(np.append(heads, len(h)))
            done, full = heads[:-1], sizes[:-1] > 1
            if opening and len(done):
                run, count = (h[done[0]], doc[done[0]], at[done[0]]), int(sizes[0])
                yield singly(*run)
                opening, done, full = False, done[1:], full[1:]
            ready.append((doc[done[full]], at[done[full]], np.ones(full.sum(), np.int64)))
            last = heads[-1]
            run, count = (h[last], doc[last], at[last]), int(sizes[-1])
        size += len(h)
        if size > 1 << 19:
            yield packed(*(np.concatenate(x) for x in zip(*ready)))
            ready, size = [], 0
    if ready:
        yield packed(*(np.concatenate(x) for x in zip(*ready)))
    if run is not None:
        yield singly(*run)


def cover(starts: np.ndarray, size: int) -> np.ndarray:
    """Words under stretches that start at these places."""
    edges = np.bincount(starts, minlength=size + 1)[:size + 1] - np.bincount(starts + LEAST, minlength=size + 1)[:size + 1]
    return np.cumsum(edges)[:size] > 0


def ranges(under: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], under.astype(np.int8), [0]]))
    starts = np.flatnonzero(edges == 1)
    return starts, np.flatnonzero(edges == -1) - starts


SPAN = pa.struct([("start", pa.int64()), ("length", pa.int64())])


def spans_of(batches) -> Iterator[pa.RecordBatch]:
    """(doc_id, repeats, cuts) from all of a document's packed places."""
    for batch in batches:
        repeats, cuts = [], []
        for parts in batch.column(1).to_pylist():
            at, first = (np.concatenate(x) for x in zip(*map(unpacked, parts)))
            size = int(at.max()) + LEAST
            for out, under in ((repeats, cover(at, size)), (cuts, cover(at[~first], size) & ~cover(at[first], size))):
                out.append([{"start": s, "length": n} for s, n in zip(*(x.tolist() for x in ranges(under)))])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(repeats, pa.list_(SPAN)), pa.array(cuts, pa.list_(SPAN))], ["doc_id", "repeats", "cuts"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document that has passages of at least ``LEAST`` words which stand elsewhere too, in it or in others.

    repeats: maximal ranges of words, each word of which is in such a passage. cuts: what can go so that the first occurrence (smallest id, then place) of every such passage
    stays whole. Words are runs of anything but ASCII white space, A-Z in lower case.

    Null, empty and shorter texts have none; rows with a null id are left out; repeated rows are documents that share
    all, whose findings are given together under their id; other columns are ignored; an empty table gives no rows.
    """
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spark, order = docs.sparkSession, ("h", "doc_id", "at")
    work = scratch_folder(spark, "repeats")
    sparse = written(suffixes(texts), "suffixes", work)
    heads = written(sparse.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(tidied(shared_heads), "h long"), "heads", work)
    power = log_blocks(heads.count())
    runs = written(extended(texts, build_bits(heads, power), power), "runs", work)
    # Equal stretches keep the same suffix, so its head may come first; then a run's stretches meet in one task.
    order = ("g", *order)
    stretch = runs.mapInArrow(tidied(one_by_one), "g long, h long, doc_id long, at int")
    found = written(stretch.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(tidied(repeated), FOUND_DDL), "repeats")
    drop_folder(spark, work)
    edges = found.where("places IS NULL").select("h", "doc_id", "at", "many")  # two of each task
    firsts = edges.groupBy("h").agg(F.min(F.struct("doc_id", "at")).alias("first"), (F.max("many") | (F.count("*") > 1)).alias("twice"))
    settled = edges.join(firsts.where("twice"), "h").selectExpr("doc_id", "at", "cast(first.doc_id = doc_id AND first.at = at AS long) AS is_first")

    def pack_rows(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield packed(*(c.to_numpy() for c in batch.columns))

    more = settled.mapInArrow(tidied(pack_rows), FOUND_DDL)
    by_doc = found.where("places IS NOT NULL").unionByName(more).groupBy("doc_id").agg(F.collect_list("places").alias("places"))
    return by_doc.mapInArrow(tidied(spans_of), "doc_id long, repeats array<struct<start: long, length: long>>, cuts array<struct<start: long, length: long>>")


def cut_repeats(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with ``cuts`` taken out of their texts, up to where the next word kept starts; all other rows and
    columns as they are, whatever their names.

    Rows that ``found`` (doc_id, cuts) does not name, null ids and null texts among them, stay as they are; repeated
    rows are cut alike, so rows of one id have to be of one text; an empty table gives no rows.
    """
    names = docs.columns
    place = names.index(text_col)
    plain = docs.toDF(*(f"_c{k}" for k in range(len(names))))  # names that no column of found has
    joined = plain.join(found.select("doc_id", "cuts"), F.col(f"_c{names.index(id_col)}") == F.col("doc_id"), "left")

    def cut(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cuts = batch.column(place).to_pylist(), batch.column(len(names)).to_pylist()
            made = pa.array([without(x, c) if c else x for x, c in zip(texts, cuts)], pa.string())
            yield pa.RecordBatch.from_arrays([made if k == place else batch.column(k) for k in range(len(names))], names)

    return joined.select(*plain.columns, "cuts").mapInArrow(tidied(cut), docs.schema)


def without(text: str, cuts: list[dict]) -> str:
    data = text.encode()
    starts, _, _ = find_words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), NOT_SPACE)
    edges = np.append(starts, len(data))
    out, at = [], 0
    for c in cuts:
        out.append(data[at:edges[c["start"]]])
        at = int(edges[c["start"] + c["length"]])
    return b"".join([*out, data[at:]]).decode()
