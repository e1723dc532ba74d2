"""Near-duplicates by SetSketch: banded registers find candidates, a joint likelihood weighs them, full sets decide.

All documents of one bucket are first compared with one of them, the pivot. Where that leaves a bucket's documents
unconnected, the rest are joined exactly on the shingles that fewest documents have: neither step pairs a bucket's
documents with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.bloom import build_bits, log_blocks, probe
from gridloom.llm.components import components
from gridloom.llm.words import LOWER, NOT_SPACE, find_words, mixed, multipliers, row_slices, sequence_hashes, text_bytes, word_hashes
from gridloom.llm.workers import tidied
from gridloom.plans.scratch import drop_folder, scratch_folder, written

#: Words in a shingle.
SHINGLE = 5

#: Registers of a sketch, and those of a band: documents that agree on a whole band are candidates. At a similarity of
#: 0.8 a pair agrees on none of the 32 bands with a probability of 5e-8, at 0.85 of 6e-11.
REGISTERS, BAND = 128, 4

#: Registers count in steps of this factor; it and the rate decide the range that 16 bits can hold.
BASE, RATE = 1.001, 20.0

#: Counters by which frequent shingles are told from rare ones; any counts give right results.
SLOTS = 1 << 16

#: Parts of the way back from the largest possible similarity to the least one asked for.
FINE = np.concatenate([np.linspace(1, 0, 33), 2.0 ** -np.arange(6, 40)])

#: A candidate is dropped unseen only if its sketches are less likely, by this many nats, than at their best similarity.
NATS = 18.0


def shingle_sets(column) -> Iterator[np.ndarray]:
    """Sorted fingerprints of each text's distinct shingles. A text of fewer words has one, of all of them; without
    words none. A-Z are lowered; words are runs of anything but ASCII white space."""
    data, bounds = text_bytes(column)
    for a, b in row_slices(bounds):
        part = LOWER[data[bounds[a]:bounds[b]]]
        starts, ends, first = find_words(part, bounds[a:b + 1] - bounds[a], NOT_SPACE)
        words = word_hashes(part, starts, ends)
        runs = sequence_hashes(words, SHINGLE)
        for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
            if high - low >= SHINGLE:
                yield np.unique(runs[low:high - SHINGLE + 1])
            elif high > low:
                yield sequence_hashes(words[low:high], high - low, seed=100 + high - low)
            else:
                yield np.zeros(0, np.uint64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers: each the exponent, truncated to 16 bits, of the smallest of exponentially spaced values.

    The sketch of a union is the larger of both sets' registers, one by one.
    """
    factors = multipliers(REGISTERS, 3)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 1024):
        least = np.minimum(least, (shingles[k:k + 1024, None] * factors).min(axis=0))
    spread = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(spread) / np.log(BASE)), 0, 65535).astype(np.uint16)


def merged(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(one, other)


def similarity(one: np.ndarray, other: np.ndarray, n_one: int, n_other: int, at_least: float) -> tuple[float, bool]:
    """(most likely similarity, may it be ``at_least``) of two sets of known sizes.

    Jointly by how often one register is larger, smaller or equal: each has a known probability at each similarity.
    Weighed at even steps up to the most that the sizes allow and, from ``at_least`` to there, at ever finer ones: near
    that end the probability of 'the smaller set's register is larger' goes to 0, and one such register decides.
    """
    u = n_one / (n_one + n_other)
    v = 1 - u
    most = min(u / v, v / u)
    room = max(0.0, most - at_least)
    fine = most - room * FINE if at_least <= most + 1e-9 else np.zeros(0)
    grid = np.concatenate([np.linspace(0, most, 201), fine])
    above, below = (one > other).sum(), (one < other).sum()

    def part(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    p, q = np.maximum(part(u - v * grid), 1e-12), np.maximum(part(v - u * grid), 1e-12)
    fit = above * np.log(p) + below * np.log(q) + (len(one) - above - below) * np.log(np.maximum(1 - p - q, 1e-12))
    best = int(fit.argmax())
    allowed = fit[grid >= at_least - 1e-9]
    return float(grid[best]), bool(len(allowed) and allowed.max() > fit[best] - NATS)


def common(one: np.ndarray, other: np.ndarray) -> int:
    both = np.sort(np.concatenate([one, other]))
    return int((both[1:] == both[:-1]).sum())


def near_duplicates(docs: DataFrame, similar: tuple[int, int] = (80, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable over links), kept (is it that id).

    Two documents are linked when the shared part of their shingles is at least ``similar`` (numerator, denominator) of
    the union, on full sets. Documents with equal sets are one class and are compared once. Null or empty texts and
    texts without words have no shingles and are linked with nothing. Rows with a null id are left out; rows of one id
    are one document for linking, and each gives a row. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    num, den = similar

    def digest(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, own in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1))):
                fp = [int(x) for x in (mixed(own).sum(dtype=np.uint64), mixed(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))]
                bands = []
                if len(own):
                    quads = sketch(own).astype(np.uint64).reshape(-1, BAND)
                    packed = (quads << (np.arange(BAND, dtype=np.uint64) * np.uint64(16))).sum(axis=1, dtype=np.uint64)
                    bands = mixed(mixed(packed) + np.arange(len(quads), dtype=np.uint64)).view(np.int64).tolist()
                rows.append({"doc_id": doc_id, "n_shingles": len(own), "fp1": fp[0] - (1 << 63), "fp2": fp[1] - (1 << 63), "bands": bands})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("bands", pa.list_(pa.int64()))]))

    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    digests = written(texts.mapInArrow(tidied(digest), "doc_id long, n_shingles long, fp1 long, fp2 long, bands array<long>"), "sketches")
    classes = written(digests.where("n_shingles > 0").groupBy("fp1", "fp2").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "classes")

    work = scratch_folder(spark, "near-duplicates")
    # Buckets that more than one class is in, and the pivot of each: the class that meets most others in its buckets.
    in_bands = classes.select("rep", F.explode("bands").alias("key"))
    full = in_bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = written(in_bands.join(full, "key"), "buckets", work)
    met = members.groupBy("rep").agg(F.sum("size").alias("met"))
    pivots = members.join(met, "rep").groupBy("key").agg(F.max(F.struct("met", "rep")).alias("p")).selectExpr("key", "p.rep AS pivot")
    pairs = written(members.join(pivots, "key").select("rep", "pivot").distinct(), "pairs", work)

    sets = written(full_sets(texts, pairs.select("rep").distinct()), "sets", work)
    likely = written(likely_pairs(pairs.where("rep <> pivot"), sets, num / den), "likely", work)
    links = written(linked_pairs(likely, sets, num, den), "links", work)
    found = written(components(links, work), "found", work)

    within = scratch_folder(spark, "rest")
    rest = written(likely_pairs(rest_pairs(pairs, found, sets, num, den, within), sets, num / den), "rest", work)
    drop_folder(spark, within)
    more = linked_pairs(rest, sets, num, den)
    more = written(more, "more-links", work)
    if not more.isEmpty():
        found = components(links.unionByName(more), work)
    found = written(found, "found")
    drop_folder(spark, work)  # what follows reads digests, classes and components only

    reached = digests.where("n_shingles > 0").select("doc_id", "n_shingles", "fp1", "fp2").join(
        classes.select("fp1", "fp2", "rep"), ["fp1", "fp2"]
    ).join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    alone = digests.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return reached.unionByName(alone).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def full_sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, shingles, registers) of the documents wanted, and of a few more: a filter of fixed size picks them where
    they are read, so that no other text is moved."""
    power = log_blocks(wanted.count())
    bits = build_bits(wanted.select(F.xxhash64("rep").alias("h")), power)

    def chosen(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = pa.array(probe(bits, power, batch.column(2).to_numpy().view(np.uint64)))
            ids, column = batch.column(0).filter(hit), batch.column(1).filter(hit)
            ready, size = [], 0
            for rep, own in zip(ids.to_pylist(), shingle_sets(column)):
                ready.append({"rep": rep, "shingles": own.tobytes(), "registers": sketch(own).tobytes()})
                size += own.nbytes
                if size > 1 << 23:
                    yield pa.RecordBatch.from_pylist(ready, SETS)
                    ready, size = [], 0
            yield pa.RecordBatch.from_pylist(ready, SETS)

    hashed = texts.select("doc_id", "text", F.xxhash64("doc_id").alias("h"))
    return hashed.mapInArrow(tidied(chosen), "rep long, shingles binary, registers binary")


SETS = pa.schema([("rep", pa.int64()), ("shingles", pa.binary()), ("registers", pa.binary())])


def with_sets(pairs: DataFrame, one: str, other: str, sets: DataFrame) -> DataFrame:
    """The pairs with both sides' sets; plain joins, whose skewed keys (pivots of large groups) Spark splits."""
    left = sets.select(F.col("rep").alias(one), F.col("shingles").alias("s1"), F.col("registers").alias("r1"))
    right = sets.select(F.col("rep").alias(other), F.col("shingles").alias("s2"), F.col("registers").alias("r2"))
    return pairs.join(left, one).join(right, other).select(one, other, "s1", "r1", "s2", "r2")


def likely_pairs(pairs: DataFrame, sets: DataFrame, at_least: float) -> DataFrame:
    """The pairs that the likelihood of their sketches lets pass: most do not, and their full sets need not be moved."""
    sizes = sets.select("rep", "registers", F.expr("octet_length(shingles) div 8 AS n"))
    left = sizes.select("rep", F.col("registers").alias("r1"), F.col("n").alias("n1"))
    right = sizes.select(F.col("rep").alias("pivot"), F.col("registers").alias("r2"), F.col("n").alias("n2"))

    def chosen(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns[2:]))
            may = [similarity(np.frombuffer(r1, np.uint16), np.frombuffer(r2, np.uint16), n1, n2, at_least)[1] for r1, n1, r2, n2 in rows]
            yield batch.select(["rep", "pivot"]).filter(pa.array(may, pa.bool_()))

    weighed = pairs.join(left, "rep").join(right, "pivot").select("rep", "pivot", "r1", "n1", "r2", "n2")
    return weighed.mapInArrow(tidied(chosen), "rep long, pivot long").distinct()


CHECKED = "rep long, pivot long, linked boolean"


def check_pairs(num: int, den: int):
    """Decides pairs: by the likelihood of their sketches whether they may be linked, then on full sets."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for s1, r1, s2, r2 in zip(*(c.to_pylist() for c in batch.columns[2:])):
                own, theirs = np.frombuffer(s1, np.uint64), np.frombuffer(s2, np.uint64)
                may = similarity(np.frombuffer(r1, np.uint16), np.frombuffer(r2, np.uint16), len(own), len(theirs), num / den)[1]
                shared = common(own, theirs) if may else 0
                linked.append(may and den * shared >= num * (len(own) + len(theirs) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["rep", "pivot", "linked"])

    return run


def linked_pairs(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of the pairs that are links."""
    checked = with_sets(pairs, "rep", "pivot", sets).mapInArrow(tidied(check_pairs(num, den)), CHECKED)
    return checked.where("linked").selectExpr("rep AS a", "pivot AS b")


def slot_counts(sets: DataFrame) -> np.ndarray:
    """How many shingles of the sets fall into each of ``SLOTS`` slots, by the top bits of their fingerprints."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.bincount((np.frombuffer(x, np.uint64) >> np.uint64(48)).astype(np.int64), minlength=SLOTS)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(total[full])], ["slot", "n"])

    rows = sets.select("shingles").mapInArrow(tidied(count), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SLOTS, np.int64)
    counts[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return counts


def prefixes(sets: DataFrame, counts: np.ndarray, num: int, den: int) -> DataFrame:
    """(rep, n, prefix): each set's size, and those of its shingles that any set linked to it has one of.

    A set shares at least num/den of its size with any set linked to it. So, of all sets' shingles in one order, one of
    its first n - that + 1 is among the other's first. In the order used, shingles of emptier slots come first: what
    only a few sets have stands before what a large group has in common.
    """

    def first(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, made = [], []
            for x in batch.column(1).to_pylist():
                own = np.frombuffer(x, np.uint64)
                order = np.lexsort((own, counts[(own >> np.uint64(48)).astype(np.int64)]))
                sizes.append(len(own))
                made.append(own[order[:len(own) - -(-num * len(own) // den) + 1]].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(made, pa.list_(pa.int64()))], ["rep", "n", "prefix"])

    return sets.select("rep", "shingles").mapInArrow(tidied(first), "rep long, n long, prefix array<long>")


def rest_pairs(pairs: DataFrame, found: DataFrame, sets: DataFrame, num: int, den: int, under: str) -> DataFrame:
    """Pairs of documents in different components that may yet be linked: an exact join on the sets' prefixes.

    Only documents of pivots whose documents are in several components matter, and of their shingles only those met in
    several. The most frequent component of a shingle is never paired with itself. Sizes, and places in the prefixes,
    rule out most of the rest: the first shingle two sets share leaves only so many to share after it. A pair comes out
    where it meets at that first one only, not once more for each shingle it shares.

    Sets that share a passage share all its shingles. Of the shingles that the very same sets have, only the first in
    order is joined on: as the order is one for all sets, the first that two sets share is always among these. So
    whether two sets share an earlier one is seen from those joined on alone; the rest of a prefix is moved nowhere.
    """
    placed = pairs.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("rep", "pivot", F.coalesce("component", "rep").alias("c"))
    torn = placed.groupBy("pivot").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("pivot")
    wanted = written(placed.join(torn, "pivot").select("rep", "c").distinct(), "torn", under)
    if wanted.isEmpty():
        return pairs.where("false").select("rep", "pivot")
    # An id may have several sets, so each has a number of its own.
    firsts = prefixes(sets, slot_counts(sets), num, den).join(wanted, "rep")
    firsts = written(firsts.withColumn("own", F.monotonically_increasing_id()), "firsts", under)
    entries = firsts.select("own", "c", F.posexplode("prefix").alias("i", "s"))
    held = entries.groupBy("s", "c").agg(F.count("*").alias("k"))
    major = held.groupBy("s").agg(F.max(F.struct("k", "c")).alias("m"), F.count("*").alias("kinds")).where("kinds > 1").selectExpr("s", "m.c AS mc")
    kept = written(entries.join(major, "s"), "prefixes", under)
    lists = kept.groupBy("s").agg(F.expr("bit_xor(xxhash64(own)) AS f"), F.count("*").alias("k"), F.min(F.struct("own", "i")).alias("m"))
    heads = lists.groupBy("f", "k", "m.own").agg(F.min(F.struct("m.i", "s")).alias("h")).selectExpr("h.s AS s")
    headed = kept.join(heads, "s").groupBy("own").agg(F.sort_array(F.collect_list(F.struct("i", "s", "mc"))).alias("met"))
    headed = written(headed.join(firsts.select("own", "rep", "n", "c"), "own"), "headed", under)
    kept = headed.select("rep", "n", "c", F.col("met.s").alias("all"), F.posexplode("met").alias("k", "x")).selectExpr(
        "x.s AS s", "rep", "n", "c", "x.i AS i", "x.mc AS mc", "slice(all, 1, k) AS before")
    few = kept.where("c <> mc").selectExpr("s", "rep AS a", "n AS na", "c AS ca", "i AS ia", "before AS before_a")
    all_ = kept.selectExpr("s", "rep AS b", "n AS nb", "c AS cb", "i AS ib", "c = mc AS major", "before AS before_b")
    # The lists are many times larger than the file they are unfolded from, by which Spark would choose to broadcast them.
    near = few.hint("merge").join(all_, "s").where(
        f"ca <> cb AND (major OR a < b) AND na * {den} >= nb * {num} AND nb * {den} >= na * {num} "
        f"AND least(na - ia, nb - ib) * {num + den} >= (na + nb) * {num} AND NOT arrays_overlap(before_a, before_b)")
    return near.selectExpr("least(a, b) AS rep", "greatest(a, b) AS pivot").distinct()
