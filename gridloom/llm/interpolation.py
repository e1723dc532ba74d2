"""Language-model scores by deleted interpolation: n-gram shares of three orders, mixed by how often their contexts stand.

Texts are cut into chunks that a task can hold. A chunk sends its distinct n-grams and their counts, by ranges of their
fingerprints, to tasks that sum them over all chunks, and gets back the counts of the others in the order it sent them.
So no table of counts is ever in one place, and an n-gram travels as a few bytes: sorted, as distance from the one before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from gridloom.llm.words import LOWER, NOT_SPACE, find_words, mixed, row_slices, sequence_hashes, text_bytes, word_hashes
from gridloom.llm.workers import tidied, tidied_group, trim
from gridloom.plans.scratch import drop_folder, scratch_folder, settings, written

#: Bytes of text in a chunk, and in the pieces that longer texts are cut into; bytes of text whose n-grams fall into one
#: range of fingerprints.
CHUNK_BYTES, PIECE_BYTES, RANGE_BYTES = 6_000_000, 2_000_000, 8_000_000

#: Of the training texts, one in this many is held out for the weights; its n-grams count in the end all the same.
HELD = 10

#: Rounds of expectation and maximisation, and the change of weights below which they end.
ROUNDS, ENOUGH = 20, 1e-3

#: Context frequencies are told apart by powers of two.
BUCKETS = 64

#: Stand for a text's begin and end among fingerprints of words.
BEGIN, END = np.uint64(1), np.uint64(2)

#: N-grams are fingerprints with their order in the last two bits; two contexts at a text's begin have 0 there.
BEGIN_WORD, BEGIN_PAIR = 4, 8

#: Shuffle files go as soon as a step's result is written, and few texts or chunks are sent to a worker at once.
LEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(CHUNK_BYTES)}

CHUNKS = "chunk long, size long, pieces binary"


def cut_texts(id_type: pa.DataType):
    """The ``mapInArrow`` function: (doc_id, text, part) → chunks, each a compressed table of pieces of texts.

    A piece that does not begin its text has the two words before it in front (``lead``). Texts held out for weights
    are in chunks of their own, which odd numbers tell."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", id_type), ("part", pa.int32()), ("lead", pa.int32()), ("last", pa.bool_()), ("text", pa.binary())])

    def closed(chunk: int, rows: list[tuple]) -> pa.RecordBatch:
        table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 9))) as writer:
            writer.write_table(table)
        size = sum(len(r[-1]) for r in rows)
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "size", "pieces"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        task, row = TaskContext.get().partitionId(), 0
        open_, filled, number = [[], []], [0, 0], [0, 0]
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for doc_id, part, a, b in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                held = int(part == 2)
                for lead, last, text in text_pieces(data[a:b]):
                    open_[held].append(((task << 33) + row, doc_id, part, lead, last, text))
                    filled[held] += len(text) + 64
                    if filled[held] >= CHUNK_BYTES:
                        yield closed(((task << 31 | number[held]) << 1) + held, open_[held])
                        open_[held], filled[held], number[held] = [], 0, number[held] + 1
                row += 1
        for held in (0, 1):
            if open_[held]:
                yield closed(((task << 31 | number[held]) << 1) + held, open_[held])

    return run


def text_pieces(data: np.ndarray) -> Iterator[tuple[int, bool, bytes]]:
    """(words in front, is it the last, bytes) of a text's pieces."""
    if len(data) <= PIECE_BYTES:
        yield 0, True, data.tobytes()
        return
    starts, ends, _ = find_words(data, np.array([0, len(data)]), NOT_SPACE)
    first = 0
    while True:
        after = int(np.searchsorted(starts, starts[first] + PIECE_BYTES)) if len(starts) else 0
        lead = min(first, 2)
        if after >= len(starts):
            yield lead, True, data[starts[first - lead]:].tobytes() if len(starts) else b""
            return
        yield lead, False, data[starts[first - lead]:ends[after - 1]].tobytes()
        first = after


class Grams:
    """N-grams of pieces of texts, a position per word, and one more for each end.

    ``names`` has those of one word, then those of two, then those of three: one array, which a task has room for once."""

    def __init__(self, texts, lead: np.ndarray, last: np.ndarray):
        data, bounds = text_bytes(texts)
        words, counts = [], []
        for a, b in row_slices(bounds):
            part = LOWER[data[bounds[a]:bounds[b]]]
            starts, ends, first = find_words(part, bounds[a:b + 1] - bounds[a], NOT_SPACE)
            words.append(word_hashes(part, starts, ends))
            counts.append(np.diff(first))
        counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        heads = np.concatenate([[0], np.cumsum(2 - lead + counts + last)]).astype(np.int64)
        said = np.ones(heads[-1], bool)  # positions of words
        said[heads[:-1][lead == 0]] = said[heads[:-1][lead == 0] + 1] = said[heads[:-1][lead == 1]] = False
        said[heads[1:][last] - 1] = False
        sequence = np.full(heads[-1], BEGIN)
        if words:
            sequence[said] = np.concatenate(words)
        del words, said
        sequence[heads[1:][last] - 1] = END
        #: Positions are those behind the first of each piece; of them, all but its second are scored.
        inside = np.ones(heads[-1], bool)
        inside[heads[:-1]] = False
        scored = inside.copy()
        scored[heads[:-1] + 1] = False
        self.scored = scored[inside]
        self.piece = np.repeat(np.arange(len(lead), dtype=np.int32), np.diff(heads) - 1)
        self.begins = ~self.scored & (lead == 0)[self.piece]
        tag = np.uint64(3)
        size = len(self.piece)
        self.names = np.empty(2 * size + np.count_nonzero(self.scored), np.uint64)
        one, two, three = self.names[:size], self.names[size:2 * size], self.names[2 * size:]
        begin = sequence == BEGIN
        one[:] = mixed(sequence[inside])
        one &= ~tag
        one |= np.uint64(1)
        one[begin[inside]] = BEGIN_WORD
        two[:] = sequence_hashes(sequence, 2, seed=202)[inside[1:]]
        two &= ~tag
        two |= np.uint64(2)
        two[(begin[1:] & begin[:-1])[inside[1:]]] = BEGIN_PAIR
        three[:] = sequence_hashes(sequence, 3, seed=203)[scored[2:]]
        three |= tag

    def distinct(self, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams in order, and how often pieces to be learned from have each. A text's begin counts as an n-gram, to
        be the context of its first words. ``names`` are sorted where they are."""
        others, times = distinct(np.sort(self.names[~self.known(train)]))
        self.names.sort()
        names, n = distinct(self.names)
        n[np.searchsorted(names, others)] -= times
        return names, n

    def known(self, train: np.ndarray) -> np.ndarray:
        """Which of ``names`` are learned from."""
        mine = train[self.piece]
        known = (self.scored | self.begins) & mine
        return np.concatenate([known, known, mine[self.scored]])


def packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 up in few bytes: all first bytes, then all second ones and so on, as far as any is not 0."""
    width = max(1, -(-int(numbers.max()).bit_length() // 8)) if len(numbers) else 1
    planes = np.ascontiguousarray(numbers.astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(pa.decompress(data[1:], decompressed_size=size * width, codec="zstd", asbytes=True), np.uint8)
    out = np.zeros((size, 8), np.uint8)
    out[:, :width] = planes.reshape(width, size).T
    return out.view(np.uint64).ravel()


def heads_of(ordered: np.ndarray) -> np.ndarray:
    """Whether each of ordered numbers is the first of its value."""
    heads = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=heads[1:])
    return heads


def distinct(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of ordered numbers, and how often each stands. (numpy's own hashes them, which is slower.)"""
    heads = heads_of(ordered)
    first = np.flatnonzero(heads)
    times = np.empty(len(first), np.int64)
    if len(first):
        np.subtract(first[1:], first[:-1], out=times[:-1])
        times[-1] = len(ordered) - first[-1]
    del first
    return ordered[heads], times


def ranked(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones in order, and where each of ``numbers`` stands among them."""
    order = np.argsort(numbers)
    ordered = numbers[order]
    heads = heads_of(ordered)
    names = ordered[heads]
    del ordered
    place = np.cumsum(heads, dtype=np.int32)
    place -= 1
    which = np.empty(len(numbers), np.int32)
    which[order] = place
    return names, which


def range_starts(ranges: int) -> list[int]:
    """Where each of so many even ranges of fingerprints starts; the last two bits stay those of the order."""
    return [(k << 64) // ranges & ~3 for k in range(ranges)]


def range_cuts(names: np.ndarray, ranges: int) -> np.ndarray:
    return np.append(np.searchsorted(names, np.array(range_starts(ranges), np.uint64)), len(names))


def _grams(pieces: bytes) -> tuple[Grams, np.ndarray, pa.Table]:
    with pa.ipc.open_stream(pieces) as reader:
        table = reader.read_all()
    lead, last, part = (table[c].to_numpy() for c in ("lead", "last", "part"))
    return Grams(table["text"].combine_chunks(), lead, last.astype(bool)), part > 0, table


SENT = "chunk long, at int, size int, names binary, own binary"


def sent_counts(ranges: int):
    """The ``mapInArrow`` function: each chunk's n-grams and own counts, a row per range."""
    schema = pa.schema([("chunk", pa.int64()), ("at", pa.int32()), ("size", pa.int32()), ("names", pa.binary()), ("own", pa.binary())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        starts = range_starts(ranges)
        for batch in batches:
            for chunk, pieces in zip(batch.column(0).to_pylist(), batch.column(1)):
                grams, train, _ = _grams(pieces.as_buffer())
                names, n = grams.distinct(train)
                del grams, _
                cuts = range_cuts(names, ranges).tolist()
                rows = []
                for at, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    if b > a:
                        steps = np.diff(names[a:b], prepend=np.uint64(starts[at]))
                        rows.append((chunk, at, b - a, packed(steps), packed(n[a:b])))
                del names, n
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                del rows
                trim()

    return run


ANSWERS = "chunk long, at int, others binary, rest binary, sums array<long>"


def sum_counts(sent: pa.Table) -> pa.Table:
    """Of one range, for each chunk's n-grams in the order sent: the counts of other chunks, and for a chunk held out those
    of all that are not. ``sums``, in the first row: tokens and distinct tokens, tokens held out, distinct ones of the rest."""
    sizes = sent["size"].to_pylist()
    cuts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    spans = list(zip(cuts[:-1], cuts[1:]))
    chunks = sent["chunk"].to_pylist()
    names = np.empty(cuts[-1], np.uint64)
    own = np.empty(cuts[-1], np.int64)
    for (a, b), steps, counts in zip(spans, sent["names"], sent["own"]):
        np.cumsum(unpacked(steps.as_py(), b - a), out=names[a:b])
        own[a:b] = unpacked(counts.as_py(), b - a)
    names, which = ranked(names)
    word = names & np.uint64(3) == 1
    del names
    total = np.bincount(which, own, len(word)).astype(np.int64)  # counts are exact in doubles up to 2**53
    odd = np.repeat(sent["chunk"].to_numpy() % 2 == 1, sizes)
    left = total - np.bincount(which[odd], own[odd], len(word)).astype(np.int64)
    sums = [int(x) for x in (total[word].sum(), (total[word] > 0).sum(), (total - left)[word].sum(), (left > 0)[word].sum())]
    return pa.table({
        "chunk": sent["chunk"], "at": sent["at"], "others": pa.array([packed(total[which[a:b]] - own[a:b]) for a, b in spans], pa.binary()),
        "rest": pa.array([packed(left[which[a:b]]) if c % 2 else None for c, (a, b) in zip(chunks, spans)], pa.binary()),
        "sums": pa.array([sums] + [None] * (len(chunks) - 1), pa.list_(pa.int64())),
    })


def bucket(times: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one more than the whole logarithm to base 2."""
    return np.frexp(times.astype(np.float64))[1]


class Shares:
    """Counts and context counts of a chunk's scored positions."""

    def __init__(self, answers: pa.Table, pieces: bytes, ranges: int, held: bool):
        """With ``held``, the counts are those without the texts held out, which this chunk is of."""
        grams, train, self.pieces = _grams(pieces)
        known = grams.known(train)
        names, which = ranked(grams.names)
        del grams.names
        cuts = range_cuts(names, ranges)
        n = np.bincount(which[known], minlength=len(names))
        del names, known
        for at, x in zip(answers["at"].to_pylist(), answers["rest" if held else "others"]):
            told = unpacked(x.as_py(), cuts[at + 1] - cuts[at]).view(np.int64)
            n[cuts[at]:cuts[at + 1]] = told if held else n[cuts[at]:cuts[at + 1]] + told
        scored = np.flatnonzero(grams.scored)
        size = len(grams.piece)
        one, two, three = which[:size], which[size:2 * size], which[2 * size:]
        self.piece = grams.piece[scored]
        self.c1, self.c2, self.c3 = n[one[scored]], n[two[scored]], n[three]
        self.d2, self.d3 = n[one[scored - 1]], n[two[scored - 1]]

    def parts(self, n: int, v: int):
        """Shares by order, and buckets of the contexts; a share whose context was never seen is 0."""
        m1, m2, m3 = (c / np.maximum(d, 1) for c, d in ((self.c1, n), (self.c2, self.d2), (self.c3, self.d3)))
        return m1, m2, m3, bucket(self.d2), bucket(self.d3)


EVIDENCE = "m1 double, m2 double, m3 double, b2 int, b3 int, times long"


def evidence(n: int, v: int, ranges: int):
    """The cogroup function on chunks held out: distinct combinations of what mixing needs, and how often each stands."""

    def run(answers: pa.Table, chunk: pa.Table) -> pa.Table:
        m1, m2, m3, b2, b3 = Shares(answers, chunk["pieces"][0].as_buffer(), ranges, True).parts(n, v)
        table = pa.table({"m1": m1, "m2": m2, "m3": m3, "b2": b2.astype(np.int32), "b3": b3.astype(np.int32)})
        found = table.group_by(table.column_names).aggregate([([], "count_all")])
        return found.rename_columns([*table.column_names, "times"]).cast(pa.schema([*table.schema, ("times", pa.int64())]))

    return run


def learn_weights(found: DataFrame, v: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of the third, second and first order by expectation and maximisation; one row per pair of buckets comes
    back from each round. Buckets without evidence take the weight of the next lower one."""
    three, two, one = np.full(BUCKETS, 0.5), np.full(BUCKETS, 0.5), 0.5
    three[0] = two[0] = 0.0

    def listed(x):
        return "array(" + ", ".join(f"{float(w)!r}D" for w in x) + ")"

    for _ in range(ROUNDS):
        first = f"{one!r}D * m1"
        p1 = f"({first} + {1 - one!r}D / {v + 1})"
        rows = found.selectExpr("*", f"get({listed(three)}, b3) AS w3", f"get({listed(two)}, b2) AS w2", f"{p1} AS p1", f"{first} / {p1} AS r1").selectExpr(
            "*", "w2 * m2 + (1 - w2) * p1 AS p2").selectExpr("*", "w3 * m3 / (w3 * m3 + (1 - w3) * p2) AS r3", "w2 * m2 / p2 AS r2")
        sums = rows.groupBy("b3", "b2").agg(
            F.sum("times").alias("n3"), F.expr("sum(times * r3) AS k3"),
            F.expr("sum(times * (1 - r3)) AS n2"), F.expr("sum(times * (1 - r3) * r2) AS k2"),
            F.expr("sum(times * (1 - r3) * (1 - r2)) AS n1"), F.expr("sum(times * (1 - r3) * (1 - r2) * r1) AS k1")).toPandas()
        if not len(sums):
            return three, two, one
        new3, new2 = _shares(sums, "b3", "k3", "n3", three), _shares(sums, "b2", "k2", "n2", two)
        new1 = float(np.clip(sums["k1"].sum() / max(sums["n1"].sum(), 1e-300), 1e-6, 1 - 1e-6))
        change = max(np.abs(new3 - three).max(), np.abs(new2 - two).max(), abs(new1 - one))
        three, two, one = new3, new2, new1
        if change < ENOUGH:
            break
    return three, two, one


def _shares(sums, by: str, part: str, of: str, before: np.ndarray) -> np.ndarray:
    groups = sums.groupby(by)[[part, of]].sum()
    out, last = before.copy(), 0.5
    for b in range(1, BUCKETS):
        if b in groups.index and groups.at[b, of] > 0:
            last = float(np.clip(groups.at[b, part] / groups.at[b, of], 1e-6, 1 - 1e-6))
        out[b] = last
    return out


SCORES = "row long, doc_id {id}, n_tokens long, n_known long, base_score double, score double"


def scores(n: int, v: int, weights: tuple[np.ndarray, np.ndarray, float], ranges: int, id_type: pa.DataType):
    """The cogroup function: sums of each piece."""
    three, two, one = weights
    one = one if n else 0.0
    schema = pa.schema([("row", pa.int64()), ("doc_id", id_type), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(answers: pa.Table, chunk: pa.Table) -> pa.Table:
        shares = Shares(answers, chunk["pieces"][0].as_buffer(), ranges, False)
        pieces = shares.pieces
        m1, m2, m3, b2, b3 = shares.parts(n, v)
        p = one * m1 + (1 - one) / (v + 1)
        p = two[b2] * m2 + (1 - two[b2]) * p
        p = three[b3] * m3 + (1 - three[b3]) * p
        base = (shares.c1 + 0.1) / (n + 0.1 * (v + 1))

        def summed(x):
            return np.bincount(shares.piece, x, pieces.num_rows)

        counts = [pa.array(summed(x).astype(np.int64)) for x in (np.ones(len(p)), shares.c1 > 0)]
        columns = [pieces["row"], pieces["doc_id"], *counts, pa.array(summed(np.log10(base))), pa.array(summed(np.log10(p)))]
        return pa.Table.from_arrays(columns, schema=schema)

    return run


def interpolated_scores(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are runs of anything but ASCII white space, A-Z lowered, and one end. The model learns from the rows where
    ``train`` holds: all their n-grams up to three tokens are counted. ``score`` is the decimal logarithm of the text's
    probability, in which a token's share after the two before it is mixed with that after the one before it, with that
    in all tokens, and with one of as many parts as there are distinct tokens and one more. Weights depend on how often
    the context stands in training; they are learned on a tenth of its texts (by a hash of the id) with counts of the
    rest. ``base_score`` is that of single tokens with 0.1 added to each count. ``n_known`` tokens are among the
    ``train_tokens`` ones.

    Null text is empty, and has one token, the end. Null ``train`` does not hold. Repeated rows count, and give a row, each; so
    do rows of one id. Without training texts every token is equally likely, without any held out all weights are a
    half. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    work = scratch_folder(spark, "interpolation")
    part = F.when(F.coalesce(train, F.lit(False)), F.when(F.expr(f"pmod(xxhash64(`{id_col}`, 13), {HELD}) = 0"), 2).otherwise(1)).otherwise(0)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), part.alias("part"))
    id_ddl = texts.schema["doc_id"].dataType.simpleString()
    id_arrow = to_arrow_schema(texts.schema).field("doc_id").type
    with settings(spark, LEAN):
        chunks = written(texts.mapInArrow(tidied(cut_texts(id_arrow)), CHUNKS), "chunks", work, **{"parquet.block.size": str(2 * CHUNK_BYTES)})

    ranges = -(-(chunks.agg(F.sum("size")).first()[0] or 1) // RANGE_BYTES)
    sent = chunks.select("chunk", "pieces").mapInArrow(tidied(sent_counts(ranges)), SENT)
    with settings(spark, LEAN):
        answers = written(sent.groupBy("at").applyInArrow(tidied_group(sum_counts), ANSWERS), "answers", work)
    n, v, n_held, v_rest = answers.where("sums IS NOT NULL").selectExpr(*[f"coalesce(sum(sums[{i}]), 0)" for i in range(4)]).first()

    def both(where: str, function, ddl: str) -> DataFrame:
        """By chunk, its answers and its pieces: each chunk has both."""
        left, right = answers.where(where).select("chunk", "at", "others", "rest"), chunks.where(where).select("chunk", "pieces")
        return left.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(tidied_group(function), ddl)

    with settings(spark, LEAN):
        found = written(both("chunk % 2 = 1", evidence(n - n_held, v_rest, ranges), EVIDENCE).groupBy("m1", "m2", "m3", "b2", "b3").agg(
            F.sum("times").alias("times")), "evidence", work)
    weights = learn_weights(found, v_rest)
    per_piece = both("true", scores(n, v, weights, ranges, id_arrow), SCORES.format(id=id_ddl))
    with settings(spark, LEAN):
        per_text = written(per_piece.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]), "scores")
    drop_folder(spark, work)
    return per_text.select("doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
