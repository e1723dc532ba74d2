"""Exact top-k search by inner product: vectors keyed by nearest pivot and distance to it, visited in annuli.

A vector x becomes a point by one more coordinate, sqrt(M² - |x|²), with M the largest norm; a query gets 0 there. Then
the larger the inner product, the smaller the distance, and the triangle inequality holds: a point at distance r from a
pivot is at least |D - r| from a query at distance D. Each query goes over annuli in the order of that bound, outwards
from its own distances, and stops at the first whose bound exceeds its k-th best.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.workers import tidied
from gridloom.plans.scratch import scratch_folder, written

#: Vectors looked at to choose pivots and first thresholds, about; pivots of vectors of one length.
SAMPLE, PIVOTS = 4096, 48

#: Vectors of an annulus, and queries that go over the index together.
ANNULUS, QUERIES = 1024, 4096

#: Bytes of vectors that a task holds at once to walk over their annuli in order; annuli between looks at the k-th best.
HELD, STEPS = 32 << 20, 2


def augmented(vectors: np.ndarray, largest: float) -> np.ndarray:
    """The points of vectors."""
    norms = (vectors**2).sum(axis=1)
    return np.column_stack([vectors, np.sqrt(np.maximum(0, largest - norms))])


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * points @ centres.T
    return np.sqrt(np.maximum(0, square))


def choose_pivots(points: np.ndarray, n: int) -> np.ndarray:
    """Points far from each other: each the one farthest from those before."""
    chosen = [0]
    away = distances(points, points[:1])[:, 0]
    while len(chosen) < n and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def products(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly: by floating point where it holds them, else by 64-bit integers."""
    most = max(1.0, np.abs(one).max(initial=0)) * max(1.0, np.abs(other).max(initial=0)) * one.shape[1]
    if most < 2.0**53:
        return (one @ other.T).astype(np.int64)
    return one.astype(np.int64) @ other.astype(np.int64).T


def best_of(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Rows that are among their query's ``k`` best; ties to the smaller id."""
    order = np.lexsort((ids, -scores, query))
    ordered = query[order]
    return order[np.arange(len(order)) - np.searchsorted(ordered, ordered) < k]


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(vec_id, dim, v): components times ``scale``, rounded down. Vectors that are null or empty, or hold a null, NaN or
    infinite component, and rows with a null id are left out."""
    v = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))
    fine = F.coalesce(F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x)), F.lit(False))
    return vectors.where(F.col(id_col).isNotNull() & fine & (F.size(vector_col) > 0)).select(
        F.col(id_col).cast("long").alias("vec_id"), F.size(vector_col).alias("dim"), v.alias("v"))


def build_index(whole: DataFrame) -> tuple[DataFrame, dict]:
    """The annuli as a table, and for each vector length: pivots, largest squared norm, the sample (ids, vectors)."""
    squared = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    known = {r.dim: r for r in whole.groupBy("dim").agg(F.count("*").alias("n"), F.max(squared).alias("largest")).collect()}
    total = sum(r.n for r in known.values())
    place = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) / (1 << 20)
    taken = whole.where(place < SAMPLE / max(1, total)).orderBy("vec_id").collect()
    spaces = {}
    for dim, r in known.items():
        own = [x for x in taken if x.dim == dim]
        sample = np.array([x.v for x in own], np.float64).reshape(-1, dim)
        points = augmented(sample if len(own) else np.zeros((1, dim)), r.largest)
        spaces[dim] = {"largest": r.largest, "pivots": choose_pivots(points, PIVOTS), "ids": np.array([x.vec_id for x in own], np.int64), "sample": sample}
    pivots = {dim: (s["pivots"], s["largest"]) for dim, s in spaces.items()}

    def keyed(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            values = batch.column(2)
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                vectors = values.take(pa.array(rows)).flatten().to_numpy().reshape(-1, dim)
                away = distances(augmented(vectors, pivots[dim][1]), pivots[dim][0])
                near = away.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), dim, np.int32)), pa.array(near.astype(np.int32)),
                    pa.array(away[np.arange(len(rows)), near]), pa.array([x.tobytes() for x in vectors], pa.binary())],
                    ["vec_id", "dim", "pivot", "away", "v"])

    def annuli(batches) -> Iterator[pa.RecordBatch]:
        """Runs of neighbours in the order of pivot and distance."""
        rows = (r for batch in batches for r in batch.to_pylist())
        for (dim, pivot), own in groupby(rows, lambda r: (r["dim"], r["pivot"])):
            ready: list[dict] = []
            for row in own:
                ready.append(row)
                if len(ready) == ANNULUS:
                    yield annulus(dim, pivot, ready)
                    ready = []
            if ready:
                yield annulus(dim, pivot, ready)

    rows = written(whole.mapInArrow(tidied(keyed), "vec_id long, dim int, pivot int, away double, v binary"), "keyed-vectors")
    ordered = rows.repartitionByRange("dim", "pivot", "away", "vec_id").sortWithinPartitions("dim", "pivot", "away", "vec_id")
    return written(ordered.mapInArrow(tidied(annuli), "dim int, pivot int, low double, high double, ids binary, vectors binary"), "annuli"), spaces


def annulus(dim: int, pivot: int, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{
        "dim": dim, "pivot": pivot, "low": rows[0]["away"], "high": rows[-1]["away"],
        "ids": np.array([r["vec_id"] for r in rows], np.int64).tobytes(), "vectors": b"".join(r["v"] for r in rows)}],
        pa.schema([("dim", pa.int32()), ("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("ids", pa.binary()), ("vectors", pa.binary())]))


class QueryBlock:
    """Queries of one length, and the best found for each so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, space: dict, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.reach = (vectors**2).sum(axis=1) + space["largest"]
        self.to_pivots = distances(np.column_stack([vectors, np.zeros(len(vectors))]), space["pivots"])
        self.least = np.full(len(ids), np.iinfo(np.int64).min)  # scores that can still be among the best
        for a in range(0, len(ids), 256):  # k-th best of the sample
            scores = products(vectors[a:a + 256], space["sample"])
            scores[ids[a:a + 256, None] == space["ids"]] = np.iinfo(np.int64).min
            if scores.shape[1] >= k:
                self.least[a:a + 256] = np.partition(scores, -k, axis=1)[:, -k]
        self.found = [np.zeros((0, 3), np.int64)]

    def walk(self, rows: list[dict]) -> None:
        """Goes over annuli, each query from the one of the least bound on, to the first beyond its k-th best."""
        if not rows:
            return
        pivots, low, high = (np.array([r[c] for r in rows]) for c in ("pivot", "low", "high"))
        to_pivot = self.to_pivots[:, pivots]
        bounds = np.maximum(0, np.maximum(to_pivot - high, low - to_pivot))
        order = bounds.argsort(axis=1, kind="stable")
        going, waiting = np.arange(len(self.ids)), 0
        for step in range(len(rows)):
            farthest = np.sqrt(np.maximum(0, self.reach[going] - 2.0 * self.least[going]))
            going = going[bounds[going, order[going, step]] <= farthest * (1 + 1e-9) + 1e-6]
            if not len(going):
                break
            at = order[going, step]
            for a in np.unique(at).tolist():
                self.visit(rows[a], going[at == a])
                waiting += len(self.found[-1])
                if waiting > 1 << 18:
                    self.settle()
                    waiting = 0
            if step % STEPS == STEPS - 1:
                self.settle()
                waiting = 0
        self.settle()

    def visit(self, row: dict, open_: np.ndarray) -> None:
        """Looks at an annulus for some of the queries."""
        ids = np.frombuffer(row["ids"], np.int64)
        scores = products(self.vectors[open_], np.frombuffer(row["vectors"], np.float64).reshape(len(ids), -1))
        q, x = np.nonzero(scores >= self.least[open_][:, None])
        other = ids[x] != self.ids[open_[q]]
        q, x = q[other], x[other]
        self.found.append(np.column_stack([open_[q], ids[x], scores[q, x]]))

    def settle(self) -> None:
        """Keeps each query's best, and asks for more than the last of them from now on."""
        rows = np.concatenate(self.found)
        rows = rows[best_of(rows[:, 0], rows[:, 1], rows[:, 2], self.k)]
        count = np.bincount(rows[:, 0], minlength=len(self.ids))
        last = np.cumsum(count) - 1
        full = count == self.k
        self.least[full] = np.maximum(self.least[full], rows[last[full], 2])
        self.found = [rows]


def search(index: DataFrame, spaces: dict, queries: pa.Table, k: int) -> DataFrame:
    """(query_id, vec_id, score): of each task's part of the index, the best for each query."""
    ids, dims = queries.column(0).to_numpy(), queries.column(1).to_numpy()
    by_dim = {}
    for dim in np.unique(dims).tolist():
        own = np.flatnonzero(dims == dim)
        vectors = queries.column(2).take(pa.array(own)).combine_chunks().flatten().to_numpy().reshape(-1, dim)
        by_dim[dim] = QueryBlock(ids[own], vectors, spaces[dim], k)

    def visit(batches) -> Iterator[pa.RecordBatch]:
        held, size = {dim: [] for dim in by_dim}, 0
        for batch in batches:
            for k in range(batch.num_rows):
                (row,) = batch.slice(k, 1).to_pylist()
                if row["dim"] in by_dim:
                    held[row["dim"]].append(row)
                    size += len(row["vectors"])
                if size > HELD:
                    for dim, rows in held.items():
                        by_dim[dim].walk(rows)
                    held, size = {dim: [] for dim in by_dim}, 0
        for dim, block in by_dim.items():
            block.walk(held[dim])
            rows = block.found[0]
            yield pa.RecordBatch.from_arrays([pa.array(block.ids[rows[:, 0]]), pa.array(rows[:, 1]), pa.array(rows[:, 2])], ["query_id", "vec_id", "score"])

    return index.mapInArrow(tidied(visit), "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: str, k: int = 20, scale: float = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each query's ``k`` best vectors: query_id, rank (from 1), vec_id, score.

    Queries are the rows of ``vectors`` that the condition ``is_query`` (SQL, on vec_id) holds for; candidates are all
    rows with another id. The score is the inner product of components times ``scale``, rounded down; ties go to the
    smaller id. Vectors of another length than the query's are no candidates; see ``whole_vectors`` for what takes no
    part. Ids are taken to be unique; further rows of an id are candidates of their own. An empty table gives no rows.

    Queries go over the index in blocks of about ``QUERIES``, which bounds what is sent to tasks.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, id_col, vector_col, scale)
    index, spaces = build_index(whole)
    asked = whole.where(is_query)
    blocks = max(1, -(-asked.count() // QUERIES))
    folder = f"{scratch_folder(spark, 'found')}/rows" if blocks > 1 else None
    for b in range(blocks):
        found = search(index, spaces, asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow(), k)
        if folder:
            found.write.mode("append").parquet(folder)
    if folder:
        found = spark.read.schema("query_id long, vec_id long, score long").parquet(folder)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
