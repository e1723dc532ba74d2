"""Whitening of vectors with MLlib's block matrices: scatter and projection are block products, eigenvectors are local.

Entries are whole numbers first, so that equal vectors are told exactly, sums are exact, and rows are centred by whole
numbers before the one division that rounds them.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.workers import tidied
from gridloom.plans.scratch import drop_folder, scratch_folder, written

#: Doubles in a block of rows, and in all blocks of one side that one task multiplies.
BLOCK_ENTRIES, TASK_ENTRIES = 1 << 16, 1 << 19

#: Rows in one block matrix: MLlib counts rows in 32 bits where it turns blocks back into rows. More rows take several.
MATRIX_ROWS = 1 << 30

#: A component with less than this part of the variance is rounding, not variance.
LEAST_PART = 1e-11

#: Entries have to fit a 64-bit whole number.
MOST = 2.0**62


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int, shift: int) -> DataFrame:
    """(id, x): floor(scale * entry) + shift, of the vectors without null, non-finite and oversized entries."""
    fits = f"size(v) > 0 AND forall(v, c -> c IS NOT NULL AND abs(cast(c AS double) * {scale}) < {MOST!r}D)"  # NaN is larger
    return vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(fits).selectExpr(
        "id", f"transform(v, c -> floor(cast(c AS double) * {scale}) + {shift}L) AS x")


def column_sums(rows: DataFrame, dim: int) -> tuple[int, list[int], int, int]:
    """How many rows, the sum of each of ``dim`` columns, the smallest and the largest entry; all exact."""

    def add(batches) -> Iterator[pa.RecordBatch]:
        n, sums, least, most = 0, [0] * dim, 1 << 62, -(1 << 62)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy().reshape(-1, dim)
            low, high = int(x.min()), int(x.max())
            exact = x if max(high, -low) * len(x) < 1 << 62 else x.astype(object)
            n, least, most = n + len(x), min(least, low), max(most, high)
            sums = [s + int(t) for s, t in zip(sums, exact.sum(axis=0))]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dim), pa.int32()), *(pa.array([v] * dim, pa.int64()) for v in (n, least, most)),
                 pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))], ["at", "n", "least", "most", "s"])

    found = rows.select("x").mapInArrow(tidied(add), "at int, n long, least long, most long, s decimal(38,0)").groupBy("at").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.sum("s").alias("s")).orderBy("at").collect()
    return (found[0]["n"], [int(r["s"]) for r in found], found[0]["least"], found[0]["most"]) if found else (0, [0] * dim, 0, 0)


def numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows of written files with ``at``, 0, 1, 2 … in order of file and place, and their number; no row moves."""
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_i"))
    sizes = placed.groupBy("_file").count()  # a row per file
    before = sizes.selectExpr("_file", "coalesce(sum(count) OVER (ORDER BY _file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS _before")
    total = sizes.agg(F.sum("count")).first()[0] or 0
    return placed.join(before, "_file").selectExpr("_before + _i AS at", *[f"`{c}`" for c in rows.columns]), total


def block_matrix(rows: DataFrame, n_rows: int, dim: int) -> BlockMatrix:
    """The block matrix of rows (at, v): ``v`` an array of ``dim`` doubles; rows that are not there are zeros."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("at", array_to_vector("v").alias("v")), "v")
    return IndexedRowMatrix(vectors, n_rows, dim).toBlockMatrix(rows_per_block(dim), dim)


def rows_per_block(dim: int) -> int:
    return max(1, min(1024, BLOCK_ENTRIES // dim))


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix, as a local square of its columns.

    Row blocks are dealt to as many tasks as keep each small. Python's ``multiply`` has no argument for that number, so
    the method behind it is called.
    """
    blocks = -(-matrix.numRows() // matrix.rowsPerBlock)
    tasks = -(-blocks // max(1, TASK_ENTRIES // (matrix.rowsPerBlock * matrix.colsPerBlock)))
    turned = matrix.transpose()
    product = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, tasks)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def times(spark: SparkSession, matrix: BlockMatrix, right: np.ndarray) -> DataFrame:
    """(at, y): each row of the matrix times ``right``."""
    one = Matrices.dense(*right.shape, right.T.ravel().tolist())  # columns after one another
    local = BlockMatrix(spark.sparkContext.parallelize([((0, 0), one)], 1), *right.shape)
    product = matrix.multiply(local).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").alias("at"), vector_to_array("vector").alias("y"))


def whitened_vectors(
    vectors: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """A row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Entries become whole numbers x = floor(scale * entry) + shift. The fit list is each distinct x once: ``n`` vectors
    with column sums S and covariance V, of divisor n. ``deviation`` is the exact sum of (n * x - S)² over the columns,
    null where it does not fit a long. Components are V's unit eigenvectors by falling eigenvalue e; ``whitened`` is
    x - S / n projected on one, over the root of e, ``explained`` is e over V's trace. ``identity_error`` is the largest
    entry of the covariance of the fit list's whitened rows less the identity.

    Vectors that are null, empty, or hold null, non-finite or (beyond 2⁶²) oversized entries take no part, nor do those
    of another length than most have (of equally many, the longer count). Components without variance (less than 1e-11
    of it) are left out, so that equal vectors, a single vector and an empty table give no rows. Repeated rows and ids
    each give their rows; a null id stays null. Other columns are ignored.
    """
    spark = vectors.sparkSession
    work = scratch_folder(spark, "whitening")
    known = written(whole_vectors(vectors, id_col, vector_col, scale, shift), "vectors", work)
    sizes = known.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = sizes["dim"] if sizes else 1
    rows, total = numbered(known)
    rows = rows.where(F.size("x") == dim)
    fit = written(rows.groupBy("x").agg(F.min("at").alias("at")), "fit", work)
    n, sums, least, most = column_sums(fit, dim)

    # n * x - S, in longs where no step can leave them.
    wide = "bigint" if n * max(most, -least) < 1 << 61 else "decimal(38,0)"
    listed = ", ".join(f"cast('{s}' AS {wide})" for s in sums)
    moved = f"zip_with(x, array({listed}), (c, s) -> cast({n} AS {wide}) * cast(c AS {wide}) - s)"
    centred = f"transform({moved}, c -> cast(c AS double) / {n}D) AS v"
    square = "bigint" if dim * (n * (most - least)) ** 2 < 1 << 63 else "decimal(38,0)"
    root, parts = np.zeros((dim, 0)), []
    if n > 1:
        variance = scatter(block_matrix(fit.selectExpr("at", centred), total, dim)) / n
        values, axes = np.linalg.eigh((variance + variance.T) / 2)
        values, axes = values[::-1], axes[:, ::-1]
        good = min(components, int((values > LEAST_PART * values.sum()).sum()) if values[0] > 0 else 0)
        root, parts = axes[:, :good] / np.sqrt(values[:good]), (values[:good] / values.sum()).tolist()
    if not parts:
        drop_folder(spark, work)
        return _result(vectors.select(F.col(id_col).alias("id")).limit(0).selectExpr("id", "0L AS deviation", "array(0D) AS y"), n, [0.0], 0.0)

    spans = []
    for low in range(0, total, MATRIX_ROWS):
        some = rows.where(f"at >= {low} AND at < {low + MATRIX_ROWS}").selectExpr(f"at - {low} AS at", centred)
        matrix = block_matrix(some, min(MATRIX_ROWS, total - low), dim)
        spans.append(times(spark, matrix, root).withColumn("at", F.col("at") + F.lit(low).cast("long")))
    projected = spans[0]
    for more in spans[1:]:
        projected = projected.unionByName(more)
    projected = written(projected, "projected", work)

    again = projected.join(fit.select("at"), "at").select("at", F.col("y").alias("v"))
    error = float(np.abs(scatter(block_matrix(again, total, len(parts))) / n - np.eye(len(parts))).max())
    step = f"try_cast(try_add(t, try_multiply(cast(c AS {square}), cast(c AS {square}))) AS {square})"
    far = f"try_cast(aggregate({moved}, cast(0 AS {square}), (t, c) -> {step}) AS bigint)"
    found = rows.selectExpr("at", "id", f"{far} AS deviation").join(projected, "at")
    found = written(found.select("id", "deviation", "y"), "whitened")
    drop_folder(spark, work)
    return _result(found, n, parts, error)


def _result(found: DataFrame, n: int, parts: list[float], error: float) -> DataFrame:
    listed = ", ".join(f"{p!r}D" for p in parts)
    return found.selectExpr("id AS vec_id", "deviation", "posexplode(y) AS (at, whitened)").selectExpr(
        "vec_id", "at + 1 AS component", f"{n}L AS n", "deviation", "whitened", f"get(array({listed}), at) AS explained", f"{error!r}D AS identity_error")
