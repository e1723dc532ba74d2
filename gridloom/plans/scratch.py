"""Writing an intermediate table to shared storage, so that it is worked out once and survives lost executors."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Folders made while a ``written_alone`` is at work, innermost last.
_PASSING: list[list[str]] = []

#: Shuffle files go as soon as the query that made them has ended; a table it wrote does not need them any more.
LEAN_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``, else the context's, else the session's warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    found = found or spark.conf.get("spark.sql.warehouse.dir", None)
    if not found:
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
    return found.rstrip("/")


def _files(spark: SparkSession, folder: str):
    """Hadoop's path and file system of a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_folder(spark: SparkSession, what: str) -> str:
    """A new folder for intermediate rows, removed when the session's JVM ends."""
    folder = f"{scratch_root(spark)}/gridloom-{what}-{uuid.uuid4()}"
    path, files = _files(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    if _PASSING:
        _PASSING[-1].append(folder)
    return folder


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Removes a scratch folder ahead of time, when no frame reads from it any more."""
    path, files = _files(spark, folder)
    files.delete(path, True)


@contextmanager
def settings(spark: SparkSession, changed: dict[str, str]):
    """Within, these settings of the session hold for what is run; those before come back afterwards."""
    before = {name: spark.conf.get(name, None) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def written(df: DataFrame, what: str, under: str | None = None, **options: str) -> DataFrame:
    """The same rows, read back from a table written once, in a scratch folder of its own or ``under`` another.

    ``options`` are those of Spark's writer."""
    spark = df.sparkSession
    folder = f"{under}/{what}-{uuid.uuid4()}" if under else f"{scratch_folder(spark, what)}/rows"
    df.write.options(**options).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def written_alone(spark: SparkSession, make: Callable[[], DataFrame], what: str) -> DataFrame:
    """The rows of ``make()``, written; the scratch folders and shuffle files it made on the way go at once."""
    folder = scratch_folder(spark, what)
    _PASSING.append([])
    try:
        with settings(spark, LEAN_SHUFFLES):
            return written(make(), what, folder)
    finally:
        for passing in _PASSING.pop():
            drop_folder(spark, passing)
