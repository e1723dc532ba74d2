"""Workbooks that keep arriving in a folder, as a stream of typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridloom.errors import WorkbookError
from gridloom.sources.files import workbook_files
from gridloom.sources.reader import parse_options, read_workbook_files


def stream_workbooks(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> DataFrame:
    """Streaming DataFrame of the workbooks under ``path``; the schema has to be given.

    The read works row by row and keeps no state, so the batch pipeline runs on the stream as it is.
    """
    if schema is None:
        raise WorkbookError("A stream of workbooks needs a schema")
    parsed = parse_options(spark, options)
    # The scan's own columns, and those of the partition folders that are there already.
    found = workbook_files(spark, path, parsed).schema
    reader = spark.readStream.format("binaryFile").schema(found).options(**parsed.file_options)
    reader = reader.option("ignoreMissingFiles", str(parsed.ignore_missing_files).lower())
    return read_workbook_files(reader.load(path), schema, **options)
