"""Finding workbook files: paths, globs, partition directories, and what state the files are in."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.options import WorkbookOptions
from gridloom.relations import FILE_COLUMNS
from gridloom.sources.package import open_workbooks


def resolve_ignore(spark: SparkSession, options: WorkbookOptions) -> WorkbookOptions:
    """Options with ``ignoreCorruptFiles`` and ``ignoreMissingFiles`` taken from the session where unset."""

    def session(name, given):
        return spark.conf.get(f"spark.sql.files.{name}", "false").lower() == "true" if given is None else given

    return replace(
        options,
        ignore_corrupt_files=session("ignoreCorruptFiles", options.ignore_corrupt_files),
        ignore_missing_files=session("ignoreMissingFiles", options.ignore_missing_files),
    )


def workbook_files(spark: SparkSession, paths: str | list[str], options: WorkbookOptions | None = None) -> DataFrame:
    """``files(path, modificationTime, length, content, <partition columns>)`` of one or many paths or globs."""
    options = resolve_ignore(spark, options or WorkbookOptions())
    reader = spark.read.format("binaryFile").options(**options.file_options)
    reader = reader.option("ignoreMissingFiles", str(options.ignore_missing_files).lower())
    return reader.load([paths] if isinstance(paths, str) else list(paths))


def partition_columns(files: DataFrame) -> list[str]:
    return [c for c in files.columns if c not in FILE_COLUMNS]


def workbook_report(files: DataFrame, formulas: bool = False) -> DataFrame:
    """``workbooks(file, size, mtime, status, error, n_sheets, <partition columns>)``: what can be read and what not.

    ``status`` is one of ok, corrupt, encrypted, unsupported_format. ``formulas`` decodes the files
    too and adds ``uncalculated``: formula cells without a stored result, which read as null.
    """
    times = "modificationTime" if "modificationTime" in files.columns else "cast(NULL AS timestamp)"
    report = open_workbooks(files).selectExpr(
        "path AS file", "length(content) AS size", f"{times} AS mtime", "status", "error", "size(sheets) AS n_sheets",
        *[f"`{c}`" for c in partition_columns(files)],
    )
    if not formulas:
        return report
    from gridloom.sources.decode import decode_workbooks

    everything = WorkbookOptions(sheet_name_pattern="(?s).*", evaluate_formulae=False, ignore_corrupt_files=True)
    bare = "size(filter(cells, c -> c.formula IS NOT NULL AND c.kind = 'blank'))"
    counts = (
        decode_workbooks(files, everything).filter("cells IS NOT NULL").groupBy("file")
        .agg(F.sum(F.expr(bare)).alias("uncalculated"))
    )
    return report.join(counts, "file", "left").withColumn("uncalculated", F.coalesce("uncalculated", F.lit(0)))
