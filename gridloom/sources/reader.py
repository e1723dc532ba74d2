"""``read_workbooks``: files → typed DataFrame."""

from __future__ import annotations

import logging
import re
from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.errors import NO_SHEET, WorkbookError, WorkbookOptionError
from gridloom.functions.a1 import parse_a1
from gridloom.operators.formulas import formula_view
from gridloom.operators.infer import SHEET_NAME_COLUMN, check_flag, infer_schema
from gridloom.operators.rows import assemble_rows
from gridloom.operators.select import anchor
from gridloom.options import WorkbookOptions
from gridloom.sources.decode import decode_workbooks
from gridloom.sources.files import partition_columns, resolve_ignore, workbook_files
from gridloom.sources.package import open_workbooks

log = logging.getLogger(__name__)

_GLOB_CHARS = re.compile(r"([\\*?\[\]{}])")


def parse_options(spark: SparkSession, options: dict) -> WorkbookOptions:
    parsed = resolve_ignore(spark, WorkbookOptions.parse(options))
    if parsed.workbook_password is not None:
        raise WorkbookOptionError("The 'workbookPassword' option is not supported: encrypted workbooks can't be read")
    return parsed


def _table_grid(files: DataFrame, options: WorkbookOptions, row_limit: int | None = None, first_sheet: bool = False, scanned: bool = False):
    grid = decode_workbooks(files, options, row_limit, first_sheet, scanned)
    return formula_view(anchor(grid, options.cell_address), options.evaluate_formulae)


def _infer(first_file: DataFrame, options: WorkbookOptions) -> T.StructType:
    """Schema from the first wanted sheet of one file; stops inflating once the sample is complete."""
    limit = None
    if options.max_row_count:
        limit = parse_a1(options.cell_address)[0] + options.header_row_count + options.max_row_count - 1
    try:
        return infer_schema(_table_grid(first_file, options, limit, first_sheet=True), options)
    except PySparkException as e:
        text = str(e)
        if NO_SHEET in text:
            raise WorkbookError(NO_SHEET) from e
        found = re.search(r"can't read workbook [^\n]*", text)
        if found:
            raise WorkbookError(found[0]) from e
        raise


def _first_path(files: DataFrame, options: WorkbookOptions) -> str | None:
    return files.agg(F.min("path")).first()[0]


def _first_readable(files: DataFrame, only, after: str) -> str | None:
    """The first path behind ``after`` whose workbook opens. Walks the sorted listing in slices, each four times the one
    before, and opens no file behind the slice with the first good one."""
    size = 1
    while True:
        rows = files.select("path").filter(F.col("path") > after).orderBy("path").limit(size).collect()
        if not rows:
            return None
        paths = [r["path"] for r in rows]
        opened = open_workbooks(only(paths).select("path", "content")).filter(F.col("status") == "ok")
        found = opened.agg(F.min("path")).first()[0]
        if found is not None:
            return found
        after, size = paths[-1], min(size * 4, 4096)


def infer_files_schema(files: DataFrame, options: WorkbookOptions, only=None) -> T.StructType:
    """Schema of the first file by path. ``only(paths)`` gives a DataFrame of these files, so that no other is read."""
    only = only or (lambda paths: files.filter(F.col("path").isin(paths)))
    path = _first_path(files, options)
    if path is None:
        raise WorkbookError("No workbook files found")
    if options.ignore_corrupt_files:
        path = _first_readable(files, only, "")
        while path is not None:
            try:  # a file that opens may still hold a damaged sheet
                return _infer(only([path]).select("path", "content"), replace(options, ignore_corrupt_files=False))
            except WorkbookError as e:
                if "can't read workbook" not in str(e):
                    raise
                log.warning("%s", e)
            path = _first_readable(files, only, path)
        raise WorkbookError("No readable workbook files found")
    return _infer(only([path]).select("path", "content"), options)


def _read(files: DataFrame, schema, options: WorkbookOptions, only=None) -> DataFrame:
    carry = partition_columns(files)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if schema is None:
        schema = infer_files_schema(files, options, only)
    else:
        check_flag(schema, options)
        # Fields named like a partition column describe that column, not a grid column.
        partitions = {c.lower() for c in carry}
        schema = T.StructType([f for f in schema if f.name.lower() not in partitions])
        if options.include_sheet_name and SHEET_NAME_COLUMN not in schema.names:
            log.warning("includeSheetName is set, but the given schema has no column %s", SHEET_NAME_COLUMN)
    return assemble_rows(_table_grid(files, options, scanned=only is not None), schema, options, carry)


def read_workbook_files(files: DataFrame, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Typed rows of ``files(path, content, <partition columns>)``, however that DataFrame came about."""
    return _read(files, schema, parse_options(files.sparkSession, options))


def read_workbooks(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """Typed rows of all workbooks under ``paths`` (a path, a glob, or a list of them).

    Partition directories become columns at the end. Without a schema, one job reads the top of the
    first file; see the README for the options.
    """
    parsed = parse_options(spark, options)
    files = workbook_files(spark, paths, parsed)

    def only(paths: list[str]) -> DataFrame:
        single = replace(parsed, file_options={})
        return workbook_files(spark, [_GLOB_CHARS.sub(r"\\\1", p) for p in paths], single)

    return _read(files, schema, parsed, only)


def create_workbook_view(spark: SparkSession, name: str, paths: str | list[str], schema=None, **options) -> DataFrame:
    """Registers the read as a temporary view for SQL, and returns it."""
    df = read_workbooks(spark, paths, schema, **options)
    df.createOrReplaceTempView(name)
    return df


def add_reader_method() -> None:
    """Adds ``spark.read.excel(*paths, schema=None, **options)`` to Spark's reader."""

    def excel(self: DataFrameReader, *paths: str, schema=None, **options) -> DataFrame:
        return read_workbooks(self._spark, list(paths), schema, **options)

    DataFrameReader.excel = excel


class WorkbookFormat:
    """``spark.read.format("excel")``: collects options, schema and paths, then reads as :func:`read_workbooks` does."""

    def __init__(self, spark: SparkSession):
        self._spark, self._options, self._schema = spark, {}, None

    def option(self, key: str, value) -> WorkbookFormat:
        self._options[key] = value
        return self

    def options(self, **options) -> WorkbookFormat:
        self._options.update(options)
        return self

    def schema(self, schema: T.StructType | str) -> WorkbookFormat:
        self._schema = schema
        return self

    def load(self, path: str | list[str] | None = None, format: str | None = None, schema: T.StructType | str | None = None, **options) -> DataFrame:
        given = {k.lower(): v for k, v in {**self._options, **options}.items()}
        paths = path if path is not None else given.pop("path", None)
        if paths is None:
            raise WorkbookOptionError("No path to read workbooks from")
        given.pop("path", None)
        return read_workbooks(self._spark, paths, schema if schema is not None else self._schema, **given)


def add_format() -> None:
    """Makes ``excel`` a format of Spark's reader: ``spark.read.format("excel").option(…).schema(…).load(…)``.

    Spark can't run a data source written in Python as a DataFrame plan, so the reader hands over where the format is
    named; options and a schema set before that are kept as well.
    """
    if hasattr(DataFrameReader, "_without_workbooks"):
        return
    plain = {name: getattr(DataFrameReader, name) for name in ("format", "option", "options", "schema", "load")}
    DataFrameReader._without_workbooks = plain

    def noted(self: DataFrameReader) -> dict:
        return self.__dict__.setdefault("_noted", {"options": {}, "schema": None})

    def handed_over(self: DataFrameReader) -> WorkbookFormat:
        reader = WorkbookFormat(self._spark).options(**noted(self)["options"])
        return reader.schema(noted(self)["schema"]) if noted(self)["schema"] is not None else reader

    def format(self: DataFrameReader, source: str):
        return handed_over(self) if source.lower() == "excel" else plain["format"](self, source)

    def option(self: DataFrameReader, key, value):
        noted(self)["options"][key] = value
        return plain["option"](self, key, value)

    def options(self: DataFrameReader, **options):
        noted(self)["options"].update(options)
        return plain["options"](self, **options)

    def schema(self: DataFrameReader, schema):
        noted(self)["schema"] = schema
        return plain["schema"](self, schema)

    def load(self: DataFrameReader, path=None, format=None, schema=None, **options):
        if format is not None and format.lower() == "excel":
            return handed_over(self).load(path, None, schema, **options)
        return plain["load"](self, path, format, schema, **options)

    DataFrameReader.format, DataFrameReader.option, DataFrameReader.options = format, option, options
    DataFrameReader.schema, DataFrameReader.load = schema, load
