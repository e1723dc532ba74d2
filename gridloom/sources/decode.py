"""Workbook files → grid rows, in one pass over each file; only pieces of large files are shuffled."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

from gridloom.options import WorkbookOptions
from gridloom.relations import grid_schema
from gridloom.sources.files import partition_columns
from gridloom.sources.inflate import inflate_stage
from gridloom.sources.pieces import PIECE_ARROW, cut_stage, piece_stage
from gridloom.sources.package import open_workbooks, select_workbook_sheets

# Sheets of files above this size are cut by one task into pieces of about so many bytes of XML, which others decode.
SPREAD_BYTES = 64 * 1024**2
PIECE_BYTES = 4 * 1024**2


def decode_workbooks(
    files: DataFrame, options: WorkbookOptions, row_limit: int | None = None, first_sheet: bool = False, scanned: bool = False,
    spread_bytes: int | None = None, piece_bytes: int | None = None,
) -> DataFrame:
    """Grid rows of the sheets asked for in ``files(path, content, <partition columns>)``.

    ``row_limit`` stops each sheet after that row, and ``first_sheet`` leaves out all but the first sheet
    asked for, as schema inference needs no more. ``scanned`` says that ``files`` is Spark's scan of files, which
    gives every file a length and reads contents only below its filter on it: then large files are decoded by pieces,
    of which a shuffle moves each once, and no file's content; ``spread_bytes`` says which are large, ``piece_bytes`` how
    much XML a piece has. Any other frame is worked out once, in one branch, whatever its columns hold.
    """
    carry = partition_columns(files)
    sized = scanned and not files.isStreaming and row_limit is None
    schema = StructType(grid_schema().fields + [files.schema[c] for c in carry])
    stage = inflate_stage(
        carry,
        to_arrow_schema(schema),
        formulas=not options.evaluate_formulae,
        row_limit=row_limit,
        string_limit=options.threshold_bytes,
        ignore_corrupt=bool(options.ignore_corrupt_files),
    )
    columns = ["path AS file", "content", "sheets", "strings_part", "date_styles", "date1904", *[f"`{c}`" for c in carry]]

    def opened(some: DataFrame, *more: str) -> DataFrame:
        chosen = select_workbook_sheets(open_workbooks(some.select("path", "content", *more, *carry)), options)
        return chosen.withColumn("sheets", F.expr("slice(sheets, 1, 1)")) if first_sheet else chosen

    if not sized:
        return opened(files).selectExpr(*columns).mapInArrow(stage, schema)
    # The filter on length reaches the file scan, so each file's content is read for one branch only.
    limit = SPREAD_BYTES if spread_bytes is None else spread_bytes
    whole = opened(files.filter(f"length <= {limit}")).selectExpr(*columns)
    large = opened(files.filter(f"length > {limit}"), "length").selectExpr(*columns)
    return whole.mapInArrow(stage, schema).unionByName(_by_pieces(large, carry, schema, options, piece_bytes or PIECE_BYTES))


def _by_pieces(large: DataFrame, carry: list[str], schema: StructType, options: WorkbookOptions, piece_bytes: int) -> DataFrame:
    """Grid rows of large workbooks: cut in one pass each, dealt out, decoded."""
    formulas, ignore = not options.evaluate_formulae, bool(options.ignore_corrupt_files)
    kept = to_arrow_schema(StructType([large.schema[c] for c in carry]))
    arrow = pa.schema([*PIECE_ARROW, *kept])
    cut = large.mapInArrow(cut_stage(carry, arrow, formulas, options.threshold_bytes, ignore, piece_bytes), from_arrow_schema(arrow))
    # A number of partitions of its own keeps Spark from joining pieces again, which are small but take long.
    n = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut.repartition(n, "file", "sheet_idx", "piece")
    return dealt.mapInArrow(piece_stage(carry, to_arrow_schema(schema), formulas, ignore), schema)
