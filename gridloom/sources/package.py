"""Workbook level: which sheets there are, which styles are dates — all from the small XML parts.

One row per workbook. The only Python here is the zip directory (:func:`zip_directory`); its XML is read
by Spark's own XML function.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.errors import NO_SHEET
from gridloom.functions.dates import is_date_format
from gridloom.operators.select import sheet_wanted
from gridloom.options import WorkbookOptions
from gridloom.sources.container import STATUS_FIELDS, directory

SHEETS_TYPE = "array<struct<idx:int,name:string,part:string>>"
_WORKBOOK = "workbookPr struct<_date1904:string>, sheets struct<sheet:array<struct<_name:string,_id:string>>>"
_RELS = "Relationship array<struct<_Id:string,_Target:string>>"
_STYLES = (
    "numFmts struct<numFmt:array<struct<_numFmtId:int,_formatCode:string>>>,"
    " cellXfs struct<xf:array<struct<_numFmtId:int>>>"
)


def zip_directory(content: Column, path: Column) -> Column:
    """``struct`` of status, error and small parts of the container in ``content``."""

    @F.pandas_udf(", ".join(f"{n} string" for n in STATUS_FIELDS))
    def read(content: pd.Series, path: pd.Series) -> pd.DataFrame:
        rows = [directory(bytes(c), p) for c, p in zip(content, path)]
        return pd.DataFrame(rows, columns=list(STATUS_FIELDS), dtype=object)

    return read(content, path)


def _xml(part: str, ddl: str, root: str) -> str:
    options = f"map('ignoreNamespace', 'true', 'mode', 'PERMISSIVE', 'rowTag', '{root}')"
    return f"from_xml({part}, '{ddl}', {options})"


def date_styles(styles: str) -> str:
    """Indexes of the cell styles whose number format shows a date; ``styles`` is the parsed part."""
    code = f"get(filter({styles}.numFmts.numFmt, f -> f._numFmtId = x._numFmtId), 0)._formatCode"
    flagged = (
        f"transform(coalesce({styles}.cellXfs.xf, array()), "
        f"(x, i) -> CASE WHEN {is_date_format('x._numFmtId', code)} THEN i END)"
    )
    return f"array_compact({flagged})"


def open_workbooks(files: DataFrame) -> DataFrame:
    """Adds to ``files(path, content, …)``: status, error, sheets, strings_part, date_styles, date1904.

    ``sheets`` is an array of idx, name and part in workbook order.
    """
    own = [f"`{c}`" for c in files.columns]
    parsed = files.withColumn("_dir", zip_directory(F.col("content"), F.col("path"))).selectExpr(
        *own, "_dir.status AS status", "_dir.error AS error", "_dir.strings_part AS strings_part", "_dir.base AS _base",
        f"{_xml('_dir.workbook', _WORKBOOK, 'workbook')} AS _workbook",
        f"{_xml('_dir.rels', _RELS, 'Relationships')} AS _rels",
        f"{_xml('_dir.styles', _STYLES, 'styleSheet')} AS _styles",
    )
    target = "get(filter(_rels.Relationship, r -> r._Id = s._id), 0)._Target"
    absolute = (
        f"CASE WHEN startswith({target}, '/') THEN substring({target}, 2) ELSE concat(coalesce(_base, ''), {target}) END"
    )
    # A target may step out of its folder: a/b/../c is a/c.
    part = f"regexp_replace({absolute}, '[^/]+/[.][.]/', '')"
    sheets = (
        f"transform(coalesce(_workbook.sheets.sheet, array()), "
        f"(s, i) -> named_struct('idx', i, 'name', s._name, 'part', {part}))"
    )
    return parsed.selectExpr(
        *own, "status", "error", "strings_part", f"{sheets} AS sheets", f"{date_styles('_styles')} AS date_styles",
        "coalesce(_workbook.workbookPr._date1904 IN ('1', 'true'), false) AS date1904",
    )


def sheet_catalog(workbooks: DataFrame) -> DataFrame:
    """One row per sheet: file, sheet_idx, sheet_name, part (and the columns the files came with)."""
    own = {"content", "status", "error", "strings_part", "sheets", "date_styles", "date1904", "path"}
    extra = [f"`{c}`" for c in workbooks.columns if c not in own]
    return workbooks.selectExpr("path AS file", *extra, "explode(sheets) AS _s").selectExpr(
        "file", "_s.idx AS sheet_idx", "_s.name AS sheet_name", "_s.part AS part", *extra
    )


def select_workbook_sheets(workbooks: DataFrame, options: WorkbookOptions) -> DataFrame:
    """Leaves in ``sheets`` of each workbook the sheets asked for.

    A workbook that can't be opened, or has no such sheet, ends the query when it is reached; where corrupt
    files are to be skipped, one that can't be opened is left without sheets. Rows are not filtered, as Spark
    would move such a filter below the opening and open each file once more for it.
    """
    failed = "raise_error(concat(\"can't read workbook \", path, ': ', status, ', ', coalesce(error, '')))"
    unreadable = "array()" if options.ignore_corrupt_files else failed
    missing = f"raise_error(concat('{NO_SHEET}: ', path))"
    wanted = f"filter(sheets, s -> {sheet_wanted('s.name', 's.idx', options.sheet_name_pattern)})"
    checked = (
        f"CASE WHEN status <> 'ok' THEN cast({unreadable} AS {SHEETS_TYPE}) "
        f"WHEN size(sheets) = 0 THEN cast({missing} AS {SHEETS_TYPE}) ELSE sheets END"
    )
    return workbooks.withColumn("sheets", F.expr(wanted)).withColumn("sheets", F.expr(checked))
