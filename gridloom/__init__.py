"""Workbooks and other cell grids as typed Spark DataFrames."""

from gridloom.errors import WorkbookError, WorkbookOptionError
from gridloom.options import WorkbookOptions
from gridloom.plans.table import read_grid
from gridloom.sources.files import workbook_files, workbook_report
from gridloom.sources.reader import create_workbook_view, read_workbook_files, read_workbooks
from gridloom.sources.tables import table_to_grid
from gridloom.streaming.stream import stream_workbooks

__all__ = [
    "WorkbookError", "WorkbookOptionError", "WorkbookOptions", "create_workbook_view", "read_grid",
    "read_workbook_files", "read_workbooks", "stream_workbooks", "table_to_grid", "workbook_files",
    "workbook_report",
]
