"""Operators on the grid and cell relations; each takes and returns DataFrames."""

from gridloom.operators.cells import cells_to_grid, grid_cells
from gridloom.operators.formulas import expand_shared_formulas, formula_view
from gridloom.operators.headers import build_headers, column_profile, table_columns, table_width
from gridloom.operators.infer import check_flag, infer_schema, infer_types
from gridloom.operators.merges import fill_merged
from gridloom.operators.rows import assemble_rows, schema_match
from gridloom.operators.select import anchor, first_sheet, select_sheets
from gridloom.operators.spine import add_gaps, close_sheets, row_spine
from gridloom.operators.strings import resolve_strings
from gridloom.operators.styles import classify_dates

__all__ = [
    "add_gaps", "anchor", "assemble_rows", "build_headers", "cells_to_grid", "check_flag", "classify_dates",
    "close_sheets", "column_profile", "expand_shared_formulas", "fill_merged", "first_sheet", "formula_view",
    "grid_cells", "infer_schema", "infer_types", "resolve_strings", "row_spine", "schema_match",
    "select_sheets", "table_columns", "table_width",
]
