"""Grid → table: sheet choice, anchoring, schema, rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridloom.operators.formulas import formula_view
from gridloom.operators.infer import check_flag, infer_schema
from gridloom.operators.rows import assemble_rows
from gridloom.operators.select import anchor, first_sheet, require_sheets, select_sheets
from gridloom.options import WorkbookOptions


def table_view(grid: DataFrame, options: WorkbookOptions) -> DataFrame:
    """The wanted sheets of a grid, seen from the table's first cell."""
    chosen = select_sheets(grid, options.sheet_name_pattern)
    return formula_view(anchor(chosen, options.cell_address), options.evaluate_formulae)


def read_grid(grid: DataFrame, schema: T.StructType | str | None = None, keep: list[str] = (), **options) -> DataFrame:
    """Typed table of any grid; same options as :func:`gridloom.read_workbooks`.

    Without a schema, one job over the top of the first sheet finds it. A pattern that no sheet of a workbook
    matches is an error.
    """
    parsed = WorkbookOptions.parse(options)
    view = table_view(grid, parsed)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if schema is None:
        schema = infer_schema(first_sheet(view), parsed)
    else:
        check_flag(schema, parsed)
        if parsed.sheet_name_pattern.strip():
            return require_sheets(assemble_rows(view, schema, parsed, keep), grid, parsed.sheet_name_pattern)
    return assemble_rows(view, schema, parsed, keep)
