"""Column names and widths, from the rows at the top of the first sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.cells import apply_fills, cell_text, cell_type, resolved_type
from gridloom.functions.names import clean_name
from gridloom.options import WorkbookOptions


def column_profile(grid: DataFrame, options: WorkbookOptions) -> DataFrame:
    """Per grid column of one anchored sheet: ``col, in_first_row, header, types``.

    Header texts are those of merged cells too; types come from the cells themselves, from at most
    ``maxRowCount`` rows below the header. One small group per column, combined before the shuffle.
    """
    heads, sample = options.header_row_count, options.max_row_count
    top = grid.filter("cells IS NOT NULL")
    if sample:
        top = top.filter(f"row < {heads + sample}")
    # The first row counts for the width even where there is no header.
    cells = f"CASE WHEN row < {max(heads, 1)} THEN {apply_fills('cells', 'fills')} ELSE cells END"
    exploded = top.selectExpr("row", "date1904", f"explode({cells}) AS c")
    said = exploded.selectExpr(
        "c.col AS col", "row",
        f"CASE WHEN row < {heads} THEN {cell_text('c', 'date1904')} END AS text",
        f"CASE WHEN row >= {heads} THEN {cell_type('c')} END AS type",
    )
    profile = said.groupBy("col").agg(
        F.expr("max(row = 0) AS in_first_row"),
        F.expr("array_sort(collect_list(CASE WHEN text <> '' THEN named_struct('row', row, 'text', text) END)) AS parts"),
        F.expr("collect_set(type) AS types"),
    )
    return profile.selectExpr(
        "col", "in_first_row", "array_join(array_distinct(transform(parts, p -> p.text)), ' ') AS header", "types"
    )


def table_width(profile: DataFrame) -> DataFrame:
    """``width``: columns up to the last cell of the first row; null if that row has none."""
    return profile.agg(F.expr("max(CASE WHEN in_first_row THEN col + 1 END) AS width"))


def table_columns(profile: DataFrame, options: WorkbookOptions) -> DataFrame:
    """``position, name, type`` of each table column; no rows where the first row holds nothing.

    A sheet has at most 16,384 columns, so the profile fits one row.
    """
    packed = profile.agg(
        F.expr("max(CASE WHEN in_first_row THEN col + 1 END) AS width"),
        F.expr("map_from_entries(collect_list(struct(col, named_struct('header', header, 'types', types)))) AS known"),
    ).filter("width > 0")
    each = packed.selectExpr("explode(sequence(0, width - 1)) AS position", "known").selectExpr(
        "position", "try_element_at(known, position) AS found"
    )
    header = "found.header" if options.header_row_count else "''"
    return each.selectExpr(
        "position", f"{clean_name(header, 'position')} AS name", f"coalesce({resolved_type('found.types')}, 'string') AS type"
    )


def build_headers(grid: DataFrame, options: WorkbookOptions) -> DataFrame:
    """``position, name`` of the table on one anchored sheet."""
    return table_columns(column_profile(grid, options), options).select("position", "name")
