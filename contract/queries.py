"""One query per operator. Each takes a session and a folder of parquet tables and returns a DataFrame."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.workbook_frames import FILES, ROWS_PER_WORKBOOK, save_books, workbook_frame
from fixtures.make_workbooks import Sheet, build_workbook
from gridloom import (
    WorkbookOptions, create_workbook_view, read_grid, read_workbook_files, read_workbooks, stream_workbooks, table_to_grid,
)
from gridloom.functions import a1_column, a1_to_rc, cell, clean_name
from gridloom.functions.text import text
from gridloom.operators import (
    build_headers, cells_to_grid, classify_dates, expand_shared_formulas, fill_merged, infer_types, resolve_strings, select_sheets,
)
from gridloom.plans.scratch import scratch_folder, written
from gridloom.sources.decode import decode_workbooks
from gridloom.sources.files import workbook_files, workbook_report
from gridloom.sources.package import open_workbooks, sheet_catalog
from gridloom.sources.tables import number_rows, to_cell


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


YEAR = "date_format(o_orderdate, 'yyyy')"


def flagship(spark, sf):
    """Orders as one sheet per year; three years read back and summed."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    grid = table_to_grid(orders, sheet=YEAR, order_by=["o_orderkey"], unique=True)
    rows = read_grid(grid, sheetNamePattern="199[5-7]", includeSheetName=True)
    return rows.groupBy(F.col("_SheetName").alias("sheet_name")).agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


def sheet_default(spark, sf):
    """Without a pattern only the first sheet is read."""
    grid = table_to_grid(table(spark, sf, "events"), sheet="event_type", order_by=["event_id"], unique=True)
    return read_grid(grid).select("event_id", "user_id", "value", "props")


def sheet_pattern(spark, sf):
    """A pattern has to match the whole sheet name."""
    grid = table_to_grid(table(spark, sf, "events").select("event_id", "event_type", "value"), sheet="event_type")
    rows = read_grid(grid, "event_id long, event_type string, value double, _SheetName string",
                     sheetNamePattern="clic|sign.*|v[a-z]ew", includeSheetName=True)
    return rows.select(F.col("_SheetName").alias("sheet_name"), "event_id", "value")


def anchor_offset(spark, sf):
    """A table that starts at C5."""
    grid = table_to_grid(table(spark, sf, "part"), order_by=["p_partkey"], unique=True, at="C5")
    return read_grid(grid, cellAddress="C5")


def table_width(spark, sf):
    """Columns beyond the last header cell are cut."""
    grid = table_to_grid(table(spark, sf, "part"), header=[["key", "name", "brand"]])
    return read_grid(grid, maxRowCount=0)


def merged_fill(spark, sf):
    """The order key stands only in the first row of each block of lines and is merged down over it."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    numbered = written(number_rows(lines, "'Sheet1'", ["l_orderkey", "l_linenumber"]), "lines")
    blocks = written(numbered.groupBy("l_orderkey").agg(F.min("_n").alias("r0"), F.max("_n").alias("r1")), "blocks")
    marked = numbered.join(blocks.select(F.col("r0").alias("_n"), F.lit(True).alias("first")), "_n", "left")
    # Written once, as filling goes over the grid's rows three times.
    shown = written(marked.selectExpr("CASE WHEN first THEN l_orderkey END AS l_orderkey", *lines.columns[1:], "_n"), "shown")
    cells = [to_cell(c, shown.schema[c].dataType, i) for i, c in enumerate(lines.columns)]
    grid = table_to_grid(shown, row="_n", dense=True, cells=cells, header=[lines.columns])
    merges = blocks.filter("r1 > r0").selectExpr(
        "'table' AS file", "0 AS sheet_idx", "r0", "0 AS c0", "r1", "0 AS c1"
    )
    return read_grid(fill_merged(grid, merges), "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double")


def merged_fill_2d(spark, sf):
    """Header texts merged over pairs of columns, and blocks of three rows by two columns in the data."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    named = written(number_rows(customers, "c_mktsegment", ["c_custkey"], unique=True), "customers")
    segments = [r[0] for r in customers.select("c_mktsegment").distinct().orderBy("c_mktsegment").collect()]
    index = f"cast(array_position(array({', '.join(text(s) for s in segments)}), c_mktsegment) - 1 AS int) AS sheet_idx"
    cells = [to_cell(c, customers.schema[c].dataType, i) for i, c in enumerate(customers.columns[:4])]
    head = [["Key", None, "Money", None], ["id", "name", "nation", "balance"]]
    grid = table_to_grid(named, sheet="c_mktsegment", sheets=segments, row="_n + 1", dense=True, cells=cells, header=head)
    sizes = customers.groupBy("c_mktsegment").agg((F.count("*") + 1).alias("last"))
    blocks = named.filter("_n % 3 = 1").join(sizes, "c_mktsegment").selectExpr(
        "'table' AS file", index, "_n + 1 AS r0", "2 AS c0", "least(_n + 3, last) AS r1", "3 AS c1"
    )
    tops = sizes.selectExpr("'table' AS file", index, "inline(array(named_struct('r0', 0L, 'c0', 0, 'r1', 0L, 'c1', 1), "
                            "named_struct('r0', 0L, 'c0', 2, 'r1', 0L, 'c1', 3)))")
    return read_grid(fill_merged(grid, blocks.unionByName(tops)), headerRowCount=2, sheetNamePattern=".*",
                     includeSheetName=True)


def header_multirow(spark, sf):
    """A row of years, each over two columns, above a row of measures."""
    orders = table(spark, sf, "orders").selectExpr("year(o_orderdate) AS year", "o_orderpriority AS priority", "o_totalprice")
    sums = written(
        orders.groupBy("year", "priority").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total")), "sums"
    )
    years = sums.select("year").distinct().selectExpr("year", "cast(row_number() OVER (ORDER BY year) AS int) AS y")
    names = sums.select("priority").distinct().selectExpr("priority", "row_number() OVER (ORDER BY priority) + 1 AS row")
    sheet = ["'table' AS file", "0 AS sheet_idx", "'Sheet1' AS sheet_name"]

    def long(frame, *cells):
        return frame.selectExpr(*sheet, f"inline(array({', '.join(cells)}))")

    def at(row, made):
        return f"named_struct('row', cast({row} AS bigint), 'c', {made})"

    heads = long(years, at(0, cell("y * 2 - 1", "str", str="cast(year AS string)")), at(0, cell("y * 2", "blank")),
                 at(1, cell("y * 2 - 1", "str", str="'Orders'")), at(1, cell("y * 2", "str", str="'Total, gross'")))
    corner = long(spark.range(1), at(1, cell(0, "str", str="'Priority'")))
    body = long(sums.join(years, "year").join(names, "priority"),
                at("row", cell("y * 2 - 1", "num", num="n")), at("row", cell("y * 2", "num", num="total")))
    left = long(names, at("row", cell(0, "str", str="priority")))
    cells = heads.unionByName(corner).unionByName(body).unionByName(left).selectExpr(*["file", "sheet_idx", "sheet_name", "row"], "c.*")
    merges = years.selectExpr("'table' AS file", "0 AS sheet_idx", "0L AS r0", "y * 2 - 1 AS c0", "0L AS r1", "y * 2 AS c1")
    options = WorkbookOptions.parse({"headerRowCount": 2})
    return build_headers(fill_merged(cells_to_grid(cells), merges), options)


def clean_names(spark, sf):
    """Whole texts as header texts."""
    return table(spark, sf, "documents").selectExpr("doc_id", f"{clean_name('text', 'doc_id')} AS name").selectExpr(
        "doc_id", "cast(length(name) AS bigint) AS name_length", "md5(name) AS name_md5"
    )


def blank_headers(spark, sf):
    """Header cells without text are named by their position."""
    grid = table_to_grid(table(spark, sf, "supplier"), header=[[None, " . ", "s_nationkey", "+"]], order_by=["s_suppkey"])
    return read_grid(grid)


def headerless(spark, sf):
    grid = table_to_grid(table(spark, sf, "supplier"), header=False, order_by=["s_suppkey"], unique=True)
    return read_grid(grid, headerRowCount=0)


def _mixed_events(spark, sf, text_where: str):
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    cells = [
        cell(0, "num", num="event_id"),
        cell(1, "num", num="unix_millis(cast(ts AS timestamp)) / 86400000D + 25569D", is_date="true"),
        cell(2, "bool", bool="event_type = 'click'"),
        f"CASE WHEN {text_where} THEN {cell(3, 'str', str='event_type')} ELSE {cell(3, 'num', num='value')} END",
        cell(4, "blank"),
        cell(5, "str", str="event_type"),
        f"CASE WHEN event_type = 'error' THEN {cell(6, 'error', str=repr('#N/A'))} ELSE {cell(6, 'num', num='value')} END",
    ]
    return table_to_grid(events, row="event_id + 1", cells=cells,
                         header=[["id", "at", "is_click", "mixed", "nothing", "kind", "holes"]])


def infer_types_all(spark, sf):
    """One type seen in a column decides; several, or none, make it text."""
    return infer_types(_mixed_events(spark, sf, "event_type = 'view'"), WorkbookOptions(max_row_count=0))


def infer_sampled(spark, sf):
    """A text below the sampled rows does not change the type."""
    grid = _mixed_events(spark, sf, "event_id >= 150")
    found = [
        infer_types(grid, WorkbookOptions(max_row_count=n)).selectExpr(f"{n} AS sampled", "position", "type")
        for n in (100, 150, 151, 0)
    ]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def header_only(spark, sf):
    """A sheet with a header and nothing below it gives one record of nulls."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    sheet = "concat(o_orderpriority, '/', o_orderstatus)"
    names = [r[0] for r in orders.selectExpr(f"{sheet} AS s").distinct().orderBy("s").collect()]
    grid = table_to_grid(orders.filter("o_orderstatus <> 'P'"), sheet=sheet, sheets=names)
    rows = read_grid(grid, "o_orderkey long, o_totalprice double, a string, b string, _SheetName string",
                     sheetNamePattern=".+", includeSheetName=True)
    return rows.groupBy(F.col("_SheetName").alias("sheet_name")).agg(
        F.count("*").alias("records"), F.count("o_orderkey").alias("orders")
    )


def gap_rows(spark, sf):
    """Rows that are absent from the sheet come back as nulls, and never match the schema."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    grid = table_to_grid(orders.filter("o_orderstatus <> 'P'"), row="o_orderkey + 1")
    return read_grid(grid, "o_orderkey double, o_totalprice double, o_orderstatus string, ok boolean",
                     schemaMatchColumnName="ok")


def multi_sheet_union(spark, sf):
    """All sheets of a workbook, one below the other, with their names."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    grid = table_to_grid(orders, sheet="o_orderpriority", order_by=["o_orderkey"], unique=True)
    rows = read_grid(grid, sheetNamePattern=r"\d-[A-Z ]+", includeSheetName=True)
    return rows.select("o_orderkey", "o_totalprice", F.col("_SheetName").alias("sheet_name"))


def _lines(spark, sf, cells: list[str], schema: str, **options):
    lines = table(spark, sf, "lineitem")
    grid = table_to_grid(lines, cells=cells, header=[[f"c{i}" for i in range(len(cells))]])
    return read_grid(grid, schema, **options)


_KEYS = [cell(0, "num", num="l_orderkey"), cell(1, "num", num="l_partkey")]


def coerce_int(spark, sf):
    """Fractions are cut, and a number out of range becomes the end of the range."""
    return _lines(spark, sf, [*_KEYS, cell(2, "num", num="l_extendedprice * (0.5D - l_discount * 10)"),
                              cell(3, "num", num="l_extendedprice * 1e5")],
                  "l_orderkey long, l_partkey long, cut int, clamped int")


def coerce_long(spark, sf):
    return _lines(spark, sf, [*_KEYS, cell(2, "num", num="l_extendedprice * -1000"), cell(3, "num", num="l_extendedprice * 1e15")],
                  "l_orderkey long, l_partkey long, cut long, clamped long")


def coerce_float(spark, sf):
    return _lines(spark, sf, [*_KEYS, cell(2, "num", num="l_discount"), cell(3, "str", str="l_returnflag")],
                  "l_orderkey long, l_partkey long, f float, not_a_number float")


def coerce_string(spark, sf):
    """Numbers, truth values, dates and texts as text."""
    return _lines(spark, sf, [*_KEYS, cell(2, "num", num="l_quantity"), cell(3, "bool", bool="l_discount > 0.05D"),
                              to_cell("l_shipdate", spark.read.parquet(f"{sf}/lineitem.parquet").schema["l_shipdate"].dataType, 4),
                              cell(5, "str", str="l_returnflag"), cell(6, "error", str="'#DIV/0!'")],
                  "l_orderkey long, l_partkey long, number string, truth string, day string, text string, broken string")


def coerce_bool(spark, sf):
    labels = table(spark, sf, "labels")
    cells = [cell(0, "num", num="doc_id"), cell(1, "bool", bool="quality = 1"), cell(2, "num", num="toxic")]
    grid = table_to_grid(labels, cells=cells, header=[["doc_id", "good", "toxic"]])
    rows = read_grid(grid, "doc_id long, good boolean, toxic boolean, ok boolean", schemaMatchColumnName="ok")
    return rows.selectExpr("doc_id", "good", "toxic IS NULL AS toxic_lost", "ok")


def serial_dates(spark, sf):
    """Days as serial numbers, read as timestamp, date, text and number."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    kind = orders.schema["o_orderdate"].dataType
    cells = [cell(0, "num", num="o_orderkey"), *[to_cell("o_orderdate", kind, i) for i in (1, 2, 3, 4)]]
    grid = table_to_grid(orders, cells=cells, header=[["k", "a", "b", "c", "d"]])
    return read_grid(grid, "o_orderkey long, at timestamp, day date, iso string, serial int").selectExpr(
        "o_orderkey", "at", "cast(day AS string) AS day", "iso", "serial")


def serial_times(spark, sf):
    """Times of day survive to the millisecond; text shows a fraction only where there is one."""
    events = table(spark, sf, "events").select("event_id", "ts")
    kind = events.schema["ts"].dataType
    grid = table_to_grid(events, cells=[cell(0, "num", num="event_id"), to_cell("ts", kind, 1), to_cell("ts", kind, 2)],
                         header=[["id", "at", "iso"]])
    return read_grid(grid, "event_id long, at timestamp, iso string")


def null_token(spark, sf):
    """A text that stands for nothing, whatever its case."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return read_grid(table_to_grid(orders), "o_orderkey long, o_orderpriority string", nullValue="3-Medium")


def _flagged_events(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    value = f"CASE WHEN event_type = 'error' THEN {cell(1, 'str', str=repr('n/a'))} ELSE {cell(1, 'num', num='value')} END"
    grid = table_to_grid(events, cells=[cell(0, "num", num="event_id"), value, cell(2, "str", str="event_type")],
                         header=[["id", "value", "kind"]])
    return read_grid(grid, "event_id long, value double, event_type string, ok boolean", schemaMatchColumnName="ok")


def schema_match(spark, sf):
    """A text where a number belongs: null, and the row is flagged."""
    return _flagged_events(spark, sf)


def prune_with_flag(spark, sf):
    """Only the flag is asked for; the columns behind it still count."""
    return _flagged_events(spark, sf).select("ok").groupBy("ok").agg(F.count("*").alias("n"))


def a1_addresses(spark, sf):
    """Numbers to addresses and back."""
    keyed = table(spark, sf, "orders").selectExpr("o_orderkey", "cast(o_custkey % 16384 AS int) AS c")
    named = keyed.selectExpr("o_orderkey", "c", f"{a1_column('o_orderkey', 'c')} AS address")
    return named.selectExpr("o_orderkey", "address", f"{a1_to_rc('address')} AS rc").selectExpr(
        "o_orderkey", "address", "rc.row AS r", "rc.col AS c"
    )


def resolve_strings_query(spark, sf):
    """Languages and sources of documents kept as numbers of a text table."""
    docs = table(spark, sf, "documents").selectExpr("doc_id", "inline(array(named_struct('col', 0, 't', lang), named_struct('col', 1, 't', source)))")
    strings = docs.select("t").distinct().selectExpr("'table' AS file", "xxhash64(t) AS idx", "t AS text")
    cells = docs.selectExpr("'table' AS file", "0 AS sheet_idx", "doc_id AS row", "col", "'str' AS kind", "cast(NULL AS string) AS str",
                            "xxhash64(t) AS sid")
    return resolve_strings(cells, strings).selectExpr("row AS doc_id", "col", "str AS text")


# Number formats by style, as a workbook's style part would list them.
_FORMATS = (
    (0, 0, None), (1, 14, None), (2, 164, "yyyy\\-mm\\-dd"), (3, 165, '0.00 "days"'), (4, 166, "[h]:mm:ss"),
    (5, 167, "[Red]#,##0.00"), (6, 168, "dd/mm/yyyy;@"), (7, 169, "General"), (8, 22, None), (9, 170, '[$-409]d-mmm-yy'),
)


def classify_dates_query(spark, sf):
    """Numbers whose style has a date format."""
    styles = spark.createDataFrame([("table", s, f) for s, f, _ in _FORMATS], "file string, style int, format_id int")
    formats = spark.createDataFrame([("table", f, c) for _, f, c in _FORMATS if c], "file string, format_id int, code string")
    cells = table(spark, sf, "events").selectExpr(
        "'table' AS file", "event_id AS row", "'num' AS kind", "value AS num", "false AS is_date", "cast(user_id % 10 AS int) AS style", "user_id"
    )
    return classify_dates(cells, styles, formats).selectExpr("row AS event_id", "user_id", "is_date")


def _formula_lines(spark, sf, evaluate: bool, schema: str):
    formula = "concat(cast(l_linenumber AS string), '*B', cast(l_partkey + 2 AS string))"
    return _lines(spark, sf, [*_KEYS, cell(2, "num", num="l_quantity * l_extendedprice", formula=formula)], schema,
                  evaluateFormulae=evaluate)


def formula_text(spark, sf):
    """Formulas as they are written."""
    return _formula_lines(spark, sf, False, "l_orderkey long, l_partkey long, formula string")


def formula_result(spark, sf):
    """The results stored beside formulas."""
    return _formula_lines(spark, sf, True, "l_orderkey long, l_partkey long, result double")


def shared_formula(spark, sf):
    """One formula written once for a whole column."""
    cells = table(spark, sf, "orders").selectExpr(
        "'table' AS file", "0 AS sheet_idx", "o_orderkey + 1 AS row", "cast(o_orderkey % 3 AS int) + 2 AS col",
        "CASE WHEN o_orderkey = 0 THEN 'A2*$B$1+SUM(B2:$C2)' END AS formula", "7 AS shared_id", "o_orderkey",
    )
    return expand_shared_formulas(cells).select("o_orderkey", "formula")


def _customer_books(spark, sf, **more):
    customers = table(spark, sf, "customer")
    return workbook_frame(customers, f"c_custkey div {ROWS_PER_WORKBOOK}", customers.columns, **more)


def roundtrip_xlsx(spark, sf):
    """Customers as workbooks of a thousand rows, read back with an inferred schema."""
    return read_workbook_files(written(_customer_books(spark, sf), "books"))


def roundtrip_dates(spark, sf):
    """Orders as workbooks, with dates, read back with a given schema."""
    orders = table(spark, sf, "orders")
    books = workbook_frame(orders, f"o_orderkey div {4 * ROWS_PER_WORKBOOK}", orders.columns)
    return read_workbook_files(books, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                      "o_orderdate timestamp, o_orderpriority string")


def roundtrip_merged(spark, sf):
    """Workbooks whose nation column is merged down over customers of the same nation."""
    columns = ["c_nationkey", "c_custkey", "c_acctbal"]
    customers = table(spark, sf, "customer").select(*columns)
    books = workbook_frame(customers, f"c_custkey div {ROWS_PER_WORKBOOK}", columns, merge="c_nationkey")
    return read_workbook_files(books, "c_nationkey int, c_custkey long, c_acctbal double, ok boolean", schemaMatchColumnName="ok")


def partitioned_files(spark, sf):
    """Workbooks in one folder per region; the region comes from the folder."""
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
    customers = table(spark, sf, "customer").join(nations, F.expr("c_nationkey = n_nationkey"))
    books = workbook_frame(customers, f"c_custkey div {ROWS_PER_WORKBOOK}", ["c_custkey", "c_name"], carry="r_name")
    return read_workbook_files(books, "c_custkey long, c_name string")


def sheet_catalog_query(spark, sf):
    """Which sheets the workbooks hold, in order."""
    books = _customer_books(spark, sf, sheet="c_mktsegment").select("path", "content")
    return sheet_catalog(open_workbooks(books)).select("file", "sheet_idx", "sheet_name")


def sheets_of_files(spark, sf):
    """Some sheets of every workbook, picked by name."""
    books = _customer_books(spark, sf, sheet="c_mktsegment")
    rows = read_workbook_files(books, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, _SheetName string",
                               sheetNamePattern="[A-G].*", includeSheetName=True)
    return rows.withColumnRenamed("_SheetName", "sheet_name")


def sql_view(spark, sf):
    """A workbook read as a view and queried in SQL."""
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string, ok boolean"
    read_workbook_files(_customer_books(spark, sf), schema, schemaMatchColumnName="ok").createOrReplaceTempView("customer_books")
    return spark.sql("SELECT c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance "
                     "FROM customer_books WHERE ok GROUP BY c_mktsegment")


def corrupt_files(spark, sf):
    """Good, cut off and encrypted files of a hundred customers: what state each is in."""
    customers = table(spark, sf, "customer")
    books = workbook_frame(customers, "c_custkey div 100", customers.columns)
    number = "cast(regexp_extract(path, '[0-9]+', 0) AS int) % 3"
    broken = books.withColumn("content", F.expr(
        f"CASE {number} WHEN 1 THEN substring(content, 1, length div 2) WHEN 2 THEN unhex('D0CF11E0A1B11AE1') ELSE content END"
    ))
    return workbook_report(broken).groupBy("status").agg(F.count("*").alias("files"))


def skip_corrupt(spark, sf):
    """The rows of the files that can be read."""
    books = _customer_books(spark, sf)
    broken = books.withColumn("content", F.expr(
        "CASE WHEN path LIKE '%0.xlsx' THEN content ELSE substring(content, 1, length div 2) END"
    ))
    return read_workbook_files(broken, "c_custkey long, c_name string", ignoreCorruptFiles=True)


def stream_ingest(spark, sf):
    """Events arriving as a stream of workbooks, read by the same pipeline."""
    columns = ["event_id", "user_id", "event_type", "value"]
    source = (
        spark.readStream.schema(table(spark, sf, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    )

    def books(batches):
        for pdf in batches:
            rows = [[x.item() if hasattr(x, "item") else x for x in r] for r in pdf[columns].itertuples(index=False)]
            content = build_workbook([Sheet("Events", [columns, *rows])], level=1)
            yield pd.DataFrame({"path": [f"events-{rows[0][0] if rows else 0}.xlsx"], "modificationTime": [pd.Timestamp(2024, 1, 1)],
                                "length": [len(content)], "content": [content]})

    files = source.select(*columns).mapInPandas(books, FILES)
    rows = read_workbook_files(files, "event_id long, user_id long, event_type string, value double")
    folder = scratch_folder(spark, "stream")
    query = (
        rows.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/rows")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/rows")


def files_glob(spark, sf):
    """Workbooks found by a glob, with an inferred schema."""
    folder = save_books(_customer_books(spark, sf), scratch_folder(spark, "books"))
    return read_workbooks(spark, f"{folder}/book-*.xlsx")


def files_partitioned(spark, sf):
    """Workbooks in folders named by region; the folders become a column."""
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
    customers = table(spark, sf, "customer").join(nations, F.expr("c_nationkey = n_nationkey"))
    books = workbook_frame(customers, f"c_custkey div {ROWS_PER_WORKBOOK}", ["c_custkey", "c_name"], carry="r_name")
    folder = save_books(books, scratch_folder(spark, "books"), under="concat('region=', r_name)")
    return read_workbooks(spark, folder, "c_custkey long, c_name string")


def files_view(spark, sf):
    """A view over workbook files, queried in SQL."""
    folder = save_books(_customer_books(spark, sf), scratch_folder(spark, "books"))
    create_workbook_view(spark, "customer_files", folder, schemaMatchColumnName="ok")
    return spark.sql("SELECT c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance "
                     "FROM customer_files WHERE ok GROUP BY c_mktsegment")


def files_stream(spark, sf):
    """Workbook files read as a stream."""
    folder = save_books(_customer_books(spark, sf), scratch_folder(spark, "books"))
    rows = stream_workbooks(spark, folder, "c_custkey long, c_name string, c_nationkey int")
    out = scratch_folder(spark, "stream")
    query = (
        rows.writeStream.format("parquet").option("checkpointLocation", f"{out}/state").option("path", f"{out}/rows")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{out}/rows")


def merged_overlap(spark, sf):
    """Regions that overlap, and reach below the last row: the first one counts, and no row is made."""
    orders = table(spark, sf, "orders").selectExpr("o_orderkey + 1 AS p", "o_orderkey", "o_custkey", "o_orderkey AS last")
    cells = [cell(i, "num", num=n) for i, n in enumerate(["o_orderkey", "o_custkey", "last"])]
    grid = table_to_grid(orders, row="p", cells=cells, header=[["a", "b", "c"]])
    merges = orders.filter("o_orderkey % 4 = 0").selectExpr(
        "'table' AS file", "0 AS sheet_idx", "inline(array(named_struct('r0', p, 'c0', 0, 'r1', p + 1, 'c1', 1), "
        "named_struct('r0', p, 'c0', 1, 'r1', p, 'c1', 1)))")
    return read_grid(fill_merged(grid, merges), "a long, b long, c long").filter("c IS NOT NULL")


def header_typed(spark, sf):
    """Header cells that are numbers, dates and booleans."""
    parts = table(spark, sf, "part").selectExpr("p_partkey + 1 AS p", "p_partkey", "p_size")
    head = parts.filter("p_partkey = (SELECT 0)").selectExpr("0L AS p", "0L AS p_partkey", "0 AS p_size").limit(1)
    day = cell(2, "num", num="CASE WHEN p = 0 THEN 44197D ELSE p_size END", is_date="p = 0")
    cells = [cell(0, "num", num="CASE WHEN p = 0 THEN 2021.5D ELSE p_partkey END"), cell(1, "bool", bool="p = 0 OR p_size > 25"), day]
    grid = table_to_grid(parts.unionByName(head), row="p", cells=cells, header=False)
    return read_grid(grid, maxRowCount=0)


def header_only_inferred(spark, sf):
    """The types of a sheet per order status; that of pending orders has a header only, so all its columns are text."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    names = [r[0] for r in orders.select("o_orderstatus").distinct().orderBy("o_orderstatus").collect()]
    grid = table_to_grid(orders.filter("o_orderstatus <> 'P'"), sheet="o_orderstatus", sheets=names,
                         cells=[to_cell(c, orders.schema[c].dataType, i) for i, c in enumerate(orders.columns[:3])], header=[orders.columns[:3]])
    out = None
    for sheet in names:
        types = infer_types(select_sheets(grid, sheet), WorkbookOptions(max_row_count=0)).selectExpr(f"{text(sheet)} AS sheet_name", "position", "type")
        out = types if out is None else out.unionByName(types)
    return out


def large_files(spark, sf):
    """Workbooks decoded by pieces, with texts and merged regions that reach over many of them."""
    columns = ["o_orderpriority", "o_orderkey", "o_totalprice"]
    books = workbook_frame(table(spark, sf, "orders").select(*columns), "o_orderkey div 20000", columns, merge="o_orderpriority")
    files = workbook_files(spark, save_books(books, scratch_folder(spark, "books")))
    grid = decode_workbooks(files, WorkbookOptions(), scanned=True, spread_bytes=0, piece_bytes=100_000)
    return read_grid(grid, "o_orderpriority string, o_orderkey long, o_totalprice double")


def flag_inferred(spark, sf):
    """Without a schema the flag comes last."""
    grid = table_to_grid(table(spark, sf, "supplier").select("s_suppkey", "s_name"), order_by=["s_suppkey"], unique=True)
    rows = read_grid(grid, schemaMatchColumnName="ok")
    return rows.selectExpr("*", f"{rows.columns.index('ok')} AS flag_at")


def flag_not_null(spark, sf):
    """A null where the schema allows none is no match."""
    events = table(spark, sf, "events").selectExpr("event_id", "CASE WHEN event_id % 3 > 0 THEN value END AS value")
    grid = table_to_grid(events, order_by=["event_id"], unique=True, cells=[to_cell(c, events.schema[c].dataType, i) for i, c in enumerate(events.columns)])
    return read_grid(grid, "event_id long, value double NOT NULL, ok boolean", schemaMatchColumnName="ok").select("event_id", "ok")


QUERIES = {
    "files_glob": files_glob,
    "files_partitioned": files_partitioned,
    "files_view": files_view,
    "files_stream": files_stream,
    "merged_overlap": merged_overlap,
    "header_typed": header_typed,
    "header_only_inferred": header_only_inferred,
    "large_files": large_files,
    "flag_inferred": flag_inferred,
    "flag_not_null": flag_not_null,
    "flagship": flagship,
    "sheet_default": sheet_default,
    "sheet_pattern": sheet_pattern,
    "anchor_offset": anchor_offset,
    "table_width": table_width,
    "merged_fill": merged_fill,
    "merged_fill_2d": merged_fill_2d,
    "header_multirow": header_multirow,
    "clean_names": clean_names,
    "blank_headers": blank_headers,
    "headerless": headerless,
    "infer_types": infer_types_all,
    "infer_sampled": infer_sampled,
    "header_only": header_only,
    "gap_rows": gap_rows,
    "multi_sheet_union": multi_sheet_union,
    "coerce_int": coerce_int,
    "coerce_long": coerce_long,
    "coerce_float": coerce_float,
    "coerce_string": coerce_string,
    "coerce_bool": coerce_bool,
    "serial_dates": serial_dates,
    "serial_times": serial_times,
    "null_token": null_token,
    "schema_match": schema_match,
    "prune_with_flag": prune_with_flag,
    "a1_addresses": a1_addresses,
    "resolve_strings": resolve_strings_query,
    "classify_dates": classify_dates_query,
    "formula_text": formula_text,
    "formula_result": formula_result,
    "shared_formula": shared_formula,
    "roundtrip_xlsx": roundtrip_xlsx,
    "roundtrip_dates": roundtrip_dates,
    "roundtrip_merged": roundtrip_merged,
    "partitioned_files": partitioned_files,
    "sheet_catalog": sheet_catalog_query,
    "sheets_of_files": sheets_of_files,
    "sql_view": sql_view,
    "corrupt_files": corrupt_files,
    "skip_corrupt": skip_corrupt,
    "stream_ingest": stream_ingest,
}
