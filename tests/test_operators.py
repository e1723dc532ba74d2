"""Operators on small grids."""

import random

import pytest
from pyspark.sql import types as T

from gridloom import WorkbookError, WorkbookOptions, read_grid, table_to_grid
from gridloom.functions import a1_column, a1_to_rc, cell, clean_name, coerce, coerce_match, is_date_format
from gridloom.operators import (
    cells_to_grid, column_profile, expand_shared_formulas, fill_merged, grid_cells, resolve_strings, table_width,
)
from gridloom.sources.tables import number_rows


def rows(df):
    return [tuple(r) for r in df.collect()]


def value(spark, sql):
    return spark.range(1).selectExpr(f"{sql} AS v").first()["v"]


@pytest.mark.parametrize("header, name", [
    ("Plain", "Plain"), ("  two words ", "two_words"), ("a..b", "a_b"), ("_x_", "_x"), ("a+\\b,c\nd", "a_b_c_d"),
    (" ,. ", "col_3"), ("", "col_3"), ("tab\tstays", "tab\tstays"), ("2010.0", "2010_0"), ("x__", "x"),
])
def test_clean_name(spark, header, name):
    df = spark.createDataFrame([(header,)], "h string")
    assert df.selectExpr(clean_name("h", "3")).first()[0] == name


def test_addresses(spark):
    numbers = spark.range(16384).selectExpr("cast(id AS int) AS c", "cast(id * 64 AS int) AS r")
    back = numbers.selectExpr("r", "c", f"{a1_to_rc(a1_column('r', 'c'))} AS rc").filter("r <> rc.row OR c <> rc.col")
    assert back.count() == 0
    assert value(spark, a1_column("0", "702")) == "AAA1"
    assert value(spark, a1_to_rc("'$xfd$1048576'")) == (1048575, 16383)
    assert value(spark, a1_to_rc("'7A'")) == (None, None)


@pytest.mark.parametrize("code, is_date", [
    ("yyyy-mm-dd", True), ("d/m/yy;@", True), ("[h]:mm", True), ("[$-409]mmm d, yyyy", True), ("h:mm AM/PM", True),
    ('yyyy"年"m"月"', True), ("0.00", False), ("General", False), ('0 "days"', False), ("#,##0;[Red]-#,##0", False),
    ("0.00E+00", False), ("@", False), ("\\d0", False), ("mm:ss.0", True), ("[Blue]0", False),
])
def test_date_formats(spark, code, is_date):
    df = spark.createDataFrame([(999, code)], "i int, c string")
    assert df.selectExpr(is_date_format("i", "c")).first()[0] is is_date


CELLS = {
    "blank": cell(0, "blank"), "error": cell(0, "error", str="'#N/A'"), "bool": cell(0, "bool", bool="true"),
    "num": cell(0, "num", num="-99.9D"), "huge": cell(0, "num", num="1e300"), "date": cell(0, "num", num="44421.25D", is_date="true"),
    "str": cell(0, "str", str="'12'"), "formula": cell(0, "formula", str="'A1*2'", formula="'A1*2'"),
}
KINDS = {"s": T.StringType(), "b": T.BooleanType(), "i": T.IntegerType(), "l": T.LongType(), "f": T.FloatType(),
         "d": T.DoubleType(), "t": T.TimestampType(), "day": T.DateType(), "other": T.DecimalType(10, 2)}


def test_coercion_matrix(spark):
    got = {}
    for n, c in CELLS.items():
        frame = spark.range(1).selectExpr(f"{c} AS c")
        exprs = [f"cast({coerce('c', t)} AS string) AS {k}" for k, t in KINDS.items()]
        fits = [f"{coerce_match('c', t)} AS m_{k}" for k, t in KINDS.items()]
        got[n] = frame.selectExpr(*exprs, *fits).first().asDict()

    def shown(n):
        return {k: got[n][k] for k in KINDS if got[n][k] is not None}

    def fitting(n):
        return {k for k in KINDS if got[n][f"m_{k}"]}

    assert shown("blank") == shown("error") == {} and fitting("blank") == fitting("error") == set(KINDS)
    assert shown("bool") == {"s": "true", "b": "true"} and fitting("bool") == {"s", "b"}
    assert shown("num") == {"s": "-99.9", "i": "-99", "l": "-99", "f": "-99.9", "d": "-99.9"}
    assert fitting("num") == {"s", "i", "l", "f", "d"}
    assert (got["huge"]["i"], got["huge"]["l"]) == ("2147483647", "9223372036854775807")
    assert shown("date") == {"s": "2021-08-13T06:00:00", "i": "44421", "l": "44421", "f": "44421.25", "d": "44421.25",
                             "t": "2021-08-13 06:00:00", "day": "2021-08-13"}
    assert fitting("date") == {"s", "i", "l", "f", "d", "t", "day"}
    assert shown("str") == {"s": "12"} and fitting("str") == {"s"}
    assert shown("formula") == {"s": "A1*2"} and fitting("formula") == {"s"}


def test_not_nullable_fields(spark):
    frame = spark.range(1).selectExpr(f"{CELLS['blank']} AS c", f"{CELLS['num']} AS n")
    for t in KINDS.values():
        assert frame.selectExpr(coerce_match("c", t, False)).first()[0] is False
    assert frame.selectExpr(coerce_match("n", T.DoubleType(), False)).first()[0] is True


@pytest.mark.parametrize("plain_rows", [10**6, 40])
def test_numbering(spark, plain_rows):
    """A hot sheet, hot keys and copies of rows: every sheet is numbered 1..n in key order, however it is done."""
    df = spark.range(600).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 4) END AS s",
                                     "CASE WHEN id % 2 = 0 THEN 7 ELSE id % 50 END AS k", "id % 20 AS x")
    out = number_rows(df, "s", ["k"], plain_rows=plain_rows).collect()
    sheets = {}
    for r in out:
        sheets.setdefault(r["s"], []).append((r["_n"], r["k"]))
    assert len(out) == 600
    for found in sheets.values():
        found.sort()
        assert [n for n, _ in found] == list(range(1, len(found) + 1))
        assert [k for _, k in found] == sorted(k for _, k in found)


def test_numbering_goes_over_ranges(spark, monkeypatch):
    """A sheet is numbered by ranges of its key, with nulls in it; rows without a sheet's name are kept."""
    monkeypatch.setattr("gridloom.sources.tables.RANGE_ROWS", 50)
    df = spark.range(1000).selectExpr("CASE WHEN id % 10 > 0 THEN 'hot' END AS s", "CASE WHEN id % 7 > 0 THEN 1000 - id END AS k")
    out = number_rows(df, "s", ["k"], plain_rows=100)
    found = sorted((str(r["s"]), r["_n"], -1 if r["k"] is None else r["k"]) for r in out.collect())
    for s, n in (("hot", 900), ("None", 100)):
        own = [(i, k) for x, i, k in found if x == s]
        assert [i for i, _ in own] == list(range(1, n + 1)) and [k for _, k in own] == sorted(k for _, k in own)


def test_grid_and_cells(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 2.5), (4, "c", 1.0)], "k int, s string, v double")
    grid = table_to_grid(df, row="k")
    again = cells_to_grid(grid_cells(grid), grid.filter("cells IS NOT NULL"))
    expected = [(1.0, "a", None), (2.0, None, 2.5), (None, None, None), (4.0, "c", 1.0)]
    for g in (grid, again):
        assert sorted(rows(read_grid(g)), key=repr) == sorted(expected, key=repr)


def test_gaps_wider_than_a_band(spark, monkeypatch):
    from gridloom.operators import spine

    monkeypatch.setattr(spine, "BAND_ROWS", 4)
    places = [1, 2, 9, 10, 27]
    grid = table_to_grid(spark.createDataFrame([(p,) for p in places], "p int"), row="p")
    got = [r[0] for r in rows(read_grid(grid, "p int"))]
    assert sorted(x for x in got if x is not None) == places
    assert len(got) == 27


def test_fill_merged_ends_at_the_last_row(spark):
    df = spark.createDataFrame([(1, "a", 1), (4, "b", 2)], "p int, s string, v int")
    grid = table_to_grid(df, row="p", cells=[cell(0, "str", str="s"), cell(1, "num", num="v")], header=[["s", "v"]])
    merges = spark.createDataFrame([("table", 0, 1, 0, 2, 0), ("table", 0, 4, 0, 6, 1)],
                                   "file string, sheet_idx int, r0 long, c0 int, r1 long, c1 int")
    out = read_grid(fill_merged(grid, merges), "s string, v string, ok boolean", schemaMatchColumnName="ok")
    assert sorted(rows(out), key=repr) == sorted([
        ("a", "1.0", True), ("a", None, True), (None, None, False), ("b", "b", True),
    ], key=repr)


def test_overlapping_regions(spark):
    """Of regions over one cell the first counts, and what stands right of them stays in its column."""
    df = spark.createDataFrame([(1, 1, 2, 100), (2, 3, 4, 200)], "p int, a int, b int, c int")
    grid = table_to_grid(df, row="p", cells=[cell(i, "num", num=n) for i, n in enumerate("abc")], header=[["a", "b", "c"]])
    merges = spark.createDataFrame([("table", 0, 1, 0, 2, 1), ("table", 0, 1, 1, 1, 1)],
                                   "file string, sheet_idx int, r0 long, c0 int, r1 long, c1 int")
    out = read_grid(fill_merged(grid, merges), "a int, b int, c int")
    assert sorted(rows(out)) == [(1, 1, 100), (1, 1, 200)]


def test_listed_order_of_regions(spark):
    """With a place, the region listed first counts, wherever it starts."""
    df = spark.createDataFrame([(1, 1, 2), (2, 3, 4)], "p int, a int, b int")
    grid = table_to_grid(df, row="p", cells=[cell(i, "num", num=n) for i, n in enumerate("ab")], header=[["a", "b"]])
    regions = [("table", 0, 1, 0, 2, 0), ("table", 0, 2, 0, 2, 1)]
    layout = "file string, sheet_idx int, r0 long, c0 int, r1 long, c1 int, place int"
    found = [sorted(rows(read_grid(fill_merged(grid, spark.createDataFrame(
        [(*r, p) for r, p in zip(regions, places)], layout)), "a int, b int"))) for places in ((0, 1), (1, 0))]
    assert found == [[(1, 2), (1, 3)], [(1, 2), (3, 3)]]


def test_regions_of_all_heights(spark):
    """Regions from one row to many thousands, over rows with gaps, against looking at each region for each row."""
    made = random.Random(5)
    places = sorted(made.sample(range(1, 20_000), 700))
    df = spark.createDataFrame([(p, f"t{p}") for p in places], "p int, s string")
    grid = table_to_grid(df, row="p", cells=[cell(i, "str", str="s") for i in range(6)], header=[list("abcdef")])
    regions = []
    for column in range(6):  # one column each, so that none overlap
        top = 1
        while top < 20_000:
            top += made.choice([0, 1, 63, 64, 65, 700])
            height = made.choice([1, 2, 64, 65, 129, 4096, 4097, 9000])
            regions.append(("table", 0, top, column, top + height - 1, column))
            top += height
    merges = spark.createDataFrame(regions, "file string, sheet_idx int, r0 long, c0 int, r1 long, c1 int")
    out = fill_merged(grid, merges).filter("cells IS NOT NULL AND row > 0").selectExpr(
        "row", "gap", "transform(coalesce(fills, array()), x -> named_struct('c', x.c0, 's', x.cell.str)) AS f").collect()
    last = max(places)
    expected = {}
    for _, _, r0, c, r1, _ in regions:
        for row in range(r0, min(r1, last) + 1):
            expected.setdefault(row, {})[c] = f"t{r0}" if r0 in set(places) else None
    got = {r["row"]: {x["c"]: x["s"] for x in r["f"]} for r in out}
    assert {k: x for k, x in got.items() if x} == expected
    assert sorted(got) == list(range(1, last + 1))
    assert {r["row"] for r in out if r["gap"] == 0} == set(places) | set(expected)


def test_filling_needs_no_cross_join_and_no_row_per_covered_row(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "p int, s string")
    grid = table_to_grid(df, row="p", cells=[cell(0, "str", str="s")], header=[["s"]])
    merges = spark.range(1).selectExpr("'table' AS file", "0 AS sheet_idx", "1L AS r0", "0 AS c0", "1L << 40 AS r1", "0 AS c1")
    out = fill_merged(grid, merges)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert sorted(rows(read_grid(out, "s string"))) == [("a",), ("a",)]


def test_two_cells_in_a_column(spark):
    cells = spark.createDataFrame(
        [("f", 0, "S", 0, k, "num", float(k)) for k in range(3)] + [("f", 0, "S", 0, 1, "num", 9.0)],
        "file string, sheet_idx int, sheet_name string, row long, col int, kind string, num double")
    cells = cells.selectExpr("*", "cast(NULL AS boolean) AS bool", "cast(NULL AS string) AS str", "false AS is_date",
                             "cast(NULL AS string) AS formula")
    assert rows(read_grid(cells_to_grid(cells), "a int, b int, c int", headerRowCount=0)) == [(0, 9, 2)]


def test_unmatched_pattern_with_a_schema(spark):
    grid = table_to_grid(spark.createDataFrame([(1,)], "a int"))
    with pytest.raises(Exception, match="No worksheets found"):
        read_grid(grid, "a int", sheetNamePattern="none.*").collect()
    assert read_grid(grid, "a int", sheetNamePattern="Sheet.*").count() == 1


def test_width_and_empty_first_row(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    profile = column_profile(table_to_grid(df, header=[["only"]]), WorkbookOptions())
    assert table_width(profile).first()["width"] == 1
    bare = table_to_grid(df, header=[[]])
    with pytest.raises(WorkbookError, match="No data found on first row"):
        read_grid(bare)


def test_unknown_sheet(spark):
    grid = table_to_grid(spark.createDataFrame([(1,)], "a int"))
    with pytest.raises(WorkbookError, match="No worksheets found"):
        read_grid(grid, sheetNamePattern="Sheet")


def test_flag_in_the_middle_takes_a_position(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    out = read_grid(table_to_grid(df), "a int, ok boolean, c int, _SheetName string", schemaMatchColumnName="ok",
                    includeSheetName=True)
    assert rows(out) == [(1, True, 3, "Sheet1")]


def test_resolve_strings_and_formulas(spark):
    cells = spark.range(100).selectExpr(
        "'f' AS file", "0 AS sheet_idx", "id AS row", "0 AS col", "'num' AS kind", "cast(NULL AS string) AS str",
        "CASE WHEN id < 90 THEN 1L WHEN id < 95 THEN 2L END AS sid",
    )
    strings = spark.createDataFrame([("f", 1, "hot"), ("f", 2, "cold"), ("g", 1, "other")], "file string, idx long, text string")
    got = resolve_strings(cells, strings).groupBy("kind", "str").count()
    assert sorted(rows(got), key=repr) == [("num", None, 5), ("str", "cold", 5), ("str", "hot", 90)]
    shared = spark.range(5).selectExpr("'f' AS file", "0 AS sheet_idx", "id AS row", "2 AS col",
                                       "CASE WHEN id = 1 THEN 'A2*$B$1' WHEN id = 4 THEN 'own' END AS formula",
                                       "CASE WHEN id IN (1, 2, 3) THEN 0 END AS shared_id")
    out = expand_shared_formulas(shared).orderBy("row").select("formula")
    assert rows(out) == [(None,), ("A2*$B$1",), ("A3*$B$1",), ("A4*$B$1",), ("own",)]


def test_reading_needs_no_shuffle_and_prunes(spark):
    grid = table_to_grid(spark.range(10).selectExpr("id AS a", "id AS b"))
    df = read_grid(grid, "a long, b long, ok boolean", schemaMatchColumnName="ok")
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    pruned = df.select("a")._jdf.queryExecution().optimizedPlan().toString()
    assert "_c0" in pruned and "_c1" not in pruned


def test_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frame = spark.range(1).selectExpr(f"{CELLS['date']} AS c")
        got = frame.selectExpr(f"cast({coerce('c', T.TimestampType())} AS string) AS t", f"{coerce('c', T.StringType())} AS s").first()
        assert tuple(got) == ("2021-08-13 06:00:00", "2021-08-13T06:00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("at", ["A1", "B3", "A70000"])
def test_sheets_that_end_above_the_table(spark, at):
    """One record of nulls per sheet, however far above the table it ends."""
    grid = table_to_grid(spark.createDataFrame([("x", 1), ("y", 2)], "s string, v int"), sheet="s", order_by=["v"])
    got = rows(read_grid(grid, "v int, _SheetName string", cellAddress=at, headerRowCount=2, sheetNamePattern=".", includeSheetName=True))
    assert sorted(got) == [(None, "x"), (None, "y")]
