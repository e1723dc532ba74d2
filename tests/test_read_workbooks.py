"""Reads of whole workbook files."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from fixtures import workbooks as wb
from gridloom import WorkbookError, WorkbookOptionError, create_workbook_view, read_workbooks
from gridloom.sources.reader import add_reader_method

SIMPLE = [("a", 1.0, "x"), ("b", 2.0, "y"), ("c", 3.0, "z")]


def rows(df):
    return [tuple(r) for r in df.collect()]


def names_types(df):
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


def test_simple(spark, save):
    df = read_workbooks(spark, save("Simple.xlsx", wb.simple()))
    assert names_types(df) == [("Col1", "string"), ("Col2", "double"), ("Col3", "string")]
    assert rows(df) == SIMPLE


def test_sheet_name(spark, save):
    df = read_workbooks(spark, save("Simple.xlsx", wb.simple()), includeSheetName=True)
    assert rows(df) == [(*r, "Sheet1") for r in SIMPLE]
    assert df.schema["_SheetName"].nullable


def test_no_matching_sheet(spark, save):
    path = save("Simple.xlsx", wb.simple())
    with pytest.raises(WorkbookError, match="No worksheets found matching user defined pattern"):
        read_workbooks(spark, path, sheetNamePattern="SheetX")
    with pytest.raises(PySparkException, match="No worksheets found"):
        read_workbooks(spark, path, "a string", sheetNamePattern="SheetX").collect()


def test_other_start(spark, save):
    df = read_workbooks(spark, save("Simple.xlsx", wb.simple()), cellAddress="B1")
    assert df.columns == ["Col2", "Col3"]
    assert rows(df) == [r[1:] for r in SIMPLE]


def test_blanks(spark, save):
    df = read_workbooks(spark, save("Blanks.xlsx", wb.with_blanks()))
    assert rows(df) == [("a", 1.0, "x"), ("b", None, "y"), ("c", 3.0, "z")]


def test_misaligned(spark, save):
    path = save("Misaligned.xlsx", wb.misaligned())
    with pytest.raises(WorkbookError, match="^No data found on first row$"):
        read_workbooks(spark, path)
    assert rows(read_workbooks(spark, path, cellAddress="C5")) == SIMPLE


def test_varying_types(spark, save):
    path = save("Varying.xlsx", wb.varying_types())
    df = read_workbooks(spark, path, evaluateFormulae=False, maxRowCount=3)
    assert names_types(df) == [
        ("Item", "string"), ("2010_0", "double"), ("2011_0", "double"), ("IsGood", "boolean")
    ]
    assert rows(df) == [(i, x, x, g) for i, x, g in wb.VARYING]
    # Every row sampled: the texts make both columns strings.
    everything = read_workbooks(spark, path, maxRowCount=0)
    assert [t for _, t in names_types(everything)] == ["string", "string", "string", "boolean"]
    assert rows(everything)[0][1] == "99.4"


def test_integers_and_longs(spark, save):
    schema = T.StructType([
        T.StructField("Item", T.StringType()), T.StructField("2010", T.IntegerType()), T.StructField("2011", T.LongType()),
    ])
    df = read_workbooks(spark, save("Varying.xlsx", wb.varying_types()), schema)
    assert rows(df) == [(i, None if x is None else int(x), None if x is None else int(x)) for i, x, _ in wb.VARYING]


def test_match_flag(spark, save):
    path = save("Varying.xlsx", wb.varying_types())
    df = read_workbooks(spark, path, maxRowCount=3, schemaMatchColumnName="ValidRow")
    assert df.columns[-1] == "ValidRow"
    assert [r[-1] for r in rows(df)] == [x is not None for _, x, _ in wb.VARYING]
    assert rows(df.select("ValidRow")) == [(x is not None,) for _, x, _ in wb.VARYING]


def test_match_flag_given_schema(spark, save):
    path = save("Varying.xlsx", wb.varying_types())
    schema = "Item string, a double, b double, IsGood boolean, ok boolean"
    df = read_workbooks(spark, path, schema, schemaMatchColumnName="OK")
    assert [r["ok"] for r in df.collect()] == [x is not None for _, x, _ in wb.VARYING]
    with pytest.raises(WorkbookError, match="does not exist within the schema"):
        read_workbooks(spark, path, "Item string", schemaMatchColumnName="ok")
    with pytest.raises(WorkbookError, match="not defined as a boolean"):
        read_workbooks(spark, path, "Item string, ok string", schemaMatchColumnName="ok")


def test_match_flag_clash(spark, save):
    with pytest.raises(WorkbookError, match="conflicts with a column of the same name"):
        read_workbooks(spark, save("Simple.xlsx", wb.simple()), schemaMatchColumnName="col3")


def test_match_flag_not_null(spark, save):
    schema = T.StructType([
        T.StructField("Col1", T.StringType()), T.StructField("Col2", T.DoubleType(), False),
        T.StructField("Col3", T.StringType()), T.StructField("ok", T.BooleanType()),
    ])
    df = read_workbooks(spark, save("Blanks.xlsx", wb.with_blanks()), schema, schemaMatchColumnName="ok")
    assert [r["ok"] for r in df.collect()] == [True, False, True]


@pytest.mark.parametrize("options, expected", [
    ({"cellAddress": "A3", "headerRowCount": 0}, 3),
    ({"cellAddress": "A3", "headerRowCount": 0, "sheetNamePattern": r"\d{4}"}, 6),
])
def test_sheet_choice(spark, save, options, expected):
    df = read_workbooks(spark, save("Multi.xlsx", wb.multi_sheet()), **options)
    assert df.columns == [f"col_{i}" for i in range(25)]
    assert df.count() == expected


def test_multi_row_header(spark, save):
    path = save("Multi.xlsx", wb.multi_sheet())
    df = read_workbooks(spark, path, headerRowCount=2, sheetNamePattern=r"\d{4}", includeSheetName=True)
    expected = ["Category"] + [f"{m}_{k}" for m in wb.MONTHS for k in ("Purchased", "Sold")] + ["_SheetName"]
    assert df.columns == expected
    assert {f.dataType.simpleString() for f in df.schema[1:25]} == {"double"}
    got = sorted(rows(df.select("Category", "Mar_Purchased", "Mar_Sold", "_SheetName")))
    assert got == sorted(
        (k, p, s, y) for y in ("2019", "2020")
        for k, p, s in (("Pens", 100.0, 200.0), ("Erasers", 28.0, 37.0), ("Exercise books", 24.0, 90.0))
    )


def test_formula_results(spark, save):
    path = save("Calculated.xlsx", wb.calculated())
    df = read_workbooks(spark, path)
    assert names_types(df) == [
        ("Col_A", "double"), ("Col_B", "timestamp"), ("Col_C", "double"), ("Col_D", "timestamp"), ("Col_E", "double")
    ]
    got = rows(df)
    assert len(got) == 10
    assert got[5] == (6.0, datetime(2020, 1, 6), 36.0, datetime(2020, 4, 30), 6.0)


def test_formula_text(spark, save):
    df = read_workbooks(spark, save("Calculated.xlsx", wb.calculated()), evaluateFormulae="false")
    assert [t for _, t in names_types(df)] == ["double", "timestamp", "string", "string", "string"]
    assert rows(df)[5] == (6.0, datetime(2020, 1, 6), "A7*A7", "EOMONTH(B7,3)", "DAY(B7)")


def test_dates_and_floats(spark, save):
    schema = "Col_A int, Col_B date, Col_C float, Col_D date, Col_E double"
    df = read_workbooks(spark, save("Calculated.xlsx", wb.calculated()), schema)
    assert df.count() == 10
    assert rows(df)[0] == (1, date(2020, 1, 1), 1.0, date(2020, 4, 30), 1.0)


def test_concatenation(spark, save):
    path = save("Concat.xlsx", wb.concat_string())
    df = read_workbooks(spark, path)
    assert df.columns == ["Title", "Given_Name", "Family_Name", "Full_Name"]
    assert rows(df) == [
        ("Dr", "Jennifer", "Alagora", "Dr Jennifer Alagora"), ("Mr", "Adam", "Fox", "Mr Adam Fox"),
        ("Ms", None, "Proctor", "Ms Proctor"),
    ]
    nulled = read_workbooks(spark, path, nullValue="MR ADAM FOX")
    assert [r["Full_Name"] for r in nulled.collect()] == ["Dr Jennifer Alagora", None, "Ms Proctor"]


def test_text_of_other_values(spark, save):
    schema = T.StructType([T.StructField(n, T.StringType(), False) for n in ("Number", "Date", "Boolean", "Scientific")])
    df = read_workbooks(spark, save("NonString.xlsx", wb.non_string()), schema)
    assert rows(df) == [
        ("1.0", "2021-08-13T00:00:00", "true", "3.9E-10"), ("2.0", "2021-08-14T00:00:00", "false", "3.1415E8"),
    ]


def test_empty(spark, save):
    with pytest.raises(WorkbookError, match="^No data found on first row$"):
        read_workbooks(spark, save("Empty.xlsx", wb.empty()))


def test_header_only(spark, save):
    path = save("NoData.xlsx", wb.no_data())
    assert rows(read_workbooks(spark, path)) == [(None, None, None)]
    assert rows(read_workbooks(spark, path, "a string, b string, c string, d string")) == [(None,) * 4]
    # A given schema also reads an empty sheet as one record.
    assert rows(read_workbooks(spark, save("Empty.xlsx", wb.empty()), "a string")) == [(None,)]


def test_given_strings(spark, save):
    df = read_workbooks(spark, save("Simple.xlsx", wb.simple()), "Col1 string, Col2 string, Col3 string")
    assert rows(df) == [("a", "1.0", "x"), ("b", "2.0", "y"), ("c", "3.0", "z")]


def test_paths(spark, save, tmp_path):
    save("in/Simple 1.xlsx", wb.simple())
    save("in/Simple[2].xlsx", wb.simple())
    folder = str(tmp_path / "in")
    assert read_workbooks(spark, folder + "/Simple 1.xlsx").count() == 3
    assert read_workbooks(spark, folder + "/*.xlsx").count() == 6
    assert read_workbooks(spark, [folder + "/Simple 1.xlsx", folder + "/Simple 1.xlsx"], "a string").count() == 6
    assert read_workbooks(spark, folder, pathGlobFilter="*2].xlsx").count() == 3


def test_partition_columns(spark, save, tmp_path):
    save("t/year=2019/a.xlsx", wb.simple())
    save("t/year=2020/b.xlsx", wb.simple())
    df = read_workbooks(spark, str(tmp_path / "t"))
    assert df.columns == ["Col1", "Col2", "Col3", "year"]
    assert df.filter("year = 2020").count() == 3
    given = read_workbooks(spark, str(tmp_path / "t"), "a string, year int, b double, c string")
    assert sorted(rows(given))[0] == ("a", 1.0, "x", 2019)


def test_sql_view(spark, save):
    create_workbook_view(spark, "sample_workbook", save("Simple.xlsx", wb.simple()), schemaMatchColumnName="is_value")
    assert rows(spark.sql("SELECT Col1 FROM sample_workbook WHERE is_value AND Col2 > 1")) == [("b",), ("c",)]


def test_reader_method(spark, save):
    add_reader_method()
    path = save("Simple.xlsx", wb.simple())
    assert spark.read.excel(path, path.replace("Simple", "S*"), headerRowCount=1).columns == ["Col1", "Col2", "Col3"]


def test_corrupt_files(spark, save, tmp_path):
    good = wb.simple()
    save("mixed/a_broken.xlsx", good[: len(good) // 2])
    save("mixed/b_good.xlsx", good)
    save("mixed/c_encrypted.xlsx", wb.encrypted())
    folder = str(tmp_path / "mixed")
    with pytest.raises(WorkbookError, match="corrupt"):
        read_workbooks(spark, folder)
    with pytest.raises(PySparkException, match="can't read workbook"):
        read_workbooks(spark, folder, "a string").collect()
    assert rows(read_workbooks(spark, folder, ignoreCorruptFiles=True)) == SIMPLE


def test_password_is_refused(spark, save):
    with pytest.raises(WorkbookOptionError, match="not supported"):
        read_workbooks(spark, save("e.xlsx", wb.encrypted()), workbookPassword="password")


def test_no_writer():
    import gridloom

    assert not [n for n in dir(gridloom) if "write" in n.lower() or "save" in n.lower()]
