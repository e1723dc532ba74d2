"""``excel`` as a format of Spark's reader."""

import pytest
from pyspark.sql import DataFrameReader

from fixtures.make_workbooks import Sheet, build_workbook
from gridloom import WorkbookError, read_workbooks
from gridloom.sources.reader import add_format


@pytest.fixture
def excel(spark):
    add_format()
    add_format()  # a second time changes nothing
    yield spark
    for name, plain in DataFrameReader._without_workbooks.items():
        setattr(DataFrameReader, name, plain)
    del DataFrameReader._without_workbooks


BOOK = build_workbook([Sheet("A", [["n", "t"], [1, "x"], [2, None]]), Sheet("B", [["n", "t"], [3, "y"]])])


def test_load(excel, save):
    path = save("a.xlsx", BOOK)
    expected = read_workbooks(excel, path, sheetNamePattern="[AB]", includeSheetName=True)
    asked = {"sheetNamePattern": "[AB]", "includeSheetName": True}
    readers = [
        excel.read.format("excel").option("sheetNamePattern", "[AB]").option("includeSheetName", True).load(path),
        excel.read.options(**asked).format("Excel").load([path]),
        excel.read.option("sheetnamepattern", "zzz").format("excel").options(**asked).load(path),
        excel.read.format("excel").option("path", path).load(**asked),
        excel.read.load(path, "excel", **asked),
    ]
    for df in readers:
        assert df.schema == expected.schema and sorted(df.collect()) == sorted(expected.collect())


def test_schema(excel, save):
    path = save("a.xlsx", BOOK)
    for df in (excel.read.schema("k long").format("excel").load(path), excel.read.format("excel").schema("k long").load(path),
               excel.read.load(path, format="excel", schema="k long")):
        assert df.columns == ["k"] and sorted(r["k"] for r in df.collect()) == [1, 2]


def test_other_formats_and_errors(excel, save, tmp_path):
    excel.range(3).write.parquet(str(tmp_path / "p"))
    assert excel.read.option("mergeSchema", True).format("parquet").load(str(tmp_path / "p")).count() == 3
    assert excel.read.schema("id long").load(str(tmp_path / "p"), "parquet").count() == 3
    with pytest.raises(Exception, match="No path"):
        excel.read.format("excel").load()
    with pytest.raises(Exception, match="did you mean"):
        excel.read.format("excel").option("sheetNamePatern", "x").load(save("a.xlsx", BOOK))
    with pytest.raises(WorkbookError):
        excel.read.format("excel").option("sheetNamePattern", "none").load(save("a.xlsx", BOOK))
