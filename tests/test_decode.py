"""Unusual but valid workbooks."""

import gzip
import random
from datetime import datetime

import numpy as np
import pytest

from fixtures.make_workbooks import BLANK, Date, Error, Formula, Inline, Raw, Sheet, build_workbook
from gridloom import WorkbookError, read_workbook_files, read_workbooks, workbook_files, workbook_report
from gridloom.functions.references import shift_formula
from gridloom.sources import decode, inflate, pieces


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_texts(spark, save):
    book = build_workbook([Sheet("S", [
        ["rich", "inline", "spaces", "escapes", "empty"],
        [["a ", "b", "<&>"], Inline("x & y"), "  keep  ", "line_x000A_break", ""],
        [["once"], Inline(""), "é日本", "_x005F_x000A_", BLANK],
    ])])
    assert rows(read_workbooks(spark, save("t.xlsx", book))) == [
        ("a b<&>", "x & y", "  keep  ", "line\nbreak", ""), ("once", "", "é日本", "_x000A_", None),
    ]


def test_without_references_and_with_prefix(spark, save):
    sheets = [Sheet("S", [["a", "b"], ["x", 1], ["y", 2.5]])]
    plain = rows(read_workbooks(spark, save("plain.xlsx", build_workbook(sheets))))
    assert plain == [("x", 1.0), ("y", 2.5)]
    assert rows(read_workbooks(spark, save("bare.xlsx", build_workbook(sheets, refs=False)))) == plain
    assert rows(read_workbooks(spark, save("x.xlsx", build_workbook(sheets, prefix="x")))) == plain
    assert rows(read_workbooks(spark, save("g.xlsx.gz", gzip.compress(build_workbook(sheets))))) == plain


def test_odd_cell_xml(spark, save):
    odd = [
        Raw('<c t="n" r="A2" s="0"><v>7</v></c>'), Raw("<c r='B2' t='str'><f>1&lt;2</f><v>yes</v></c>"),
        Raw('<c r="D2" t="e"><v>#N/A</v></c>'), Raw('<c r="E2" t="s"/>'), Raw('<c r="F2"> <v>1.5E3</v> </c>'),
    ]
    book = build_workbook([Sheet("S", [["a", "b", "c", "d", "e", "f"], odd])])
    df = read_workbooks(spark, save("odd.xlsx", book), "a double, b string, c string, d string, e string, f double")
    assert rows(df) == [(7.0, "yes", None, None, "", 1500.0)]


def test_gaps_everywhere(spark, save):
    # Rows 2 (header), 4 and 6-7 are absent; a row without cells is there at 8.
    book = build_workbook([Sheet("S", {0: ["a", "b"], 2: ["x", 1], 4: ["y", 2], 7: [], 8: ["z", 3]})])
    df = read_workbooks(spark, save("gaps.xlsx", book), headerRowCount=2, schemaMatchColumnName="ok")
    assert rows(df) == [
        ("x", 1.0, True), (None, None, False), ("y", 2.0, True), (None, None, False), (None, None, False),
        (None, None, True), ("z", 3.0, True),
    ]


def test_merged_blocks(spark, save):
    book = build_workbook([Sheet("S", {
        0: ["k", "v", "w", "x"], 1: ["a", 1, 2, "p"], 2: [None, 9, 9], 3: [None, None, None, "q"], 6: ["end", 4, 5],
    }, merges=["A2:A4", "B2:C3", "D4:D6", "A7:A9"])])
    df = read_workbooks(spark, save("m.xlsx", book), schemaMatchColumnName="ok")
    assert rows(df) == [
        ("a", 1.0, 1.0, "p", True), ("a", 1.0, 1.0, None, True), ("a", None, None, "q", True),
        (None, None, None, "q", True), (None, None, None, "q", True), ("end", 4.0, 5.0, None, True),
    ]


def test_merged_regions_across_pieces(monkeypatch):
    """Small pieces of XML give the same rows as one piece, fills included."""
    rng = random.Random(5)
    grid = [[rng.choice([1.5, "t", BLANK, True, None]) for _ in range(6)] for _ in range(200)]
    merges, at = [], 1
    while at < 190:
        height = rng.randint(1, 30)
        merges.append(f"{rng.choice('ABC')}{at}:{rng.choice('DEF')}{at + height - 1}")
        at += height + rng.randint(0, 3)
    import io
    import zipfile

    content = build_workbook([Sheet("S", grid, merges)])

    def decoded():
        z = zipfile.ZipFile(io.BytesIO(content))
        strings = inflate.read_strings(z, "xl/sharedStrings.xml", 10**6)
        out = []
        for numbers, gaps, cells, fills in inflate.sheet_batches(z, "xl/worksheets/sheet1.xml", strings, set(), False, None):
            out += zip(numbers.tolist(), gaps.tolist(), cells.to_pylist(), [f or None for f in fills.to_pylist()])
        return out

    whole = decoded()
    monkeypatch.setattr(inflate, "CHUNK_BYTES", 300)
    monkeypatch.setattr(inflate, "KEEP_BYTES", 10)
    assert decoded() == whole
    # Pieces decoded each by itself, with what they bring along, give the same rows.
    z = zipfile.ZipFile(io.BytesIO(content))
    strings = inflate.read_strings(z, "xl/sharedStrings.xml", 10**6)
    found = []
    names = ("piece", "before", "xml", "ids", "texts", "regions", "masters")
    for piece in pieces.sheet_pieces(z, "xl/worksheets/sheet1.xml", strings, set(), False, 300):
        numbers, gaps, cells, fills = pieces.piece_rows(dict(zip(names, piece)) | {"date_styles": []}, False)
        found.append(list(zip(numbers.tolist(), gaps.tolist(), cells.to_pylist(), [f or None for f in fills.to_pylist()])))
    assert len(found) > 30 and sum(found, []) == whole
    # All rows down to the last one, and the end of the sheet.
    assert len(whole) == 200 + 1


def test_string_table_over_the_limit():
    import pyarrow as pa

    table = inflate.StringTable(limit=50)
    words = [f"word {i}" for i in range(1000)]
    for i in range(0, 1000, 100):
        table.add(pa.array(words[i:i + 100]))
    assert sum(isinstance(p, pa.Array) for p in table.pages) < 10
    ids = np.random.default_rng(3).integers(0, 1000, 500)
    assert table.take(ids).to_pylist() == [words[i] for i in ids]
    assert table.take(np.array([5, 5000])).to_pylist() == ["word 5", None]


@pytest.mark.parametrize("date1904, expected", [
    (False, [datetime(1900, 2, 28), datetime(1900, 3, 1), datetime(1900, 3, 1), datetime(2021, 8, 13, 12, 0, 0, 500000)]),
    (True, [datetime(1904, 2, 29), datetime(1904, 3, 1), datetime(1904, 3, 2), datetime(2025, 8, 14, 12, 0, 0, 500000)]),
])
def test_date_systems(spark, save, date1904, expected):
    serials = [59, 60, 61, 44421 + 0.5 + 0.5 / 86400]
    book = build_workbook([Sheet("S", [["d"], *[[Date(s)] for s in serials]])], date1904=date1904)
    df = read_workbooks(spark, save("d.xlsx", book))
    assert [r[0] for r in rows(df)] == expected
    texts = read_workbooks(spark, save("d.xlsx", book), "d string")
    assert rows(texts)[3][0] == expected[3].strftime("%Y-%m-%dT%H:%M:%S") + ".5"


def test_date_styles(spark, save):
    book = build_workbook([Sheet("S", [["a", "b", "c", "d", "e"], [Date(1.0, s) for s in range(5)], [Date(-1.0, 1)] * 5])])
    df = read_workbooks(spark, save("s.xlsx", book), "a string, b string, c string, d string, e string")
    assert rows(df) == [
        ("1.0", "1900-01-01T00:00:00", "1900-01-01T00:00:00", "1.0", "1900-01-01T00:00:00"), ("-1.0",) * 5,
    ]


def test_header_of_other_kinds(spark, save):
    head = [2010, Date(44421), True, Error("#REF!"), Formula("1+1", "calc"), " . ", "a.b, c\\d+\ne_", None, "last"]
    book = build_workbook([Sheet("S", [head, [1] * 9])])
    assert read_workbooks(spark, save("h.xlsx", book)).columns == [
        "2010_0", "13-Aug-2021", "TRUE", "#REF!", "calc", "col_5", "a_b_c_d_e", "col_7", "last",
    ]
    assert read_workbooks(spark, save("h.xlsx", book), evaluateFormulae=False).columns[4] == "1+1".replace("+", "_")


def test_repeated_header(spark, save):
    with pytest.raises(WorkbookError, match="more than once in the header: a"):
        read_workbooks(spark, save("r.xlsx", build_workbook([Sheet("S", [["a", "a"], [1, 2]])])))


def test_uncalculated_formula(spark, save):
    book = build_workbook([Sheet("S", [["a", "b"], [1, Formula("A2*2")], [1, Formula("A3*2", 2)]])])
    path = save("u.xlsx", book)
    assert rows(read_workbooks(spark, path, "a int, b int")) == [(1, None), (1, 2)]
    found = workbook_report(workbook_files(spark, path), formulas=True).first()
    assert (found["status"], found["uncalculated"]) == ("ok", 1)


def test_schema_of_text_in_the_last_row(spark, save):
    book = build_workbook([Sheet("S", [["a"], [1], [2], ["x"]])])
    path = save("l.xlsx", book)
    assert read_workbooks(spark, path).schema["a"].dataType.simpleString() == "string"
    assert read_workbooks(spark, path, maxRowCount=2).schema["a"].dataType.simpleString() == "double"


def test_report(spark, save, tmp_path):
    good = build_workbook([Sheet("S", [["a"], [1]]), Sheet("T", [])])
    save("r/good.xlsx", good)
    save("r/cut.xlsx", good[:200])
    save("r/old.xls", bytes.fromhex("d0cf11e0a1b11ae1") + b"\0" * 512)
    save("r/locked.xlsx", bytes.fromhex("d0cf11e0a1b11ae1") + "EncryptedPackage".encode("utf-16-le"))
    save("r/text.xlsx", b"a,b,c\n1,2,3\n")
    report = workbook_report(workbook_files(spark, str(tmp_path / "r")))
    found = {r["file"].rsplit("/", 1)[1]: (r["status"], r["n_sheets"]) for r in report.collect()}
    assert found == {
        "good.xlsx": ("ok", 2), "cut.xlsx": ("corrupt", 0),
        "old.xls": ("unsupported_format", 0), "locked.xlsx": ("encrypted", 0), "text.xlsx": ("corrupt", 0),
    }


def test_damaged_sheet_is_an_error_not_missing_rows(spark, save):
    good = bytearray(build_workbook([Sheet("S", [["a"], *[[f"text {i * 7919 % 1000}"] for i in range(2000)]])]))
    at = good.find(b"xl/worksheets/sheet1.xml") + 200
    good[at:at + 40] = bytes(40)
    path = save("damaged.xlsx", bytes(good))
    with pytest.raises(Exception, match="can't read workbook"):
        read_workbooks(spark, path, "a string").collect()


@pytest.mark.parametrize("text, moved", [
    ("A1*$B$1+C$2-$D3", "C4*$B$1+E$2-$D6"), ("SUM(A1:B2)", "SUM(C4:D5)"), ('"A1"&A1', '"A1"&C4'),
    ("Sheet1!A1+'A1 x'!B2", "Sheet1!C4+'A1 x'!D5"), ("LOG10(A1)", "LOG10(C4)"), ("A:B+3:$4", "C:D+6:$4"),
    ("Rate_A1+A1", "Rate_A1+C4"),
])
def test_shift_formula(text, moved):
    assert shift_formula(text, 3, 2) == moved


def test_large_files_are_shared(spark, save, monkeypatch):
    from gridloom.sources import decode

    monkeypatch.setattr(decode, "SPREAD_BYTES", 20_000)
    monkeypatch.setattr(decode, "PIECE_BYTES", 10_000)
    lines = [[f"text {i}", i, i * 0.5] for i in range(3000)]
    book = build_workbook([Sheet("A", [["t", "i", "x"], *lines]), Sheet("B", [["t", "i", "x"], *lines[:10]])])
    assert len(book) > 20_000
    paths = [save("big.xlsx", book), save("small.xlsx", build_workbook([Sheet("A", [["t", "i", "x"], ["s", 1, 2]])]))]
    df = read_workbooks(spark, paths, "t string, i int, x double, _SheetName string", sheetNamePattern="[AB]", includeSheetName=True)
    expected = [(*r, "A") for r in lines] + [(*r, "B") for r in lines[:10]] + [("s", 1, 2.0, "A")]
    assert sorted(rows(df)) == sorted((t, i, float(x), s) for t, i, x, s in expected)


def test_cells_out_of_order(spark, save):
    odd = [Raw('<c r="C2"><v>3</v></c>'), Raw('<c r="A2"><v>0</v></c>'), Raw('<c r="E2"><v>5</v></c>'), Raw('<c r="A2"><v>1</v></c>')]
    book = build_workbook([Sheet("S", [["a", "b", "c", "d", "e"], odd, [1, 2, 3, 4, 5]])])
    assert rows(read_workbooks(spark, save("o.xlsx", book))) == [
        (1.0, None, 3.0, None, 5.0), (1.0, 2.0, 3.0, 4.0, 5.0),
    ]


def _replaced(book: bytes, part: str, *changes: tuple[str, str]) -> bytes:
    """The workbook with texts in the XML of one part replaced."""
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(book)) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
        for item in old.infolist():
            data = old.read(item)
            if item.filename == part:
                for a, b in changes:
                    assert a.encode() in data
                    data = data.replace(a.encode(), b.encode())
            new.writestr(item.filename, data)
    return out.getvalue()


SHEET = "xl/worksheets/sheet1.xml"


@pytest.mark.parametrize("spread", [False, True])
def test_damaged_values_and_character_data(spark, save, monkeypatch, spread):
    """CDATA, characters written in halves, and values that are none: read by one task and shared between several."""
    if spread:
        monkeypatch.setattr(decode, "SPREAD_BYTES", 10)
        monkeypatch.setattr(decode, "PIECE_BYTES", 100)
    book = build_workbook([Sheet("S", [["n", "s"], [2, "a"], [77, "b"], [5, "_xD83D__xDE00_|_xD83D_|"]])])
    book = _replaced(book, SHEET, ("<v>2</v>", "<v><![CDATA[2]]></v>"), ("<v>77</v>", "<v>two</v>"))
    df = read_workbooks(spark, save("d.xlsx", book), "n long, s string, ok boolean", schemaMatchColumnName="ok")
    assert sorted(rows(df), key=repr) == sorted([(2, "a", True), (None, "b", True), (5, "\U0001f600|�|", True)], key=repr)


@pytest.mark.parametrize("spread", [False, True])
def test_skipped_files(spark, save, tmp_path, monkeypatch, spread):
    """Files that can't be read are skipped where asked for, and no others."""
    if spread:
        monkeypatch.setattr(decode, "SPREAD_BYTES", 10)
    good = build_workbook([Sheet("S", [["n"], [1], [2]])])
    save("in/a.xlsx", _replaced(good, SHEET, ("</row>", "<//row")))
    save("in/b.xlsx", good)
    import io
    import zipfile

    bare = io.BytesIO()
    with zipfile.ZipFile(bare, "w") as z:
        z.writestr("readme.txt", "no workbook")
    save("in/c.xlsx", bare.getvalue())
    save("in/d.xlsx", good)
    df = read_workbooks(spark, str(tmp_path / "in"), "n long", ignoreCorruptFiles=True)
    assert sorted(r[0] for r in df.collect() if r[0] is not None) == [1, 1, 2, 2]
    with pytest.raises(Exception, match="can't read workbook"):
        read_workbooks(spark, str(tmp_path / "in"), "n long").collect()


def test_files_without_a_length(spark):
    good = build_workbook([Sheet("S", [["n"], [1], [2], [3]])])
    files = spark.createDataFrame([("a.xlsx", 9, bytearray(good)), ("b.xlsx", None, bytearray(good))], "path string, length long, content binary")
    assert read_workbook_files(files, "n long").count() == 6


def test_region_down_the_whole_column(spark, save):
    book = build_workbook([Sheet("S", [["k", "v"], ["a", 1], [None, 2]], merges=["A2:A1048576"])])
    assert rows(read_workbooks(spark, save("m.xlsx", book), "k string, v int")) == [("a", 1), ("a", 2)]


def test_overlapping_regions_of_a_file(spark, save):
    book = build_workbook([Sheet("S", [["a", "b", "c"], [1, 2, 100], [3, 4, 200]], merges=["A2:B3", "B2:B2"])])
    assert rows(read_workbooks(spark, save("m.xlsx", book), "a int, b int, c int")) == [(1, 1, 100), (1, 1, 200)]


def _spread(monkeypatch, piece_bytes: int = 200):
    monkeypatch.setattr(decode, "SPREAD_BYTES", 10)
    monkeypatch.setattr(decode, "PIECE_BYTES", piece_bytes)


def test_pieces_bring_regions_and_formulas(spark, save, monkeypatch):
    """Regions over many pieces, shared formulas written once, cells and rows without addresses, folders as columns."""
    lines = [[f"t{i % 7}", i, Formula("B2*2", i * 2.0, shared=3) if i == 0 else Formula("", i * 2.0, shared=3)] for i in range(120)]
    sheet = Sheet("S", [["t", "n", "f"], *lines], merges=["A3:A40", "A50:B121", "B45:B46"])
    book = build_workbook([sheet, Sheet("T", [["t", "n", "f"], ["x", 1, 2]])])
    bare = _replaced(build_workbook([Sheet("S", [["t", "n"], *[[f"u{i}", i] for i in range(50)]], merges=["A2:A30"])]), SHEET, (' r="A2"', ""), (' r="B2"', ""))
    for name, content in (("k=1/a.xlsx", book), ("k=2/b.xlsx", bare)):
        save(f"in/{name}", content)
    folder = save("in/k=1/c.xlsx", book).rsplit("/k=1", 1)[0]
    for options in ({}, {"evaluateFormulae": False}, {"sheetNamePattern": "[ST]", "cellAddress": "A2"}):
        read = lambda: sorted(rows(read_workbooks(spark, folder, "t string, n int, f string, ok boolean", schemaMatchColumnName="ok", **options)), key=repr)
        with monkeypatch.context() as m:
            whole = read()
            _spread(m)
            assert read() == whole and len(whole) > 280


def test_only_pieces_are_shuffled(spark, save, monkeypatch):
    """No exchange carries files' contents, and small files pass none."""
    _spread(monkeypatch)
    path = save("a.xlsx", build_workbook([Sheet("S", [["n"], *[[i] for i in range(100)]])]))
    df = read_workbooks(spark, path, "n long")
    plan = df._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.split("\n") if "Exchange" in line]
    assert len(exchanges) == 1 and "piece" in exchanges[0] and "content" not in exchanges[0]
    assert df.count() == 100


def test_a_damaged_piece_ends_the_query(spark, save, monkeypatch):
    _spread(monkeypatch)
    book = build_workbook([Sheet("S", [["n"], *[[i] for i in range(100)]])])
    path = save("a.xlsx", _replaced(book, SHEET, ('r="90"', 'r="x"')))
    with pytest.raises(Exception, match="can't read workbook"):
        read_workbooks(spark, save("b.xlsx", book[:-400] + b"x" * 400), "n long").collect()
    assert read_workbooks(spark, path, "n long").count() >= 99
