"""The workbooks the tests read, one function each."""

from __future__ import annotations

from datetime import datetime

from fixtures.make_workbooks import BLANK, Date, Formula, Sheet, build_workbook, serial


def simple(name="Sheet1") -> bytes:
    return build_workbook([Sheet(name, [["Col1", "Col2", "Col3"], ["a", 1, "x"], ["b", 2, "y"], ["c", 3, "z"]])])


def with_blanks() -> bytes:
    return build_workbook([Sheet("Sheet1", [["Col1", "Col2", "Col3"], ["a", 1, "x"], ["b", BLANK, "y"], ["c", 3, "z"]])])


def misaligned() -> bytes:
    rows = [["Col1", "Col2", "Col3"], ["a", 1, "x"], ["b", 2, "y"], ["c", 3, "z"]]
    return build_workbook([Sheet("Sheet1", {4 + i: [None, None, *r] for i, r in enumerate(rows)})])


def empty() -> bytes:
    return build_workbook([Sheet("Sheet1", [])])


def no_data() -> bytes:
    return build_workbook([Sheet("Sheet1", [["Name", "Size", "Kind"]])])


VARYING = [
    ("Item 1", 99.4, True), ("Item 2", 12.4, True), ("Item 3", 74.2, True), ("Item 4", 36.8, False),
    ("Item 5", 24.2, False), ("Item 6", 11.6, False), ("Header Items", None, None), ("Item 12", 99.2, False),
    ("Item 13", 18.4, True), ("Item 14", 12.3, True),
]


def varying_types() -> bytes:
    rows = [["Item", 2010, 2011, "IsGood"]]
    for item, x, good in VARYING:
        rows.append([item, "2010 Items", "2011 Items", BLANK] if x is None else [item, x, x, good])
    return build_workbook([Sheet("Sheet1", rows)])


def calculated() -> bytes:
    rows = [["Col A", "Col B", "Col C", "Col D", "Col E"]]
    april = serial(datetime(2020, 4, 30))
    for n in range(1, 11):
        r = n + 1
        rows.append([
            n, Date(serial(datetime(2020, 1, n))),
            Formula("A2*A2" if n == 1 else "", n * n, shared=0),
            Formula(f"EOMONTH(B{r},3)", april, style=1),
            Formula("DAY(B2)" if n == 1 else "", n, shared=1),
        ])
    return build_workbook([Sheet("Sheet1", rows)])


def concat_string() -> bytes:
    people = [("Dr", "Jennifer", "Alagora"), ("Mr", "Adam", "Fox"), ("Ms", BLANK, "Proctor")]
    rows = [["Title", "Given Name", "Family Name", "Full Name"]]
    for i, (t, g, f) in enumerate(people, 2):
        full = " ".join(x for x in (t, g, f) if x is not BLANK)
        rows.append([t, g, f, Formula(f'CONCATENATE(A{i}," ",B{i}," ",C{i})', full)])
    return build_workbook([Sheet("Sheet1", rows)])


def non_string() -> bytes:
    rows = [
        ["Number", "Date", "Boolean", "Scientific"],
        [1, Date(serial(datetime(2021, 8, 13))), True, 3.9e-10],
        [2, Date(serial(datetime(2021, 8, 14))), False, 314150000],
    ]
    return build_workbook([Sheet("Sheet1", rows)])


MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def multi_sheet() -> bytes:
    from fixtures.make_workbooks import column_name

    head = [BLANK] + [x for m in MONTHS for x in (m, BLANK)]
    second = ["Category"] + ["Purchased", "Sold"] * 12
    merges = [f"{column_name(1 + 2 * i)}1:{column_name(2 + 2 * i)}1" for i in range(12)]
    march = {"Pens": (100, 200), "Erasers": (28, 37), "Exercise books": (24, 90)}

    def year(name):
        body = [[k] + [x for m in range(12) for x in ((p, s) if m == 2 else (m, m + 1))] for k, (p, s) in march.items()]
        return Sheet(name, [head, second, *body], merges)

    return build_workbook([year("2019"), year("2020"), Sheet("Summary", [["Total"], [6]])])


def encrypted() -> bytes:
    return bytes.fromhex("d0cf11e0a1b11ae1")
