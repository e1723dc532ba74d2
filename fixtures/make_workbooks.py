"""Builds small workbooks for tests and benchmarks. Not part of the package, which never writes workbooks."""

from __future__ import annotations

import io
import re
import zipfile
from dataclasses import dataclass, field
from datetime import datetime
from xml.sax.saxutils import escape, quoteattr

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PKG = "http://schemas.openxmlformats.org/package/2006/relationships"


@dataclass(frozen=True)
class Date:
    """A number shown as a date; ``style`` picks one of STYLES."""
    serial: float
    style: int = 1


@dataclass(frozen=True)
class Formula:
    text: str
    result: object = None
    shared: int | None = None
    style: int = 0


@dataclass(frozen=True)
class Error:
    code: str


@dataclass(frozen=True)
class Inline:
    text: str


@dataclass(frozen=True)
class Raw:
    """Cell XML given as it is."""
    xml: str


BLANK = object()

# Cell styles of every workbook made here: (format id, custom code).
STYLES = ((0, None), (14, None), (164, "yyyy\\-mm\\-dd hh:mm:ss"), (165, '0.00 "days"'), (166, "[h]:mm:ss"))


@dataclass
class Sheet:
    name: str
    rows: dict[int, list] | list[list]
    merges: list[str] = field(default_factory=list)
    part: str | None = None
    extra_columns: int = 0


def serial(when: datetime) -> float:
    delta = when - datetime(1899, 12, 30)
    return delta.days + delta.seconds / 86400 + delta.microseconds / 86400e6


def column_name(i: int) -> str:
    name, i = "", i + 1
    while i:
        i, rest = divmod(i - 1, 26)
        name = chr(65 + rest) + name
    return name


class _Strings:
    def __init__(self):
        self.index: dict[str, int] = {}
        self.uses = 0

    def add(self, xml: str) -> int:
        self.uses += 1
        return self.index.setdefault(xml, len(self.index))


def _number(x) -> str:
    return repr(float(x)) if isinstance(x, float) else str(x)


def _value(x) -> tuple[str, str]:
    """(type attribute, value element) of a result."""
    if x is None:
        return "", ""
    if isinstance(x, bool):
        return ' t="b"', f"<v>{int(x)}</v>"
    if isinstance(x, (int, float)):
        return "", f"<v>{_number(x)}</v>"
    if isinstance(x, Error):
        return ' t="e"', f"<v>{escape(x.code)}</v>"
    return ' t="str"', f"<v>{escape(x)}</v>"


def _cell(ref: str, x, strings: _Strings) -> str:
    r = f' r="{ref}"' if ref else ""
    if isinstance(x, Raw):
        return x.xml
    if x is BLANK:
        return f"<c{r}/>"
    if isinstance(x, list):  # rich text: one run per part
        runs = "".join(f'<r><rPr><b/></rPr><t xml:space="preserve">{escape(p)}</t></r>' for p in x)
        return f'<c{r} t="s"><v>{strings.add(f"<si>{runs}</si>")}</v></c>'
    if isinstance(x, str):
        space = ' xml:space="preserve"' if x != x.strip() else ""
        return f'<c{r} t="s"><v>{strings.add(f"<si><t{space}>{escape(x)}</t></si>")}</v></c>'
    if isinstance(x, Inline):
        return f'<c{r} t="inlineStr"><is><t>{escape(x.text)}</t></is></c>'
    if isinstance(x, Date):
        return f'<c{r} s="{x.style}"><v>{_number(x.serial)}</v></c>'
    if isinstance(x, Formula):
        kind, value = _value(x.result)
        style = f' s="{x.style}"' if x.style else ""
        mark = f' t="shared" si="{x.shared}"' if x.shared is not None else ""
        text = f"<f{mark}>{escape(x.text)}</f>" if x.text else f"<f{mark}/>"
        return f"<c{r}{style}{kind}>{text}{value}</c>"
    kind, value = _value(x)
    return f"<c{r}{kind}>{value}</c>"


def _sheet_xml(sheet: Sheet, strings: _Strings, refs: bool) -> str:
    rows = sheet.rows.items() if isinstance(sheet.rows, dict) else enumerate(sheet.rows)
    out = []
    for n, cells in rows:
        body = "".join(
            _cell(f"{column_name(j)}{n + 1}" if refs else "", x, strings)
            for j, x in enumerate(cells) if x is not None
        )
        r = f' r="{n + 1}"' if refs else ""
        out.append(f"<row{r}>{body}</row>" if body else f"<row{r}/>")
    merges = "".join(f'<mergeCell ref="{m}"/>' for m in sheet.merges)
    tail = f'<mergeCells count="{len(sheet.merges)}">{merges}</mergeCells>' if merges else ""
    data = f"<sheetData>{''.join(out)}</sheetData>" if out else "<sheetData/>"
    return f'<worksheet xmlns="{MAIN}" xmlns:r="{REL}"><dimension ref="A1"/>{data}{tail}<pageMargins left="0.7"/></worksheet>'


def _styles_xml() -> str:
    custom = "".join(f"<numFmt numFmtId=\"{i}\" formatCode={quoteattr(c)}/>" for i, c in STYLES if c)
    xfs = "".join(f'<xf numFmtId="{i}" applyNumberFormat="1"/>' for i, _ in STYLES)
    return f'<styleSheet xmlns="{MAIN}"><numFmts>{custom}</numFmts><cellStyleXfs><xf numFmtId="14"/></cellStyleXfs><cellXfs>{xfs}</cellXfs></styleSheet>'


def _prefixed(xml: str, prefix: str) -> str:
    xml = re.sub(r"(</?)(?=[A-Za-z])", rf"\1{prefix}:", xml)
    return xml.replace(f'xmlns="{MAIN}"', f'xmlns:{prefix}="{MAIN}"')


def build_workbook(sheets: list[Sheet], *, refs: bool = True, prefix: str = "", date1904: bool = False,
                   styles: bool = True, level: int = 6) -> bytes:
    """The bytes of a workbook."""
    strings = _Strings()
    parts = {}
    for i, sheet in enumerate(sheets, 1):
        parts[sheet.part or f"worksheets/sheet{i}.xml"] = _sheet_xml(sheet, strings, refs)
    names = "".join(
        f'<sheet name={quoteattr(s.name)} sheetId="{i}" r:id="rId{i}"/>' for i, s in enumerate(sheets, 1)
    )
    flag = '<workbookPr date1904="1"/>' if date1904 else "<workbookPr/>"
    workbook = f'<workbook xmlns="{MAIN}" xmlns:r="{REL}">{flag}<sheets>{names}</sheets></workbook>'
    table = f'<sst xmlns="{MAIN}" count="{strings.uses}" uniqueCount="{len(strings.index)}">{"".join(strings.index)}</sst>'
    if prefix:
        parts = {k: _prefixed(v, prefix) for k, v in parts.items()}
        workbook, table = _prefixed(workbook, prefix), _prefixed(table, prefix)
    links = [(f"rId{i}", "worksheet", k) for i, k in enumerate(parts, 1)]
    if styles:
        links.append(("rIdS", "styles", "styles.xml"))
    if strings.index:
        links.append(("rIdT", "sharedStrings", "sharedStrings.xml"))
    rels = "".join(f'<Relationship Id="{i}" Type="{REL}/{t}" Target="{k}"/>' for i, t, k in links)
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=level) as z:
        def put(name, text):
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), head + text, zipfile.ZIP_DEFLATED)

        put("[Content_Types].xml", '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"/>')
        put("_rels/.rels", f'<Relationships xmlns="{PKG}"><Relationship Id="rId1" Type="{REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        put("xl/workbook.xml", workbook)
        put("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PKG}">{rels}</Relationships>')
        if styles:
            put("xl/styles.xml", _styles_xml())
        if strings.index:
            put("xl/sharedStrings.xml", table)
        for k, v in parts.items():
            put(f"xl/{k}", v)
    return out.getvalue()
