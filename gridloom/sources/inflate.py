"""Task-side stage: one workbook container in, Arrow batches of grid rows out.

A sheet is inflated as a stream, cut after whole rows and split into cells with Arrow kernels, a few
megabytes at a time. Each row leaves here complete: its texts are looked up in the workbook's string
table, the regions merged over it carry the content of their first cell, and the number of absent rows
above it is known. So no later step has to bring rows of one sheet together again.
"""

from __future__ import annotations

import io
import re
import zipfile
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gridloom.functions.references import letters_to_number, shift_formula
from gridloom.sources.container import ContainerError, as_text, open_zip

CELL_ARROW = pa.struct([
    ("col", pa.int32()), ("kind", pa.string()), ("num", pa.float64()), ("bool", pa.bool_()),
    ("str", pa.string()), ("is_date", pa.bool_()), ("formula", pa.string()),
])
FILL_ARROW = pa.struct([("c0", pa.int32()), ("c1", pa.int32()), ("cell", CELL_ARROW)])

# Bytes of sheet XML split at a time; a longer row is taken as a whole.
CHUNK_BYTES = 4 * 1024**2
# Sheets up to this size are inflated once and kept; larger ones twice, as their merged regions come last.
KEEP_BYTES = 32 * 1024**2
# Rows, or bytes, gathered before a batch is handed to Spark.
BATCH_ROWS = 8192
BATCH_BYTES = 32 * 1024**2

_COLS = 16384  # fixed value: columns of a sheet
# What a damaged part of a file may raise while it is read.
DAMAGE = (ContainerError, zipfile.BadZipFile, zlib.error, ValueError, KeyError, IndexError, EOFError, OSError, RuntimeError,
          OverflowError, pa.ArrowException)
_KINDS = pa.array(["blank", "num", "str", "bool", "error"])

# How the XML of one cell, row, text item and merged region is written.
_CELL_FAST = (
    r'^(?:r="(?P<c>[A-Z]+)[0-9]+")?(?: s="(?P<s>[0-9]+)")?(?: t="(?P<t>[A-Za-z]+)")?\s*'
    r"(?:/>|>\s*(?:<v[^>]*>(?P<v>[^<]*)</v>)?\s*</c>)\s*$"
)
_CELL_R = r"""^(?:[^>]*?\s)?r=["'](?P<x>[A-Za-z]+)"""
_CELL_S = r"""^(?:[^>]*?\s)?s=["'](?P<x>[0-9]+)"""
_CELL_T = r"""^(?:[^>]*?\s)?t=["'](?P<x>[A-Za-z]+)"""
_CELL_V = r"<v(?:\s[^>]*)?>(?P<x>[^<]*)</v>"
_CELL_IS = r"(?s)<is(?:\s[^>]*)?>(?P<x>.*)</is>"
_CELL_F = r"<f(?P<a>(?:\s[^>]*?)?)(?:/>|>(?P<x>[^<]*)</f>)"
_ROW_R = r"""<row(?:[^>]*?\s)r=["'](?P<x>[0-9]+)"""
_ROW_TAG = re.compile(rb"""<row\s(?:[^>]*?\s)?r=["']([0-9]+)["']""")
_SI_FAST = r"^\s*<si>\s*<t[^>/]*>(?P<x>[^<]*)</t>\s*$"
_MERGE = re.compile(rb"""<mergeCell\s[^>]*?ref=["']\$?([A-Z]+)\$?([0-9]+):\$?([A-Z]+)\$?([0-9]+)["']""")
_RUN_TEXT = re.compile(r"<t(?:\s[^>]*?)?(?:/>|>([^<]*)</t>)")
_PHONETIC = re.compile(r"(?s)<rPh\b.*?</rPh>")
_ENTITY = re.compile(r"&(#x[0-9A-Fa-f]+|#[0-9]+|lt|gt|amp|quot|apos);")
_ENTITIES = {"lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'"}
_ESCAPE = re.compile(r"_x([0-9A-Fa-f]{4})_")


def _entity(m):
    name = m[1]
    if name[0] != "#":
        return _ENTITIES[name]
    code = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
    return chr(code) if code < 0x110000 else "\ufffd"


def plain_text(xml_text: str) -> str:
    """XML character data → the text it stands for, with the format's ``_xHHHH_`` escapes undone."""
    text = _ENTITY.sub(_entity, xml_text) if "&" in xml_text else xml_text
    text = _ESCAPE.sub(lambda m: chr(int(m[1], 16)), text) if "_x" in text else text
    # A character may be written as two halves; a half by itself is none.
    return text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


def run_text(fragment: str) -> str:
    """Text of a string item: its runs joined, phonetic hints left out."""
    return plain_text("".join(t or "" for t in _RUN_TEXT.findall(_PHONETIC.sub("", fragment))))


def _extract(values, pattern):
    """First group of ``pattern`` per value, "" where there is none."""
    return pc.fill_null(pc.struct_field(pc.extract_regex(values, pattern), "x"), "")


def _unescaped(values: pa.Array) -> pa.Array:
    """Undo entities and escapes, touching only the values that have any."""
    special = pc.fill_null(pc.match_substring_regex(values, "&|_x[0-9A-Fa-f]{4}_"), False)
    if not pc.any(special).as_py():
        return values
    fixed = pa.array([plain_text(v) for v in values.filter(special).to_pylist()], pa.string())
    return pc.replace_with_mask(values, special, fixed)


def _spread(mask: np.ndarray, some: pa.Array, into: pa.Array) -> pa.Array:
    """``into`` with the places where ``mask`` holds replaced by ``some``, in order."""
    return pc.replace_with_mask(into, pa.array(mask), some)


def _blocks(stream, size: int = CHUNK_BYTES):
    while block := stream.read(size):
        yield block


def _cut(blocks, end_tag: bytes):
    """Regroup blocks of bytes so that each but the last ends right after ``end_tag``."""
    rest = b""
    for block in blocks:
        rest += block
        at = rest.rfind(end_tag)
        while at >= 0 and rest.rfind(b"<![CDATA[", 0, at) > rest.rfind(b"]]>", 0, at):
            at = rest.rfind(end_tag, 0, at)
        if at >= 0:
            yield rest[: at + len(end_tag)]
            rest = rest[at + len(end_tag):]
    if rest:
        yield rest


class StringTable:
    """The shared texts of one workbook: Arrow pages, packed once they pass ``limit`` bytes."""

    def __init__(self, limit: int):
        self.limit, self.held = limit, 0
        self.pages, self.starts, self.size = [], [], 0
        self._open = (None, None)

    def add(self, page: pa.Array):
        self.starts.append(self.size)
        self.size += len(page)
        self.held += page.nbytes
        if self.held > self.limit:
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression="zstd")
            batch = pa.record_batch([page], names=["x"])
            with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
                writer.write_batch(batch)
            page = sink.getvalue()
        self.pages.append(page)

    def _page(self, k: int) -> pa.Array:
        if isinstance(self.pages[k], pa.Array):
            return self.pages[k]
        if self._open[0] != k:
            with pa.ipc.open_stream(self.pages[k]) as reader:
                self._open = (k, reader.read_next_batch().column(0))
        return self._open[1]

    def take(self, ids: np.ndarray) -> pa.Array:
        if not self.size:
            return pa.nulls(len(ids), pa.string())
        ok = (ids >= 0) & (ids < self.size)
        page_of = np.searchsorted(self.starts, np.where(ok, ids, 0), "right") - 1
        parts, order = [], []
        for k in np.unique(page_of):
            here = np.flatnonzero(page_of == k)
            local = pa.array(ids[here] - self.starts[k], mask=~ok[here])
            parts.append(self._page(int(k)).take(local))
            order.append(here)
        if len(parts) == 1:
            return parts[0]
        back = np.argsort(np.concatenate(order), kind="stable")
        return pa.concat_arrays(parts).take(pa.array(back))


def read_strings(z: zipfile.ZipFile, part: str | None, limit: int) -> StringTable:
    table = StringTable(limit)
    if not part or part not in z.namelist():
        return table
    with z.open(part) as stream:
        prefix, blocks = _prefixed(stream, b"sst")
        first = True
        for piece in _cut(blocks, b"</" + prefix + b"si>"):
            xml = _bare(piece, prefix)
            if first:
                at = re.search(rb"<sst[^>]*>", xml)
                xml, first = xml[at.end():] if at else xml, False
            xml = re.sub(rb"<si(?:\s[^>]*)?/>", b"<si></si>", xml)
            items = pc.split_pattern(pa.array([xml.decode("utf-8")]), "</si>").values
            items = items.filter(pc.match_substring(items, "<si"))
            if not len(items):
                continue
            fast = pc.extract_regex(items, _SI_FAST)
            texts = _unescaped(pc.struct_field(fast, "x"))
            slow = np.asarray(pc.is_null(fast))
            if slow.any():
                rich = items.filter(pa.array(slow)).to_pylist()
                texts = _spread(slow, pa.array([run_text(i) for i in rich], pa.string()), texts)
            table.add(texts)
    return table


def _prefixed(stream, root: bytes, size: int | None = None):
    """The namespace prefix of the root element (with its colon) and the stream's blocks as UTF-8."""
    size = size or CHUNK_BYTES
    head = stream.read(size)
    if head[:2] in (b"\xff\xfe", b"\xfe\xff"):
        head = as_text(head + stream.read()).encode("utf-8")
    m = re.search(rb"<([A-Za-z_][\w.-]*:)?" + root + rb"[\s>/]", head)
    if not m:
        raise ContainerError("corrupt", f"part has no <{root.decode()}> element")

    def blocks():
        yield head
        yield from _blocks(stream, size)

    return m[1] or b"", blocks()


def _as_characters(m) -> bytes:
    return m[1].replace(b"&", b"&amp;").replace(b"<", b"&lt;").replace(b">", b"&gt;")


def _bare(xml: bytes, prefix: bytes) -> bytes:
    """XML without its prefix, and with CDATA as plain characters."""
    if b"<![CDATA[" in xml:
        xml = re.sub(rb"(?s)<!\[CDATA\[(.*?)\]\]>", _as_characters, xml)
    return re.sub(rb"(</?)" + re.escape(prefix), rb"\1", xml) if prefix else xml


def _merge_regions(tail: bytes) -> np.ndarray:
    """Merged regions as rows of r0, c0, r1, c1 and place in the file, in order of their first row."""
    regions = [
        (int(r0) - 1, letters_to_number(c0.decode()) - 1, int(r1) - 1, letters_to_number(c1.decode()) - 1, k)
        for k, (c0, r0, c1, r1) in enumerate(_MERGE.findall(tail))
    ]
    return np.array(sorted(regions), dtype=np.int64).reshape(-1, 5)


class SheetXml:
    """The rows of one sheet part as pieces of XML, and the regions merged over them."""

    def __init__(self, z: zipfile.ZipFile, part: str, piece_bytes: int | None = None):
        self.z, self.part, self.piece_bytes = z, part, piece_bytes
        self.known = part in z.namelist()
        self.kept = None
        if self.known and z.getinfo(part).file_size <= KEEP_BYTES:
            self.kept = z.read(part)

    def _stream(self):
        return io.BytesIO(self.kept) if self.kept is not None else self.z.open(self.part)

    def _tail(self) -> bytes:
        """All after the rows, without the prefix."""
        with self._stream() as stream:
            prefix, blocks = _prefixed(stream, b"(?:worksheet|chartsheet|dialogsheet|macrosheet)")
            closing, found, rest = b"</" + prefix + b"sheetData>", False, b""
            for block in blocks:
                rest += block
                if not found:
                    at = rest.find(closing)
                    found = at >= 0
                    rest = rest[at:] if found else rest[-len(closing):]
            return _bare(rest, prefix) if found else b""

    def merges(self) -> np.ndarray:
        return _merge_regions(self._tail() if self.known else b"")

    def pieces(self):
        """XML of whole rows, each piece a few megabytes."""
        if not self.known:
            return
        with self._stream() as stream:
            prefix, blocks = _prefixed(stream, b"(?:worksheet|chartsheet|dialogsheet|macrosheet)", self.piece_bytes)
            opening = re.compile(rb"<" + prefix + rb"sheetData(?:\s[^>]*)?(/)?>")
            closing = b"</" + prefix + b"sheetData>"
            started = False
            for piece in _cut(blocks, b"</" + prefix + b"row>"):
                if not started:
                    m = opening.search(piece)
                    if not m or m[1]:
                        return
                    piece, started = piece[m.end():], True
                end = piece.find(closing)
                body = piece if end < 0 else piece[:end]
                if body.strip():
                    yield _bare(body, prefix)
                if end >= 0:
                    return


def _in_column_order(offsets: np.ndarray, cells: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Cells of each row by column; of several in one column the last counts. Sheets are nearly always so already."""
    line = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    key = line * _COLS + np.asarray(cells.field("col"), dtype=np.int64)
    if (np.diff(key) > 0).all():
        return offsets, cells
    order = np.argsort(key, kind="stable")
    last = np.append(np.diff(key[order]) > 0, True)
    kept = order[last]
    counts = np.bincount(line[kept], minlength=len(offsets) - 1)
    return np.concatenate([[0], np.cumsum(counts)]), cells.take(pa.array(kept))


def _number(text: str | None) -> float | None:
    try:
        return float(text) if text is not None else None
    except ValueError:
        return None


def _whole_numbers(texts: pa.Array) -> np.ndarray:
    """Indexes; -1 for what is none."""
    try:
        return np.asarray(texts.cast(pa.int64()))
    except pa.ArrowInvalid:
        return np.array([int(t) if t.strip().isdecimal() and len(t) < 18 else -1 for t in texts.to_pylist()], np.int64)


class SheetDecoder:
    """Turns the XML pieces of one sheet into row numbers, cell offsets and a cell array."""

    def __init__(self, strings: StringTable, date_styles: set[int], formulas: bool):
        self.strings, self.date_styles, self.formulas = strings, date_styles, formulas
        self.last_row = -1
        self.masters: dict[str, tuple[str, int, int]] = {}

    def _rows(self, xml: bytes) -> pa.ListArray:
        """One list per row: the row's tag, then what follows each cell's opening."""
        xml = re.sub(rb"<row((?:\s[^<>]*)?)/>", rb"<row\1></row>", xml)
        xml = xml.replace(b"<c>", b"<c >").replace(b"<c/>", b"<c />")
        rows = pc.split_pattern(pa.array([xml.decode("utf-8")]), "</row>").values
        return pc.split_pattern(rows.filter(pc.match_substring(rows, "<row")), "<c ")

    def skip(self, xml: bytes) -> np.ndarray:
        """Moves past a piece whose cells are not wanted; the last of its row numbers is right in any case."""
        last = _ROW_TAG.match(xml, max(xml.rfind(b"<row"), 0))
        if last:
            self.last_row = int(last[1]) - 1
            return np.array([self.last_row])
        parts = self._rows(xml)
        if not len(parts):
            return np.empty(0, np.int64)
        starts = np.asarray(parts.offsets, dtype=np.int64)
        return self._row_numbers(parts.flatten().take(pa.array(starts[:-1] - starts[0])))

    def piece(self, xml: bytes):
        parts = self._rows(xml)
        if not len(parts):
            return np.empty(0, np.int64), np.zeros(1, np.int64), pa.array([], CELL_ARROW)
        starts = np.asarray(parts.offsets, dtype=np.int64)
        starts = starts - starts[0]
        values = parts.flatten()
        numbers = self._row_numbers(values.take(pa.array(starts[:-1])))
        offsets = starts - np.arange(len(starts))
        is_cell = np.ones(len(values), bool)
        is_cell[starts[:-1]] = False
        row_of = np.repeat(numbers, np.diff(offsets))
        cells = self._cells(values.filter(pa.array(is_cell)), row_of, offsets)
        return numbers, *_in_column_order(offsets, cells)

    def _row_numbers(self, heads: pa.Array) -> np.ndarray:
        text = _extract(heads, _ROW_R)
        given = np.asarray(pc.not_equal(text, ""))
        if given.all():
            numbers = np.asarray(text.cast(pa.int64())) - 1
        else:
            numbers, at = np.empty(len(heads), np.int64), self.last_row
            for i, t in enumerate(text.to_pylist()):
                at = int(t) - 1 if t else at + 1
                numbers[i] = at
        self.last_row = int(numbers[-1])
        return numbers

    def _columns(self, letters: pa.Array, offsets: np.ndarray) -> np.ndarray:
        codes = pc.dictionary_encode(letters)
        known = [letters_to_number(x.upper()) - 1 if x else -1 for x in codes.dictionary.to_pylist()]
        cols = np.array(known, np.int64)[np.asarray(codes.indices)] if known else np.empty(0, np.int64)
        if (cols < 0).any():
            first = set(offsets[:-1].tolist())
            for i in np.flatnonzero(cols < 0):
                cols[i] = 0 if i in first else cols[i - 1] + 1
        return cols

    def _cells(self, bodies: pa.Array, row_of: np.ndarray, offsets: np.ndarray) -> pa.Array:
        n = len(bodies)
        if n == 0:
            return pa.array([], CELL_ARROW)
        fast = pc.extract_regex(bodies, _CELL_FAST)
        letters, style, kind_code, v = (
            pc.fill_null(pc.struct_field(fast, k), "") for k in ("c", "s", "t", "v")
        )
        inline = formula = None
        slow = np.asarray(pc.is_null(fast))
        if slow.any():
            rest = bodies.filter(pa.array(slow))
            letters = _spread(slow, _extract(rest, _CELL_R), letters)
            style = _spread(slow, _extract(rest, _CELL_S), style)
            kind_code = _spread(slow, _extract(rest, _CELL_T), kind_code)
            v = _spread(slow, _extract(rest, _CELL_V), v)
            items = _extract(rest, _CELL_IS)
            if pc.any(pc.not_equal(items, "")).as_py():
                texts = pa.array([run_text(i) if i else None for i in items.to_pylist()], pa.string())
                inline = _spread(slow, texts, pa.nulls(n, pa.string()))
        cols = self._columns(letters, offsets)
        if slow.any() and self.formulas:
            formula = self._formulas(rest, slow, row_of, cols)

        codes = pc.dictionary_encode(kind_code)
        names = codes.dictionary.to_pylist()
        code_of = np.asarray(codes.indices)

        def coded(*wanted):
            return np.isin(code_of, [i for i, x in enumerate(names) if x in wanted])

        has_v = np.array(pc.not_equal(v, ""))
        shared, error = coded("s"), coded("e")
        text = coded("s", "str", "inlineStr", "d")
        boolean = coded("b") & has_v
        number = ~(text | error | coded("b")) & has_v
        kind = np.zeros(n, np.int8)
        for k, where in enumerate((number, text, boolean, error), 1):
            kind[where] = k

        num = self._numbers(v, number)
        # What should be a number or an index and is none reads as an error cell, which fits no column.
        bad = number & np.asarray(pc.is_null(num))
        indexes = _whole_numbers(v.filter(pa.array(shared & has_v)))
        if (indexes < 0).any():
            bad[np.flatnonzero(shared & has_v)[indexes < 0]] = True
        if bad.any():
            kind[bad] = 4
            error, number, text, shared = error | bad, number & ~bad, text & ~bad, shared & ~bad
            indexes = indexes[indexes >= 0]
        words = pc.if_else(pa.array(text | error), v, pa.nulls(n, pa.string()))
        if (text & ~shared).any():
            words = _unescaped(words)
        if inline is not None:
            words = pc.coalesce(inline, words)
        if shared.any():
            words = _spread(shared & has_v, self.strings.take(indexes), words)
        if text.any():
            words = pc.if_else(pa.array(text), pc.fill_null(words, ""), words)
        truth = pc.if_else(pa.array(boolean), pc.is_in(v, pa.array(["1", "true"])), pa.nulls(n, pa.bool_()))
        dates = self._dates(style) & number
        if dates.any():
            dates &= np.asarray(pc.fill_null(pc.greater_equal(num, 0.0), False))
        return pa.StructArray.from_arrays(
            [
                pa.array(cols, pa.int32()), _KINDS.take(pa.array(kind)), num, truth, words,
                pa.array(dates), formula if formula is not None else pa.nulls(n, pa.string()),
            ],
            fields=list(CELL_ARROW),
        )

    def _numbers(self, v: pa.Array, number: np.ndarray) -> pa.Array:
        texts = pc.if_else(pa.array(number), v, pa.nulls(len(v), pa.string()))
        try:
            return texts.cast(pa.float64())
        except pa.ArrowInvalid:
            return pa.array([_number(t) for t in texts.to_pylist()], pa.float64())

    def _dates(self, style: pa.Array) -> np.ndarray:
        codes = pc.dictionary_encode(style)
        known = np.array([bool(s) and int(s) in self.date_styles for s in codes.dictionary.to_pylist()], bool)
        # A cell without a style has style 0.
        for i, s in enumerate(codes.dictionary.to_pylist()):
            if not s:
                known[i] = 0 in self.date_styles
        return known[np.asarray(codes.indices)]

    def _formulas(self, bodies: pa.Array, slow: np.ndarray, row_of, cols) -> pa.Array:
        found = pc.extract_regex(bodies, _CELL_F)
        texts = pc.struct_field(found, "x").to_pylist()
        marks = pc.struct_field(found, "a").to_pylist()
        out = []
        for i, text, mark in zip(np.flatnonzero(slow), texts, marks):
            if text is None:
                out.append(None)
                continue
            text = plain_text(text)
            group = re.search(r"""\ssi=["'](\d+)""", mark) if "shared" in mark else None
            if group and text:
                self.masters[group[1]] = (text, int(row_of[i]), int(cols[i]))
            elif group and group[1] in self.masters:
                master, r, c = self.masters[group[1]]
                text = shift_formula(master, int(row_of[i]) - r, int(cols[i]) - c)
            out.append(text or None)
        return _spread(slow, pa.array(out, pa.string()), pa.nulls(len(slow), pa.string()))


class MergeFiller:
    """Adds to each row the merged regions that cover it, with the content of the region's first cell."""

    def __init__(self, regions: np.ndarray):
        self.regions = regions
        self.anchors: dict[int, pa.Array] = {}  # region no. → its first cell, while it is still open
        self.next, self.done_row = 0, -1
        self.open = np.empty(0, np.int64)

    def rows(self, numbers, offsets, cells):
        """Rows, offsets, cells and fills of a piece; absent rows that a region covers are added, none below the last."""
        high = int(numbers[-1])
        low, self.done_row = self.done_row + 1, max(high, self.done_row)
        upto = int(np.searchsorted(self.regions[:, 0], high, "right"))
        active = np.concatenate([self.open, np.arange(self.next, max(upto, self.next))])
        self.next = max(upto, self.next)
        if not len(active):
            return numbers, offsets, cells, None
        r0, c0, r1, c1 = (self.regions[active, i] for i in range(4))

        key = np.repeat(numbers, np.diff(offsets)) * _COLS + np.asarray(cells.field("col"), dtype=np.int64)
        want = r0 * _COLS + c0
        order = np.argsort(key, kind="stable")
        at = np.searchsorted(key[order], want)
        hit = at < len(key)
        hit[hit] = key[order][at[hit]] == want[hit]
        content = []
        for j, region in enumerate(active):
            if region in self.anchors:
                content.append(self.anchors[region])
            elif hit[j]:
                content.append(cells.slice(int(order[at[j]]), 1))
            else:
                content.append(pa.nulls(1, CELL_ARROW))
        content = pa.concat_arrays(content)

        top, bottom = np.maximum(r0, low), np.minimum(r1, high)
        height = np.maximum(bottom - top + 1, 0)
        which = np.repeat(np.arange(len(active)), height)
        step = np.arange(len(which)) - np.repeat(np.cumsum(height) - height, height)
        fill_row = top[which] + step
        by_row = np.lexsort((self.regions[active, 4][which], fill_row))  # of several regions the file's first counts
        which, fill_row = which[by_row], fill_row[by_row]
        fill = pa.StructArray.from_arrays(
            [pa.array(c0[which], pa.int32()), pa.array(c1[which], pa.int32()), content.take(pa.array(which))],
            fields=list(FILL_ARROW),
        )
        still = r1 > high
        self.open = active[still]
        self.anchors = {int(active[j]): content.slice(int(j), 1) for j in np.flatnonzero(still)}

        all_rows = np.union1d(numbers, fill_row)
        width = np.zeros(len(all_rows), np.int64)
        width[np.searchsorted(all_rows, numbers)] = np.diff(offsets)
        fill_offsets = np.searchsorted(fill_row, np.append(all_rows, np.iinfo(np.int64).max))
        return (
            all_rows, np.concatenate([[0], np.cumsum(width)]), cells,
            pa.ListArray.from_arrays(pa.array(fill_offsets, pa.int32()), fill),
        )


def sheet_batches(z, part, strings, date_styles, formulas, row_limit):
    """(row numbers, gaps, cells, fills) batches of one sheet; the last stands for the sheet's end."""
    sheet = SheetXml(z, part)
    decoder, filler = SheetDecoder(strings, date_styles, formulas), MergeFiller(sheet.merges())
    previous = -1

    def batch(numbers, offsets, cells, fills):
        nonlocal previous
        gaps = np.maximum(np.diff(numbers, prepend=previous) - 1, 0)
        previous = int(numbers[-1])
        listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), cells)
        if fills is None:
            fills = pa.nulls(len(numbers), pa.list_(FILL_ARROW))
        return numbers, gaps, listed, fills

    for xml in sheet.pieces():
        numbers, offsets, cells = decoder.piece(xml)
        if not len(numbers):
            continue
        yield batch(*filler.rows(numbers, offsets, cells))
        if row_limit is not None and previous >= row_limit:
            break
    end = np.array([previous])
    yield end, np.zeros(1, np.int64), pa.nulls(1, pa.list_(CELL_ARROW)), pa.nulls(1, pa.list_(FILL_ARROW))


def inflate_stage(carry: list[str], arrow_schema: pa.Schema, formulas: bool, row_limit: int | None,
                  string_limit: int, ignore_corrupt: bool):
    """The ``mapInArrow`` function: rows of (file, content, sheets, …) → grid rows."""

    def workbook(source: pa.RecordBatch, i: int):
        row = {name: source.column(name)[i].as_py() for name in ("file", "content", "sheets", "strings_part",
                                                                "date_styles", "date1904")}
        if not row["sheets"]:
            return
        z = open_zip(row["content"], row["file"])
        strings = read_strings(z, row["strings_part"], string_limit)
        styles = set(row["date_styles"] or ())
        for sheet in row["sheets"]:
            for numbers, gaps, cells, fills in sheet_batches(
                z, sheet["part"], strings, styles, formulas, row_limit
            ):
                n = len(numbers)
                columns = {
                    "file": pa.repeat(row["file"], n),
                    "sheet_idx": pa.repeat(pa.scalar(sheet["idx"], pa.int32()), n),
                    "sheet_name": pa.repeat(sheet["name"], n),
                    "row": pa.array(numbers, pa.int64()),
                    "gap": pa.array(gaps, pa.int64()),
                    "date1904": pa.repeat(bool(row["date1904"]), n),
                    "cells": cells,
                    "fills": fills,
                }
                same = pa.array(np.zeros(n, np.int64))
                for name in carry:
                    columns[name] = source.column(name).slice(i, 1).take(same)
                yield pa.record_batch([columns[f.name].cast(f.type) for f in arrow_schema], schema=arrow_schema)

    def stage(batches):
        held, rows, size = [], 0, 0
        for source in batches:
            for i in range(source.num_rows):
                try:
                    for out in workbook(source, i):
                        held.append(out)
                        rows, size = rows + out.num_rows, size + out.nbytes
                        if rows >= BATCH_ROWS or size >= BATCH_BYTES:
                            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                            held, rows, size = [], 0, 0
                except DAMAGE as e:
                    if not ignore_corrupt:
                        raise RuntimeError(f"can't read workbook {source.column('file')[i].as_py()}: {e}") from e
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return stage
