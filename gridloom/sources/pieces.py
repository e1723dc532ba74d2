"""Large workbooks: one pass over a file cuts its sheets into pieces of rows, which any number of tasks then decode.

A piece brings along all that its rows need: the texts they refer to, the regions merged over them with the content of
those that began above, the row number before it, and the formulas that cells above share with it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from gridloom.functions.references import number_to_letters
from gridloom.sources.container import open_zip
from gridloom.sources.inflate import CELL_ARROW, DAMAGE, FILL_ARROW, MergeFiller, SheetDecoder, SheetXml, read_strings

REGION_ARROW = pa.struct([
    ("r0", pa.int64()), ("c0", pa.int64()), ("r1", pa.int64()), ("c1", pa.int64()), ("place", pa.int64()), ("above", pa.bool_()), ("cell", CELL_ARROW),
])
MASTER_ARROW = pa.struct([("id", pa.string()), ("text", pa.string()), ("row", pa.int64()), ("col", pa.int64())])

#: What a piece is made of; ``xml`` is null on the one that stands for a sheet's end, whose ``before`` is its last row.
PIECE_ARROW = (
    ("file", pa.string()), ("sheet_idx", pa.int32()), ("sheet_name", pa.string()), ("date1904", pa.bool_()), ("date_styles", pa.list_(pa.int32())),
    ("piece", pa.int64()), ("before", pa.int64()), ("xml", pa.binary()), ("ids", pa.list_(pa.int64())), ("texts", pa.list_(pa.string())),
    ("regions", pa.list_(REGION_ARROW)), ("masters", pa.list_(MASTER_ARROW)),
)

# How a cell with a shared text, any value, a cell without address and a shared formula's text are written.
_SHARED_TEXT = re.compile(rb' t="s"(?: [^<>]*)?><v>([0-9]{1,17})</v>')
_ANY_NUMBER = re.compile(rb"<v(?:\s[^>]*)?>\s*([0-9]{1,17})\s*</v>")
_NO_ADDRESS = re.compile(rb"<c(?:\s(?![^>]*?\br=)[^>]*)?/?>")
_MASTER = re.compile(rb"""<f\s[^>]*?t=["']shared["'][^>]*?[^/]>[^<]""")


def text_ids(xml: bytes) -> np.ndarray:
    """Numbers of the shared texts that a piece's cells refer to; if in doubt, all numbers that cells hold."""
    found = _SHARED_TEXT.findall(xml)
    if len(found) != xml.count(b't="s"') + xml.count(b"t='s'"):
        found = _ANY_NUMBER.findall(xml)
    ids = np.sort(np.array(found, dtype="S17").astype(np.int64)) if found else np.zeros(0, np.int64)
    return ids[np.append(True, ids[1:] != ids[:-1])] if len(ids) else ids


def cell_of(xml: bytes, row: int, col: int, before: int, decoder: SheetDecoder):
    """The cell at a place of a piece, as a Python value; null where there is none."""
    name = f"{number_to_letters(col + 1)}{row + 1}".encode()
    found = re.search(rb"""(?is)<c\s(?:[^>]*?\s)?r=["']""" + name + rb"""["'][^>]*?(?:/>|>.*?</c>)""", xml)
    if found:
        xml = b'<row r="%d">' % (row + 1) + found[0] + b"</row>"
    elif not _NO_ADDRESS.search(xml):
        return None
    decoder.last_row = before
    numbers, offsets, cells = decoder.piece(xml)
    line = np.repeat(numbers, np.diff(offsets))
    at = np.flatnonzero((line == row) & (np.asarray(cells.field("col")) == col))
    return cells[int(at[-1])].as_py() if len(at) else None


def sheet_pieces(z, part: str, strings, styles: set[int], formulas: bool, piece_bytes: int):
    """(piece, before, xml, ids, texts, regions, masters) of one sheet, its end last."""
    sheet = SheetXml(z, part, piece_bytes)
    regions, contents = sheet.merges(), {}
    walker, reader = SheetDecoder(strings, styles, False), SheetDecoder(strings, styles, formulas)
    count = 0
    for xml in sheet.pieces():
        before = walker.last_row
        numbers = walker.skip(xml)
        if not len(numbers):
            continue
        high = walker.last_row
        ids = text_ids(xml)
        ids = ids[ids < strings.size]
        over = np.flatnonzero((regions[:, 0] <= high) & (regions[:, 2] > before)).tolist()
        listed = [dict(zip(("r0", "c0", "r1", "c1", "place"), regions[k].tolist())) | {"above": k in contents, "cell": contents.get(k)} for k in over]
        masters = [dict(zip(("id", "text", "row", "col"), (i, *m))) for i, m in reader.masters.items()] if formulas and b"shared" in xml else []
        yield count, before, xml, ids.tolist(), strings.take(ids).to_pylist() if len(ids) else [], listed, masters
        count += 1
        for k in over:  # what goes on below needs the content of its first cell
            if regions[k, 2] <= high:
                contents.pop(k, None)
            elif k not in contents:
                contents[k] = cell_of(xml, int(regions[k, 0]), int(regions[k, 1]), before, SheetDecoder(strings, styles, False))
        if formulas and _MASTER.search(xml):
            reader.last_row = before
            reader.piece(xml)
    yield count, walker.last_row, None, [], [], [], []


def cut_stage(carry: list[str], schema: pa.Schema, formulas: bool, string_limit: int, ignore_corrupt: bool, piece_bytes: int):
    """The ``mapInArrow`` function: rows of (file, content, sheets, …) → pieces, a batch each."""
    names = [n for n, _ in PIECE_ARROW]

    def run(batches):
        for source in batches:
            for i in range(source.num_rows):
                row = {n: source.column(n)[i].as_py() for n in ("file", "content", "sheets", "strings_part", "date_styles", "date1904")}
                try:
                    if not row["sheets"]:
                        continue
                    z = open_zip(row["content"], row["file"])
                    strings, styles = read_strings(z, row["strings_part"], string_limit), row["date_styles"] or []
                    for sheet in row["sheets"]:
                        for piece in sheet_pieces(z, sheet["part"], strings, set(styles), formulas, piece_bytes):
                            made = (row["file"], sheet["idx"], sheet["name"], bool(row["date1904"]), styles, *piece)
                            columns = {n: pa.array([v], t) for (n, t), v in zip(PIECE_ARROW, made)}
                            columns |= {n: source.column(n).slice(i, 1) for n in carry}
                            yield pa.record_batch([columns[f.name].cast(f.type) for f in schema], schema=schema)
                except DAMAGE as e:
                    if not ignore_corrupt:
                        raise RuntimeError(f"can't read workbook {row['file']}: {e}") from e

    assert [f.name for f in schema][:len(names)] == names
    return run


class PieceStrings:
    """The texts of one piece, by their numbers in the workbook."""

    def __init__(self, ids: np.ndarray, texts: pa.Array):
        self.ids, self.texts = ids, texts

    def take(self, wanted: np.ndarray) -> pa.Array:
        if not len(self.ids):
            return pa.nulls(len(wanted), pa.string())
        at = np.minimum(np.searchsorted(self.ids, wanted), len(self.ids) - 1)
        return self.texts.take(pa.array(at, mask=self.ids[at] != wanted))


def piece_rows(row: dict, formulas: bool):
    """(row numbers, gaps, cells, fills) of a piece; None if it holds no row."""
    if row["xml"] is None:
        return np.array([row["before"]]), np.zeros(1, np.int64), pa.nulls(1, pa.list_(CELL_ARROW)), pa.nulls(1, pa.list_(FILL_ARROW))
    strings = PieceStrings(np.array(row["ids"], np.int64), pa.array(row["texts"], pa.string()))
    decoder = SheetDecoder(strings, set(row["date_styles"] or ()), formulas)
    decoder.last_row = row["before"]
    decoder.masters = {m["id"]: (m["text"], m["row"], m["col"]) for m in row["masters"]}
    regions = row["regions"]  # in order of their first row, as they were cut
    filler = MergeFiller(np.array([[r[k] for k in ("r0", "c0", "r1", "c1", "place")] for r in regions], np.int64).reshape(-1, 5))
    above = [k for k, r in enumerate(regions) if r["above"]]
    filler.done_row, filler.next, filler.open = row["before"], len(above), np.array(above, np.int64)
    filler.anchors = {k: pa.array([regions[k]["cell"]], CELL_ARROW) for k in above}
    numbers, offsets, cells = decoder.piece(row["xml"])
    if not len(numbers):
        return None
    numbers, offsets, cells, fills = filler.rows(numbers, offsets, cells)
    gaps = np.maximum(np.diff(numbers, prepend=row["before"]) - 1, 0)
    listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), cells)
    return numbers, gaps, listed, fills if fills is not None else pa.nulls(len(numbers), pa.list_(FILL_ARROW))


def piece_stage(carry: list[str], schema: pa.Schema, formulas: bool, ignore_corrupt: bool):
    """The ``mapInArrow`` function: pieces → grid rows."""

    def run(batches):
        for source in batches:
            for i in range(source.num_rows):
                row = {n: source.column(n)[i].as_py() for n, _ in PIECE_ARROW}
                try:
                    made = piece_rows(row, formulas)
                except DAMAGE as e:
                    if not ignore_corrupt:
                        raise RuntimeError(f"can't read workbook {row['file']}: {e}") from e
                    continue
                if made is None:
                    continue
                numbers, gaps, cells, fills = made
                n = len(numbers)
                columns = {
                    "file": pa.repeat(row["file"], n), "sheet_idx": pa.repeat(pa.scalar(row["sheet_idx"], pa.int32()), n),
                    "sheet_name": pa.repeat(row["sheet_name"], n), "row": pa.array(numbers, pa.int64()), "gap": pa.array(gaps, pa.int64()),
                    "date1904": pa.repeat(row["date1904"], n), "cells": cells, "fills": fills,
                }
                columns |= {c: source.column(c).slice(i, 1).take(pa.array(np.zeros(n, np.int64))) for c in carry}
                yield pa.record_batch([columns[f.name].cast(f.type) for f in schema], schema=schema)

    return run
