"""A1-style addresses, as expressions and for the one address given as an option."""

from __future__ import annotations

import re

from gridloom.errors import WorkbookOptionError

_ADDRESS = re.compile(r"\$?([A-Za-z]{1,3})\$?([0-9]+)")


def parse_a1(address: str) -> tuple[int, int]:
    """``"C5"`` → ``(4, 2)``: zero-based row and column of an address given on the driver."""
    m = _ADDRESS.fullmatch(address.strip())
    if not m or int(m[2]) < 1:
        raise WorkbookOptionError(f"'{address}' is not a cell address")
    col = 0
    for letter in m[1].upper():
        col = col * 26 + ord(letter) - 64
    return int(m[2]) - 1, col - 1


def a1_to_rc(address: str) -> str:
    """``struct<row:int,col:int>``, zero-based; null fields where the text is no address."""
    letters = f"upper(regexp_extract({address}, '^[$]?([A-Za-z]{{1,3}})[$]?[0-9]+$', 1))"
    digits = f"regexp_extract({address}, '^[$]?[A-Za-z]{{1,3}}[$]?([0-9]+)$', 1)"
    col = f"aggregate(split({letters}, ''), 0, (n, x) -> CASE WHEN x = '' THEN n ELSE n * 26 + ascii(x) - 64 END) - 1"
    return (
        f"named_struct('row', try_cast({digits} AS int) - 1, "
        f"'col', CASE WHEN {letters} <> '' THEN {col} END)"
    )


def column_letters(col: str) -> str:
    """Zero-based column number → letters (0 → A, 26 → AA), up to three letters."""

    def letter(n: str) -> str:
        return f"char(65 + pmod({n}, 26))"

    two, three = f"({col} - 26)", f"({col} - 702)"
    return (
        f"CASE WHEN {col} < 26 THEN {letter(col)} "
        f"WHEN {col} < 702 THEN concat({letter(f'{two} div 26')}, {letter(two)}) "
        f"ELSE concat({letter(f'{three} div 676')}, {letter(f'{three} div 26')}, {letter(three)}) END"
    )


def a1_column(row: str, col: str) -> str:
    """Zero-based row and column → address, the inverse of :func:`a1_to_rc`."""
    return f"concat({column_letters(col)}, cast({row} + 1 AS string))"
