"""Moving the relative references of a formula, as a shared formula needs it."""

from __future__ import annotations

import re

# A quoted text or sheet name, a cell reference, and the same as a whole row or column range.
FORMULA_TOKEN = re.compile(
    r"\"(?:[^\"]|\"\")*\"|'(?:[^']|'')*'"
    r"|(?<![A-Za-z0-9_.$])(\$?)([A-Z]{1,3})(\$?)([0-9]{1,7})(?![A-Za-z0-9_(.!])"
    r"|(?<![A-Za-z0-9_.$])(\$?)([A-Z]{1,3}):(\$?)([A-Z]{1,3})(?![A-Za-z0-9_(.!])"
    r"|(?<![A-Za-z0-9_.$])(\$?)([0-9]{1,7}):(\$?)([0-9]{1,7})(?![A-Za-z0-9_(.!])"
)


def letters_to_number(letters: str) -> int:
    n = 0
    for letter in letters:
        n = n * 26 + ord(letter) - 64
    return n


def number_to_letters(n: int) -> str:
    out = ""
    while n > 0:
        n, rest = divmod(n - 1, 26)
        out = chr(65 + rest) + out
    return out


def shift_formula(text: str, rows: int, cols: int) -> str:
    """``text`` with each relative reference moved by so many rows and columns."""
    if text is None or (rows == 0 and cols == 0):
        return text

    def col(fixed, letters):
        return fixed + (letters if fixed else number_to_letters((letters_to_number(letters) + cols - 1) % 16384 + 1))

    def row(fixed, digits):
        return fixed + (digits if fixed else str((int(digits) + rows - 1) % 1048576 + 1))

    def moved(m):
        if m[2]:
            return col(m[1], m[2]) + row(m[3], m[4])
        if m[6]:
            return col(m[5], m[6]) + ":" + col(m[7], m[8])
        if m[10]:
            return row(m[9], m[10]) + ":" + row(m[11], m[12])
        return m[0]

    return FORMULA_TOKEN.sub(moved, text)
