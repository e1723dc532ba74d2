"""Column names from header text."""

from gridloom.functions.text import text

# Characters that may not stand in a column name, and the edges a trim removes.
INVALID_NAME_CHARS = "[+\\\\._, \n]+"
EDGE_CHARS = r"^[\x00-\x20]+|[\x00-\x20]+$"


def clean_name(header: str, position: str) -> str:
    """Header text → column name; text without any name in it gives ``col_<position>``.

    A run of invalid characters becomes one underscore and a single trailing underscore goes; a leading one
    stays.
    """
    trimmed = f"regexp_replace(coalesce({header}, ''), {text(EDGE_CHARS)}, '')"
    cleaned = f"regexp_replace(regexp_replace({trimmed}, {text(INVALID_NAME_CHARS)}, '_'), '_$', '')"
    return f"coalesce(nullif({cleaned}, ''), concat('col_', cast({position} AS string)))"
