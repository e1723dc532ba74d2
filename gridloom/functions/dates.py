"""Serial day numbers and the number formats that mark a number as a date."""

from __future__ import annotations

from gridloom.functions.text import text

MS_PER_DAY = 86_400_000

# Days from 1970-01-01 to day 0 of each date system. Before serial 61 the 1900
# system is one day off, because it counts a 29 February 1900 that never was.
EPOCH_1900 = -25_569
EPOCH_1900_EARLY = -25_568
EPOCH_1904 = -24_107
FIRST_SERIAL_AFTER_PHANTOM_DAY = 61

# Number format ids that are dates or times without any format text.
BUILTIN_DATE_FORMATS = (14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47)

_ELAPSED = r"(?i)^\[(h+|m+|s+)\]"
_LITERALS = r'"[^"]*"|\\.|_.|\*.|;@$'
_BRACKETS = r"\[[^\]]*\]"
_DATE_CHARS = r"(?i)^[ymdhsaptT/年月日時分秒\-,. :'0]*$"
_DATE_LETTERS = r"(?i)[ymdhs]"


def is_date_format(format_id: str, code: str) -> str:
    """Whether a number format (built-in id, or id with custom code) shows a date or time."""
    bare = f"regexp_replace(regexp_replace({code}, {text(_LITERALS)}, ''), {text(_BRACKETS)}, '')"
    first = f"get(split({bare}, ';'), 0)"
    ids = ", ".join(map(str, BUILTIN_DATE_FORMATS))
    return (
        f"(coalesce({format_id} IN ({ids}), false) OR coalesce(rlike({code}, {text(_ELAPSED)}), false) "
        f"OR coalesce(rlike({first}, {text(_DATE_LETTERS)}) AND rlike({first}, {text(_DATE_CHARS)}), false))"
    )


def serial_to_millis(serial: str, date1904: str | None = None) -> str:
    """Milliseconds from 1970-01-01 of the wall clock the serial number stands for; null if negative."""
    shift = (
        f"CASE {f'WHEN {date1904} THEN {EPOCH_1904 * MS_PER_DAY}L ' if date1904 else ''}"
        f"WHEN {serial} < {FIRST_SERIAL_AFTER_PHANTOM_DAY} THEN {EPOCH_1900_EARLY * MS_PER_DAY}L "
        f"ELSE {EPOCH_1900 * MS_PER_DAY}L END"
    )
    return f"CASE WHEN {serial} >= 0 THEN floor({serial} * {MS_PER_DAY}D + 0.5D) + {shift} END"


def serial_to_timestamp(serial: str, date1904: str | None = None) -> str:
    """The instant at which clocks in the session time zone show the serial's date and time."""
    return f"to_utc_timestamp(timestamp_millis({serial_to_millis(serial, date1904)}), current_timezone())"


def serial_to_date(serial: str, date1904: str | None = None) -> str:
    return f"date_from_unix_date(cast(floor(({serial_to_millis(serial, date1904)}) / {MS_PER_DAY}D) AS int))"


def serial_to_iso(serial: str, date1904: str | None = None) -> str:
    """ISO local date-time; fractional seconds only where there are any."""
    return f"replace(cast({serial_to_timestamp(serial, date1904)} AS string), ' ', 'T')"


def timestamp_to_serial(ts: str) -> str:
    """Inverse of :func:`serial_to_timestamp` in the 1900 system, for dates from 1 March 1900, to the millisecond."""
    return f"(unix_millis(from_utc_timestamp(cast({ts} AS timestamp), current_timezone())) / {MS_PER_DAY}D - {EPOCH_1900}D)"
