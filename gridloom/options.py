"""Reader options: defaults, parsing, and the check for misspelt keys."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from typing import Any

from gridloom.errors import WorkbookOptionError

# Option names a user may give (matched ignoring case).
OPTION_NAMES = (
    "workbookPassword",
    "sheetNamePattern",
    "cellAddress",
    "headerRowCount",
    "maxRowCount",
    "includeSheetName",
    "nullValue",
    "thresholdBytesForTempFiles",
    "maxBytesForTempFiles",
    "schemaMatchColumnName",
    "evaluateFormulae",
    "ignoreCorruptFiles",
    "ignoreMissingFiles",
)

# Options of Spark's own file sources, handed through to the file scan.
FILE_OPTION_NAMES = (
    "pathGlobFilter",
    "recursiveFileLookup",
    "modifiedBefore",
    "modifiedAfter",
    "basePath",
)

# A key this close to a valid name counts as a misspelling of it.
MISSPELT_DISTANCE = 0.30


def _edit_distance(a: str, b: str) -> int:
    previous = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        current = [i]
        for j, cb in enumerate(b, 1):
            current.append(min(previous[j] + 1, current[-1] + 1, previous[j - 1] + (ca != cb)))
        previous = current
    return previous[-1]


def closest_option(key: str) -> tuple[str, float]:
    """The valid option name nearest to ``key`` and its distance (0 = same, 1 = all different)."""
    low = key.lower()
    scored = [
        (_edit_distance(low, name.lower()) / max(len(low), len(name)), name)
        for name in OPTION_NAMES
    ]
    distance, name = min(scored)
    return name, distance


def misspelt_options(keys) -> list[str]:
    """One message per key that looks like a misspelt option; unrelated keys pass."""
    valid = {name.lower() for name in OPTION_NAMES + FILE_OPTION_NAMES}
    messages = []
    for key in keys:
        if key.lower() in valid:
            continue
        name, distance = closest_option(key)
        if distance <= MISSPELT_DISTANCE:
            messages.append(f"Invalid option '{key.lower()}', did you mean '{name}'?")
    return messages


def _flag(name: str, value: Any) -> bool:
    text = str(value).strip().lower()
    if text not in ("true", "false"):
        raise WorkbookOptionError(f"Option '{name}' must be true or false, not '{value}'")
    return text == "true"


def _whole(name: str, value: Any) -> int:
    try:
        number = int(str(value).strip())
    except ValueError:
        raise WorkbookOptionError(f"Option '{name}' must be a whole number, not '{value}'") from None
    if number < 0:
        raise WorkbookOptionError(f"Option '{name}' must not be negative")
    return number


@dataclass(frozen=True)
class WorkbookOptions:
    """Parsed options. Build with :meth:`parse`, which ignores the case of keys."""

    cell_address: str = "A1"
    header_row_count: int = 1
    max_row_count: int = 1000
    include_sheet_name: bool = False
    sheet_name_pattern: str = ""
    null_value: str | None = None
    schema_match_column_name: str | None = None
    evaluate_formulae: bool = True
    workbook_password: str | None = None
    threshold_bytes: int = 100_000_000
    ignore_corrupt_files: bool | None = None
    ignore_missing_files: bool | None = None
    file_options: dict[str, str] = field(default_factory=dict)

    @classmethod
    def parse(cls, options: dict[str, Any] | None = None) -> "WorkbookOptions":
        options = {k: v for k, v in (options or {}).items() if v is not None}
        errors = misspelt_options(options)
        if errors:
            raise WorkbookOptionError("Unable to parse options:\n" + "\n".join(errors))
        given = {k.lower(): v for k, v in options.items()}

        def get(name, default=None):
            return given.get(name.lower(), default)

        parsed: dict[str, Any] = {
            "cell_address": str(get("cellAddress", "A1")),
            "sheet_name_pattern": str(get("sheetNamePattern", "")),
            "null_value": get("nullValue"),
            "schema_match_column_name": get("schemaMatchColumnName"),
            "workbook_password": get("workbookPassword"),
        }
        for attr, name, default in (
            ("header_row_count", "headerRowCount", 1),
            ("max_row_count", "maxRowCount", 1000),
        ):
            parsed[attr] = _whole(name, get(name, default))
        parsed["threshold_bytes"] = _whole(
            "thresholdBytesForTempFiles",
            get("thresholdBytesForTempFiles", get("maxBytesForTempFiles", 100_000_000)),
        )
        for attr, name, default in (
            ("include_sheet_name", "includeSheetName", False),
            ("evaluate_formulae", "evaluateFormulae", True),
        ):
            parsed[attr] = _flag(name, get(name, default))
        for attr, name in (
            ("ignore_corrupt_files", "ignoreCorruptFiles"),
            ("ignore_missing_files", "ignoreMissingFiles"),
        ):
            if get(name) is not None:
                parsed[attr] = _flag(name, get(name))
        if parsed["null_value"] is not None:
            parsed["null_value"] = str(parsed["null_value"])
        flag = parsed["schema_match_column_name"]
        if flag is not None and not str(flag).strip():
            raise WorkbookOptionError(
                "The 'schemaMatchColumnName' option must contain a value if provided"
            )
        parsed["file_options"] = {
            name: str(get(name)) for name in FILE_OPTION_NAMES if get(name) is not None
        }
        return cls(**parsed)

    def as_dict(self) -> dict[str, Any]:
        return {f.name: getattr(self, f.name) for f in fields(self)}
