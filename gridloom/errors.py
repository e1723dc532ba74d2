"""Errors raised to the user of the package."""


class WorkbookError(Exception):
    """The workbook, sheet or table asked for can't be read as asked."""


# Fixed value: what the user sees when no sheet name matches.
NO_SHEET = "No worksheets found matching user defined pattern"


class WorkbookOptionError(ValueError):
    """An option is misspelt, malformed or not supported."""
