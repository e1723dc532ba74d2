import pytest

from gridloom import WorkbookOptionError, WorkbookOptions

MISSPELT = {
    "workbookPasword": ("abc123", "workbookPassword"), "sheetNamPatten": ("Sheet[12]", "sheetNamePattern"),
    "cellAdres": ("B3", "cellAddress"), "headerCount": ("12", "headerRowCount"), "maxRowCont": ("2000", "maxRowCount"),
    "includShetNam": ("true", "includeSheetName"), "nulvalue": ("NA", "nullValue"),
    "macsBitesTempFiles": ("10", "maxBytesForTempFiles"), "schemaMatchColumName": ("_isValid", "schemaMatchColumnName"),
    "evalateFormula": ("false", "evaluateFormulae"),
}


def test_defaults():
    o = WorkbookOptions.parse({})
    assert (o.cell_address, o.header_row_count, o.max_row_count, o.include_sheet_name) == ("A1", 1, 1000, False)
    assert (o.sheet_name_pattern, o.null_value, o.schema_match_column_name) == ("", None, None)
    assert (o.evaluate_formulae, o.workbook_password, o.threshold_bytes) == (True, None, 100_000_000)


@pytest.mark.parametrize("change_case", [str, str.lower, str.upper])
def test_given(change_case):
    given = {
        "workbookPassword": "abc123", "sheetNamePattern": r"\d{2,3}", "cellAddress": "H8", "headerRowCount": "17",
        "maxRowCount": 5, "includeSheetName": "true", "nullValue": "N/A", "maxBytesForTempFiles": "12",
        "schemaMatchColumnName": "matchesSchema", "evaluateFormulae": False,
    }
    o = WorkbookOptions.parse({change_case(k): v for k, v in given.items()})
    assert (o.workbook_password, o.sheet_name_pattern, o.cell_address) == ("abc123", r"\d{2,3}", "H8")
    assert (o.header_row_count, o.max_row_count, o.include_sheet_name) == (17, 5, True)
    assert (o.null_value, o.threshold_bytes, o.schema_match_column_name) == ("N/A", 12, "matchesSchema")
    assert o.evaluate_formulae is False


def test_threshold_wins_over_alias():
    both = {"maxBytesForTempFiles": "120", "thresholdBytesForTempFiles": "100"}
    assert WorkbookOptions.parse(both).threshold_bytes == 100


def test_misspelt_options_are_all_reported():
    with pytest.raises(WorkbookOptionError) as e:
        WorkbookOptions.parse({k: v for k, (v, _) in MISSPELT.items()})
    for key, (_, meant) in MISSPELT.items():
        assert f"Invalid option '{key.lower()}', did you mean '{meant}'?" in str(e.value)


def test_unrelated_options_pass():
    assert WorkbookOptions.parse({"pwd": "abc123", "header": "true"}).workbook_password is None


def test_bad_values():
    with pytest.raises(WorkbookOptionError, match="must contain a value if provided"):
        WorkbookOptions.parse({"schemaMatchColumnName": "  "})
    with pytest.raises(WorkbookOptionError, match="whole number"):
        WorkbookOptions.parse({"headerRowCount": "x"})
    with pytest.raises(WorkbookOptionError, match="true or false"):
        WorkbookOptions.parse({"evaluateFormulae": "perhaps"})
