import pytest

from crateflow.contracts import BY_CODE, INGEST_LOG, PERSONAL, SILVER_LOG, SOURCES


def test_ten_sources_four_csv_six_workbooks():
    assert sorted(BY_CODE) == [f"SRC{i:02d}" for i in range(1, 11)]
    assert sorted(s.file[:5] for s in SOURCES if s.format == "csv") == [
        "SRC01", "SRC03", "SRC06", "SRC09",
    ]
    assert sum(s.format == "xlsx" for s in SOURCES) == 6


@pytest.mark.parametrize("source", SOURCES, ids=lambda s: s.name)
def test_parts_are_required_columns_and_exclusive(source):
    parts = [*source.keys, *source.dates, *source.numbers, *source.texts]
    assert set(parts) <= set(source.columns)
    assert len(parts) == len(set(parts))
    assert len(source.columns) == len(set(source.columns))
    assert source.keys
    assert source.date_format == "yyyy-MM-dd"


def test_column_counts():
    counts = {code: len(source.columns) for code, source in BY_CODE.items()}
    assert counts == {
        "SRC01": 21, "SRC02": 13, "SRC03": 12, "SRC04": 10, "SRC05": 21,
        "SRC06": 14, "SRC07": 15, "SRC08": 8, "SRC09": 14, "SRC10": 14,
    }


def test_columns_without_a_part_stay_strings():
    target = BY_CODE["SRC02"]
    assert not {"year", "month"} & {*target.keys, *target.dates, *target.numbers, *target.texts}
    assert BY_CODE["SRC03"].fills == (("tax_code", "UNKNOWN"),)


def test_personal_columns_belong_to_their_source():
    for dimension, code in (
        ("dim_customers", "SRC03"), ("dim_distributors", "SRC06"), ("dim_employees", "SRC07"),
    ):
        assert set(PERSONAL[dimension]) <= set(BY_CODE[code].columns)
    assert "email" not in PERSONAL["dim_distributors"]


def test_log_schemas():
    assert INGEST_LOG.fieldNames() == [
        "batch_id", "source_name", "source_file", "source_platform", "rows_loaded", "status",
        "duration_sec",
    ]
    assert len(SILVER_LOG.fieldNames()) == 8
    assert "batch_id" not in SILVER_LOG.fieldNames()
