"""Report files: encodings, layouts, validation, comparison."""

import pytest

from tests.conftest import write_csv
from wardline.operators.quality import GateError
from wardline.plans.report_job import compared_features, dropped_by_file, load_report_rows, report_prompts
from wardline.sources.incident_files import read_any_encoding

COLUMNS = ("Month", "Crime type", "Falls within")
VALID = {"Month": "2026-02", "Crime type": "Violence and sexual offences", "Falls within": "West Yorkshire Police"}


def file(tmp_path, rows, columns=COLUMNS, name="a.csv", encoding="utf-8"):
    return write_csv(tmp_path / "in" / name, rows, columns, encoding)


def test_valid_file(spark, tmp_path):
    assert load_report_rows(spark, file(tmp_path, [VALID] * 5)).count() == 5


def test_missing_column(spark, tmp_path):
    with pytest.raises(GateError, match="missing required columns"):
        load_report_rows(spark, file(tmp_path, [{"Month": "2026-02", "Crime type": "Burglary"}], COLUMNS[:2]))


def test_rows_without_category_are_dropped(spark, tmp_path):
    path = file(tmp_path, [VALID] * 4 + [{**VALID, "Crime type": ""}])
    assert load_report_rows(spark, path).count() == 4
    row = dropped_by_file(spark, path).first()
    assert (row["row_count"], row["dropped"], row["dropped_pct"]) == (5, 1, 20.0)


def test_nothing_but_rows_without_category(spark, tmp_path):
    assert load_report_rows(spark, file(tmp_path, [{**VALID, "Crime type": ""}] * 3)).count() == 0


def test_missing_file(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_report_rows(spark, "/nonexistent/path/file.csv")


def test_month_in_words(spark, tmp_path):
    with pytest.raises(GateError, match="YYYY-MM"):
        load_report_rows(spark, file(tmp_path, [{**VALID, "Month": "February 2026"}]))


def test_one_empty_file_among_others(spark, tmp_path):
    file(tmp_path, [VALID])
    file(tmp_path, [], name="empty.csv")
    with pytest.raises(GateError, match="empty.csv"):
        load_report_rows(spark, str(tmp_path / "in"))


def test_warning_below_nine_in_ten(spark, tmp_path, caplog):
    load_report_rows(spark, file(tmp_path, [VALID] * 8 + [{**VALID, "Month": "Feb"}]))
    assert "8 of 9 months" in caplog.text


def test_encodings_and_layouts_in_one_read(spark, tmp_path):
    """UTF-8 with and without a mark, Latin-1, another column order and extra columns, all at once."""
    name = "Séction Police"
    file(tmp_path, [{**VALID, "Falls within": name}], name="1.csv")
    file(tmp_path, [{**VALID, "Falls within": name}], name="2.csv", encoding="utf-8-sig")
    file(tmp_path, [{**VALID, "Falls within": name}] * 2, name="3.csv", encoding="latin-1")
    file(tmp_path, [{**VALID, "Falls within": name, "Extra": "e"}], COLUMNS[::-1] + ("Extra",), "4.csv", "latin-1")
    rows = read_any_encoding(spark, str(tmp_path / "in"))
    assert {r["Falls within"] for r in rows.collect()} == {name}
    assert {r["Month"] for r in rows.collect()} == {"2026-02"}
    assert rows.count() == 5 and rows.where("Extra = 'e'").count() == 1
    assert load_report_rows(spark, str(tmp_path / "in")).count() == 5


def test_given_encoding_is_the_only_one(spark, tmp_path):
    path = file(tmp_path, [{**VALID, "Falls within": "Séction"}], encoding="latin-1")
    assert read_any_encoding(spark, path, "latin-1").first()["Falls within"] == "Séction"
    with pytest.raises(ValueError, match="could not decode"):
        read_any_encoding(spark, path, "utf-8")


def test_comparison_with_a_previous_file(spark, tmp_path):
    now = file(tmp_path, [VALID] * 10, name="now.csv")
    before = file(tmp_path, [{**VALID, "Month": "2026-01"}] * 8, name="before.csv")
    assert tuple(compared_features(spark, now, before).first()["mom_change"]) == (8, 2, 25.0, "increase")
    assert compared_features(spark, now).first()["mom_change"] is None


def test_invalid_previous_file_is_left_out(spark, tmp_path, caplog):
    now = file(tmp_path, [VALID] * 2, name="now.csv")
    wrong = file(tmp_path, [{**VALID, "Month": "?"}], name="wrong.csv")
    for previous in (wrong, "/nonexistent.csv"):
        assert compared_features(spark, now, previous).first()["mom_change"] is None
    assert caplog.text.count("previous period left out") == 2


def test_prompts_for_many_files(spark, tmp_path):
    file(tmp_path, [VALID] * 3, name="b.csv")
    file(tmp_path, [{**VALID, "Month": "2026-01"}] * 4, name="a.csv")
    file(tmp_path, [{**VALID, "Falls within": "Other"}], name="c.csv")
    rows = {(r["force"], r["period"]): r["user_text"] for r in report_prompts(spark, str(tmp_path / "in")).collect()}
    assert len(rows) == 3
    assert "decrease of 25.0% (-1 on 4)" in rows["West Yorkshire Police", "2026-02"]
