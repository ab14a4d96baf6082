"""Quality gates."""

import pytest

from wardline.operators import quality
from wardline.operators.quality import GateError, Rule


def test_all_column_tests_are_there():
    assert len(quality.NOT_NULL_RULES) == 17 and len(quality.ACCEPTED_RULES) == 3
    assert {r.model for r in quality.RULES} == {"staging", "by_category", "by_month", "by_force", "hotspots"}


def test_rule_failures_in_one_pass_per_model(spark):
    frame = spark.createDataFrame([("a", 1), ("x", None), (None, None)], "name string, n int")
    rules = [Rule("m", "name"), Rule("m", "n"), Rule("m", "name", ("a", "b"))]
    found = {(r["column"], r["rule"]): r["failures"] for r in quality.rule_failures({"m": frame}, rules).collect()}
    # A null passes the test of values.
    assert found == {("name", "not_null"): 1, ("n", "not_null"): 2, ("name", "accepted_values"): 1}
    with pytest.raises(GateError, match="m.n not_null: 2"):
        quality.require_rules({"m": frame}, rules)
    quality.require_rules({"m": frame.limit(0)}, rules)


def test_row_count_gates(spark):
    rows = spark.createDataFrame([("a",)] * 3 + [("b",)], "file string")
    found = {r["file"]: (r["row_count"], r["passed"]) for r in quality.row_counts(rows, ["file"], 2).collect()}
    assert found == {"a": (3, True), "b": (1, False)}
    assert quality.require_min_rows(rows, "m", 4).first()["row_count"] == 4
    with pytest.raises(Exception, match="m has 4 rows, needs 5"):
        quality.require_min_rows(rows, "m", 5).collect()


def test_missing_pairs(spark):
    wanted = spark.createDataFrame([("a", "2026-01"), ("a", "2026-02")], "force string, month string")
    loaded = wanted.where("month = '2026-01'")
    assert [tuple(r) for r in quality.missing_pairs(wanted, loaded).collect()] == [("a", "2026-02")]


def test_required_columns_are_case_sensitive(spark):
    frame = spark.createDataFrame([("x", "y", "z")], "Month string, `Crime type` string, `falls within` string")
    with pytest.raises(GateError, match=r"missing required columns: \['Falls within'\]"):
        quality.require_columns(frame)


@pytest.mark.parametrize(
    ("months", "status"),
    [
        (["2026-02"] * 9 + ["Feb"], "ok"),
        (["2026-02"] * 8 + ["Feb"], "warn"),
        (["February 2026"], "error"),
        ([None], "error"),
        ([None] * 5 + ["2026-02"], "ok"),
        (["2026-2", "2026-02-01"], "error"),
    ],
)
def test_month_format(spark, months, status):
    frame = spark.createDataFrame([(m,) for m in months], "month string")
    assert quality.month_format(frame).first()["status"] == status


def test_month_format_of_nothing(spark):
    assert quality.month_format(spark.createDataFrame([], "month string")).first()["status"] == "error"


def test_dropped_rows(spark):
    frame = spark.createDataFrame([("a",), (None,), ("b",)], "crime_type string")
    assert tuple(quality.dropped_rows(frame).first()) == (3, 1, 33.3)
