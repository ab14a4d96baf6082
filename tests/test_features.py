"""Report features against plain counting."""

import pytest

from wardline.operators.features import extract_features, feature_rows, left_out, modes, ranked_shares, type_counts

SCHEMA = "crime_type string, falls_within string, month string, last_outcome string"


def frame(spark, types, force="West Yorkshire Police", month="2026-02"):
    return spark.createDataFrame([(t, force, month, None) for t in types], SCHEMA)


def test_basic_fields_and_order(spark):
    row = extract_features(frame(spark, ["Violence"] * 6 + ["Burglary"] * 4)).first()
    assert (row["force"], row["period"], row["total_crimes"]) == ("West Yorkshire Police", "2026-02", 10)
    assert row["top_categories"] == ["Violence", "Burglary"]
    assert [tuple(e) for e in row["distribution"]] == [("Violence", 60.0), ("Burglary", 40.0)]
    assert row["mom_change"] is None


def test_top_three_of_many(spark):
    types = [name for name, n in zip("FEDCBA", (1, 1, 2, 3, 3, 5)) for _ in range(n)]
    assert extract_features(frame(spark, types)).first()["top_categories"] == ["A", "B", "C"]


@pytest.mark.parametrize(
    ("types", "expected"),
    [
        ("ABC", [33.4, 33.3, 33.3]),
        ("A" * 33 + "B" * 33 + "C" * 34, [34.0, 33.0, 33.0]),
        ("A" + "BB" + "CCC", [50.0, 33.3, 16.7]),
        ("ABCDEFG", [14.2] + [14.3] * 6),
    ],
)
def test_shares_sum_to_100(spark, types, expected):
    shares = [e["pct"] for e in extract_features(frame(spark, types)).first()["distribution"]]
    assert shares == expected
    assert round(sum(shares), 1) == 100.0


@pytest.mark.parametrize(
    ("before", "expected"),
    [
        (8, (8, 2, 25.0, "increase")),
        (12, (12, -2, 16.7, "decrease")),
        (10, (10, 0, 0.0, "no change")),
        (0, (0, None, None, "unknown")),
    ],
)
def test_change(spark, before, expected):
    now = frame(spark, ["X"] * 10)
    previous = now.limit(0) if before == 0 else frame(spark, ["X"] * before, month="2026-01")
    assert tuple(extract_features(now, previous).first()["mom_change"]) == expected


def test_rows_without_category_count_in_the_total(spark):
    row = extract_features(frame(spark, ["A", "A", "B", None])).first()
    assert row["total_crimes"] == 4
    assert [tuple(e) for e in row["distribution"]] == [("A", 75.0), ("B", 25.0)]


def test_empty_frame_is_an_error(spark):
    with pytest.raises(Exception, match="cannot extract features"):
        extract_features(frame(spark, ["A"]).limit(0)).collect()


def test_force_and_period_of_a_mixed_frame(spark):
    mixed = frame(spark, "AA", "South", "2026-02").union(frame(spark, "AA", "North", "2026-01")).union(frame(spark, "A", None, None))
    row = extract_features(mixed).first()
    assert (row["force"], row["period"], row["total_crimes"]) == ("North", "2026-01", 5)


def test_bulk_rows_compare_with_the_period_before(spark):
    rows = frame(spark, "AAB", "N", "2025-11").union(frame(spark, "AABB", "N", "2026-01")).union(frame(spark, "C", "S", "2026-01")).union(frame(spark, "D", None, "2026-01"))
    found = {(r["force"], r["period"]): r for r in feature_rows(rows).collect()}
    assert set(found) == {("N", "2025-11"), ("N", "2026-01"), ("S", "2026-01")}
    assert all(row["mom_change"] is None for row in found.values())  # nothing from the month just before


def test_change_is_against_the_calendar_month_before(spark):
    months = {"2025-12": "AAB", "2026-01": "AABB", "2026-03": "A", None: "BBB", "2026-1": "C", "2026-13": "C"}
    rows = None
    for month, types in months.items():
        part = frame(spark, types, "N", month)
        rows = part if rows is None else rows.union(part)
    rows = rows.union(frame(spark, "AA", None, "2026-01"))
    found = {r["period"]: r["mom_change"] for r in feature_rows(rows).collect()}
    assert set(found) == {"2025-12", "2026-01", "2026-03"}
    assert tuple(found["2026-01"]) == (3, 1, 33.3, "increase")
    assert found["2025-12"] is None and found["2026-03"] is None
    assert tuple(left_out(rows).first()) == (2, 5)


def test_modes_break_ties_by_value(spark):
    rows = spark.createDataFrame([("N", "b"), ("N", "a"), ("N", None), ("N", None), ("S", "z")], "force string, outcome string")
    found = {r["force"]: (r["outcome"], r["occurrences"]) for r in modes(rows, "outcome", ["force"]).collect()}
    assert found == {"N": ("a", 1), "S": ("z", 1)}


def test_ranked_shares_are_grouped(spark):
    rows = frame(spark, "AAB", "N").union(frame(spark, "BBA", "S"))
    found = {(r["falls_within"], r["crime_type"]): (r["rank"], r["pct"]) for r in ranked_shares(type_counts(rows)).collect()}
    assert found == {("N", "A"): (1, 66.7), ("N", "B"): (2, 33.3), ("S", "B"): (1, 66.7), ("S", "A"): (2, 33.3)}
