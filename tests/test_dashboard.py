"""Dashboard datasets: filters, empty selections, ties."""

import pytest

from wardline.operators import marts
from wardline.operators.cube import incident_cube
from wardline.operators.staging import clean
from wardline.plans import dashboard
from wardline.plans.dashboard import Selection
from wardline.plans.sample import raw_incidents

SF = "/root/testdata/sf0.001"
NOTHING = Selection(forces=[])


@pytest.fixture(scope="module")
def tables(spark):
    cleaned = clean(raw_incidents(spark, SF))
    cube = incident_cube(cleaned)
    built = {
        "cube": cube,
        "category": marts.by_category(cube),
        "month": marts.by_month(cube),
        "force": marts.by_force(cube),
        "hotspots": marts.hotspots(cleaned),
    }
    return {name: spark.createDataFrame(frame.collect(), frame.schema) for name, frame in built.items()}


def test_empty_selection(tables):
    row = dashboard.kpis(tables["category"], tables["force"], tables["hotspots"], NOTHING).first()
    assert (row["total_crimes"], row["top_crime_type"], row["high_hotspot_rows"]) == (0, "N/A", 0)
    assert row["pct_under_investigation"] is None
    assert dashboard.trend(tables["month"], NOTHING).isEmpty()
    assert dashboard.heatmap(tables["category"], NOTHING).columns == ["crime_type"]


def test_top_type_tie_is_alphabetical(spark, tables):
    schema = "force string, year int, crime_type string, total_crimes bigint"
    mart = spark.createDataFrame([("a", 2026, "Robbery", 3), ("a", 2026, "Drugs", 2), ("a", 2025, "Drugs", 1)], schema)
    row = dashboard.kpis(mart, tables["force"], tables["hotspots"]).first()
    assert (row["total_crimes"], row["top_crime_type"]) == (6, "Drugs")


def test_filters_apply_where_the_dashboard_applies_them(tables):
    some = Selection(forces=["asia"], years=[1997], crime_types=["Drugs"])
    cells = dashboard.category_totals(tables["category"], some).collect()
    assert [r["crime_type"] for r in cells] == ["Drugs"]
    assert {r["force"] for r in dashboard.trend(tables["month"], some).collect()} == {"asia"}
    # The open share follows the force only, the outcome chart nothing.
    one = dashboard.kpis(tables["category"], tables["force"], tables["hotspots"], some).first()
    other = dashboard.kpis(tables["category"], tables["force"], tables["hotspots"], Selection(forces=["asia"])).first()
    assert one["pct_under_investigation"] == other["pct_under_investigation"]
    total = sum(r["cnt"] for r in dashboard.outcome_distribution(tables["cube"]).collect())
    assert total == tables["month"].agg({"total_crimes": "sum"}).first()[0]


def test_heatmap_cells(tables):
    heat = dashboard.heatmap(tables["category"], months=["1997-01", "2030-01"])
    assert heat.columns == ["crime_type", "1997-01", "2030-01"]
    assert {r["2030-01"] for r in heat.collect()} == {0}


def test_outcome_shares_are_long(tables):
    rows = dashboard.outcome_shares_by_force(tables["force"]).collect()
    assert len(rows) == 15 and {r["Outcome"] for r in rows} == set(dashboard.OUTCOME_SHARES)


def test_markers(spark):
    schema = (
        "lsoa_code string, lsoa_name string, month string, centroid_lat double, centroid_lon double, "
        "total_crimes bigint, hotspot_tier string, violence_count bigint, burglary_count bigint"
    )
    mart = spark.createDataFrame(
        [
            ("a", "A 1", "2026-02", 53.0, -1.0, 3, "Low", 1, 0),
            ("b", "B 1", "2026-02", 53.0, -1.0, 30, "High", 1, 2),
            ("c", "C 1", "2026-02", 53.0, -1.0, 300, "Unheard", 1, 2),
            ("d", "D 1", "2026-02", None, -1.0, 30, "High", 1, 2),
            ("e", "E 1", "2026-01", 53.0, -1.0, 30, "High", 1, 2),
        ],
        schema,
    )
    found = {r["lsoa_code"]: r for r in dashboard.markers(mart).collect()}
    assert {c: (r["radius"], r["colour"]) for c, r in found.items()} == {
        "a": (4.0, "green"), "b": (10.0, "red"), "c": (20.0, "blue"),
    }
    assert found["b"]["popup"] == "<b>B 1</b><br>Crimes: 30<br>Tier: High<br>Violence: 1<br>Burglary: 2"
    assert [r["lsoa_code"] for r in dashboard.markers(mart, "2026-01").collect()] == ["e"]
    assert [r["month"] for r in dashboard.month_options(mart.withColumns({})).collect()] == ["2026-02", "2026-01"]
