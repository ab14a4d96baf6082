"""Staging rules, mart figures on a small fixture, and agreement between ways to build a mart."""

import pytest
from pyspark.sql import functions as F

from wardline.functions.numeric import mean_coordinate, one_decimal, percent, round_half_away
from wardline.operators import marts
from wardline.operators.cube import incident_cube, unit_cube
from wardline.operators.staging import STAGED_COLUMNS, clean, stage
from wardline.plans.sample import raw_incidents
from wardline.schema import OUTCOME_NO_SUSPECT, OUTCOME_OPEN

SCHEMA = (
    "crime_id string, month string, force string, lsoa_code string, lsoa_name string, longitude double, "
    "latitude double, location string, crime_type string, last_outcome string, _loaded_at timestamp"
)
SF = "/root/testdata/sf0.001"


def incident(**given):
    row = {
        "crime_id": "x", "month": "2026-02", "force": " west-yorkshire ", "lsoa_code": " E01 ",
        "lsoa_name": " Bradford 001A ", "longitude": -1.8, "latitude": 53.9, "location": " On or near A ",
        "crime_type": "Burglary ", "last_outcome": OUTCOME_OPEN, "_loaded_at": None,
    }
    return {**row, **given}


def frame(spark, *rows):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(row[name] for name in names) for row in rows], SCHEMA)


def test_stage_cleans_and_derives(spark):
    staged = stage(
        frame(
            spark,
            incident(crime_id="  ", last_outcome=" "),
            incident(lsoa_name="City of London 001F extra 2", last_outcome=None),
            incident(lsoa_name="Leeds", last_outcome=" Offender fined\t"),
            incident(month=None),
            incident(crime_type=None),
        )
    )
    assert staged.columns == list(STAGED_COLUMNS)
    rows = staged.collect()
    assert len(rows) == 3
    first = rows[0]
    assert first["crime_id"] is None and first["last_outcome"] == "No outcome recorded"
    assert (first["year"], first["month_num"], first["force"]) == (2026, 2, "west-yorkshire")
    assert (first["lsoa_code"], first["district"], first["crime_type"]) == ("E01", "Bradford", "Burglary")
    assert [r["district"] for r in rows[1:]] == ["City of London", "Leeds"]
    # Only spaces are trimmed.
    assert rows[2]["last_outcome"] == "Offender fined\t"


def test_malformed_month_stops_unless_lenient(spark):
    bad = frame(spark, incident(month="Feb 2026"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage(bad).collect()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        marts.by_category(incident_cube(clean(bad))).collect()
    row = stage(bad, strict=False).first()
    assert row["year"] is None and row["month"] == "Feb 2026"


def test_force_mart_shares_need_not_sum_to_100(spark):
    outcomes = [OUTCOME_OPEN, OUTCOME_OPEN, OUTCOME_NO_SUSPECT, None, "Offender fined", "Local resolution"]
    rows = frame(spark, *[incident(last_outcome=o) for o in outcomes], incident(crime_type="Drugs"))
    row = marts.by_force(incident_cube(clean(rows))).first()
    assert (row["total_crimes"], row["distinct_crime_types"]) == (7, 2)
    assert (row["pct_under_investigation"], row["pct_no_suspect"], row["pct_resolved"]) == (42.86, 14.29, 28.57)


def test_month_mart_compares_with_previous_year_present(spark):
    months = {"2023-02": 4, "2025-02": 5, "2026-02": 3, "2026-03": 2}
    rows = frame(spark, *[incident(month=m) for m, n in months.items() for _ in range(n)])
    found = {r["month"]: (r["prev_year_crimes"], r["yoy_pct_change"]) for r in marts.by_month(incident_cube(clean(rows))).collect()}
    assert found == {"2023-02": (None, None), "2025-02": (4, 25.0), "2026-02": (5, -40.0), "2026-03": (None, None)}


def test_category_mart_counts_ids(spark):
    rows = frame(spark, incident(), incident(crime_id=""), incident(last_outcome=None))
    row = marts.by_category(incident_cube(clean(rows))).first()
    assert (row["total_crimes"], row["crimes_with_id"], row["pct_under_investigation"]) == (3, 2, 66.67)


def test_hotspot_tiers_counts_and_centroid(spark):
    rows = [incident(lsoa_code="A") for _ in range(20)]
    rows += [incident(lsoa_code="B", crime_type="Drugs", latitude=53.0 + i / 10) for i in range(10)]
    rows += [incident(lsoa_code="C")] * 9 + [incident(lsoa_code="C", latitude=None), incident(lsoa_code=None)]
    found = {r["lsoa_code"]: r for r in marts.hotspots(clean(frame(spark, *rows))).collect()}
    assert {code: r["hotspot_tier"] for code, r in found.items()} == {"A": "High", "B": "Medium", "C": "Low"}
    assert (found["B"]["drugs_count"], found["B"]["burglary_count"], found["A"]["burglary_count"]) == (10, 0, 20)
    assert (found["B"]["centroid_lat"], found["B"]["centroid_lon"]) == (53.45, -1.8)
    assert found["A"]["district"] == "Bradford" and found["A"]["year"] == 2026


def test_mean_coordinate_with_values_no_decimal_holds(spark):
    values = spark.createDataFrame([("a", float("nan")), ("a", 1.0), ("b", 1e300), ("b", 1e300), ("c", 0.0000005)], "k string, x double")
    found = {r["k"]: r["m"] for r in values.groupBy("k").agg(mean_coordinate("x").alias("m")).collect()}
    assert found["a"] != found["a"] and found["b"] == 1e300 and found["c"] == 0.000001


def test_rounding_helpers(spark):
    row = spark.range(1).select(
        round_half_away(F.lit(-2.5), 0).alias("a"),
        percent(F.lit(201), F.lit(20000)).alias("b"),
        percent(F.lit(1), F.lit(0)).alias("c"),
        one_decimal(F.lit(0.25)).alias("d"),
    ).first()
    assert tuple(row) == (-3.0, 1.0, None, 0.2)


@pytest.mark.parametrize("mart", [marts.by_category, marts.by_month, marts.by_force])
def test_marts_from_cube_and_from_rows_agree(spark, mart):
    cleaned = clean(raw_incidents(spark, SF))
    assert sorted(map(str, mart(incident_cube(cleaned)).collect())) == sorted(map(str, mart(unit_cube(cleaned)).collect()))


def test_mart_totals_equal_staged_rows(spark):
    raw = raw_incidents(spark, SF)
    staged, cube = stage(raw), incident_cube(clean(raw))
    rows = staged.count()
    for mart in (marts.by_category, marts.by_month, marts.by_force):
        assert mart(cube).agg(F.sum("total_crimes")).first()[0] == rows
    mapped = marts.hotspots(clean(raw)).agg(F.sum("total_crimes")).first()[0]
    assert mapped == marts.located(staged).count()


def test_hotspots_do_not_depend_on_partitioning(spark):
    cleaned = clean(raw_incidents(spark, SF))
    results = []
    for parts in (1, 7):
        shuffled = cleaned.repartition(parts, "location")
        results.append(sorted(map(str, marts.hotspots(shuffled).collect())))
    assert results[0] == results[1]


def test_reading_order(spark):
    cube = incident_cube(clean(raw_incidents(spark, SF)))
    rows = marts.ordered(marts.by_category(cube), "by_category").collect()
    keys = [(r["year"], r["month_num"], r["force"], -r["total_crimes"]) for r in rows]
    assert keys == sorted(keys)
