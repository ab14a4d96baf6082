"""The registered queries: same names as their SQL, and plans that hold at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import compare
from wardline.operators import marts
from wardline.operators.cube import incident_cube, unit_cube
from wardline.operators.staging import clean
from wardline.plans import oracle, registry
from wardline.plans.sample import raw_incidents

SF = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert registry.queries().items() <= entry.queries().items()
    assert oracle.oracle_sql().items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, SF, name) is None


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_query_pairs_rows_without_a_key(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


def test_filters_and_columns_reach_the_raw_table(spark, tmp_path):
    """A month mart of one force and month reads that partition; a year filter stays above lag."""
    raw = raw_incidents(spark, SF).withColumn("force", F.trim("force"))
    raw.write.partitionBy("force", "month").parquet(str(tmp_path / "raw"))
    stored = clean(spark.read.parquet(str(tmp_path / "raw")))
    mart = marts.by_month(incident_cube(stored))
    text = plan(mart.where("force = 'asia'"))
    assert "asia" in text.split("PartitionFilters: [")[1].split("]")[0]
    read = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert {part.split(":")[0] for part in read.split(",")} <= {"crime_type", "last_outcome"}
    assert text.count("Window [") == 1
    late = mart.where("year = 1998")
    assert late.where("prev_year_crimes is not null").count() == late.count() > 0


def test_row_level_shuffles_carry_counts_only(spark):
    """Marts shuffle partial counts: one exchange of grouped rows after the sample's own join."""
    cleaned = clean(raw_incidents(spark, SF))
    joins = plan(cleaned).count("Exchange hashpartitioning")
    assert plan(marts.hotspots(cleaned)).count("Exchange hashpartitioning") == joins + 1
    assert plan(marts.by_category(unit_cube(cleaned))).count("Exchange hashpartitioning") == joins + 1
