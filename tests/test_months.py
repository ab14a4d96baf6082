"""Month arithmetic and load marks."""

import datetime

import pytest
from pyspark.sql import functions as F

from wardline.functions.months import current_month, months_after, previous_month, target_month
from wardline.sources.marks import latest_marks, pending_months


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("start", "end", "expected"),
    [
        ("2025-10", "2026-02", ["2025-11", "2025-12", "2026-01", "2026-02"]),
        ("2026-02", "2026-02", []),
        ("2026-03", "2026-02", []),
    ],
)
def test_months_after(spark, start, end, expected):
    assert value(spark, months_after(F.lit(start), F.lit(end))) == expected


def test_months_after_ends_with_the_current_month(spark):
    assert value(spark, months_after(previous_month(current_month()))) == [value(spark, current_month())]


def test_previous_and_target_month(spark):
    assert value(spark, previous_month(F.lit("2026-01"))) == "2025-12"
    assert value(spark, target_month(F.lit(datetime.date(2026, 3, 31)))) == "2026-02"
    assert value(spark, target_month(F.lit(datetime.date(2026, 1, 5)))) == "2025-12"


def test_marks_are_overwritten_not_maximised(warehouse):
    spark = warehouse.spark
    assert warehouse.mark("west-yorkshire") is None
    for force, month in (("west-yorkshire", "2026-01"), ("greater-manchester", "2025-12"), ("west-yorkshire", "2025-11")):
        warehouse.set_marks(spark.createDataFrame([(force, month)], "force string, month string"))
    assert warehouse.mark("west-yorkshire") == "2025-11"
    assert warehouse.mark("greater-manchester") == "2025-12"
    marks = {r["force"]: r["month"] for r in warehouse.marks().collect()}
    assert marks == {"west-yorkshire": "2025-11", "greater-manchester": "2025-12"}


def test_pending_months_of_all_forces_at_once(spark):
    log = spark.createDataFrame(
        [("a", "2025-12", 1), ("a", "2025-10", 0), ("b", "2026-02", 0)], "force string, month string, updated_at int"
    ).withColumn("updated_at", F.timestamp_seconds("updated_at"))
    pending = pending_months(latest_marks(log), "2026-02")
    assert sorted(map(tuple, pending.collect())) == [("a", "2026-01"), ("a", "2026-02")]
