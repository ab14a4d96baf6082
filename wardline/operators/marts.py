"""The four marts.

Category, month and force marts take any frame in the cube's layout; hotspots take cleaned rows.
Year, month number and district are worked out on grouped rows, not on every incident. No mart is
sorted: order is applied when one is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.numeric import SUM_PARTS, coordinate_sums, mean_coordinate, mean_of_sums, percent, sum_if
from wardline.operators.staging import with_district, with_period
from wardline.schema import (
    HIGH_FROM,
    HOTSPOT_COUNTS,
    MEDIUM_FROM,
    OUTCOME_MISSING,
    OUTCOME_NO_SUSPECT,
    OUTCOME_OPEN,
)

HOTSPOT_KEYS = ("lsoa_code", "lsoa_name", "force", "month")

# Columns of the marts.
MART_COLUMNS: dict[str, tuple[str, ...]] = {
    "by_category": (
        "year",
        "month_num",
        "month",
        "force",
        "crime_type",
        "total_crimes",
        "crimes_with_id",
        "pct_under_investigation",
    ),
    "by_month": ("year", "month_num", "month", "force", "total_crimes", "prev_year_crimes", "yoy_pct_change"),
    "by_force": (
        "force",
        "year",
        "month",
        "total_crimes",
        "distinct_crime_types",
        "pct_under_investigation",
        "pct_no_suspect",
        "pct_resolved",
    ),
    "hotspots": (
        "lsoa_code",
        "lsoa_name",
        "district",
        "force",
        "year",
        "month",
        "centroid_lat",
        "centroid_lon",
        "total_crimes",
        *HOTSPOT_COUNTS,
        "hotspot_tier",
    ),
}


def _share_of_incidents(condition: Column) -> Column:
    return percent(sum_if(condition, F.col("incidents")), F.sum("incidents"))


def by_category(cube: DataFrame) -> DataFrame:
    counted = cube.groupBy("month", "force", "crime_type").agg(
        F.sum("incidents").alias("total_crimes"),
        F.sum("incidents_with_id").alias("crimes_with_id"),
        _share_of_incidents(F.col("last_outcome") == OUTCOME_OPEN).alias("pct_under_investigation"),
    )
    return with_period(counted).select(*MART_COLUMNS["by_category"])


def by_month(cube: DataFrame) -> DataFrame:
    """Monthly totals against the previous year that has the same month.

    The previous year is the previous one present: over a gap, 2026 is compared with 2024.
    """
    totals = cube.groupBy("month", "force").agg(F.sum("incidents").alias("total_crimes"))
    same_month = Window.partitionBy("force", "month_num").orderBy("year")
    now, before = F.col("total_crimes"), F.col("prev_year_crimes")
    compared = with_period(totals).withColumn(
        "prev_year_crimes", F.lag("total_crimes").over(same_month)
    )
    return compared.withColumn("yoy_pct_change", percent(now - before, before)).select(
        *MART_COLUMNS["by_month"]
    )


def by_force(cube: DataFrame) -> DataFrame:
    """Outcome shares per force and month. Rows without an outcome are in none of the three."""
    outcome = F.col("last_outcome")
    counted = cube.groupBy("force", "month").agg(
        F.sum("incidents").alias("total_crimes"),
        F.count_distinct("crime_type").alias("distinct_crime_types"),
        _share_of_incidents(outcome == OUTCOME_OPEN).alias("pct_under_investigation"),
        _share_of_incidents(outcome == OUTCOME_NO_SUSPECT).alias("pct_no_suspect"),
        _share_of_incidents(
            ~outcome.isin(OUTCOME_OPEN, OUTCOME_MISSING, OUTCOME_NO_SUSPECT)
        ).alias("pct_resolved"),
    )
    return with_period(counted).select(*MART_COLUMNS["by_force"])


def tier(total: Column, high_from: int = HIGH_FROM, medium_from: int = MEDIUM_FROM) -> Column:
    return (
        F.when(total >= high_from, "High").when(total >= medium_from, "Medium").otherwise("Low")
    )


def located(cleaned: DataFrame) -> DataFrame:
    """Rows that can be put on a map."""
    return cleaned.dropna(subset=["latitude", "longitude", "lsoa_code"])


def _graded(counted: DataFrame, high_from: int, medium_from: int) -> DataFrame:
    tiered = counted.withColumn("hotspot_tier", tier(F.col("total_crimes"), high_from, medium_from))
    return with_district(with_period(tiered)).select(*MART_COLUMNS["hotspots"])


def hotspots(
    cleaned: DataFrame, high_from: int = HIGH_FROM, medium_from: int = MEDIUM_FROM
) -> DataFrame:
    """Area by month: centroid, total, six category counts and a tier, in one pass."""
    category = F.col("crime_type")
    counted = located(cleaned).groupBy(*HOTSPOT_KEYS).agg(
        mean_coordinate("latitude").alias("centroid_lat"),
        mean_coordinate("longitude").alias("centroid_lon"),
        F.count(F.lit(1)).alias("total_crimes"),
        *[F.count_if(category == name).alias(column) for column, name in HOTSPOT_COUNTS.items()],
    )
    return _graded(counted, high_from, medium_from)


_SUMS = ("total_crimes", *HOTSPOT_COUNTS, *[f"{name}_{part}" for name in ("latitude", "longitude") for part in SUM_PARTS])


def area_sums(cleaned: DataFrame) -> DataFrame:
    """What hotspots are made of, in sums that can be added up over any parts of the rows."""
    category = F.col("crime_type")
    return located(cleaned).groupBy(*HOTSPOT_KEYS).agg(
        F.count(F.lit(1)).alias("total_crimes"),
        *[F.count_if(category == name).alias(column) for column, name in HOTSPOT_COUNTS.items()],
        *coordinate_sums("latitude"),
        *coordinate_sums("longitude"),
    )


def added_areas(parts: DataFrame) -> DataFrame:
    """Sums of several parts put together."""
    kinds = dict(parts.dtypes)
    return parts.groupBy(*HOTSPOT_KEYS).agg(*[F.sum(name).cast(kinds[name]).alias(name) for name in _SUMS])


def hotspots_of(areas: DataFrame, high_from: int = HIGH_FROM, medium_from: int = MEDIUM_FROM) -> DataFrame:
    """The hotspot mart from area sums; the same as from the rows."""
    means = {"centroid_lat": mean_of_sums("latitude"), "centroid_lon": mean_of_sums("longitude")}
    return _graded(areas.withColumns(means), high_from, medium_from)


# Reading order of each mart: column -> ascending.
MART_ORDER: dict[str, dict[str, bool]] = {
    "by_category": {"year": True, "month_num": True, "force": True, "total_crimes": False},
    "by_month": {"force": True, "year": True, "month_num": True},
    "by_force": {"force": True, "year": True, "month": True},
    "hotspots": {"total_crimes": False},
}


def ordered(mart: DataFrame, name: str) -> DataFrame:
    order = MART_ORDER[name]
    return mart.orderBy(*order, ascending=list(order.values()))
