"""Shared pre-aggregate: the only full pass that three of the four marts need."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CUBE_KEYS = ("month", "force", "crime_type", "last_outcome")


def incident_cube(cleaned: DataFrame) -> DataFrame:
    """Counts at the finest grain the count marts use.

    Rows are combined before the shuffle, so a key with a third of all rows sends one row per task.
    """
    return cleaned.groupBy(*CUBE_KEYS).agg(
        F.count(F.lit(1)).alias("incidents"), F.count("crime_id").alias("incidents_with_id")
    )


def unit_cube(cleaned: DataFrame) -> DataFrame:
    """Cleaned rows in the cube's layout, one incident each: for a single mart in a single shuffle."""
    return cleaned.select(
        *CUBE_KEYS,
        F.lit(1).alias("incidents"),
        F.col("crime_id").isNotNull().cast("int").alias("incidents_with_id"),
    )


def added_cubes(parts: DataFrame) -> DataFrame:
    """Cubes of several parts of the rows put together."""
    return parts.groupBy(*CUBE_KEYS).agg(*[F.sum(name).alias(name) for name in ("incidents", "incidents_with_id")])
