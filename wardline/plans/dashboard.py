"""Datasets behind the dashboard: filters pushed into the marts, small aggregates returned."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.numeric import one_decimal
from wardline.operators.features import most_common

# Marker colours by tier, bounds of the marker radius.
TIER_COLOURS = {"High": "red", "Medium": "orange", "Low": "green"}
OTHER_COLOUR = "blue"
RADIUS_MIN, RADIUS_MAX, INCIDENTS_PER_RADIUS = 4.0, 20.0, 3

OUTCOME_SHARES = ("pct_resolved", "pct_no_suspect", "pct_under_investigation")


@dataclass(frozen=True)
class Selection:
    """Sidebar choices. None selects everything, an empty list selects nothing."""

    forces: Sequence[str] | None = None
    years: Sequence[int] | None = None
    crime_types: Sequence[str] | None = None

    def by_force(self, mart: DataFrame) -> DataFrame:
        return _pick(mart, force=self.forces)

    def by_period(self, mart: DataFrame) -> DataFrame:
        return _pick(mart, force=self.forces, year=self.years)

    def by_type(self, mart: DataFrame) -> DataFrame:
        return _pick(mart, force=self.forces, year=self.years, crime_type=self.crime_types)


EVERYTHING = Selection()


def _pick(mart: DataFrame, **choices: Sequence | None) -> DataFrame:
    for column, values in choices.items():
        if values is not None:
            mart = mart.where(F.col(column).isin(list(values)))
    return mart


def filter_domains(by_category: DataFrame) -> DataFrame:
    """Values to choose from, one row each, in one pass over the category mart."""
    names = ("force", "year", "crime_type")
    text = by_category.select(*[F.col(name).cast("string").alias(name) for name in names])
    found = text.groupingSets([[name] for name in names], *names).agg(
        *[F.grouping(name).alias(f"_{name}") for name in names]
    )
    chosen = F.coalesce(*[F.when(F.col(f"_{name}") == 0, F.lit(name)) for name in names])
    return found.select(chosen.alias("filter"), F.coalesce(*names).alias("value")).orderBy("filter", "value")


def kpis(
    by_category: DataFrame,
    by_force: DataFrame,
    hotspots: DataFrame,
    selection: Selection = EVERYTHING,
) -> DataFrame:
    """The four headline figures in one row.

    The open share is the plain mean of monthly shares and follows the force filter only; the last
    figure counts area-months, not areas.
    """
    per_type = (
        selection.by_type(by_category)
        .groupBy("crime_type")
        .agg(F.sum("total_crimes").alias("total_crimes"))
    )
    parts = [
        per_type.agg(
            F.sum("total_crimes").alias("total_crimes"),
            most_common("crime_type", "total_crimes").alias("top_crime_type"),
        ),
        selection.by_force(by_force).agg(
            one_decimal(F.avg("pct_under_investigation")).alias("pct_under_investigation")
        ),
        selection.by_period(hotspots).agg(
            F.count_if(F.col("hotspot_tier") == "High").alias("high_hotspot_rows")
        ),
    ]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part, allowMissingColumns=True)
    # Three rows, each with its own columns filled.
    return joined.agg(
        F.coalesce(F.max("total_crimes"), F.lit(0)).alias("total_crimes"),
        F.max("pct_under_investigation").alias("pct_under_investigation"),
        F.coalesce(F.max("top_crime_type"), F.lit("N/A")).alias("top_crime_type"),
        F.max("high_hotspot_rows").alias("high_hotspot_rows"),
    )


def outcome_distribution(cube: DataFrame) -> DataFrame:
    """Incidents per outcome over everything; filters do not apply here."""
    return (
        cube.groupBy("last_outcome")
        .agg(F.sum("incidents").alias("cnt"))
        .orderBy(F.desc("cnt"), "last_outcome")
    )


def _month_force_totals(mart: DataFrame) -> DataFrame:
    return mart.groupBy("month", "force").agg(F.sum("total_crimes").alias("total_crimes"))


def trend(by_month: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    return _month_force_totals(selection.by_period(by_month)).orderBy("month", "force")


def category_totals(by_category: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    return (
        selection.by_type(by_category)
        .groupBy("crime_type")
        .agg(F.sum("total_crimes").alias("total_crimes"))
        .orderBy("total_crimes", "crime_type")
    )


def heatmap(
    by_category: DataFrame,
    selection: Selection = EVERYTHING,
    months: Iterable[str] | None = None,
) -> DataFrame:
    """Category by month, 0 where there is nothing.

    Columns are the given months, or all months present: one job over the mart then lists them.
    """
    chosen = selection.by_type(by_category)
    if months is None:
        months = sorted(row["month"] for row in chosen.select("month").distinct().collect())
    pivoted = chosen.groupBy("crime_type").pivot("month", list(months)).sum("total_crimes")
    return pivoted.na.fill(0)


def outcome_shares_by_force(by_force: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    """Mean monthly shares per force, one row per force and outcome."""
    means = selection.by_period(by_force).groupBy("force").agg(
        *[F.avg(name).alias(name) for name in OUTCOME_SHARES]
    )
    return means.unpivot("force", list(OUTCOME_SHARES), "Outcome", "Percentage")


def monthly_totals(by_force: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    """One row per month and force: what a box plot of monthly volume takes."""
    return _month_force_totals(selection.by_period(by_force))


def monthly_quartiles(by_force: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    """Box of each force: extremes and interpolated quartiles of its monthly totals."""
    total = F.col("total_crimes")
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    return monthly_totals(by_force, selection).groupBy("force").agg(
        F.min(total).alias("minimum"),
        *[F.percentile(total, at).alias(name) for name, at in quartiles.items()],
        F.max(total).alias("maximum"),
    )


def markers(hotspots: DataFrame, month: str | Column | None = None) -> DataFrame:
    """Map markers of one month, by default the latest: place, radius, colour and popup text.

    The month is a grouping key of the mart, so the filter reaches the scan below it.
    """
    if month is None:
        month = hotspots.agg(F.max("month")).scalar()
    total = F.col("total_crimes")
    colour = F.lit(OTHER_COLOUR)
    for name, value in TIER_COLOURS.items():
        colour = F.when(F.col("hotspot_tier") == name, value).otherwise(colour)
    popup = F.concat(
        F.lit("<b>"),
        F.coalesce("lsoa_name", F.lit("")),
        F.lit("</b>"),
        *[
            F.concat(F.lit(f"<br>{label}: "), F.col(column).cast("string"))
            for label, column in (
                ("Crimes", "total_crimes"),
                ("Tier", "hotspot_tier"),
                ("Violence", "violence_count"),
                ("Burglary", "burglary_count"),
            )
        ],
    )
    return (
        hotspots.where(F.col("month") == month)
        .dropna(subset=["centroid_lat", "centroid_lon"])
        .select(
            "lsoa_code",
            "month",
            "centroid_lat",
            "centroid_lon",
            F.greatest(
                F.lit(RADIUS_MIN), F.least(total / F.lit(INCIDENTS_PER_RADIUS), F.lit(RADIUS_MAX))
            ).alias("radius"),
            colour.alias("colour"),
            popup.alias("popup"),
        )
    )


def month_options(hotspots: DataFrame, selection: Selection = EVERYTHING) -> DataFrame:
    """Months to choose from on the map, latest first."""
    return selection.by_period(hotspots).select("month").distinct().orderBy(F.desc("month"))
