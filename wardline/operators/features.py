"""Report features: totals, ranked categories, shares, and change against the period before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.months import previous_month
from wardline.functions.numeric import one_decimal, safe_ratio
from wardline.schema import CALENDAR_MONTH, MOM_TYPE

GROUP = ("falls_within", "month")
FEATURE_COLUMNS = (
    "force",
    "period",
    "total_crimes",
    "top_categories",
    "distribution",
    "mom_change",
)


def most_common(value: str, amount: str) -> Column:
    """Non-null value with the largest amount over counted rows; ties go to the smallest value."""
    order = F.struct(-F.col(amount), F.col(value))
    return F.min_by(value, F.when(F.col(value).isNotNull(), order))


def modes(frame: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Most frequent non-null value per group, ties to the smallest.

    Two steps, each combined before its shuffle, so that no task sees a whole group.
    """
    counted = frame.dropna(subset=[value]).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(*by).agg(
        most_common(value, "_n").alias(value), F.max("_n").alias("occurrences")
    )


def type_counts(frame: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """Rows per group and category. Null categories are counted as their own group."""
    return frame.groupBy(*by, "crime_type").agg(F.count(F.lit(1)).alias("incidents"))


def ranked_shares(counts: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """Rank and share of every category in its group; the shares of a group sum to exactly 100.0.

    Shares are rounded to one decimal and what is then missing goes to the largest category. The
    total is over all rows of the group; rows without a category have no rank and no share.
    Windows run over counted rows: a handful per group.
    """
    named = F.col("crime_type").isNotNull()
    group = Window.partitionBy(*by)
    ranking = group.orderBy(named.desc(), F.desc("incidents"), F.asc("crime_type"))
    rounded = one_decimal(safe_ratio(F.col("incidents"), F.col("total")) * 100.0)
    share = F.col("_share")
    missing = F.lit(100) - F.sum("_share").over(group)
    return (
        counts.withColumn("total", F.sum("incidents").over(group))
        .withColumn("_share", F.when(named, rounded.cast("decimal(9,1)")))
        .withColumn("rank", F.when(named, F.row_number().over(ranking)))
        .withColumn("pct", F.when(F.col("rank") == 1, share + missing).otherwise(share).cast("double"))
        .drop("_share")
    )


def change(current: Column, previous: Column) -> Column:
    """Change against a previous total; figures are null where there were no rows before."""
    difference = current - previous
    known = previous > 0
    direction = (
        F.when(~known, "unknown")
        .when(difference > 0, "increase")
        .when(difference < 0, "decrease")
        .otherwise("no change")
    )
    return F.struct(
        previous.alias("previous_total"),
        F.when(known, difference).alias("absolute"),
        F.when(known, one_decimal(safe_ratio(F.abs(difference), previous) * 100.0)).alias("pct"),
        direction.alias("direction"),
    ).cast(MOM_TYPE)


def _ranked_entries() -> Column:
    """Categories of a group in order of rank: as many entries as the group has categories."""
    entry = F.struct("rank", "crime_type", "pct")
    return F.sort_array(F.collect_list(F.when(F.col("rank").isNotNull(), entry)))


def _lists(ranked: str) -> dict[str, Column]:
    return {
        "top_categories": F.transform(F.slice(ranked, 1, 3), lambda e: e["crime_type"]),
        "distribution": F.transform(
            ranked, lambda e: F.struct(e["crime_type"].alias("category"), e["pct"].alias("pct"))
        ),
    }


def _reportable() -> Column:
    """Rows a report can be about: with a force, and a month of the calendar."""
    return F.col("falls_within").isNotNull() & F.coalesce(F.col("month").rlike(CALENDAR_MONTH), F.lit(False))


def left_out(frame: DataFrame) -> DataFrame:
    """How many rows belong to no report: without a force, or without a well-formed month."""
    without_month = F.col("falls_within").isNotNull() & ~_reportable()
    return frame.agg(
        F.count_if(F.col("falls_within").isNull()).alias("without_force"),
        F.count_if(without_month).alias("without_month"),
    )


def feature_rows(frame: DataFrame) -> DataFrame:
    """One feature row per force and period, all at once, compared with the calendar month before.

    Where that month has no rows there is no change. Rows without a force or a well-formed month make no
    feature row and are nobody's month before; left_out counts them.
    """
    described = ranked_shares(type_counts(frame.where(_reportable()))).groupBy(*GROUP).agg(
        F.sum("incidents").alias("total_crimes"), _ranked_entries().alias("_ranked")
    )
    by_month = Window.partitionBy("falls_within").orderBy("month")
    adjacent = F.lag("month").over(by_month) == previous_month(F.col("month"))
    before = F.when(adjacent, F.lag("total_crimes").over(by_month))
    return (
        described.withColumns(_lists("_ranked"))
        .withColumn("mom_change", F.when(before.isNotNull(), change(F.col("total_crimes"), before)))
        .withColumnsRenamed({"falls_within": "force", "month": "period"})
        .select(*FEATURE_COLUMNS)
    )


def extract_features(current: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """The feature row of one whole frame, whatever forces and months it mixes.

    Force and period are the most frequent ones. mom_change is null when no previous frame is given
    and has null figures when that frame is empty. An empty current frame is an error.
    """
    # One pass over the rows. The counts, forces x months x categories of them at most, are then
    # summed by force, by month and by category together.
    keys = [*GROUP, "crime_type"]
    sums = type_counts(current).groupingSets([[key] for key in keys], *keys).agg(
        F.sum("incidents").alias("incidents"), F.grouping("crime_type").alias("_other")
    )
    # Sums by force or month have no category, hence no rank and no share.
    whole = ranked_shares(sums, ["_other"]).agg(
        most_common("falls_within", "incidents").alias("force"),
        most_common("month", "incidents").alias("period"),
        F.sum(F.when(F.col("_other") == 0, F.col("incidents"))).alias("total_crimes"),
        _ranked_entries().alias("_ranked"),
    )
    if previous is None:
        mom_change = F.lit(None).cast(MOM_TYPE)
    else:
        mom_change = change(F.col("total_crimes"), previous.agg(F.count(F.lit(1))).scalar())
    named = {
        name: F.coalesce(name, F.raise_error(F.lit(f"cannot extract features: no {name}")))
        for name in ("force", "period")
    }
    return (
        whole.withColumns(_lists("_ranked"))
        .withColumn("mom_change", mom_change)
        .withColumns(named)
        .select(*FEATURE_COLUMNS)
    )
