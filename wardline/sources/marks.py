"""Load marks: the month up to which a force is complete, and what became of each planned month.

Both are append-only logs. A mark never passes a month that was planned and is not loaded: that month stays
pending, and months loaded beyond it are known from their log and are not loaded again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.months import month_name, month_number, month_starts_after, previous_month

SCHEMA = "force string, month string, updated_at timestamp"


def latest_marks(log: DataFrame) -> DataFrame:
    """Current mark per force: the one set last, even if its month is earlier."""
    return log.groupBy("force").agg(
        F.max_by("month", F.struct("updated_at", "month")).alias("month"),
        F.max("updated_at").alias("updated_at"),
    )


def mark_of(log: DataFrame, force: str) -> str | None:
    """Month of one force, or None if it has no mark."""
    row = latest_marks(log.where(F.col("force") == force)).first()
    return row["month"] if row else None


# What became of a planned month. A forgotten one counts as never planned.
LOADED, HELD, FORGOTTEN = "loaded", "held", "forgotten"
MONTH_SCHEMA = "force string, month string, status string, updated_at timestamp"


def latest_status(log: DataFrame) -> DataFrame:
    """(force, month, status): the newest entry of each month that is not forgotten."""
    newest = log.groupBy("force", "month").agg(F.max_by("status", F.struct("updated_at", "status")).alias("status"))
    return newest.where(F.col("status") != FORGOTTEN)


def advanced_marks(marks: DataFrame, status: DataFrame) -> DataFrame:
    """(force, month): the mark of each force that moves, as far as its months are loaded without a gap.

    A force without a mark begins at its first month in status.
    """
    base = status.groupBy("force").agg(F.min("month").alias("first")).join(marks.select("force", "month"), "force", "left")
    base = base.select("force", F.coalesce("month", previous_month(F.col("first"))).alias("base"))
    loaded = status.where(F.col("status") == LOADED).select("force", "month").distinct()
    beyond = loaded.join(base, "force").where(F.col("month") > F.col("base"))
    step = F.row_number().over(Window.partitionBy("force").orderBy("month"))
    distance = month_number(F.col("month")) - month_number(F.col("base"))
    whole = beyond.withColumn("_gapless", distance == step).where("_gapless")
    return whole.groupBy("force").agg(F.max("month").alias("month"))


def pending_months(marks: DataFrame, end: str | Column | None = None) -> DataFrame:
    """(force, month) still to load: every month after a force's mark, up to and including end.

    Without an end, up to the current month.
    """
    last = F.lit(end) if isinstance(end, str) else end
    days = marks.select("force", F.explode(month_starts_after(F.col("month"), last)).alias("_day"))
    return days.select("force", month_name(F.col("_day")).alias("month"))
