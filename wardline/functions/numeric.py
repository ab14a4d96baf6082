"""Rounding and ratios with one definition for all marts and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double, ties away from zero, working on the binary value.

    The built-in round goes through the decimal text of the double and so lifts values such as
    1.005 that lie below the tie in binary.
    """
    scale = float(10**digits)
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / F.lit(scale)


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, null where whole is zero."""
    return part.cast("double") / F.nullif(whole, F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """Share of whole in percent, two decimals."""
    return round_half_away(safe_ratio(F.lit(100.0) * part, whole), 2)


def one_decimal(value: Column) -> Column:
    """One decimal, ties to the even digit, as report figures are rounded."""
    return F.bround(value, 1)


def sum_if(condition: Column, amount: Column) -> Column:
    """Sum of amount over the rows that meet the condition; 0 where none does."""
    return F.sum(F.when(condition, amount).otherwise(0))


def mean_coordinate(name: str) -> Column:
    """Mean of a coordinate to six decimals, the same whatever order rows arrive in.

    Degrees are summed as decimals, because a sum of doubles depends on how rows were split over
    tasks. 22 integer digits leave room for any group size. A group holding a value that no decimal
    can carry (NaN, infinity, garbage) falls back to the plain mean.
    """
    exact = F.col(name).try_cast("decimal(18,6)")
    present = F.count(name)
    mean = F.sum(exact).cast("double") / F.nullif(present, F.lit(0))
    return F.when(F.count(exact) == present, round_half_away(mean, 6)).otherwise(
        F.round(F.avg(name), 6)
    )


# What a mean coordinate is made of, so that parts of a group can be added up.
SUM_PARTS = ("exact_sum", "exact_count", "count", "plain_sum")


def coordinate_sums(name: str) -> list[Column]:
    exact = F.col(name).try_cast("decimal(18,6)")
    parts = (F.sum(exact), F.count(exact), F.count(name), F.sum(name))
    return [part.alias(f"{name}_{kind}") for kind, part in zip(SUM_PARTS, parts, strict=True)]


def mean_of_sums(name: str) -> Column:
    """mean_coordinate from the sums of its parts."""
    exact_sum, exact_count, present, plain_sum = (F.col(f"{name}_{kind}") for kind in SUM_PARTS)
    mean = exact_sum.cast("double") / F.nullif(present, F.lit(0))
    return F.when(exact_count == present, round_half_away(mean, 6)).otherwise(F.round(plain_sum / F.nullif(present, F.lit(0)), 6))
