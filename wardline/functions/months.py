"""Arithmetic on YYYY-MM strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FORMAT = "yyyy-MM"


def _first_day(month: Column) -> Column:
    return F.to_date(month, _FORMAT)


def shift_month(month: Column, by: int) -> Column:
    return F.date_format(F.add_months(_first_day(month), by), _FORMAT)


def previous_month(month: Column) -> Column:
    return shift_month(month, -1)


def month_number(month: Column) -> Column:
    """Months since year 0, so that neighbouring months differ by one."""
    return F.year(_first_day(month)) * 12 + F.month(_first_day(month))


def target_month(run_date: Column) -> Column:
    """The calendar month before the one a run falls in."""
    return F.date_format(F.add_months(F.trunc(run_date, "month"), -1), _FORMAT)


def current_month() -> Column:
    return F.date_format(F.current_date(), _FORMAT)


def month_starts_after(start: Column, end: Column | None = None) -> Column:
    """First days of the months after start up to and including end; empty when there are none."""
    last = current_month() if end is None else end
    between = F.sequence(
        F.add_months(_first_day(start), 1), _first_day(last), F.expr("interval 1 month")
    )
    # sequence refuses a start beyond its end, hence the guard.
    return F.when(start < last, between).otherwise(F.array().cast("array<date>"))


def months_after(start: Column, end: Column | None = None) -> Column:
    """The same as an array of YYYY-MM."""
    return F.transform(month_starts_after(start, end), lambda day: F.date_format(day, _FORMAT))


def month_name(day: Column) -> Column:
    return F.date_format(day, _FORMAT)
