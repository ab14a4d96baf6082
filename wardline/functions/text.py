"""Cleaning and display of text values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def strip_area_suffix(area_name: Column) -> Column:
    """District part of an area name: everything before the first ' <digits>'."""
    return F.regexp_replace(F.trim(area_name), r" \d+.*$", "")


def thousands(number: Column) -> Column:
    return F.format_number(number, 0)


def signed_thousands(number: Column) -> Column:
    return F.concat(F.when(number > 0, "+").otherwise(""), thousands(number))


def percent_text(pct: Column) -> Column:
    """41.2 -> '41.2%'. Through a decimal, so that large values never turn scientific."""
    return F.concat(pct.cast("decimal(30,1)").cast("string"), F.lit("%"))


def safe_stem(force: Column, period: Column) -> Column:
    """File stem of a report: word characters and dashes only, blanks as underscores."""
    # (?U): accented letters count as word characters.
    kept = F.regexp_replace(F.regexp_replace(force, r"(?U)[^\w\s-]", ""), r"(?U)^\s+|\s+$", "")
    return F.concat_ws(
        "_", F.replace(kept, F.lit(" "), F.lit("_")), F.regexp_replace(period, r"(?U)[^\w-]", "")
    )


def partition_key(prefix: Column, month: Column, force: Column, file_name: Column) -> Column:
    """Path of a landed file below the store's root."""
    return F.concat_ws(
        "/",
        prefix,
        F.concat(F.lit("part_year="), F.split_part(month, F.lit("-"), F.lit(1))),
        F.concat(F.lit("part_month="), F.split_part(month, F.lit("-"), F.lit(2))),
        F.concat(F.lit("force="), force),
        F.concat(F.lit("source_file="), file_name),
    )
