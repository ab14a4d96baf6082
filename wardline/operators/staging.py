"""Raw incidents -> one clean, typed frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.text import blank_to_null, strip_area_suffix
from wardline.schema import OUTCOME_MISSING

STAGED_COLUMNS = (
    "crime_id",
    "month",
    "year",
    "month_num",
    "force",
    "lsoa_code",
    "lsoa_name",
    "district",
    "longitude",
    "latitude",
    "location",
    "crime_type",
    "last_outcome",
    "_loaded_at",
)


def clean(raw: DataFrame) -> DataFrame:
    """Trim text, blank IDs to null, default the outcome; drop rows without a month or category.

    What is left out here, see with_period and with_district, follows from single columns and can
    be added to grouped rows just as well.
    """
    usable = raw.where(F.col("month").isNotNull() & F.col("crime_type").isNotNull())
    cleaned = {
        "crime_id": blank_to_null(F.col("crime_id")),
        "month": F.col("month"),
        "force": F.trim("force"),
        "lsoa_code": F.trim("lsoa_code"),
        "lsoa_name": F.trim("lsoa_name"),
        "longitude": F.col("longitude"),
        "latitude": F.col("latitude"),
        "location": F.trim("location"),
        "crime_type": F.trim("crime_type"),
        "last_outcome": F.coalesce(blank_to_null(F.col("last_outcome")), F.lit(OUTCOME_MISSING)),
        "_loaded_at": F.col("_loaded_at"),
    }
    return usable.select([column.alias(name) for name, column in cleaned.items()])


def _month_part(index: int, strict: bool) -> Column:
    text = F.split_part(F.col("month"), F.lit("-"), F.lit(index))
    return text.cast("int") if strict else text.try_cast("int")


def with_period(frame: DataFrame, strict: bool = True) -> DataFrame:
    """Add year and month_num. A malformed month stops the job; not strict, it gives nulls."""
    return frame.withColumns({"year": _month_part(1, strict), "month_num": _month_part(2, strict)})


def with_district(frame: DataFrame) -> DataFrame:
    return frame.withColumn("district", strip_area_suffix(F.col("lsoa_name")))


def stage(raw: DataFrame, strict: bool = True) -> DataFrame:
    """The staging frame: cleaned rows with year, month number and district."""
    return with_district(with_period(clean(raw), strict)).select(*STAGED_COLUMNS)
