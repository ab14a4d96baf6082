"""From incident files to prompts, for all files at once."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators import features, narrative
from wardline.operators.quality import GateError, dropped_rows, month_format, require_columns
from wardline.schema import FILE_COLUMNS
from wardline.sources.incident_files import read_any_encoding
from wardline.sources.records import MALFORMED, list_paths

log = logging.getLogger(__name__)


def load_report_rows(
    spark: SparkSession, paths: str | Sequence[str], encoding: str | None = None
) -> DataFrame:
    """Validated rows of report files: required columns, month format, null categories dropped.

    The months are checked per file. A file without a single YYYY-MM month is an error, one with
    fewer than nine in ten is a warning.
    """
    rows = read_any_encoding(spark, paths, encoding)
    require_columns(rows)
    renamed = rows.select(
        *[F.col(f"`{name}`").alias(FILE_COLUMNS.get(name, name)) for name in rows.columns]
    )
    # One row per file. A file without rows has none, and no month either.
    counted = month_format(renamed, by=["source_file"]).join(renamed.groupBy("source_file").agg(F.count(MALFORMED).alias("malformed")), "source_file")
    verdicts = {row["source_file"]: row for row in counted.collect()}
    wrong = [
        path
        for path in list_paths(spark, paths)
        if path not in verdicts or verdicts[path]["status"] == "error"
    ]
    if wrong:
        raise GateError(f"no YYYY-MM month in {wrong}")
    for path, row in verdicts.items():
        if row["status"] == "warn":
            log.warning("%s: %d of %d months are YYYY-MM", path, row["matching"], row["non_null"])
        if row["malformed"]:
            log.warning("%s: %d records with more or fewer fields than the header", path, row["malformed"])
    return renamed.dropna(subset=["crime_type"]).drop(MALFORMED)


def dropped_by_file(
    spark: SparkSession, paths: str | Sequence[str], encoding: str | None = None
) -> DataFrame:
    """How many rows of each file have no category and are left out."""
    rows = read_any_encoding(spark, paths, encoding)
    return dropped_rows(rows, "Crime type", by=["source_file"])


def report_prompts(
    spark: SparkSession,
    paths: str | Sequence[str],
    version: str = narrative.DEFAULT_VERSION,
    encoding: str | None = None,
) -> DataFrame:
    """Prompts for every force and period in the files, with change where a period precedes."""
    rows = load_report_rows(spark, paths, encoding)
    unused = features.left_out(rows).first()
    if any(unused):
        log.warning("rows in no report: %d without a force, %d without a month", *unused)
    return narrative.prompts(features.feature_rows(rows), version)


def compared_features(
    spark: SparkSession,
    current: str | Sequence[str],
    previous: str | Sequence[str] | None = None,
    encoding: str | None = None,
) -> DataFrame:
    """The feature row of one period's files against those of another.

    Files of the other period that do not pass are reported and left out of account.
    """
    rows = load_report_rows(spark, current, encoding)
    before = None
    if previous is not None:
        try:
            before = load_report_rows(spark, previous, encoding)
        except Exception as error:  # missing, unreadable or invalid: go on without a comparison
            log.warning("previous period left out: %s", error)
    return features.extract_features(rows, before)
