"""Quality gates: each returns failures as rows; require_* turn failures into an error."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.numeric import one_decimal, safe_ratio
from wardline.schema import (
    CATEGORIES,
    FORCES,
    MIN_FILE_ROWS,
    MIN_MONTH_MATCH,
    MONTH_PATTERN,
    REPORT_COLUMNS,
    TIERS,
)


class GateError(ValueError):
    """A gate did not pass."""


@dataclass(frozen=True)
class Rule:
    """A column test: not null, or, with values, null or one of them."""

    model: str
    column: str
    values: Sequence[str] | None = None

    @property
    def kind(self) -> str:
        return "not_null" if self.values is None else "accepted_values"

    def fails(self) -> Column:
        column = F.col(self.column)
        if self.values is None:
            return column.isNull()
        return ~column.isin(list(self.values))


# The column tests of staging and marts.
NOT_NULL = {
    "staging": ("month", "year", "month_num", "force", "crime_type", "last_outcome"),
    "by_category": ("month", "force", "crime_type", "total_crimes"),
    "by_month": ("month", "force", "total_crimes"),
    "by_force": ("force", "month"),
    "hotspots": ("lsoa_code", "total_crimes"),
}
ACCEPTED = (
    ("staging", "force", FORCES),
    ("staging", "crime_type", CATEGORIES),
    ("hotspots", "hotspot_tier", TIERS),
)
NOT_NULL_RULES = tuple(
    Rule(model, column) for model, columns in NOT_NULL.items() for column in columns
)
ACCEPTED_RULES = tuple(Rule(*entry) for entry in ACCEPTED)
RULES = NOT_NULL_RULES + ACCEPTED_RULES


def rule_failures(models: dict[str, DataFrame], rules: Iterable[Rule] = RULES) -> DataFrame:
    """(model, column, rule, failures) for every rule; all rules of a model share one pass."""
    by_model: dict[str, list[Rule]] = {}
    for rule in rules:
        by_model.setdefault(rule.model, []).append(rule)
    results = []
    for model, tests in by_model.items():
        counted = models[model].agg(
            *[F.count_if(test.fails()).alias(f"_{i}") for i, test in enumerate(tests)]
        )
        rows = [
            F.struct(
                F.lit(model).alias("model"),
                F.lit(test.column).alias("column"),
                F.lit(test.kind).alias("rule"),
                F.col(f"_{i}").alias("failures"),
            )
            for i, test in enumerate(tests)
        ]
        results.append(counted.select(F.inline(F.array(*rows))))
    combined = results[0]
    for result in results[1:]:
        combined = combined.unionByName(result)
    return combined


def require_rules(models: dict[str, DataFrame], rules: Iterable[Rule] = RULES) -> None:
    # One row per rule.
    failed = rule_failures(models, rules).where(F.col("failures") > 0).collect()
    if failed:
        listed = ", ".join(f"{r['model']}.{r['column']} {r['rule']}: {r['failures']}" for r in failed)
        raise GateError(f"column tests failed: {listed}")


def row_counts(frame: DataFrame, by: Sequence[str], minimum: int = MIN_FILE_ROWS) -> DataFrame:
    """Rows per group and whether there are enough. Groups without rows do not appear."""
    counted = frame.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.withColumn("passed", F.col("row_count") >= minimum)


def file_verdicts(rows: DataFrame, minimum: int = MIN_FILE_ROWS) -> DataFrame:
    """(source_path, row_count, passed, dated, malformed) per file: enough rows, how many have a month, how many are
    malformed."""
    counted = rows.groupBy("source_path").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("Month").alias("dated"), F.count("_malformed").alias("malformed")
    )
    return counted.withColumn("passed", F.col("row_count") >= minimum)


def missing_pairs(wanted: DataFrame, loaded: DataFrame) -> DataFrame:
    """(force, month) pairs without a single row in loaded."""
    keys = ["force", "month"]
    return wanted.join(loaded.select(*keys).distinct(), keys, "left_anti")


def require_min_rows(frame: DataFrame, model: str, minimum: int) -> DataFrame:
    """The row count as a frame that fails when it is computed and the count is too low."""
    return frame.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(model).alias("model"),
        F.when(F.col("row_count") >= minimum, F.col("row_count"))
        .otherwise(
            F.raise_error(
                F.format_string(
                    f"row count gate: {model} has %d rows, needs {minimum}", F.col("row_count")
                )
            ).cast("bigint")
        )
        .alias("row_count"),
    )


def require_columns(frame: DataFrame, required: Sequence[str] = REPORT_COLUMNS) -> None:
    """Names must be there with their exact case. Nothing is read for this."""
    missing = sorted(set(required) - set(frame.columns))
    if missing:
        raise GateError(f"missing required columns: {missing}; found: {sorted(frame.columns)}")


def month_format(frame: DataFrame, column: str = "month", by: Sequence[str] = ()) -> DataFrame:
    """Non-null and well-formed months per group, with a verdict.

    error: not one is well-formed (no values at all included). warn: fewer than nine in ten are.
    """
    month = F.col(column)
    counted = frame.groupBy(*by).agg(
        F.count(month).alias("non_null"), F.count_if(month.rlike(MONTH_PATTERN)).alias("matching")
    )
    share = safe_ratio(F.col("matching"), F.col("non_null"))
    verdict = (
        F.when(F.col("matching") == 0, "error").when(share < MIN_MONTH_MATCH, "warn").otherwise("ok")
    )
    return counted.withColumn("status", verdict)


def dropped_rows(frame: DataFrame, column: str = "crime_type", by: Sequence[str] = ()) -> DataFrame:
    """Rows that a null in column takes out, and their share in percent."""
    counted = frame.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(column).isNull()).alias("dropped")
    )
    share = one_decimal(safe_ratio(F.col("dropped"), F.col("row_count")) * 100.0)
    return counted.withColumn("dropped_pct", share)
