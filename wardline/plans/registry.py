"""Every dataset of the library as a query over the order tables (see plans/sample.py)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions import months
from wardline.functions.numeric import round_half_away
from wardline.functions.text import blank_to_null, safe_stem
from wardline.operators import features, marts, narrative, quality
from wardline.operators.cube import incident_cube, unit_cube
from wardline.operators.incremental import new_rows
from wardline.operators.staging import clean, stage
from wardline.plans import dashboard
from wardline.plans.dashboard import Selection
from wardline.plans.sample import raw_incidents, table
from wardline.schema import FILE_COLUMNS, ROW_KEY
from wardline.session import shared_dir
from wardline.sources import marks
from wardline.sources.incident_files import to_raw
from wardline.sources.landing import list_partitions
from wardline.sources.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

# What the sidebar is set to in the filtered queries.
PICKED = Selection(
    forces=("africa", "asia", "europe"),
    years=(1996, 1997, 1998, 1999),
    crime_types=("Burglary", "Drugs", "Robbery", "Shoplifting", "Vehicle crime"),
)

# Months up to the first are in the raw table, months from the second on are in the batch.
LOADED_UP_TO, BATCH_FROM = "1999-06", "1999-01"

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(raw_incidents(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_incidents(spark, sf_dir))


def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incident_cube(cleaned(spark, sf_dir))


def gapped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with what reports have to cope with: a month that one force has not sent, rows without a month."""
    rows = raw_incidents(spark, sf_dir).dropna(subset=["crime_type"])
    missing = (F.col("falls_within") == "ASIA Police") & F.col("month").endswith("-05")
    return rows.where(~F.coalesce(missing, F.lit(False))).withColumn("crime_type", F.trim("crime_type"))


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows as the report loader leaves them: with a category, cleaned of spaces, with a month."""
    rows = raw_incidents(spark, sf_dir).dropna(subset=["crime_type", "month"])
    return rows.withColumn("crime_type", F.trim("crime_type"))


# -- staging --------------------------------------------------------------------------------------


@query
def stage_incidents(spark, sf_dir):
    return staged(spark, sf_dir).withColumn("_loaded_at", F.col("_loaded_at").cast("string"))


@query
def stage_district(spark, sf_dir):
    names = staged(spark, sf_dir).groupBy("lsoa_name", "district")
    return names.agg(F.count(F.lit(1)).alias("row_count"))


@query
def raw_try_cast(spark, sf_dir):
    supplier = F.col("l_suppkey").cast("string")
    text = (
        F.when(F.col("l_partkey") % 5 == 0, "n/a")
        .when(F.col("l_partkey") % 7 == 0, "")
        .when(F.col("l_partkey") % 11 == 0, F.concat(F.lit(" -"), supplier, F.lit(".5 ")))
        .otherwise(F.concat(supplier, F.lit(".25")))
    )
    keep = ["l_orderkey", "l_linenumber", "l_partkey"]
    columns = [(text if column == "longitude" else F.lit(None).cast("string")).alias(name) for name, column in FILE_COLUMNS.items()]
    rows = table(spark, sf_dir, "lineitem").select(*columns, *keep)
    return to_raw(rows, "nowhere", keep).select(*keep, F.col("longitude").alias("value"))


# -- marts ----------------------------------------------------------------------------------------


@query
def mart_by_category(spark, sf_dir):
    return marts.by_category(unit_cube(cleaned(spark, sf_dir)))


@query
def cube_rollup_category(spark, sf_dir):
    return marts.by_category(cube(spark, sf_dir))


@query
def mart_by_month_yoy(spark, sf_dir):
    return marts.by_month(unit_cube(cleaned(spark, sf_dir)))


@query
def mart_by_force(spark, sf_dir):
    return marts.by_force(unit_cube(cleaned(spark, sf_dir)))


@query
def mart_hotspots(spark, sf_dir):
    return marts.hotspots(cleaned(spark, sf_dir))


# -- dashboard ------------------------------------------------------------------------------------


@query
def outcome_distribution(spark, sf_dir):
    return dashboard.outcome_distribution(unit_cube(cleaned(spark, sf_dir)))


@query
def kpi_row(spark, sf_dir):
    counts = cube(spark, sf_dir)
    return dashboard.kpis(
        marts.by_category(counts),
        marts.by_force(counts),
        marts.hotspots(cleaned(spark, sf_dir)),
        PICKED,
    )


@query
def filter_domains(spark, sf_dir):
    return dashboard.filter_domains(marts.by_category(cube(spark, sf_dir)))


@query
def trend_by_month_force(spark, sf_dir):
    return dashboard.trend(marts.by_month(cube(spark, sf_dir)), PICKED)


@query
def category_totals(spark, sf_dir):
    return dashboard.category_totals(marts.by_category(cube(spark, sf_dir)), PICKED)


@query
def heatmap_pivot(spark, sf_dir):
    return dashboard.heatmap(marts.by_category(cube(spark, sf_dir)))


@query
def force_outcome_long(spark, sf_dir):
    shares = dashboard.outcome_shares_by_force(marts.by_force(cube(spark, sf_dir)), PICKED)
    return shares.select(
        "force",
        F.col("Outcome").alias("outcome"),
        round_half_away(F.col("Percentage"), 6).alias("percentage"),
    )


@query
def monthly_totals_by_force(spark, sf_dir):
    return dashboard.monthly_totals(marts.by_force(cube(spark, sf_dir)))


@query
def monthly_quartiles_by_force(spark, sf_dir):
    return dashboard.monthly_quartiles(marts.by_force(cube(spark, sf_dir)))


@query
def hotspot_markers_latest(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    # The latest mapped month, taken before grouping: no shuffle, and the filter reaches the scan.
    latest = marts.located(rows).agg(F.max("month")).scalar()
    return dashboard.markers(marts.hotspots(rows), latest)


# -- report features ------------------------------------------------------------------------------


@query
def outcome_modes(spark, sf_dir):
    return features.modes(raw_incidents(spark, sf_dir), "last_outcome", features.GROUP)


@query
def value_counts_ranked(spark, sf_dir):
    counts = features.type_counts(report_rows(spark, sf_dir))
    return features.ranked_shares(counts).select(
        "falls_within", "month", "rank", "crime_type", "incidents"
    )


@query
def category_distribution_100(spark, sf_dir):
    counts = features.type_counts(report_rows(spark, sf_dir))
    return features.ranked_shares(counts).select("falls_within", "month", "crime_type", "pct")


@query
def top3_categories(spark, sf_dir):
    return features.feature_rows(report_rows(spark, sf_dir)).select(
        "force", "period", F.array_join("top_categories", "|").alias("top_three")
    )


@query
def month_on_month(spark, sf_dir):
    rows = features.feature_rows(gapped_rows(spark, sf_dir))
    return rows.select("force", "period", "total_crimes", "mom_change.*")


@query
def feature_rows(spark, sf_dir):
    shares = F.array_join(
        F.transform(
            "distribution",
            lambda e: F.concat(e["category"], F.lit("="), e["pct"].cast("decimal(9,1)").cast("string")),
        ),
        "|",
    )
    return features.feature_rows(gapped_rows(spark, sf_dir)).select(
        "force",
        "period",
        "total_crimes",
        F.array_join("top_categories", "|").alias("top_three"),
        shares.alias("distribution"),
        F.col("mom_change.previous_total").alias("previous_total"),
        F.col("mom_change.absolute").alias("absolute"),
        F.col("mom_change.pct").alias("pct"),
        F.col("mom_change.direction").alias("direction"),
    )


@query
def whole_table_features(spark, sf_dir):
    """All rows as one report, with the rows that have no outcome standing in for the period before."""
    rows = report_rows(spark, sf_dir)
    before = rows.where(F.col("last_outcome").isNull())
    row = features.extract_features(rows, before)
    return row.select(
        "force",
        "period",
        "total_crimes",
        F.array_join("top_categories", "|").alias("top_three"),
        F.col("mom_change.previous_total").alias("previous_total"),
        F.col("mom_change.absolute").alias("absolute"),
        F.col("mom_change.pct").alias("pct"),
        F.col("mom_change.direction").alias("direction"),
    )


@query
def prompt_versions(spark, sf_dir):
    """Length of the instructions and of the text per prompt version."""
    rows = features.feature_rows(gapped_rows(spark, sf_dir))
    found = None
    for version in narrative.VERSIONS:
        made = narrative.prompts(rows, version)
        own = made.select(F.lit(version).alias("version"), "force", "period", F.length("system_text").alias("system_length"))
        found = own if found is None else found.unionByName(own)
    return found


@query
def rows_left_out(spark, sf_dir):
    return features.left_out(gapped_rows(spark, sf_dir))


@query
def gate_require_rows(spark, sf_dir):
    return quality.require_min_rows(cleaned(spark, sf_dir), "staging", 1000)


@query
def prompt_user_text(spark, sf_dir):
    rows = features.feature_rows(report_rows(spark, sf_dir))
    return narrative.prompts(rows).select("force", "period", "user_text")


@query
def report_header_text(spark, sf_dir):
    rows = features.feature_rows(report_rows(spark, sf_dir))
    return rows.select("force", "period", narrative.header_lines().alias("header"))


@query
def report_json(spark, sf_dir):
    rows = features.feature_rows(report_rows(spark, sf_dir))
    # The prompt stands in for the narrative that a text model returns.
    narratives = rows.withColumn("report", narrative.user_text())
    written = F.lit("2026-03-05 06:00:00").cast("timestamp_ntz")
    return narratives.select("force", "period", narrative.report_json(written).alias("json"))


@query
def safe_stems(spark, sf_dir):
    pairs = cleaned(spark, sf_dir).select("last_outcome", "month").distinct()
    return pairs.select(
        "last_outcome", "month", safe_stem(F.col("last_outcome"), F.col("month")).alias("stem")
    )


# -- incremental load -----------------------------------------------------------------------------


def _keyed(spark, sf_dir):
    return (
        raw_incidents(spark, sf_dir)
        .where(F.col("month").isNotNull())
        .select(
            blank_to_null(F.col("crime_id")).alias("crime_id"),
            "month",
            F.trim("force").alias("force"),
            "crime_type",
            "lsoa_code",
            "_loaded_at",
        )
    )


def _loaded_and_batch(rows):
    return rows.where(F.col("month") <= LOADED_UP_TO), rows.where(F.col("month") >= BATCH_FROM)


@query
def incremental_new_rows(spark, sf_dir):
    loaded, batch = _loaded_and_batch(_keyed(spark, sf_dir).drop("_loaded_at"))
    return new_rows(batch, loaded)


@query
def incremental_reload_null_ids(spark, sf_dir):
    """Rows per month after everything has been loaded twice: only rows without an ID come again."""
    batch = _keyed(spark, sf_dir).select(*ROW_KEY)
    again = new_rows(batch, batch)
    total = batch.select("month", "crime_id").unionByName(again.select("month", "crime_id"))
    return total.groupBy("month").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("crime_id").alias("keyed_rows")
    )


@query
def load_counts(spark, sf_dir):
    """What each load of a month adds, and how many of its rows have no ID."""
    return _keyed(spark, sf_dir).groupBy("force", "month").agg(
        F.count(F.lit(1)).alias("inserted"), F.count_if(F.col("crime_id").isNull()).alias("keyless")
    )


@query
def warehouse_loads(spark, sf_dir):
    """Three loads into tables of their own: the first months, a batch that overlaps them, and that batch again. What each
    load counted while it wrote, and how many rows of it are stored."""
    name = uuid.uuid4().hex[:12]
    house = Warehouse(spark, f"{shared_dir(spark).rstrip('/')}/warehouse-{name}", f"q{name}_", buckets=1)
    house.initialise()
    rows = raw_incidents(spark, sf_dir).where(F.col("month").isNotNull())
    rows = rows.withColumns(
        {"crime_id": blank_to_null(F.col("crime_id")), "force": F.trim("force"), "_loaded_at": F.col("_loaded_at").cast("timestamp")}
    )
    first, batch = _loaded_and_batch(rows)
    loads = [house.load(first, "first"), house.load(batch, "second"), house.load(batch, "third")]
    counted = spark.createDataFrame([(load.load_id, load.inserted, load.keyless) for load in loads], "load_id string, inserted bigint, keyless bigint")
    return counted.join(house.raw().groupBy("load_id").agg(F.count(F.lit(1)).alias("stored")), "load_id")


def _mark_log(spark, sf_dir):
    """One mark per force and month, set when the last row of the month was loaded; each force has an end of its own."""
    end = F.concat((F.lit(1994) + F.length("force") % 7).cast("string"), F.lit("-12"))
    loaded = _keyed(spark, sf_dir).where(F.col("month") <= F.greatest(end, F.lit("1996-06")))
    return loaded.groupBy("force", "month").agg(F.max("_loaded_at").alias("updated_at"))


@query
def latest_watermark(spark, sf_dir):
    latest = marks.latest_marks(_mark_log(spark, sf_dir))
    return latest.withColumn("updated_at", F.col("updated_at").cast("string"))


@query
def pending_months(spark, sf_dir):
    latest = marks.latest_marks(_mark_log(spark, sf_dir))
    end = cleaned(spark, sf_dir).agg(F.max("month")).scalar()
    pending = marks.pending_months(latest, end)
    return pending.withColumn("previous", months.previous_month(F.col("month")))


@query
def marks_after_gates(spark, sf_dir):
    """New mark of each force when every so many months one was held back: the last before the first gap."""
    pairs = _keyed(spark, sf_dir).groupBy("force", "month").agg(F.count(F.lit(1)).alias("n"))
    held = months.month_number(F.col("month")) % (F.length("force") + 7) == 0
    status = pairs.select("force", "month", F.when(held, marks.HELD).otherwise(marks.LOADED).alias("status"))
    none = status.select("force", "month").limit(0)
    return marks.advanced_marks(none, status)


@query
def target_month(spark, sf_dir):
    runs = table(spark, sf_dir, "events").select(F.to_date("ts").alias("run_date"))
    return runs.groupBy(
        F.col("run_date").cast("string").alias("run_date"),
        months.target_month(F.col("run_date")).alias("target_month"),
    ).agg(F.count(F.lit(1)).alias("events"))


@query
def partition_listing(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    store = rows.select(
        F.split_part("month", F.lit("-"), F.lit(1)).alias("part_year"),
        F.split_part("month", F.lit("-"), F.lit(2)).alias("part_month"),
        "force",
    )
    return list_partitions(store)


# -- quality gates --------------------------------------------------------------------------------


def _models(spark, sf_dir):
    raw = raw_incidents(spark, sf_dir)
    counts = incident_cube(clean(raw))
    return {
        "staging": stage(raw),
        "by_category": marts.by_category(counts),
        "by_month": marts.by_month(counts),
        "by_force": marts.by_force(counts),
        "hotspots": marts.hotspots(clean(raw)),
    }


@query
def gate_not_null(spark, sf_dir):
    return quality.rule_failures(_models(spark, sf_dir), quality.NOT_NULL_RULES)


@query
def gate_accepted_values(spark, sf_dir):
    return quality.rule_failures(_models(spark, sf_dir), quality.ACCEPTED_RULES)


@query
def gate_min_rows(spark, sf_dir):
    return quality.row_counts(cleaned(spark, sf_dir), ["force", "month"], minimum=120)


@query
def gate_loaded_pairs(spark, sf_dir):
    """Months of the batch, per force, that a table loaded up to a cut does not have."""
    loaded, batch = _loaded_and_batch(_keyed(spark, sf_dir))
    return quality.missing_pairs(batch.select("force", "month").distinct(), loaded)


@query
def gate_month_format(spark, sf_dir):
    """Months with a letter in front: everywhere in one force, in part of two others."""
    wrong = F.concat(F.lit("M"), F.col("month"))
    number = F.length("location")
    affected = (
        (F.col("force") == "europe")
        | ((F.col("force") == "asia") & (number % 2 == 0))
        | ((F.col("force") == "africa") & (F.col("crime_type") == "Drugs") & (number % 2 == 0))
    )
    rows = cleaned(spark, sf_dir).withColumn("month", F.when(affected, wrong).otherwise(F.col("month")))
    return quality.month_format(rows, by=["force"])


@query
def gate_dropped_rows(spark, sf_dir):
    return quality.dropped_rows(raw_incidents(spark, sf_dir), by=["falls_within"])
