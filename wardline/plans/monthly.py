"""The monthly run: find pending files, gate, land, load, gate, rebuild, test, advance the marks.

All forces and months go through each step together. A force-month that fails a gate is held back
with the reason and stays pending: its force's mark goes no further than the month before it, whatever
later months are loaded, and those are not loaded twice. A file that cannot be used is held back like any other;
the rest is loaded. Failing column tests, which look at the months that changed, stop the run, and
nothing of it is published.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.months import previous_month
from wardline.operators.quality import RULES, Rule, missing_pairs, require_rules
from wardline.schema import FORCES, MIN_FILE_ROWS
from wardline.sources.incident_files import discover_files, force_of, judge, standard_rows, to_raw
from wardline.sources.landing import land
from wardline.sources.marks import HELD, LOADED, pending_months
from wardline.sources.records import scan
from wardline.sources.warehouse import Load, Warehouse


@dataclass
class MonthlyRun:
    load: Load | None = None
    loaded: list[tuple[str, str]] = field(default_factory=list)
    held_back: dict[tuple[str, str], str] = field(default_factory=dict)


def plan_months(
    warehouse: Warehouse, through: str, forces: tuple[str, ...] = FORCES, start: str | None = None
) -> DataFrame:
    """(force, month) to load, up to through: months after each mark and months held back before.

    A force without a mark gets the months from the first one that was planned for it before, else from start
    on (start included), else only through. Months that are loaded already, beyond a gap, are left out.
    """
    spark = warehouse.spark
    keys = ["force", "month"]
    # One row per force.
    wanted = spark.createDataFrame([(force,) for force in forces], "force string")
    marked = warehouse.marks().select(*keys)
    status = warehouse.month_status().join(wanted, "force").where(F.col("month") <= through)
    unmarked = wanted.join(marked, "force", "left_anti")
    tried = status.groupBy("force").agg(F.min("month").alias("tried"))
    first = F.least("tried", F.lit(through if start is None else start))
    unmarked = unmarked.join(tried, "force", "left").select("force", previous_month(first).alias("month"))
    begun = wanted.join(marked, "force").unionByName(unmarked)
    held = status.where(F.col("status") == HELD).select(*keys)
    planned = pending_months(begun, through).unionByName(held).distinct()
    return planned.join(status.where(F.col("status") == LOADED), keys, "left_anti")


def run_monthly(
    warehouse: Warehouse,
    inbox: str,
    landing: str,
    through: str,
    load_id: str,
    forces: tuple[str, ...] = FORCES,
    min_rows: int = MIN_FILE_ROWS,
    rules: tuple[Rule, ...] = RULES,
    start: str | None = None,
) -> MonthlyRun:
    """Load every pending month that has a file in the inbox; start is where a new force begins.

    Rows, marts, months and marks of a run are published together at its end. A run that fails before leaves all as
    it was, but for the files it landed, and is simply run again.
    """
    with warehouse.publication() as house:
        return _run(house, inbox, landing, through, load_id, forces, min_rows, rules, start)


def _run(
    warehouse: Warehouse,
    inbox: str,
    landing: str,
    through: str,
    load_id: str,
    forces: tuple[str, ...],
    min_rows: int,
    rules: tuple[Rule, ...],
    start: str | None,
) -> MonthlyRun:
    spark, run = warehouse.spark, MonthlyRun()
    keys = ["force", "month"]
    planned = plan_months(warehouse, through, forces, start)
    # One row per pending file or pair: forces x months at most.
    found = planned.join(discover_files(spark, inbox, forces), keys, "left").collect()
    for row in found:
        if row["path"] is None:
            run.held_back[row["force"], row["month"]] = "no file"
    files = [row for row in found if row["path"]]
    if not files:
        _log(warehouse, run)
        return run

    seen = scan(spark, [row["path"] for row in files])
    verdicts = judge(seen, [(row["source_path"], row["file_name"]) for row in files], min_rows)
    warehouse.note_files([(row["source_path"], row["file_name"], row["force"], row["month"], *verdicts[row["source_path"]]) for row in files], load_id)
    for row in files:
        if reason := verdicts[row["source_path"]][1]:
            run.held_back[row["force"], row["month"]] = reason
    # Of several loosely named files of a month, one that is held back holds the month back.
    good = [row for row in files if (row["force"], row["month"]) not in run.held_back]
    if not good:
        _log(warehouse, run)
        return run

    chosen = spark.createDataFrame(good, "force string, month string, path string, source_path string, file_name string")
    land(chosen, landing, forces, seen)
    rows = standard_rows(seen, chosen.select("source_path"))
    batch = to_raw(rows, force_of(F.col("source_file"), forces), keep=["source_path"])
    run.load = warehouse.load(batch, load_id, file_order="source_path")

    # A pair needs new rows in this load, and rows in the table.
    attempted = sorted({(row["force"], row["month"]) for row in good})
    pairs = spark.createDataFrame(attempted, "force string, month string")
    for pair in missing_pairs(pairs, warehouse.loaded(load_id)).collect():
        run.held_back[pair["force"], pair["month"]] = "no new rows"
    run.loaded = sorted(pair for pair in attempted if pair not in run.held_back)

    changed = [row["month"] for row in warehouse.loaded(load_id).select("month").distinct().collect()]
    warehouse.grow_marts(load_id)
    require_rules(warehouse.models(changed), rules)
    _log(warehouse, run)
    warehouse.advance_marks()
    return run


def _log(warehouse: Warehouse, run: MonthlyRun) -> None:
    """Remember every planned month, also those held back, so that none is lost behind a mark."""
    entries = [(*pair, LOADED) for pair in run.loaded] + [(*pair, HELD) for pair in run.held_back]
    warehouse.log_months(sorted(entries))
