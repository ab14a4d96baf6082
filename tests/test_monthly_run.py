"""The monthly run and the continuous load, end to end on files."""

import os
import uuid

import pytest

from tests.conftest import sample_rows, write_csv
from wardline.operators.quality import GateError, Rule
from wardline.plans.monthly import plan_months, run_monthly
from wardline.sources.landing import read_landed
from wardline.sources.warehouse import MART_NAMES, STAGING_VIEW, Warehouse
from wardline.streaming.landing_stream import load_new_files

FORCES = ("west-yorkshire", "greater-manchester")


def put(tmp_path, force, month, copies=40, ids=""):
    write_csv(tmp_path / "inbox" / f"{month}-{force}-street.csv", sample_rows(month, copies, ids))


def run(warehouse, tmp_path, through, load_id, **kwargs):
    folders = (str(tmp_path / "inbox"), str(tmp_path / "landing"))
    return run_monthly(warehouse, *folders, through, load_id, forces=FORCES, **kwargs)


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def test_run_loads_gates_and_advances(warehouse, tmp_path):
    assert not warehouse.ready()
    put(tmp_path, "west-yorkshire", "2026-01")
    put(tmp_path, "greater-manchester", "2026-01", copies=5)
    first = run(warehouse, tmp_path, "2026-01", "jan")
    assert first.loaded == [("west-yorkshire", "2026-01")]
    assert "under 100 rows" in first.held_back["greater-manchester", "2026-01"]
    assert (first.load.inserted, first.load.keyless) == (120, 40)
    assert warehouse.ready()
    assert warehouse.mark("west-yorkshire") == "2026-01" and warehouse.mark("greater-manchester") is None

    # Two months on: one force has both, the other one of them and a month that was held back.
    put(tmp_path, "west-yorkshire", "2026-02")
    put(tmp_path, "west-yorkshire", "2026-03")
    put(tmp_path, "greater-manchester", "2026-03")
    planned = sorted(map(tuple, plan_months(warehouse, "2026-03", FORCES).collect()))
    assert planned == [
        ("greater-manchester", "2026-01"),
        ("greater-manchester", "2026-02"),
        ("greater-manchester", "2026-03"),
        ("west-yorkshire", "2026-02"),
        ("west-yorkshire", "2026-03"),
    ]
    second = run(warehouse, tmp_path, "2026-03", "mar")
    assert set(second.held_back) == {("greater-manchester", "2026-01"), ("greater-manchester", "2026-02")}
    assert len(second.loaded) == 3
    assert warehouse.mark("west-yorkshire") == "2026-03" and warehouse.mark("greater-manchester") is None
    assert warehouse.raw().count() == 480
    assert warehouse.mart("by_month").agg({"total_crimes": "sum"}).first()[0] == 480

    # Marts grown month by month equal marts built anew.
    grown = {name: rows_of(warehouse.mart(name)) for name in MART_NAMES}
    warehouse.refresh_marts()
    assert grown == {name: rows_of(warehouse.mart(name)) for name in MART_NAMES}
    warehouse.create_staging_view()
    assert warehouse.spark.table(STAGING_VIEW).count() == 480

    # Nothing that has a good file is pending now.
    third = run(warehouse, tmp_path, "2026-03", "again")
    assert third.load is None and third.loaded == []


def test_month_that_comes_late_is_loaded_and_no_month_twice(warehouse, tmp_path):
    for month in ("2026-01", "2026-03"):
        put(tmp_path, "west-yorkshire", month)
    first = run(warehouse, tmp_path, "2026-03", "mar", start="2026-01")
    assert first.loaded == [("west-yorkshire", "2026-01"), ("west-yorkshire", "2026-03")]
    assert first.held_back["west-yorkshire", "2026-02"] == "no file"
    assert warehouse.mark("west-yorkshire") == "2026-01" and warehouse.mark("greater-manchester") is None
    put(tmp_path, "west-yorkshire", "2026-04")
    second = run(warehouse, tmp_path, "2026-04", "apr")
    assert ("west-yorkshire", "2026-04") in second.loaded and warehouse.mark("west-yorkshire") == "2026-01"
    put(tmp_path, "west-yorkshire", "2026-02")
    third = run(warehouse, tmp_path, "2026-04", "late")
    assert third.loaded == [("west-yorkshire", "2026-02")]
    assert warehouse.mark("west-yorkshire") == "2026-04"
    assert {r["month"]: r["count"] for r in warehouse.raw().groupBy("month").count().collect()} == dict.fromkeys(
        ("2026-01", "2026-02", "2026-03", "2026-04"), 120
    )
    grown = {name: rows_of(warehouse.mart(name)) for name in MART_NAMES}
    warehouse.refresh_marts()
    assert grown == {name: rows_of(warehouse.mart(name)) for name in MART_NAMES}
    # What a new force was refused at first stays planned as well.
    put(tmp_path, "greater-manchester", "2026-02")
    assert run(warehouse, tmp_path, "2026-04", "gm").loaded == [("greater-manchester", "2026-02")]


def test_rules_read_only_the_months_that_changed(warehouse, tmp_path):
    for month in ("2026-01", "2026-02"):
        put(tmp_path, "west-yorkshire", month)
    run(warehouse, tmp_path, "2026-02", "feb", start="2026-01")
    plan = warehouse.models(["2026-02"])["staging"]._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "month" in filters and "2026-02" in filters


def test_failed_column_test_moves_no_mark_and_repeat_is_safe(warehouse, tmp_path):
    put(tmp_path, "west-yorkshire", "2026-01")
    put(tmp_path, "greater-manchester", "2026-01")
    with pytest.raises(GateError, match="staging.force accepted_values: 240"):
        run(warehouse, tmp_path, "2026-01", "jan", rules=(Rule("staging", "force", ("nowhere",)),))
    assert warehouse.marks().count() == 0 and warehouse.raw().count() == 240
    repeated = run(warehouse, tmp_path, "2026-01", "jan")
    assert len(repeated.loaded) == 2 and warehouse.raw().count() == 240


def test_month_loaded_before_is_held_back(warehouse, tmp_path):
    keyed = [row for row in sample_rows("2026-01", 60) if row.get("Crime ID")]
    write_csv(tmp_path / "inbox" / "2026-01-west-yorkshire-street.csv", keyed)
    run(warehouse, tmp_path, "2026-01", "jan")
    warehouse.reload_after("west-yorkshire", "2025-12")
    repeated = run(warehouse, tmp_path, "2026-01", "other")
    assert repeated.held_back["west-yorkshire", "2026-01"] == "no new rows"
    assert repeated.held_back["greater-manchester", "2026-01"] == "no file"
    assert warehouse.mark("west-yorkshire") == "2025-12"


def test_stream_takes_each_file_once(warehouse, tmp_path):
    inbox, checkpoint = str(tmp_path / "inbox"), str(tmp_path / "checkpoint")

    def drain():
        load_new_files(warehouse, inbox, checkpoint).awaitTermination()
        return warehouse.raw().count()

    put(tmp_path, "west-yorkshire", "2026-01", copies=2)
    assert drain() == 6
    assert drain() == 6
    put(tmp_path, "greater-manchester", "2026-01", copies=1)
    assert drain() == 9
    loads = {r["force"]: r["load_id"] for r in warehouse.raw().select("force", "load_id").distinct().collect()}
    first, second = loads["west-yorkshire"], loads["greater-manchester"]
    assert first.endswith("-0") and second.endswith("-1")
    assert first[:-2] == second[:-2] and "None" not in first


def test_stream_stores_the_same_rows_for_any_batch_size(spark, tmp_path):
    rows = sample_rows("2026-01", 2)
    for k in range(3):
        path = tmp_path / "inbox" / f"{k} 2026-01-west-yorkshire-street.csv"
        write_csv(path, rows[: 6 - k])
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    stored = []
    for size in (1, 1000):
        house = Warehouse(spark, str(tmp_path / f"tables{size}"), f"s{size}_{uuid.uuid4().hex[:6]}_")
        house.initialise()
        load_new_files(house, str(tmp_path / "inbox"), str(tmp_path / f"check{size}"), max_files=size).awaitTermination()
        stored.append(rows_of(house.raw().drop("_loaded_at", "load_id")))
    assert stored[0] == stored[1] and len(stored[0]) == 4 + 2 + 1 + 1


def test_awkward_file_goes_through_a_run(warehouse, tmp_path):
    """Latin-1, line breaks in a field, leading blanks, a name with blanks; a ragged file is held back."""
    rows = [{**row, "Location": ' é "x"\nyard'} for row in sample_rows("2026-01", 40)]
    write_csv(tmp_path / "inbox" / "new 2026-01 west-yorkshire street.csv", rows, encoding="iso-8859-1")
    ragged = write_csv(tmp_path / "inbox" / "2026-01-greater-manchester-street.csv", sample_rows("2026-01", 40))
    with open(ragged, "a", newline="") as file:
        file.write("short\r\n")
    done = run(warehouse, tmp_path, "2026-01", "jan")
    assert done.loaded == [("west-yorkshire", "2026-01")] and "1 malformed rows" in done.held_back["greater-manchester", "2026-01"]
    assert {r["location"] for r in warehouse.raw().collect()} == {' é "x"\nyard'} and warehouse.raw().count() == 120
    landed = read_landed(warehouse.spark, str(tmp_path / "landing"), "west-yorkshire", "2026-01")
    assert {r["Location"] for r in landed.collect()} == {' é "x"\nyard'} and landed.count() == 120


def test_same_load_id_keeps_months_it_does_not_write(warehouse, tmp_path):
    """A force fixed after the others were loaded is added under the same name without harm."""
    put(tmp_path, "west-yorkshire", "2026-01")
    put(tmp_path, "greater-manchester", "2026-01", copies=5)
    run(warehouse, tmp_path, "2026-01", "jan")
    put(tmp_path, "greater-manchester", "2026-01")
    fixed = run(warehouse, tmp_path, "2026-01", "jan")
    assert fixed.loaded == [("greater-manchester", "2026-01")] and fixed.load.inserted == 120
    assert warehouse.raw().count() == 240
    assert warehouse.mart("by_month").agg({"total_crimes": "sum"}).first()[0] == 240
