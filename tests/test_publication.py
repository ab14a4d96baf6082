"""Publication as a whole, conflicts, the key table, growing marts, held-back files and half-way copies."""

import os
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import sample_rows, write_csv
from wardline.operators.incremental import repeated_keys
from wardline.plans import monthly
from wardline.plans.monthly import run_monthly
from wardline.schema import ROW_KEY
from wardline.sources import landing, versions
from wardline.sources.incident_files import discover_files, read_files, to_raw
from wardline.sources.landing import land, read_landed
from wardline.sources.versions import ConflictError, Versions
from wardline.sources.warehouse import MART_NAMES, Warehouse
from wardline.streaming.landing_stream import load_new_files

FORCES = ("west-yorkshire", "greater-manchester")


def put(tmp_path, force, month, copies=40, **changes):
    rows = [{**row, **changes} for row in sample_rows(month, copies)]
    return write_csv(tmp_path / "inbox" / f"{month}-{force}-street.csv", rows)


def run(warehouse, tmp_path, through, load_id, **kwargs):
    return run_monthly(warehouse, str(tmp_path / "inbox"), str(tmp_path / "landing"), through, load_id, forces=FORCES, **kwargs)


def shown(warehouse):
    """All that readers see."""
    out = {name: sorted(map(str, warehouse.mart(name).collect())) for name in MART_NAMES}
    out["raw"] = sorted(map(str, warehouse.raw().collect()))
    out["keys"] = sorted(map(str, warehouse.keys().select(*ROW_KEY).collect()))
    out["marks"] = sorted(map(str, warehouse.marks().collect()))
    out["status"] = sorted(map(str, warehouse.month_status().collect()))
    return out


class Stop(RuntimeError):
    pass


STEPS = [(monthly, "land"), (Warehouse, "load"), (Warehouse, "grow_marts"), (monthly, "require_rules"), (Versions, "publish")]


def test_a_run_that_dies_anywhere_changes_nothing(warehouse, tmp_path, monkeypatch):
    put(tmp_path, "west-yorkshire", "2026-01")
    run(warehouse, tmp_path, "2026-01", "jan")
    before = shown(warehouse)
    put(tmp_path, "west-yorkshire", "2026-02", Location="new")
    for where, name in STEPS:

        def broken(*args, _name=name, **kwargs):
            raise Stop(_name)

        with monkeypatch.context() as patch:
            patch.setattr(where, name, broken)
            with pytest.raises(Stop, match=name):
                run(warehouse, tmp_path, "2026-02", "feb")
        assert warehouse.raw().count() == 120 and warehouse.mark("west-yorkshire") == "2026-01"
    assert shown(warehouse) == before
    done = run(warehouse, tmp_path, "2026-02", "feb")
    assert done.loaded == [("west-yorkshire", "2026-02")] and done.load.inserted == 120
    assert warehouse.raw().count() == 240 and warehouse.mark("west-yorkshire") == "2026-02"
    assert warehouse.mart("by_month").agg({"total_crimes": "sum"}).first()[0] == 240


def test_of_two_jobs_at_once_one_is_refused(warehouse, spark):
    marks = lambda month: spark.createDataFrame([("north", month)], "force string, month string")
    warehouse.set_marks(marks("2026-01"))
    with pytest.raises(ConflictError), warehouse.publication() as slow:
        slow.set_marks(marks("2026-02"))
        warehouse.set_marks(marks("2026-03"))
        assert slow.mark("north") == "2026-02" and warehouse.mark("north") == "2026-03"
    assert warehouse.mark("north") == "2026-03"


def test_renaming_onto_a_version_is_refused(spark, tmp_path, monkeypatch):
    """The check before the rename is not what guards it."""
    store = Versions(spark, str(tmp_path / "v"))
    assert store.publish(0, {"a": 1}) == 1
    monkeypatch.setattr(Versions, "numbers", lambda self: [])
    with pytest.raises(ConflictError):
        store.publish(0, {"a": 2})
    monkeypatch.undo()
    assert store.newest() == (1, {"a": 1})


def test_states_stay_few(warehouse, spark, tmp_path):
    folder = Path(warehouse._versions().folder.removeprefix("file:"))
    for k in range(100):
        warehouse._set_marks([("north", f"20{k:02d}-01"), ("south", "2020-01")])
    assert len([name for name in os.listdir(folder) if name.endswith(".json")]) == versions.KEEP
    assert warehouse.mark("north") == "2099-01" and warehouse.mark("south") == "2020-01"


def test_outdated_parts_are_dropped(warehouse, tmp_path):
    put(tmp_path, "west-yorkshire", "2026-01")
    run(warehouse, tmp_path, "2026-01", "jan")
    for _ in range(versions.KEEP + 2):
        warehouse.refresh_marts()
    parts = warehouse.spark.sql(f"SHOW PARTITIONS {warehouse._name('marts', 'by_month')}").count()
    assert parts == versions.KEEP and warehouse.mart("by_month").count() == 1
    assert warehouse.raw().count() == 120 and warehouse.keys().count() == 80


def test_stored_keys_are_not_moved_by_a_load(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "tables"), "bucketed_", buckets=8)
    house.initialise()
    path = put(tmp_path, "west-yorkshire", "2026-01")
    house.load(to_raw(read_files(spark, path)), "jan")
    assert house.keys().count() == 80
    again = to_raw(read_files(spark, path))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    try:
        found = repeated_keys(again.where("crime_id is not null"), house.keys().where(F.col("key_month").isin(["2026-01"])))
        assert found.count() == 80
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for name in names:
            spark.conf.unset(name)
    lines = plan.splitlines()
    depths = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    stored = next(k for k, line in enumerate(lines) if "FileScan" in line and "incident_keys" in line)
    above, depth = [], depths[stored]
    for k in range(stored - 1, -1, -1):
        if depths[k] < depth:
            above.append(lines[k])
            depth = depths[k]
            if "Join" in lines[k]:
                break
    assert "Join" in above[-1] and not any("Exchange" in line for line in above), plan
    assert "Bucketed: true" in plan


def test_grown_marts_equal_rebuilt_ones_in_any_order(warehouse, tmp_path):
    draw = random.Random(4)
    batches = []
    for k in range(5):
        month = draw.choice(["2026-01", "2026-02"])
        rows = [{**row, "Latitude": draw.choice(["53.1", "", "53.999999", "x"]), "LSOA code": draw.choice(["A", "B"]), "Crime type": draw.choice(["Drugs", "Robbery"]), "Crime ID": f"{k}-{n}"} for n, row in enumerate(sample_rows(month, 4))]
        batches.append(write_csv(tmp_path / str(k) / f"{month}-{draw.choice(FORCES)}-street.csv", rows))
    draw.shuffle(batches)
    for k, path in enumerate([*batches, batches[0]]):
        load_id = f"load{min(k, 4)}"  # the last one repeats a load's name with another batch of files, and replaces it
        warehouse.load(to_raw(read_files(warehouse.spark, path)), load_id)
        warehouse.grow_marts(load_id)
    grown = {name: sorted(map(str, warehouse.mart(name).collect())) for name in MART_NAMES}
    warehouse.refresh_marts()
    assert grown == {name: sorted(map(str, warehouse.mart(name).collect())) for name in MART_NAMES}


def test_growing_reads_the_rows_of_the_load_alone(warehouse, tmp_path, monkeypatch):
    for month in ("2026-01", "2026-02"):
        warehouse.load(to_raw(read_files(warehouse.spark, put(tmp_path, "west-yorkshire", month))), month)
    warehouse.refresh_marts()
    warehouse.load(to_raw(read_files(warehouse.spark, put(tmp_path, "greater-manchester", "2026-02"))), "late")
    plans = []
    real = Warehouse._rebuild
    monkeypatch.setattr(Warehouse, "_rebuild", lambda self, cube, areas, *args: (plans.append((cube, areas)), real(self, cube, areas, *args)))
    warehouse.grow_marts("late")
    for frame in plans[0]:
        files = [name for name in frame.inputFiles() if "/incidents/" in name]
        assert files and all("force=greater-manchester" in name for name in files)


def test_one_bad_file_holds_back_itself_only(warehouse, tmp_path):
    for k in range(1, 10):
        put(tmp_path, "west-yorkshire", f"2026-{k:02d}")
    bad = tmp_path / "inbox" / "2026-04-west-yorkshire-street.csv"
    bad.write_bytes(bytes(range(256)) * 100)
    write_csv(tmp_path / "inbox" / "2026-05-west-yorkshire-street.csv", sample_rows("2026-05", 40), encoding="utf-8-sig")
    done = run(warehouse, tmp_path, "2026-09", "all", start="2026-01")
    assert len([pair for pair in done.loaded if pair[0] == "west-yorkshire"]) == 8
    assert "header is" in done.held_back["west-yorkshire", "2026-04"]
    noted = {r["file_name"]: (r["row_count"], r["reason"]) for r in warehouse.file_verdicts().collect()}
    assert len(noted) == 9 and noted["2026-05-west-yorkshire-street.csv"] == (120, None)
    assert warehouse.mark("west-yorkshire") == "2026-03" and warehouse.raw().count() == 960


def test_a_copy_that_died_is_made_again(spark, tmp_path, monkeypatch):
    put(tmp_path, "west-yorkshire", "2026-01")
    store, files = str(tmp_path / "store"), discover_files(spark, str(tmp_path / "inbox"))
    half = f"{store}/part_year=2026/part_month=01/force=west-yorkshire/source_file=2026-01-west-yorkshire-street.csv"
    spark.range(5).selectExpr("cast(id as string)").write.csv(half)
    assert read_landed(spark, store).count() == 0 and landing.list_files(spark, store) is None
    assert land(files, store) == 1 and read_landed(spark, store).count() == 120
    assert land(files, store) == 0


def test_stream_has_the_gates_of_the_run(warehouse, tmp_path, monkeypatch):
    """Latin-1 is loaded; ragged, short and foreign files are held back with the run's reasons; a batch that died is repeated."""
    inbox = tmp_path / "inbox"
    write_csv(inbox / "2026-01-west-yorkshire-street.csv", [{**r, "Location": "é"} for r in sample_rows("2026-01", 40)], encoding="iso-8859-1")
    with open(put(tmp_path, "west-yorkshire", "2026-02"), "a") as file:
        file.write("short\n")
    put(tmp_path, "west-yorkshire", "2026-03", copies=2)
    (inbox / "2026-04-west-yorkshire-street.csv").write_bytes(b"\x00\xff" * 99)
    write_csv(inbox / "street-of-no-force.csv", sample_rows("2026-01", 40))

    def drain():
        load_new_files(warehouse, str(inbox), str(tmp_path / "checkpoint"), min_rows=100).awaitTermination()

    with monkeypatch.context() as patch:
        patch.setattr(Versions, "publish", lambda *args: (_ for _ in ()).throw(Stop("publish")))
        with pytest.raises(Exception, match="publish"):
            drain()
    assert warehouse.raw().count() == 0
    drain()
    assert warehouse.raw().count() == 120 and {r["location"] for r in warehouse.raw().collect()} == {"é"}
    stream = {r["file_name"]: r["reason"] for r in warehouse.file_verdicts().collect()}
    assert len(stream) == 5 and warehouse.file_verdicts().count() == 5
    other = run_monthly(warehouse, str(inbox), str(tmp_path / "landing"), "2026-04", "run", FORCES, start="2026-02")
    for month in ("2026-02", "2026-03", "2026-04"):
        assert stream[f"{month}-west-yorkshire-street.csv"] == other.held_back["west-yorkshire", month]
    assert re.search("no force and month", stream["street-of-no-force.csv"])
    put(tmp_path, "greater-manchester", "2026-01")
    drain()
    assert warehouse.raw().count() == 240
