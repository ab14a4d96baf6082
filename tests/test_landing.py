"""Landing store: keys, skipping, listing, pruned reads."""

from pathlib import Path

from pyspark.sql import functions as F

from tests.conftest import sample_rows, write_csv
from wardline.functions.text import partition_key
from wardline.sources.incident_files import discover_files, to_raw
from wardline.sources.landing import land, list_files, list_partitions, read_landed


def _inbox(tmp_path, *months):
    for month in months:
        write_csv(tmp_path / "in" / f"{month}-west-yorkshire-street.csv", sample_rows(month))
    return str(tmp_path / "in")


def test_landing_is_keyed_and_idempotent(spark, tmp_path):
    store = str(tmp_path / "store")
    assert list_files(spark, store) is None
    assert land(discover_files(spark, _inbox(tmp_path, "2026-02")), store) == 1
    assert land(discover_files(spark, _inbox(tmp_path, "2026-02")), store) == 0
    assert land(discover_files(spark, _inbox(tmp_path, "2026-02", "2026-03")), store) == 1
    folder = Path(store) / "part_year=2026" / "part_month=02" / "force=west-yorkshire"
    assert (folder / "source_file=2026-02-west-yorkshire-street.csv").is_dir()
    assert read_landed(spark, store).count() == 6
    listed = [tuple(r) for r in list_partitions(list_files(spark, store)).collect()]
    assert listed == [("2026", "02", "west-yorkshire"), ("2026", "03", "west-yorkshire")]


def test_landed_rows_keep_their_month_and_are_pruned(spark, tmp_path):
    store = str(tmp_path / "store")
    land(discover_files(spark, _inbox(tmp_path, "2026-02", "2026-03")), store)
    rows = read_landed(spark, store, "west-yorkshire", "2026-02")
    assert {r["Month"] for r in rows.collect()} == {"2026-02"}
    assert {r["part_month"] for r in rows.collect()} == {"02"}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(name in filters for name in ("part_year", "part_month", "force"))
    assert read_landed(spark, store, "metropolitan", "2026-02").count() == 0


def test_partition_key(spark):
    row = spark.range(1).select(
        partition_key(F.lit("crime"), F.lit("2026-02"), F.lit("west-yorkshire"), F.lit("a.csv")).alias("k")
    )
    assert row.first()["k"] == "crime/part_year=2026/part_month=02/force=west-yorkshire/source_file=a.csv"


def test_loading_one_landed_month(warehouse, tmp_path):
    spark, store = warehouse.spark, str(tmp_path / "store")
    land(discover_files(spark, _inbox(tmp_path, "2026-02", "2026-03")), store)
    landed = read_landed(spark, store, "west-yorkshire", "2026-02")
    assert warehouse.load(to_raw(landed, F.col("force")), "feb").inserted == 3
    assert {r["month"] for r in warehouse.raw().collect()} == {"2026-02"}
