"""Reading incident files and loading them into the raw table."""

import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import sample_rows, write_csv
from wardline.operators import incremental
from wardline.operators.quality import file_verdicts
from wardline.schema import CATEGORIES, RAW_COLUMNS
from wardline.session import written
from wardline.sources.incident_files import MALFORMED, discover_files, read_files, to_raw
from wardline.sources.warehouse import Warehouse


def load(warehouse, path, force, load_id):
    return warehouse.load(to_raw(read_files(warehouse.spark, path), force), load_id)


def test_first_load_inserts_every_row(warehouse, sample_csv):
    result = load(warehouse, sample_csv, "west-yorkshire", "first")
    assert (result.inserted, result.keyless) == (3, 1)
    rows = warehouse.raw()
    assert rows.count() == 3
    assert [r[0] for r in rows.select("force").distinct().collect()] == ["west-yorkshire"]
    assert rows.where("crime_id is null").count() == 1
    assert rows.where("month is null or crime_type is null").count() == 0
    assert {r[0] for r in rows.select("crime_type").collect()} <= set(CATEGORIES)
    assert rows.where("_loaded_at is null").count() == 0
    place = rows.where("crime_id = 'wl-0001'").first()
    assert (place["longitude"], place["latitude"]) == (-2.5, 54.25)
    assert rows.columns == list(RAW_COLUMNS)


def test_second_load_adds_only_rows_without_id(warehouse, sample_csv):
    load(warehouse, sample_csv, "west-yorkshire", "first")
    again = load(warehouse, sample_csv, "west-yorkshire", "second")
    assert (again.inserted, again.keyless) == (1, 1)
    assert warehouse.raw().count() == 4


def test_repeating_a_batch_changes_nothing(warehouse, sample_csv):
    load(warehouse, sample_csv, "west-yorkshire", "first")
    again = load(warehouse, sample_csv, "west-yorkshire", "first")
    assert again.inserted == 3
    assert warehouse.raw().count() == 3


def test_same_file_for_two_forces(warehouse, sample_csv):
    load(warehouse, sample_csv, "west-yorkshire", "one")
    load(warehouse, sample_csv, "greater-manchester", "two")
    assert warehouse.raw().count() == 6


def test_batch_without_anything_new(warehouse, tmp_path):
    keyed = [row for row in sample_rows() if row.get("Crime ID")]
    path = write_csv(tmp_path / "k" / "2026-02-west-yorkshire-street.csv", keyed)
    load(warehouse, path, "west-yorkshire", "first")
    assert load(warehouse, path, "west-yorkshire", "second").inserted == 0
    assert warehouse.raw().count() == 2


def test_initialise_twice_keeps_rows(warehouse, sample_csv):
    load(warehouse, sample_csv, "west-yorkshire", "first")
    warehouse.initialise()
    assert warehouse.raw().count() == 3


def _keys(spark, rows):
    return spark.createDataFrame(rows, "crime_id string, month string, force string, note string")


def test_new_rows_are_those_brute_force_finds(spark):
    """Repeated keys, a hot key in the batch, rows without an ID on both sides."""
    existing = [(f"id{i % 40}", f"2026-0{i % 3 + 1}", "north", "old") for i in range(200)]
    existing += [(None, "2026-01", "north", "old")] * 20
    batch = [(f"id{i}", f"2026-0{i % 4 + 1}", "north", str(i)) for i in range(120)]
    batch += [("hot", "2026-01", "north", str(i)) for i in range(300)]
    batch += [("id0", "2026-01", "north", str(i)) for i in range(300)]
    batch += [(None, "2026-01", "north", "same")] * 50
    seen = {row[:3] for row in existing if row[0] is not None}
    expected = sorted((row for row in batch if row[:3] not in seen), key=str)
    found = incremental.new_rows(_keys(spark, batch), _keys(spark, existing))
    assert found.columns == ["crime_id", "month", "force", "note"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected
    assert any(r[0] == "hot" for r in expected) and not any(r[0] == "id0" and r[1] == "2026-01" for r in expected)


def test_files_of_a_batch_count_in_their_order(spark):
    rows = [("a", "2026-01", "n", "2"), ("a", "2026-01", "n", "1"), ("a", "2026-01", "n", "1"), ("b", "2026-01", "n", "2"), (None, "2026-01", "n", "1"), (None, "2026-01", "n", "2")]
    found = sorted((r["crime_id"] or "", r["note"]) for r in incremental.first_files(_keys(spark, rows), "note").collect())
    assert found == [("", "1"), ("", "2"), ("a", "1"), ("a", "1"), ("b", "2")]


def test_only_the_pairs_of_a_batch_are_read(spark, tmp_path):
    old = _keys(spark, [(f"id{i}", f"2026-{i % 9 + 1:02d}", f"f{i % 3}", "x" * 50) for i in range(900)])
    old.write.partitionBy("force", "month").parquet(str(tmp_path / "raw"))
    _keys(spark, [("id0", "2026-01", "f0", "new"), ("z", "2026-01", "f0", "new")]).write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    cut = incremental.of_pairs(raw, incremental.touched_pairs(batch))
    assert "dynamicpruning" in cut._jdf.queryExecution().optimizedPlan().toString()
    assert [r["crime_id"] for r in incremental.new_rows(batch, raw).collect()] == ["z"]


def test_hot_key_is_split_in_the_shuffled_join(spark):
    """A third of the rows on one key, a third without ID: the join's hot partition is divided."""
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        ids = spark.range(0, 300_000, 1, 8).withColumn("third", F.col("id") % 3)
        batch = ids.select(
            F.expr("case third when 0 then 'hot' when 1 then concat('k', id) end").alias("crime_id"),
            F.expr("concat('2026-0', third + 1)").alias("month"),
            F.lit("north").alias("force"),
            F.md5(F.col("id").cast("string")).alias("note"),
        )
        existing = batch.where("crime_id like '%1'").drop("note")
        expected = batch.where("crime_id is null or crime_id not like '%1'").count()
        found = incremental.new_rows(batch, existing).agg(
            F.count("note"), F.max("note")
        )
        assert found.collect()[0][0] == expected
        assert "SortMergeJoin(skew=true)" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_repeats_inside_a_batch_stay_unless_asked(spark):
    batch = _keys(spark, [("a", "2026-01", "n", "2"), ("a", "2026-01", "n", "1"), (None, "2026-01", "n", "3"), (None, "2026-01", "n", "3")])
    empty = batch.limit(0)
    assert incremental.new_rows(batch, empty).count() == 4
    kept = incremental.new_rows(batch, empty, dedupe_within_batch=True).collect()
    assert sorted((r["crime_id"] or "", r["note"]) for r in kept) == [("", "3"), ("", "3"), ("a", "1")]


def test_awkward_files_are_read_as_they_are(spark, tmp_path):
    """Latin-1 beside UTF-8, line breaks and quotes in a field, blanks, names with blanks, ragged rows."""
    place = 'Café  "Ü"\nback door'
    base = {"Crime ID": "x1", "Month": "2026-02", "Crime type": "Drugs"}
    for encoding, folder in (("utf-8", "a"), ("iso-8859-1", "b")):
        write_csv(tmp_path / folder / "2026-02-west-yorkshire-street.csv", [{**base, "Location": place}, {**base, "Location": " lead "}], encoding=encoding)
    write_csv(tmp_path / "c" / "copy of 2026-02 west-yorkshire 100% + street.csv", [base])
    ragged = write_csv(tmp_path / "d" / "2026-03-west-yorkshire-street.csv", [base])
    with open(ragged, "a", newline="") as file:
        file.write("one field\r\n" + ",".join("x" * 14) + "\r\n")
    rows = read_files(spark, [str(tmp_path / f) for f in "abcd"])
    found = {}
    for row in rows.collect():
        found.setdefault((row["source_path"].split("/")[-2], row["source_file"]), []).append(row)
    assert {key: len(value) for key, value in found.items()} == {
        ("a", "2026-02-west-yorkshire-street.csv"): 2,
        ("b", "2026-02-west-yorkshire-street.csv"): 2,
        ("c", "copy of 2026-02 west-yorkshire 100% + street.csv"): 1,
        ("d", "2026-03-west-yorkshire-street.csv"): 3,
    }
    for folder in "ab":
        own = found[folder, "2026-02-west-yorkshire-street.csv"]
        assert {r["Location"] for r in own} == {place, " lead "} and all(r[MALFORMED] is None for r in own)
    verdicts = {r["source_path"].split("/")[-2]: r["malformed"] for r in file_verdicts(rows, 1).collect()}
    assert verdicts == {"a": 0, "b": 0, "c": 0, "d": 2}


def test_quoted_blank_and_doubled_quotes(spark, tmp_path):
    path = write_csv(
        tmp_path / "q" / "2026-02-west-yorkshire-street.csv",
        [{"Crime ID": '""', "Month": "2026-02", "Location": 'Near "The Swan", High St', "Longitude": "n/a"}],
    )
    text = open(path).read().replace('""""""', '""')
    open(path, "w").write(text)
    row = to_raw(read_files(spark, path)).first()
    assert row["crime_id"] is None and row["longitude"] is None
    assert row["location"] == 'Near "The Swan", High St'
    assert row["force"] == "west-yorkshire"


def test_header_in_another_order_is_refused(spark, tmp_path):
    path = write_csv(
        tmp_path / "o" / "2026-02-west-yorkshire-street.csv", sample_rows(), list(sample_rows()[0])[::-1] + ["Context"]
    )
    with pytest.raises(Exception, match="(?i)header"):
        read_files(spark, path).collect()


def test_missing_file(spark):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_files(spark, "/nonexistent/2026-02-west-yorkshire-street.csv")


def test_discovery_prefers_exact_names(spark, tmp_path):
    for name in (
        "2026-02-west-yorkshire-street.csv",
        "copy-2026-02-west-yorkshire-street-old.csv",
        "export-2026-03-greater-manchester-street-v2.csv",
        "2026-03-north-wales-street.csv",
        "2026-02-west-yorkshire-outcomes.csv",
    ):
        write_csv(tmp_path / "d" / name, sample_rows())
    found = {tuple(r) for r in discover_files(spark, str(tmp_path / "d")).select("file_name", "force", "month").collect()}
    assert found == {
        ("2026-02-west-yorkshire-street.csv", "west-yorkshire", "2026-02"),
        ("export-2026-03-greater-manchester-street-v2.csv", "greater-manchester", "2026-03"),
        ("2026-03-north-wales-street.csv", "north-wales", "2026-03"),
    }
    scanned = discover_files(spark, str(tmp_path / "d"))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in scanned


def test_keys_of_one_bucket_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """Files are named by the task that wrote them: one file a month and bucket, but not one task for all months."""
    monkeypatch.setattr("wardline.sources.warehouse.ROWS_PER_PARTITION", 20)
    house = Warehouse(spark, str(tmp_path / "tables"), f"t{uuid.uuid4().hex[:8]}_", buckets=1)
    house.initialise()
    rows = spark.range(480).select(
        *[F.lit(None).cast(kind).alias(name) for name, kind in RAW_COLUMNS.items() if name not in ("crime_id", "month", "force", "load_id")],
        F.concat(F.lit("k"), "id").alias("crime_id"),
        F.format_string("2026-%02d", F.col("id") % 12 + 1).alias("month"),
        F.lit("north").alias("force"),
    )
    assert house.load(rows, "all").inserted == 480
    files = [(r["key_month"], r["name"].split("-")[1]) for r in house.keys().select("key_month", F.col("_metadata.file_name").alias("name")).distinct().collect()]
    assert len(files) == 12 and len({task for _, task in files}) > 3
    assert house.load(rows, "again").inserted == 0


def test_shuffles_of_a_large_batch_begin_with_more_partitions(spark, monkeypatch):
    monkeypatch.setattr("wardline.session.ROWS_PER_PARTITION", 50)
    key, seen, inner = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", [], incremental.repeated_keys

    def watched(*frames):
        seen.append(spark.conf.get(key, None))
        return inner(*frames)

    monkeypatch.setattr(incremental, "repeated_keys", watched)
    batch = spark.range(1000).select(F.concat(F.lit("k"), F.col("id") % 700).alias("crime_id"), F.lit("2026-01").alias("month"), F.lit("north").alias("force"))
    found = incremental.new_rows(batch, batch.where("crime_id < 'k5'"))
    assert found.count() == batch.where("crime_id >= 'k5'").count() > 0
    assert incremental.new_rows(batch.limit(60), batch.limit(10)).count() == 50
    assert seen == ["20", None] and spark.conf.get(key, None) is None


def test_shuffle_files_of_a_written_frame_go_at_once(spark):
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",")
        return {name.rsplit("/", 1)[-1] for name in found.split(",") if "/shuffle_" in name}

    before = files()
    rows = written(spark.range(10_000).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    assert rows.count() == 7
    counted = files() - before  # those of the count above, which is no written frame, are one row a task
    shuffles = {name.split("_")[1] for name in counted}
    assert len(shuffles) <= 1
