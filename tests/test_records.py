"""Records of files in blocks of any size against a plain reader, and files that are not as they should be."""

import csv
import io
import random

import pytest

from tests.conftest import sample_rows, write_csv
from wardline.plans.report_job import load_report_rows
from wardline.schema import FILE_COLUMNS
from wardline.sources.incident_files import file_problems, read_any_encoding, read_files, standard_rows
from wardline.sources.landing import read_landed
from wardline.sources.records import MALFORMED, column_names, scan

NAMES = list(FILE_COLUMNS)


def made(seed, rows=80):
    """Records with quotes, line breaks of both kinds and commas in fields, at random places."""
    draw = random.Random(seed)
    pieces = ["x", "é", '"', '""', ",", "\n", "\r\n", " ", "near", "\n\n", '",\n"', ""]
    out = []
    for k in range(rows):
        place = "".join(draw.choices(pieces, k=draw.choice([0, 1, 3, 9]))) if draw.random() < 0.4 else f"street {k}"
        out.append({"Crime ID": f"c{k}", "Month": "2026-02", "Location": place, "LSOA name": draw.choice(pieces[:5]) + str(k), "Crime type": "Drugs"})
    return out


def small_blocks(spark, size):
    """Files are split into blocks of so many bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.fixture(autouse=True)
def usual_blocks(spark):
    yield
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


@pytest.mark.parametrize("size", [300, 1 << 27])
@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "iso-8859-1"])
def test_records_are_those_of_a_plain_reader(spark, tmp_path, size, encoding):
    paths = [write_csv(tmp_path / f"{seed}" / "2026-02-west-yorkshire-street.csv", made(seed), encoding=encoding) for seed in range(2)]
    small_blocks(spark, size)
    expected = []
    for path in paths:
        text = open(path, newline="", encoding=encoding).read()
        expected += [tuple(x or None for x in row) for row in list(csv.reader(io.StringIO(text, newline="")))[1:]]
    rows = read_files(spark, paths)
    assert sorted(map(str, (tuple(r)[:12] for r in rows.collect()))) == sorted(map(str, expected))
    assert rows.where(f"{MALFORMED} is not null").count() == 0
    seen = scan(spark, paths)
    assert (seen.lines.select("source_path", "block").distinct().count() > 20) == (size == 300)


def test_all_paths_give_equal_rows(spark, warehouse, tmp_path):
    """The report reader, the file reader, the landing store and the stream, over awkward files at once."""
    from wardline.sources.incident_files import discover_files, to_raw
    from wardline.sources.landing import land
    from wardline.streaming.landing_stream import load_new_files

    rows = [{**row, "Crime ID": f"{k}"} for k, row in enumerate(made(9, 120))]
    inbox = tmp_path / "inbox"
    for month, encoding in (("2026-01", "utf-8"), ("2026-02", "utf-8-sig"), ("2026-03", "iso-8859-1")):
        write_csv(inbox / f"{month}-west-yorkshire-street.csv", [{**row, "Month": month} for row in rows], encoding=encoding)
    shown = lambda frame: sorted(str(tuple(r)) for r in frame.select(*[f"`{n}`" for n in NAMES]).collect())
    files = shown(read_files(spark, str(inbox)))
    assert len(files) == 360
    assert shown(read_any_encoding(spark, str(inbox))) == files
    assert land(discover_files(spark, str(inbox)), str(tmp_path / "store")) == 3
    assert shown(read_landed(spark, str(tmp_path / "store"))) == files
    load_new_files(warehouse, str(inbox), str(tmp_path / "checkpoint"), min_rows=1).awaitTermination()
    stored = warehouse.raw().select(*FILE_COLUMNS.values())
    expected = to_raw(read_files(spark, str(inbox))).select(*FILE_COLUMNS.values())
    assert sorted(map(str, stored.collect())) == sorted(map(str, expected.collect()))


def test_report_with_line_breaks_and_a_ragged_record(spark, tmp_path, caplog):
    base = {"Month": "2026-02", "Crime type": "Burglary", "Falls within": "E1"}
    path = write_csv(tmp_path / "r" / "a.csv", [{**base, "Location": "near\nX"}, base], (*base, "Location"))
    assert load_report_rows(spark, path).count() == 2
    with open(path, "a") as file:
        file.write("2026-02,Drugs\n")
    rows = load_report_rows(spark, path)
    assert rows.count() == 3 and {r["location"] for r in rows.collect()} == {"near\nX", None}
    assert "1 records with more or fewer fields" in caplog.text


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    path = write_csv(tmp_path / "big" / "2026-02-west-yorkshire-street.csv", made(1, 3000))
    small_blocks(spark, 20_000)
    seen = scan(spark, path)
    assert seen.lines.select("block").distinct().count() >= 8
    assert standard_rows(seen).count() == 3000


def test_problems_are_rows(spark, tmp_path):
    """A foreign header, no content, no rows, a quote that is never closed, bytes that are no text: the good file is read."""
    folder = tmp_path / "in"
    good = write_csv(folder / "2026-01-west-yorkshire-street.csv", sample_rows("2026-01"))
    write_csv(folder / "2026-02-west-yorkshire-street.csv", sample_rows(), NAMES[::-1])
    (folder / "2026-03-west-yorkshire-street.csv").write_bytes(b"")
    write_csv(folder / "2026-04-west-yorkshire-street.csv", [])
    with open(write_csv(folder / "2026-05-west-yorkshire-street.csv", sample_rows()), "a") as file:
        file.write('x,"never closed,\nmore\n')
    (folder / "2026-06-west-yorkshire-street.csv").write_bytes(bytes(range(256)) * 40)
    seen = scan(spark, str(folder))
    problems = {r["source_path"].split("/")[-1][:7]: r["problem"] for r in file_problems(seen).collect()}
    assert set(problems) == {"2026-02", "2026-03", "2026-05", "2026-06"}
    assert problems["2026-02"].startswith("header is Context") and problems["2026-03"] == "no header"
    assert problems["2026-05"] == "a quote is never closed" and problems["2026-06"].startswith("header is ")
    chosen = seen.files.where(seen.files.source_path.endswith("2026-01-west-yorkshire-street.csv")).select("source_path")
    assert standard_rows(seen, chosen).count() == 3
    with pytest.raises(ValueError, match="header"):
        read_files(spark, str(folder))
    assert read_files(spark, good).count() == 3


def test_a_file_that_ends_early_is_noticed(spark, tmp_path):
    """Bytes that no line holds: what a reader that passes over an error leaves out."""
    from pyspark.sql import functions as F

    import wardline.sources.records as records

    path = write_csv(tmp_path / "e" / "2026-01-west-yorkshire-street.csv", sample_rows("2026-01", 40))
    whole = records._lines
    try:
        records._lines = lambda *args: whole(*args).where(~F.col("value").cast("string").contains("Market hall"))
        found = file_problems(scan(spark, path)).first()["problem"]
    finally:
        records._lines = whole
    assert found.startswith("unreadable: ")


def test_a_record_without_end_is_cut(spark, tmp_path, monkeypatch):
    import wardline.sources.records as records

    monkeypatch.setattr(records, "MOST_BYTES", 200)
    path = write_csv(tmp_path / "l" / "2026-01-west-yorkshire-street.csv", [{**sample_rows()[0], "Location": "line\n" * 100}, sample_rows()[1]])
    rows = {r["Crime ID"]: r for r in read_files(spark, path).collect()}
    assert rows["wl-0002"][MALFORMED] is None and rows["wl-0001"][MALFORMED].endswith('"line')


def test_names_in_a_header():
    assert column_names('a,"b ""q"", c",,a') == ["a0", 'b "q", c', "_c2", "a3"]
