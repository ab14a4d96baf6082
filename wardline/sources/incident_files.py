"""Incident files: finding them, choosing their encoding, reading them by column name."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.quality import file_verdicts
from wardline.schema import COORDINATES, FILE_COLUMNS, FORCES
from wardline.sources.records import LATIN1, MALFORMED, UTF8, Scan, column_names, scan

# Name of an incident file, exact and with other text around month and force.
FILE_GLOB = "*street*.csv"
EXACT_NAME = r"^(\d{4}-\d{2})-(.+)-street\.csv$"

# Other names for the two.
ENCODING_NAMES = {
    "utf-8": UTF8,
    "utf8": UTF8,
    "utf-8-sig": UTF8,
    "latin-1": LATIN1,
    "latin1": LATIN1,
    "iso-8859-1": LATIN1,
}


def file_name_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def plain_name(source_path: Column) -> Column:
    """File name in the path that Spark's readers give, whose blanks and the like are percent-encoded."""
    return F.url_decode(F.replace(file_name_of(source_path), F.lit("+"), F.lit("%2B")))


def month_of(file_name: Column) -> Column:
    return F.nullif(F.regexp_extract(file_name, r"(\d{4}-\d{2})", 1), F.lit(""))


def force_of(file_name: Column, forces: Sequence[str] = FORCES) -> Column:
    """Force in a file name: the middle part of an exact name, else a known force found in it."""
    exact = F.nullif(F.regexp_extract(file_name, EXACT_NAME, 2), F.lit(""))
    # Longest first, so that no force is taken for another whose name it contains.
    known = "|".join(sorted(forces, key=len, reverse=True))
    loose = F.regexp_extract(file_name, rf"\d{{4}}-\d{{2}}.*?({known}).*street.*\.csv$", 1)
    return F.coalesce(exact, F.nullif(loose, F.lit("")))


def discover_files(
    spark: SparkSession, folder: str, forces: Sequence[str] = FORCES
) -> DataFrame:
    """Incident files below a folder: path, source_path (the key that rows carry), file_name, force, month.

    Where a force and month have an exactly named file, others for them are passed over. Only names
    are looked at; no file is opened.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", FILE_GLOB)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", F.col("_metadata.file_path").alias("source_path"), file_name_of(F.col("path")).alias("file_name"))
    )
    named = listed.select(
        "path",
        "source_path",
        "file_name",
        force_of(F.col("file_name"), forces).alias("force"),
        month_of(F.col("file_name")).alias("month"),
        F.col("file_name").rlike(EXACT_NAME).alias("exact"),
    ).dropna(subset=["force", "month"])
    has_exact = named.groupBy("force", "month").agg(F.bool_or("exact").alias("has_exact"))
    return (
        named.join(has_exact, ["force", "month"])
        .where(F.col("exact") | ~F.col("has_exact"))
        .select("path", "source_path", "file_name", "force", "month")
    )


def read_any_encoding(
    spark: SparkSession, paths: str | Sequence[str], encoding: str | None = None
) -> DataFrame:
    """Text columns of any number of CSV files, matched by name, plus MALFORMED and source_file (the path).

    Each file is read as UTF-8 if all of it is valid UTF-8, else as ISO-8859-1, which accepts any
    byte. A given encoding is the only one used. Records are put together as in read_files; files
    that share a header share a frame.
    """
    given = encoding and ENCODING_NAMES.get(encoding.lower(), encoding)
    seen = scan(spark, paths)
    if given == UTF8 and (undecodable := _paths(seen.files.where("not utf8"))):
        raise ValueError(f"could not decode as {UTF8}: {undecodable}")
    if broken := _paths(seen.files.where(F.col("problem").startswith("unreadable"))):
        raise ValueError(f"could not be read whole: {broken}")
    # One row per distinct header, not per file.
    headers = sorted(row["header"] for row in seen.files.where("header is not null").select("header").distinct().collect())
    if not headers:
        raise ValueError(f"no lines in {paths}")
    combined = None
    for header in headers:
        alike = seen.files.where(F.col("header") == header).select("source_path")
        frame = seen.rows(column_names(header), alike, given).withColumnRenamed("source_path", "source_file")
        combined = frame if combined is None else combined.unionByName(frame, allowMissingColumns=True)
    # As they came: the file's own columns first.
    return combined.select(*[F.col(f"`{name}`") for name in combined.columns if name not in (MALFORMED, "source_file")], MALFORMED, "source_file")


def _paths(files: DataFrame) -> list[str]:
    return sorted(row["source_path"] for row in files.select("source_path").collect())


def standard_header(header: Column) -> Column:
    """Whether a header line holds the twelve names in their order."""
    names = F.from_csv(header, ", ".join(f"c{k} string" for k in range(len(FILE_COLUMNS) + 1)), {"escape": '"'})
    found = [names[f"c{k}"].eqNullSafe(F.lit(name)) for k, name in enumerate(FILE_COLUMNS)]
    return reduce(Column.__and__, found) & names[f"c{len(FILE_COLUMNS)}"].isNull()


def file_problems(seen: Scan) -> DataFrame:
    """(source_path, problem) of every file of a scan that cannot be used as a standard file: a row each, no error."""
    wrong = F.when(~F.coalesce(standard_header(F.col("header")), F.lit(False)), F.concat(F.lit("header is "), F.substring("header", 1, 200)))
    return seen.files.select("source_path", F.coalesce("problem", wrong).alias("problem")).where("problem is not null")


def judge(seen: Scan, files: Sequence[tuple[str, str]], min_rows: int) -> dict[str, tuple[int, str | None]]:
    """For each (source_path, file_name) of a scan: its rows, and why it is held back, or None. No file stops the others."""
    problems = {row["source_path"]: row["problem"] for row in file_problems(seen).collect()}  # a row a file, as below
    usable = seen.files.join(file_problems(seen), "source_path", "left_anti").select("source_path")
    counted = {row["source_path"]: row for row in file_verdicts(standard_rows(seen, usable), min_rows).collect()}
    out = {}
    for path, name in files:
        verdict, reason = counted.get(path), problems.get(path)
        if not reason and not (verdict and verdict["passed"]):
            reason = f"under {min_rows} rows"
        elif not reason and verdict["malformed"]:
            reason = f"{verdict['malformed']} malformed rows"
        out[path] = (verdict["row_count"] if verdict else 0, f"{name}: {reason}" if reason else None)
    return out


def standard_rows(seen: Scan, chosen: DataFrame | None = None) -> DataFrame:
    """Rows of the chosen files (source_path), or all, of a scan: the twelve columns, MALFORMED, source_path and source_file."""
    rows = seen.rows(list(FILE_COLUMNS), chosen)
    return rows.select("*", plain_name(F.col("source_path")).alias("source_file"))


def read_files(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Standard files: the twelve columns as text, source_path and source_file (its name), and MALFORMED.

    The header of every file must hold the twelve names in their order, and every file must be readable, else the job
    stops (scan, file_problems and standard_rows are for jobs that go on). A quoted field may run over several
    lines. Blanks stay as they are. MALFORMED holds the text of a record with too many or too few fields
    and is null for all others.
    """
    seen = scan(spark, paths if isinstance(paths, str) else list(paths))
    empty = F.col("problem") == "no header"
    if wrong := file_problems(seen).where(~empty & (F.col("problem") != "a quote is never closed")).collect():
        raise ValueError("not standard files: " + "; ".join(f"{row['source_path']}: {row['problem']}" for row in wrong))
    return standard_rows(seen)


def to_raw(rows: DataFrame, force: str | Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Rename file columns, convert coordinates leniently, set the force and the load time.

    Without a force argument, the force is taken from each row's source file name.
    """
    if force is None:
        force = force_of(F.col("source_file"))
    elif isinstance(force, str):
        force = F.lit(force)
    columns = [
        (F.col(f"`{source}`").try_cast("double") if name in COORDINATES else F.col(f"`{source}`")).alias(name)
        for source, name in FILE_COLUMNS.items()
    ]
    return rows.select(*columns, force.alias("force"), F.current_timestamp().alias("_loaded_at"), *keep)
