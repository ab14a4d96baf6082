"""Landing store: CSV copies under part_year=/part_month=/force=/source_file=.

The partition names differ from every column in the files. Were the month partition called month,
its value would take the place of the Month column on reading.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.schema import FILE_COLUMNS, FILE_SCHEMA, FORCES
from wardline.sources.incident_files import force_of, month_of, read_files, standard_rows
from wardline.sources.records import Scan

PARTITIONS = ("part_year", "part_month", "force", "source_file")
# A landed file holds the fields as they came, blanks and line breaks included, in UTF-8.
_EXACT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
# Beside the folders of the keys, and passed over by readers of those.
LEDGER = "_ledger"
FILE_COLUMNS_QUOTED = [f"`{name}`" for name in FILE_COLUMNS]
_PARTITION_SCHEMA = ", ".join(f"{name} string" for name in PARTITIONS)


def _ledger(spark: SparkSession, root: str) -> DataFrame | None:
    """The store's ledger: one entry for each key, written when all its bytes are there. None before the first."""
    try:
        return spark.read.schema(_PARTITION_SCHEMA).parquet(f"{root}/{LEDGER}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def list_files(spark: SparkSession, root: str) -> DataFrame | None:
    """Landed (year, month, force, file) tuples from the ledger; None without a store."""
    ledger = _ledger(spark, root)
    return None if ledger is None else ledger.select(*PARTITIONS).distinct()


def list_partitions(store: DataFrame) -> DataFrame:
    """Distinct (year, month, force) of a store."""
    keys = ("part_year", "part_month", "force")
    return store.select(*keys).distinct().orderBy(*keys)


def land(files: DataFrame, root: str, forces: Sequence[str] = FORCES, seen: Scan | None = None) -> int:
    """Copy files (path, file_name, force, month) to the store, each under its key.

    Files whose key is in the ledger are skipped unread. A key without an entry, of a copy that died half-way, is
    replaced. Entries are written after the bytes. Returns the number of files copied. seen is a scan of the files, if
    there is one already (files has source_path then).
    """
    spark = files.sparkSession
    keyed = files.select(
        "path",
        *([F.col("source_path")] if seen else []),
        F.split_part("month", F.lit("-"), F.lit(1)).alias("part_year"),
        F.split_part("month", F.lit("-"), F.lit(2)).alias("part_month"),
        "force",
        F.col("file_name").alias("source_file"),
    )
    present = list_files(spark, root)
    if present is not None:
        keyed = keyed.join(present, list(PARTITIONS), "left_anti")
    # One row per file.
    new = keyed.collect()
    if not new:
        return 0
    if seen:
        chosen = spark.createDataFrame([(row["source_path"],) for row in new], "source_path string")
        rows = standard_rows(seen, chosen)
    else:
        rows = read_files(spark, [row["path"] for row in new])
    name = F.col("source_file")
    month = month_of(name)
    (
        rows.select(
            *[F.col(f"`{column}`") for column in FILE_COLUMNS],
            F.split_part(month, F.lit("-"), F.lit(1)).alias("part_year"),
            F.split_part(month, F.lit("-"), F.lit(2)).alias("part_month"),
            force_of(name, forces).alias("force"),
            "source_file",
        )
        # a file's lines lie in several parts of the scan, and one output file for each of its blocks is enough
        .hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .options(**_EXACT)
        .csv(root)
    )
    entries = spark.createDataFrame([tuple(row[n] for n in PARTITIONS) for row in new], _PARTITION_SCHEMA)
    entries.coalesce(1).write.mode("append").parquet(f"{root}/{LEDGER}")
    return len(new)


def read_landed(
    spark: SparkSession, root: str, force: str | None = None, month: str | None = None
) -> DataFrame:
    """Rows of the store, or of one force and month: the other folders are not read, nor is a copy without its entry."""
    # Partition columns are in the schema as text, so that '02' stays '02'.
    schema = f"{FILE_SCHEMA.toDDL()}, {_PARTITION_SCHEMA}"
    rows = spark.read.schema(schema).options(**_EXACT, multiLine=True).csv(root)
    if month is not None:
        year, number = month.split("-")
        rows = rows.where((F.col("part_year") == year) & (F.col("part_month") == number))
    if force is not None:
        rows = rows.where(F.col("force") == force)
    present = list_files(spark, root)
    if present is None:
        return rows.where(F.lit(False))
    return rows.join(present, list(PARTITIONS), "left_semi").select(*FILE_COLUMNS_QUOTED, *PARTITIONS)
