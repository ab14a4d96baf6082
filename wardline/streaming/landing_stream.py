"""Load landed files as they arrive, each exactly once, through the gates of the monthly run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardline.schema import FORCES
from wardline.sources.incident_files import FILE_GLOB, force_of, judge, month_of, plain_name, standard_rows, to_raw
from wardline.sources.records import scan
from wardline.sources.warehouse import Warehouse


def load_new_files(
    warehouse: Warehouse,
    folder: str,
    checkpoint: str,
    name: str = "landing",
    forces: tuple[str, ...] = FORCES,
    max_files: int = 1_000,
    min_rows: int = 1,
) -> StreamingQuery:
    """Start loading every file not loaded before, and end when there are no more.

    The source hands on names; a batch's files are read as in the monthly run. One that cannot be used, is too short, has
    malformed records, or is not named after a force and a month is held back: its verdict is kept with the batch
    (Warehouse.file_verdicts) and nothing of it is loaded, the others are. A file that is mended has to come under another name.

    How many files share a batch makes no difference: inside one, the keys of an older file count as present
    for the newer ones. The checkpoint remembers files and the query's id. A batch that is repeated after a failure has
    the id and number it had before, hence the same load_id, and replaces what it had written.
    """

    def append(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        load_id = f"{name}-{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"
        files = batch.collect()  # names, max_files at most
        if not files:
            return
        seen = scan(spark, [row["path"] for row in files])
        verdicts = judge(seen, [(row["source_path"], row["file_name"]) for row in files], min_rows)
        for row in files:
            if row["force"] is None or row["month"] is None:
                verdicts[row["source_path"]] = (verdicts[row["source_path"]][0], f"{row['file_name']}: no force and month in its name")
        good = [(row["source_path"], row["modified"], row["force"]) for row in files if not verdicts[row["source_path"]][1]]
        noted = [(row["source_path"], row["file_name"], row["force"], row["month"], *verdicts[row["source_path"]]) for row in files]
        with warehouse.publication(spark) as house:
            house.note_files(noted, load_id)
            if good:
                chosen = spark.createDataFrame(good, "source_path string, modified timestamp, _force string")
                rows = standard_rows(seen, chosen.select("source_path")).join(chosen, "source_path")
                # Oldest first, as the source takes them.
                rows = rows.withColumn("_file", F.struct("modified", "source_path"))
                house.load(to_raw(rows, F.col("_force"), keep=["_file"]), load_id, file_order="_file")

    file_name = plain_name(F.col("_metadata.file_path"))
    files = (
        warehouse.spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", FILE_GLOB)
        .option("maxFilesPerTrigger", max_files)
        .load(folder)
        .select(
            "path",
            F.col("_metadata.file_path").alias("source_path"),
            F.col("modificationTime").alias("modified"),
            file_name.alias("file_name"),
            force_of(file_name, forces).alias("force"),
            month_of(file_name).alias("month"),
        )
    )
    return (
        files.writeStream.queryName(name)
        .foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
