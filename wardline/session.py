"""Session settings the jobs rely on."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "wardline", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on. Cluster settings already present win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: the one the cluster names in spark.checkpoint.dir.

    Only a session that runs in one process may do without that setting; it gets a folder beside its
    tables. Anywhere else a default would be a disk of the driver's, so the job stops here instead.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    return os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_checkpoints")


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever their working folder.

    On a cluster the package is installed or shipped (--py-files); a path that is not there does no harm.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let checkpoint() write to the shared folder, unless the session has set one already."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


# Lets Spark remove the shuffle files of an execution when it ends, and not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Bytes of the batches in which rows go to Python workers: each task holds a batch or two in the JVM and in its worker.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
# Rows for which spread() wants a shuffle partition.
ROWS_PER_PARTITION = 500_000


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def spread(spark: SparkSession, rows: int) -> Iterator[bool]:
    """Let shuffles that run inside begin with a partition for so many rows each, if the session has fewer.

    A fixed number of partitions makes each grow with the input, and with it what a task sorts or groups in memory.
    Adaptive execution joins the small ones again and still splits skewed ones. Gives whether the number was raised;
    frames that are run after the block have the session's number.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    have, wanted = int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_PARTITION)
    with setting(spark, key, str(wanted)) if wanted > have else nullcontext():
        yield wanted > have


def written(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder as Parquet and read it back.

    Cuts the lineage, so that losing an executor later costs a read and not a recomputation, and gives the
    planner the frame's true size. The files stay until the folder is cleared; the shuffle files that led to them, which
    nothing reads again, go at once. Rows go to Python workers in batches of bounded bytes.
    """
    spark = frame.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with setting(spark, CLEANUP, "true"), setting(spark, *BATCH_BYTES):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
