"""Rows of a batch that the raw table does not hold yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.schema import ROW_KEY
from wardline.session import spread, written

PAIR = ("force", "month")


def touched_pairs(batch: DataFrame) -> DataFrame:
    """Distinct (force, month) of a batch, as a frame: however many there are, none is listed in a plan."""
    # The comparison is there for the planner: a side that is filtered is worth pruning partitions by.
    return batch.select(*PAIR).where((F.col("force") > "") & (F.col("month") > "")).distinct()


def of_pairs(frame: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of the pairs. Force and month are partitions of the raw table, so other folders are not read."""
    return frame.join(pairs, list(PAIR), "left_semi").select(*frame.columns)


def one_per_key(batch: DataFrame) -> DataFrame:
    """Drop repeated keys inside a batch, keeping the smallest row; rows without an ID all stay.

    Copies are merged before the shuffle, so a key that fills a third of a batch is no hot spot.
    """
    keyed = batch.where(F.col("crime_id").isNotNull())
    merged = keyed.groupBy(*ROW_KEY).agg(F.min(F.struct(*batch.columns)).alias("_row"))
    return _gathered(merged.select("_row.*").unionByName(batch.where(F.col("crime_id").isNull())))


def _gathered(rows: DataFrame) -> DataFrame:
    """Bring rows of one force and month together again after a shuffle by key.

    The sizes of the parts are known at run time: a large force-month is spread over tasks, small ones share one.
    """
    return rows.hint("rebalance", *PAIR)


def first_files(batch: DataFrame, order: str) -> DataFrame:
    """Rows as they are new if a batch's files are taken one after the other, in the order of a column.

    A row goes if an earlier file of the batch has its key. Repeats inside one file stay, as do rows
    without an ID. So it makes no difference which files share a batch.
    """
    keyed = batch.where(F.col("crime_id").isNotNull())
    spread = keyed.groupBy(*ROW_KEY).agg(F.min(order).alias("_first"), F.max(order).alias("_last"))
    spread = spread.where(F.col("_first") < F.col("_last")).drop("_last")
    marked = batch.join(spread, list(ROW_KEY), "left").where(F.col("_first").isNull() | (F.col(order) == F.col("_first")))
    return marked.select(*batch.columns)


def new_rows(
    batch: DataFrame, existing: DataFrame, dedupe_within_batch: bool = False, pairs: DataFrame | None = None
) -> DataFrame:
    """Rows of batch whose (crime_id, month, force) is not in existing.

    Rows without an ID never match and are always new, as are repeats inside the batch unless
    dedupe_within_batch is set.

    The existing table is cut down to the batch's (force, month) partitions while the query runs. Keys alone
    are compared, made distinct before the shuffle on both sides. The repeated keys, each once, are written
    to the shared folder: so the planner knows how many there are, sends few to every task, and for many
    shuffles both sides anew, where adaptive execution splits a hot key of the batch. Rows without an ID
    stay out of the join. The shuffles of a large batch have as many partitions as its rows ask for.

    pairs are the batch's (force, month), if the caller has them already.
    """
    # Keys, repeats and both kinds of rows are taken from it: computed once.
    batch = written(batch, "batch")
    known = of_pairs(existing, touched_pairs(batch if pairs is None else pairs)).where(F.col("crime_id").isNotNull())
    with spread(batch.sparkSession, batch.count()) as raised:
        fresh = rows_without(batch, known.select(*ROW_KEY).distinct(), dedupe_within_batch)
        return written(fresh, "fresh") if raised else fresh


def rows_without(batch: DataFrame, known: DataFrame, dedupe_within_batch: bool = False) -> DataFrame:
    """Rows of a written batch whose key is not among the known ones (ROW_KEY); see new_rows."""
    if dedupe_within_batch:
        batch = one_per_key(batch)
    has_id = F.col("crime_id").isNotNull()
    keyed, keyless = batch.where(has_id), batch.where(~has_id)
    repeats = written(repeated_keys(keyed, known), "repeats")
    # A join on names puts the keys first; restore the order.
    fresh = keyed.join(repeats, list(ROW_KEY), "left_anti").select(*batch.columns)
    return _gathered(fresh.unionByName(keyless))


def repeated_keys(keyed: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct keys of the batch that are known. Known keys that are bucketed by the key stay where they are."""
    return keyed.select(*ROW_KEY).distinct().join(known.select(*ROW_KEY), list(ROW_KEY), "left_semi")
