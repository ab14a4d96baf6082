"""Importance resampling towards a target: the documents drawn are those whose hashed words look like the target's.

Features of a text are its runs of 1 to RUN consecutive words, repeats counted; a feature's bucket is the crc32 of its bytes
modulo BUCKETS. With S features in all documents, s of them in the bucket, and T and t in the target, a bucket's gain is
floor(1000 * ln((t + 1) * (S + BUCKETS) / ((s + 1) * (T + BUCKETS)))). A document's weight is the floored
mean of its features' gains, looked up in one array. Its score adds floor(-1000 * ln(-ln((h + 0.5) / 2^32))), where h is the first
8 hex digits of sha256("SEED:id"), so that the highest scores are a draw without replacement by weight.

The cutoff of the draw is selected, not sorted for: every partition gives the median of its remaining keys and
their number, the median of those medians by weight has at least a quarter of the remaining keys on either side, and a
count of the keys above it says which side is done with. A step costs one small row a partition. What
remains is written anew whenever it has fallen to a quarter, so the steps together read a bounded multiple
of the keys; the last FEW keys are sorted. Then only the winners are sorted, by ranges, and numbered.

Defined results: null and empty texts have no features and weight 0. A document without an id is hashed as an empty
string and comes after those with one among equal scores; rows that are equal in score and id, repeated rows say,
are drawn each, in any order. A share of less than one document draws none. An empty table gives no rows, an empty
target has T = 0. Other columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.plain_terms import term_parts
from wardline.session import written

RUN = 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
# Keys that are sorted at once when a cutoff is near, and remembered features of a worker.
FEW = 10_000
REMEMBERED = 200_000


class Features(dict):
    """Bucket of each feature, remembered; a full memory is emptied."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[feature] = found = zlib.crc32(feature) % self.buckets
        return found

    def of(self, text: str | None, run: int) -> Iterator[tuple[int, np.ndarray]]:
        """(words, buckets of the features) of a whole text, a part at a time."""
        before: list[bytes] = []
        for words in term_parts(text):
            tail, new = before, len(words)
            out = [np.fromiter(map(self.__getitem__, words), np.int64, new)]
            joined = tail + words
            for size in range(2, run + 1):
                first = max(0, len(tail) - size + 1)
                starts = range(first, len(joined) - size + 1)
                out.append(np.fromiter((self[b" ".join(joined[k : k + size])] for k in starts), np.int64))
            before = joined[len(joined) - run + 1 :] if run > 1 else []
            yield new, np.concatenate(out) if run > 1 else out[0]


def bucket_counts(docs: DataFrame, text: str, run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; a task hands on one row a bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column("text"):
                for _, found in features.of(value.as_py(), run):
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of every bucket."""
    buckets, total, wanted = len(own), int(own.sum()), int(target.sum())
    ratio = [(t + 1) * (total + buckets) / ((s + 1) * (wanted + buckets)) for s, t in zip(own.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(value)) for value in ratio], np.int64)


def luck(id: str, seed: int = SEED) -> Column:
    """A draw from the standard Gumbel distribution in thousandths, fixed by the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def weighed(docs: DataFrame, id: str, text: str, gain: np.ndarray, run: int = RUN) -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    kind = docs.select(F.col(id).alias("id")).schema["id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(len(gain))
        for batch in batches:
            rows = []
            for value in batch.column("text"):
                words = size = total = 0
                for n, found in features.of(value.as_py(), run):
                    words, size, total = words + n, size + len(found), total + int(gain[found].sum())
                rows.append((words, size, total // size if size else 0))
            columns = np.array(rows, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([batch.column("id"), *map(pa.array, columns)], names=["id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(score, f"id {kind}, n_words bigint, n_features bigint, weight bigint")


KEY = ("score", "id", "row")


def _place(key: dict) -> tuple:
    """Sorts keys: highest score, smallest id, rows without an id last, then the row's number."""
    return -key["score"], key["id"] is None, 0 if key["id"] is None else key["id"], key["row"]


def _until(key: dict) -> Column:
    """Whether a row's key is not after this one."""
    at = F.col("id").isNull() if key["id"] is None else F.col("id") == F.lit(key["id"])
    before = F.col("id").isNotNull() if key["id"] is None else F.col("id") < F.lit(key["id"])
    same = F.coalesce(before, F.lit(False)) | (F.coalesce(at, F.lit(False)) & (F.col("row") <= F.lit(key["row"])))
    return (F.col("score") > F.lit(key["score"])) | ((F.col("score") == F.lit(key["score"])) & same)


def _medians(keys: DataFrame) -> list[dict]:
    """One row a partition: the median of its keys, and their number."""
    kind = keys.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            rows = pa.Table.from_batches(held)
            order = [("score", "descending"), ("id", "ascending"), ("row", "ascending")]
            at = rows.sort_by(order).slice((rows.num_rows - 1) // 2, 1)  # nulls go last
            yield from at.append_column("n", pa.array([rows.num_rows], pa.int64())).to_batches()

    return [row.asDict() for row in keys.mapInArrow(run, f"score bigint, id {kind}, row bigint, n bigint").collect()]


def weighted_median(medians: list[dict]) -> dict:
    """The key at which the partitions up to it, in order, have half of all remaining keys."""
    half, so_far = sum(m["n"] for m in medians) / 2, 0
    for median in sorted(medians, key=_place):
        so_far += median["n"]
        if so_far >= half:
            return median
    raise ValueError("no keys")


def cutoff(keys: DataFrame, count: int, few: int = FEW) -> dict | None:
    """The key of the row at place count (from 1) in order; keys has score, id and row."""
    left = total = keys.count()
    if count < 1:
        return None
    keys, size = keys.select(*KEY), total
    while left > few:
        middle = weighted_median(_medians(keys))
        upto = keys.filter(_until(middle)).count()
        if upto >= count:
            keys, left = keys.filter(_until(middle)), upto
        else:
            keys, left, count = keys.filter(~_until(middle)), left - upto, count - upto
        if left * 4 <= size:
            keys, size = written(keys, "keys"), left
    return sorted((row.asDict() for row in keys.collect()), key=_place)[count - 1]


def numbered(rows: DataFrame) -> DataFrame:
    """(row, rank): places of all rows in order, from 1. Sorted by ranges; a range's rows are counted up from its start."""
    order = [F.desc("score"), F.col("id").asc_nulls_last(), F.col("row").asc()]
    dealt = rows.select(*KEY).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = dealt.withColumn("place", F.monotonically_increasing_id())
    placed = placed.select("row", F.shiftright("place", 33).alias("range"), F.col("place").bitwiseAND((1 << 33) - 1).alias("at"))
    placed = written(placed, "places")
    sizes = placed.groupBy("range").count()
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = sizes.select("range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    return placed.join(F.broadcast(starts), "range").select("row", (F.col("start") + F.col("at") + 1).alias("rank"))


def resample(
    docs: DataFrame,
    id: str,
    text: str,
    target: DataFrame,
    target_text: str,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    run: int = RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
    few: int = FEW,
) -> DataFrame:
    """(id, n_features, weight, score, rank): every row of docs; rank is null where the draw left it out.

    Of the rows with at least least_words words, percent in a hundred are drawn.
    """
    gain = gains(bucket_counts(docs, text, run, buckets), bucket_counts(target, target_text, run, buckets))
    scored = weighed(docs, id, text, gain, run).withColumn("score", F.col("weight") + luck("id", seed))
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    able = scored.filter(F.col("n_words") >= least_words)
    last = cutoff(able, able.count() * percent // 100, few)
    drawn = able.filter(_until(last)) if last else able.limit(0)
    ranks = numbered(drawn)
    return scored.join(ranks, "row", "left").select("id", "n_features", "weight", "score", "rank")
