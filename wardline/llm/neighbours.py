"""A pass over rows in the order of their ids in which each row sees the next one.

Ids are cut into as many ranges as there are shuffle partitions, at approximate quantiles. Every range is one
sorted partition, and the first row of a range is sent along to the range before it as well (the very first
one to the last range). So rows move once, each task streams, and nothing is ordered in one place.

Rows without an id come first; rows with equal ids follow each other by a hash of their text and the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_next(docs: DataFrame, id: str, text: str, visit: Callable, schema: str, fields: pa.Schema) -> DataFrame:
    """Rows of visit, a function that makes a generator from (id, text) pairs: it takes an iterator of
    (id, text, last) in order, where last marks a row that only serves as the next of the one before."""
    spark = docs.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    shares = F.array(*[F.lit(k / count) for k in range(1, count)]) if count > 1 else F.array(F.lit(0.5))
    cuts = sorted(set(rows.agg(F.percentile_approx("id", shares, 100 * count)).first()[0] or []))
    place = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("id"))) if cuts else F.lit(0)
    rows = rows.withColumn("range", F.greatest(place, F.lit(0)))
    key = F.struct(F.col("id").isNotNull(), "id", "hash")
    heads = rows.groupBy("range").agg(F.min(key).alias("key")).orderBy("range").collect()  # a row for each range
    if not heads:
        return spark.createDataFrame([], schema)
    before = {head["range"]: heads[k - 1]["range"] for k, head in enumerate(heads)}
    chosen = F.create_map(*[F.lit(x) for head in heads for x in (head["range"], head["key"]["hash"])])
    ids = F.create_map(*[x for head in heads for x in (F.lit(head["range"]), F.lit(head["key"]["id"]).cast(docs.schema[id].dataType))])
    earlier = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    first = (F.col("hash") == chosen[F.col("range")]) & F.col("id").eqNullSafe(ids[F.col("range")])
    own = F.struct(F.col("range").alias("to"), F.lit(False).alias("last"))
    also = F.struct(earlier[F.col("range")].alias("to"), F.lit(True).alias("last"))
    sent = rows.select("id", "text", "hash", F.explode(F.when(first, F.array(own, also)).otherwise(F.array(own))).alias("go"))
    sent = sent.select("id", "text", "hash", "go.to", "go.last")
    dealt = sent.repartitionById(max(before) + 1, "to")
    dealt = dealt.sortWithinPartitions("to", "last", F.col("id").asc_nulls_first(), "hash", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flow() -> Iterator[tuple]:
            for batch in batches:
                columns = [batch.column(name) for name in ("id", "text", "last")]
                for values in zip(*columns, strict=True):
                    yield tuple(value.as_py() for value in values)

        held = []
        for row in visit(flow()):
            held.append(row)
            if len(held) == 1000:
                yield pa.RecordBatch.from_pylist(held, fields)
                held = []
        yield pa.RecordBatch.from_pylist(held, fields)

    return dealt.mapInArrow(run, schema)
