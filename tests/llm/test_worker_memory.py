"""What Python workers are given at once, and how many a task needs."""

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from wardline.llm import ngram_join, queries
from wardline.llm.bpe_codec import BpeUdfs
from wardline.session import BATCH_BYTES, written


class Given:
    """Whole sets from a frame that is there already."""

    def __init__(self, sets):
        self.sets = sets

    def of(self, pairs):
        return self.sets


def test_sets_are_compared_once_where_links_are_kept(spark):
    """A second evaluation would need a second worker for each task."""
    sets = spark.createDataFrame([(1, bytes(16)), (2, bytes(8))], "node bigint, found binary")
    pairs = spark.createDataFrame([(1, 2), (1, 1)], "a bigint, b bigint")
    shared = ngram_join._shared(pairs, Given(sets))
    kept = shared.filter(ngram_join._is_link(ngram_join.LEAST))
    assert kept._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("ArrowEvalPython") == 1
    assert sorted((r["a"], r["b"], r["total"]) for r in shared.collect()) == [(1, 1, 4), (1, 2, 3)]


def test_batches_of_written_frames_are_bounded_in_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "size"])

    texts = spark.range(0, 6000, numPartitions=1).select(F.repeat(F.lit("text"), 1000).alias("text"))
    before = spark.conf.get(BATCH_BYTES[0])
    found = written(texts.mapInArrow(sizes, "rows bigint, size bigint"), "sizes").collect()
    assert sum(r["rows"] for r in found) == 6000 and spark.conf.get(BATCH_BYTES[0]) == before
    assert max(r["size"] for r in found) < 2 * int(BATCH_BYTES[1])


def test_tokens_need_one_worker_a_task(spark, docs):
    """Encoding and decoding in two functions took two, with a vocabulary and remembered slices each."""
    found = queries.token_digests(spark, docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("ArrowEvalPython") == 1
    codec = BpeUdfs(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    apart = docs.select("doc_id", codec.encode("text").alias("x")).select("doc_id", "x.ids", codec.decode_at("x.ids", "x.offsets").alias("decoded"))
    ids = queries.sha256(F.array_join(F.col("ids").cast("array<string>"), " "))
    apart = apart.select("doc_id", F.size("ids").cast("bigint"), ids, queries.sha256(F.col("decoded")))
    rows = [sorted(map(repr, map(tuple, frame.collect()))) for frame in (found, apart)]
    assert rows[0] == rows[1] and len(rows[0]) == docs.count()
