"""One query for each operator over its whole table, with the operators' production parameters."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import (
    chat_template,
    decontamination,
    language_id,
    lexical_search,
    license_scan,
    minhash,
    ngram_join,
    quality,
    resampling,
    simhash,
    url_filter,
)
from wardline.llm.bpe_codec import BpeUdfs
from wardline.llm.neighbours import with_next
from wardline.llm.oracle import oracle_sql  # noqa: F401  (the entry points take both from here)
from wardline.llm.token_counts import CountUdfs
from wardline.session import reach_workers, written

TOKEN_LIMIT = 2048


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def remainder(of: str, divisor: int) -> Column:
    return F.pmod(F.crc32(F.col(of).cast("string")), F.lit(divisor))


def sha256(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations, then read turns and the text under the loss mask back from the output."""
    template = chat_template.turns_template()
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    roles = F.when(F.col("id") == 0, "user").otherwise("assistant")
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), roles.alias("role"), said.alias("text"))
    made = chat_template.format_conversations(rows.unionByName(extra), "conv_id", "turn", "role", "text", template)
    kind = pa.struct([("n_turns", pa.int64()), ("turns", pa.string()), ("chars", pa.int64()), ("loss", pa.string())])

    @F.arrow_udf("struct<n_turns:bigint,turns:string,chars:bigint,loss:string>")
    def read_back(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for formatted, spans in texts:
            out = []
            for text, marks in zip(formatted, spans, strict=True):
                whole = text.as_py()
                turns = chat_template.turns_of(template, whole)
                loss = "".join(template.escaper.unescape(whole[m["start"] : m["stop"]]) for m in marks.as_py())
                joined = "".join(f"{role}\n{body}\n" for role, body in turns)
                out.append({"n_turns": len(turns), "turns": _hex(joined), "chars": len(loss), "loss": _hex(loss)})
            yield pa.array(out, kind)

    found = made.select("conversation", F.char_length("formatted").cast("bigint").alias("size"), read_back("formatted", "spans").alias("found"))
    return found.select(
        F.col("conversation").alias("conv_id"),
        "found.n_turns",
        F.col("found.turns").alias("turns_sha256"),
        F.col("found.chars").alias("loss_chars"),
        F.col("found.loss").alias("loss_sha256"),
        F.col("size").alias("formatted_chars"),
    )


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages learned from the rows that are not held out. A row without an id is never learned from."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.filter(remainder("doc_id", 4) != 2), "doc_id", "text", "lang")
    found = docs.select("doc_id", language_id.predict_column(spark, model, "text").alias("found"))
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_fit: code points of the longest prefix within the limit."""
    count = CountUdfs(spark, public_tokenizers.path("word_bpe_49k.json")).tally("text", TOKEN_LIMIT)
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint")
    counted = read(spark, sf_dir, "documents").select("doc_id", size.alias("n_bytes"), count.alias("found"))
    over = F.col("found.n_tokens") > TOKEN_LIMIT
    return counted.select("doc_id", "n_bytes", "found.n_tokens", over.alias("over_limit"), "found.n_fit")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filter.rule_table(spark, url_filter.RULES)
    found = url_filter.judge(read(spark, sf_dir, "pages"), "page_id", "url", "html", rules)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def token_digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Encode every text, decode the ids by their offsets, and give digests of both."""
    codec = BpeUdfs(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    found = docs.select("doc_id", codec.both_ways("text").alias("found")).select("doc_id", "found.*")
    return found.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(spark, read(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    found = decontamination.overlaps(docs, "doc_id", "text", benchmark, "item_id", "text")
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        sha256(F.array_join("items", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), "doc_id", "text")
    digits = simhash.hex_digits("print")
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id"))


EDITED = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of the following one."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def compare_with_next(rows: Iterator[tuple]) -> Iterator[dict]:
    """Rows of EDITED for (id, text, last) in order."""
    held = None
    for id, text, last in rows:
        text = text or ""
        own = minhash.fingerprint(text)
        if held is not None:
            before, old, print_ = held
            changed = edited(old, text)
            other = minhash.fingerprint(changed)
            yield {
                "doc_id": before,
                "n_chars": len(old),
                "edited_sha256": _hex(changed),
                "fingerprint": print_.hex(),
                "edited_fingerprint": other.hex(),
                "near_edited": minhash.likeness(print_, other),
                "near_next": minhash.likeness(print_, own),
            }
        held = None if last else (id, text, own)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = [(n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    numbers = [(n, pa.float64()) for n in ("near_edited", "near_next")]
    fields = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *texts, *numbers])
    return with_next(read(spark, sf_dir, "documents"), "doc_id", "text", compare_with_next, EDITED, fields)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels learned from the rows that are not held out. The features of all rows are computed once."""
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    rows = docs.select("doc_id", held_out.alias("held_out"), quality.features_column("text").alias("features"))
    rows = written(rows, "features")
    model = quality.train(rows.filter("not held_out"), read(spark, sf_dir, "labels"), "doc_id", "quality")
    scored = rows.select("doc_id", "held_out", quality.score_column(model, "features").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(read(spark, sf_dir, "documents"), "doc_id", "text")
    labels = [F.array_join(name, ",").alias(name) for name in ("base_labels", "labels")]
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", *labels, "score")


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(read(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), F.col("component").alias("component_id"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    found = lexical_search.rank(docs, "doc_id", "text", items, "item_id", "text")
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    found = resampling.resample(docs, "doc_id", "text", target, "text")
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_format": op1_chat_format,
        "op2_language_id": op2_language_id,
        "op3_token_counts": op3_token_counts,
        "op4_url_filter": op4_url_filter,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_decontamination": op6_decontamination,
        "op7_simhash": op7_simhash,
        "op8_minhash": op8_minhash,
        "op9_quality": op9_quality,
        "op10_license_scan": op10_license_scan,
        "op11_ngram_join": op11_ngram_join,
        "op12_lexical_search": op12_lexical_search,
        "op13_resampling": op13_resampling,
    }
