"""Which words of each text lie in a passage of a benchmark, by a prefix-filtered join.

A window is ten words of an item that stand in a row; a shorter item is one window. A text can hold a window
only if it holds the window's rarest word at the right place, so that one word is all that has to be joined
(the prefix of a set that must be contained whole has length one). Rarity is counted over all texts.

1. Count the benchmark's words over the texts; a broadcast of word buckets drops all others first.
2. Each distinct window is led by its rarest word and that word's offset in it.
3. The texts' words are cut down to leading words (by bucket, again broadcast), each with up to nine words on
   either side; a text leaves a closing row as well, which holds its number of words. This is written once.
4. Joined with the windows by leading word: the window must fit between the text's ends (length and position),
   and its words must be the text's words there.
5. Spans of windows are merged per text, so a word counts once however many windows cover it.

Only DataFrame functions are used. A leading word that is very frequent is a skewed key of an equi-join; no row
carries more than nineteen words.

Defined results: null texts and texts without words have no words and no hits; null and empty items have no
windows; an item without an id counts under the empty id; items that repeat an id are one item with the windows
of all of them. Rows of docs are kept as they are, repeated ones too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.words import bucket, lower_ascii, split_words
from wardline.session import written

WINDOW = 10


def windows(benchmark: DataFrame, item: str, text: str, width: int = WINDOW) -> DataFrame:
    """(item, words): the windows of every item, lower-cased."""
    items = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"),
        F.transform(split_words(text), lower_ascii).alias("words"),
    ).filter(F.size("words") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - width + 1, F.lit(1))))
    return items.select("item", "words", starts.alias("at")).select("item", F.slice("words", F.col("at"), width).alias("words"))


def _occurrences(docs: DataFrame, text: str, buckets: DataFrame, *keep: str) -> DataFrame:
    """Words of docs that fall into one of the buckets: keep, all words, place of the word (from 0), word.

    The empty word stands after the last one of each text.
    """
    words = docs.select(*keep, F.concat(split_words(text), F.array(F.lit(""))).alias("words"))
    placed = words.select(*keep, "words", F.posexplode_outer("words").alias("at", "word"))
    return placed.withColumn("bucket", bucket(F.col("word"))).join(F.broadcast(buckets), "bucket", "left_semi")


def _buckets(words: DataFrame) -> DataFrame:
    """Distinct buckets of a column of words, the empty word's among them; bounded by their number."""
    ends = words.sparkSession.range(1).select(F.lit("").alias("word"))
    return written(words.select("word").union(ends).select(bucket(F.col("word")).alias("bucket")).distinct(), "buckets")


def leading_words(docs: DataFrame, text: str, distinct_windows: DataFrame) -> DataFrame:
    """(lead, offset, size, words): each window with its rarest word over all texts, the first of equal ones."""
    wanted = distinct_windows.select(F.explode("words").alias("word")).distinct()
    found = _occurrences(docs, text, _buckets(wanted)).select(lower_ascii(F.col("word")).alias("word"))
    counts = found.groupBy("word").agg(F.count("*").alias("n"))
    placed = distinct_windows.select("words", F.posexplode("words").alias("offset", "word"))
    ranked = placed.join(counts, "word", "left").select("words", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset").alias("key"))
    led = ranked.groupBy("words").agg(F.min("key").alias("key"))
    return led.select(
        F.col("key.word").alias("lead"), F.col("key.offset").alias("offset"), F.size("words").alias("size"), "words"
    )


def _hit_words(spans: DataFrame) -> DataFrame:
    """(row, n_hit): words covered by any of a row's spans."""
    before = Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce(F.max("stop").over(before), F.lit(0))))
    return spans.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))


def overlaps(docs: DataFrame, id: str, text: str, benchmark: DataFrame, item: str, item_text: str) -> DataFrame:
    """(id, digest, n_words, n_hit, items) for every row of docs; items sorted, digest the MD5 of the text."""
    of_items = written(windows(benchmark, item, item_text).distinct(), "windows")
    led = written(leading_words(docs, text, of_items.select("words").distinct()), "leads")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.md5(F.col(text).cast("binary")).alias("digest"), text
    )
    around = WINDOW - 1
    first = F.greatest(F.col("at") - around, F.lit(0))
    places = _occurrences(rows, text, _buckets(led.select(F.col("lead").alias("word"))), "row", "id", "digest")
    places = places.select(
        "row",
        F.when(F.col("word") == "", F.struct("id", "digest", F.col("at").cast("bigint").alias("n_words"))).alias("whole"),
        "at",
        lower_ascii(F.col("word")).alias("word"),
        first.alias("first"),
        F.transform(F.slice("words", first + 1, F.lit(2 * around + 1)), lower_ascii).alias("near"),
    )
    places = written(places, "places")
    begin = F.col("at") - F.col("offset")
    same = F.slice("near", F.greatest(begin - F.col("first") + 1, F.lit(1)), F.col("size")) == F.col("words")
    inner = places.filter("whole is null")
    hits = inner.join(led, (inner.word == led.lead) & (begin >= F.col("first")) & same)
    hits = hits.select("row", begin.alias("start"), (begin + F.col("size")).alias("stop"), "words")
    hits = written(hits, "hits")
    spans = _hit_words(hits.select("row", "start", "stop").distinct())
    named = hits.select("row", "words").distinct().join(of_items, "words").groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    whole = places.filter("whole is not null").select("row", "whole.*")
    found = whole.join(spans.join(named, "row"), "row", "left")
    none = F.array().cast("array<string>")
    return found.select(
        "id", "digest", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"), F.coalesce("items", none).alias("items")
    )
