"""Language of whole texts: known words by their log frequency per language, unseen ones by n-grams.

Training counts words per language on Spark, over a sample of at most rows_per_language expected rows of each
language (drawn by a hash of id and text, whole texts), and n-grams from the counted words. The model keeps
the max_entries most frequent words and as many n-grams, each with the languages it was seen in and no others;
that bounds what the driver collects and broadcasts, whatever the corpus. Every language is learned: each adds its
name and two numbers. Ties go by text, so a model is the same for any partitioning.

A known word adds, for each language, its smoothed log frequency there. An unseen word is covered from left
to right by the longest known n-gram at each place, from max_gram letters down to one; a letter without any
counts the same for all languages. The language with the largest sum wins, the alphabetically first of equal
ones.

Defined results: null texts and texts without a letter give "und" with score 0, and so does everything if
nothing could be learned (no rows, no language, only nulls). Repeated rows count as often as they occur. Other
columns are not looked at, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.session import written

UNKNOWN = "und"
ROWS_PER_LANGUAGE = 4_000
MAX_ENTRIES = 150_000
MAX_GRAM = 5
# Words after which more of them no longer make a prediction more certain.
CERTAIN_AFTER = 12
# Numbers that a worker remembers of unseen words, one a language for each word.
REMEMBERED = 2_000_000
# Code points of a text looked at once.
BLOCK = 1 << 20

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
GAP = regex.compile(r"[^\p{L}\p{M}]")
# The same words for Spark's own regular expressions.
NO_WORD = r"[^\p{L}\p{M}]+"
EDGE = "_"


@dataclass
class Table:
    """Entries; for each in how many languages it was seen, and for each of those its number and the count, as numbers."""

    entries: list[str]
    sizes: np.ndarray
    languages: np.ndarray
    counts: np.ndarray


class Logs:
    """Log frequencies by entry (a known word or n-gram) and language, stored for the languages an entry was seen in.

    Everywhere else an entry has its table's floor for that language.
    """

    def __init__(self, tables: list[Table], width: int):
        self.edges = np.concatenate([[0], np.cumsum(np.concatenate([[], *[t.sizes for t in tables]]))]).astype(np.int64)
        self.languages = np.concatenate([np.zeros(0, np.int32), *[t.languages for t in tables]])
        self.above = np.concatenate([np.zeros(0), *[np.log(t.counts + 0.5) - np.log(0.5) for t in tables]])
        self.table = np.repeat(np.arange(len(tables)), [len(t.entries) for t in tables])
        self.floors = np.zeros((len(tables), width))
        for k, t in enumerate(tables):
            totals = np.bincount(t.languages, t.counts, minlength=width)
            self.floors[k] = np.log(0.5) - np.log(totals + 0.5 * len(t.entries) + 1)

    def total(self, rows: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Sum of the rows, each so many times, by language."""
        starts, sizes = self.edges[rows], self.edges[rows + 1] - self.edges[rows]
        at = np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
        above = np.bincount(self.languages[at], self.above[at] * np.repeat(times, sizes), minlength=self.floors.shape[1])
        return above + np.bincount(self.table[rows], times, minlength=len(self.floors)) @ self.floors

    def __getitem__(self, row: int) -> np.ndarray:
        return self.total(np.array([row]), np.ones(1))


class LanguageModel:
    """Known words and n-grams by their row in the log frequencies."""

    def __init__(self, languages: list[str], words: dict[str, int], grams: dict[str, int], logs: Logs):
        self.languages, self.words, self.grams, self.logs = languages, words, grams, logs
        self.covers: dict[str, np.ndarray] = {}
        self.longest = max(map(len, grams), default=0)

    def _cover(self, word: str) -> np.ndarray:
        known = self.covers.get(word)
        if known is None:
            padded, at, rows = f"{EDGE}{word}{EDGE}", 0, []
            while at < len(padded):
                for size in range(min(self.longest, len(padded) - at), 0, -1):
                    if (row := self.grams.get(padded[at : at + size])) is not None:
                        rows.append(row)
                        at += size
                        break
                else:
                    at += 1
            known = self.logs.total(np.array(rows, dtype=np.int64), np.ones(len(rows)))
            if len(self.covers) * len(known) >= REMEMBERED:
                self.covers.clear()
            self.covers[word] = known
        return known

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, posterior of the mean word's evidence taken CERTAIN_AFTER times at most)."""
        counts: Counter[str] = Counter()
        for block in blocks(text or ""):
            counts.update(WORD.findall(block.lower()))
        if not counts or not self.languages:
            return UNKNOWN, 0.0
        total, rows, times = np.zeros(len(self.languages)), [], []
        for word, n in counts.items():
            row = self.words.get(word)
            if row is None:
                total += n * self._cover(word)
            else:
                rows.append(row)
                times.append(n)
        if rows:
            total += self.logs.total(np.array(rows, dtype=np.int64), np.array(times, dtype=float))
        words = counts.total()
        total *= min(words, CERTAIN_AFTER) / words
        best = int(np.argmax(total))
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """A long text in parts that end where a word does."""
    start = 0
    while len(text) - start > size:
        found = GAP.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def train(
    docs: DataFrame,
    id: str,
    text: str,
    lang: str,
    rows_per_language: int = ROWS_PER_LANGUAGE,
    max_entries: int = MAX_ENTRIES,
    max_gram: int = MAX_GRAM,
) -> LanguageModel:
    """Learn from the rows of docs that have a text and a language."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).dropna(subset=["text", "lang"])
    sizes = written(rows.groupBy("lang").agg(F.count("*").alias("rows")), "languages")
    languages = sorted(row["lang"] for row in sizes.select("lang").collect())  # names of languages, not of rows
    if not languages:
        return LanguageModel([], {}, {}, Logs([], 0))
    share = F.least(F.lit(1.0), F.lit(float(rows_per_language)) / F.col("rows"))
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / (1 << 30)
    sample = rows.join(sizes, "lang").filter(share > draw)
    words = sample.select("lang", F.explode(F.split(F.lower("text"), NO_WORD)).alias("entry")).filter(F.col("entry") != "")
    words = words.groupBy("lang", "entry").agg(F.count("*").alias("n")).persist()
    padded = F.concat(F.lit(EDGE), "entry", F.lit(EDGE))
    pieces = words.select("lang", "n", padded.alias("word"), F.explode(F.sequence(F.lit(1), F.lit(max_gram))).alias("size"))
    pieces = pieces.filter(F.length("word") >= F.col("size"))
    starts = F.explode(F.sequence(F.lit(1), F.length("word") - F.col("size") + 1))
    pieces = pieces.select("lang", "n", "word", "size", starts.alias("at"))
    grams = pieces.groupBy("lang", F.expr("substring(word, at, size)").alias("entry")).agg(F.sum("n").alias("n"))
    found = [_top(frame, languages, max_entries) for frame in (words, grams)]
    words.unpersist()
    known = {entry: k for k, entry in enumerate(found[0].entries)}
    pieces = {entry: len(known) + k for k, entry in enumerate(found[1].entries)}
    return LanguageModel(languages, known, pieces, Logs(found, len(languages)))


def _top(counts: DataFrame, languages: list[str], most: int) -> Table:
    """The most frequent entries with their counts by language; those seen once only tell nothing.

    They come to the driver as arrays of numbers: a Python object for each count would be most of its memory.
    """
    seen = F.array_sort(F.collect_list(F.struct("lang", "n"))).alias("seen")  # an element for each language at most
    table = counts.groupBy("entry").agg(F.sum("n").alias("total"), seen).filter(F.col("total") > 1)
    table = table.orderBy(F.desc("total"), "entry").limit(most)
    found = table.select("entry", F.col("seen.lang").alias("langs"), F.col("seen.n").alias("counts")).toArrow()
    langs, n = (found[name].combine_chunks() for name in ("langs", "counts"))
    places = pc.index_in(langs.flatten(), pa.array(languages, pa.string()))
    sizes = pc.list_value_length(langs)
    return Table(found["entry"].to_pylist(), sizes.to_numpy(), places.to_numpy().astype(np.int32), n.flatten().to_numpy())


def predict_column(spark: SparkSession, model: LanguageModel, text: str) -> Column:
    """Struct of lang and score for a text column."""
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang:string,score:double>")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ready = shared.value
        for batch in batches:
            found = [ready.predict(x.as_py()) for x in batch]
            yield pa.array([{"lang": lang, "score": score} for lang, score in found], kind)

    return column(F.col(text))
