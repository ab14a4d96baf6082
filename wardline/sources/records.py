"""Records of CSV files: whole ones, also where a quoted field runs over lines, and files of any size in many tasks.

Files are read as physical lines, which Spark splits into blocks at any line break. Whether a line begins inside a
quoted field follows from the lines before it. Each line is a function of that state (it leaves the state as it
is, swaps it, or sets it), and such functions are put together in any grouping: a block's lines first, then a file's
blocks. Almost all lines have no quote that stays open, and their blocks need no more than one aggregate row; only
the lines of blocks where a field does stay open are put in order, block by block, and only lines of one record meet.

The lines are written to the shared folder once, so that blocks and places are the same for every later step. All else
is decided per file, as rows: nothing about one file stops the others.

Defined results: a file is UTF-8 if all of it is, else ISO-8859-1; a byte-order mark is no part of the header.
Lines end with LF or CRLF; empty ones are passed over, the header is the first other one. A record
longer than MOST_BYTES, as a quote that is never closed makes, is given by its first line and counts as malformed.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.session import written

UTF8, LATIN1 = "UTF-8", "ISO-8859-1"
# Set for a record that has more or fewer fields than the header.
MALFORMED = "_malformed"
# A record of several lines is put together up to this size.
MOST_BYTES = 1 << 20
MARK_BYTES = 3
_CSV = {"escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "columnNameOfCorruptRecord": MALFORMED}

_WITHIN = r'(?:[^"]|"")*+'
_FIELD = rf'(?:"{_WITHIN}"[^,]*+|[^",][^,]*+|)'
_LAST_OPEN = rf'(?:{_FIELD},)*+"{_WITHIN}$'
# Whether a line that begins outside, or inside, a quoted field ends inside one.
ENDS_OPEN = rf"^{_LAST_OPEN}"
STAYS_OPEN = rf'^{_WITHIN}(?:$|"[^,]*+,{_LAST_OPEN})'

PLACE = ["source_path", "block"]


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Physical lines with their place, and what each does to the state. Unreadable parts are left out here and
    are missed in the count of bytes."""
    reader = spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    value = F.col("value").cast("binary")
    plain = F.decode(value, LATIN1)  # one character a byte: quotes and commas are what they are in both encodings
    quoted = F.col("value").contains('"')
    return reader.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        value.alias("value"),
        F.is_valid_utf8("value").alias("utf8"),
        F.when(quoted, F.rlike(plain, F.lit(ENDS_OPEN))).otherwise(False).alias("opens"),
        F.when(quoted, F.rlike(plain, F.lit(STAYS_OPEN))).otherwise(True).alias("stays"),
    )


def _running(rows: DataFrame, partition: list[str], order: str) -> DataFrame:
    """Rows with set_ and swaps_, the function of all rows up to each (see after); rows come with opens and stays."""
    upto = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    swap = (F.col("opens") & ~F.col("stays")).cast("long")
    counted = rows.withColumn("swaps_", F.sum(swap).over(upto))
    sets = F.when(F.col("opens") == F.col("stays"), F.struct(F.col("opens").alias("to"), F.col("swaps_").alias("swaps")))
    return counted.withColumn("set_", F.last(sets, ignorenulls=True).over(upto))


def _after(start: Column) -> Column:
    """The state behind a row of _running, for a state before all of them."""
    since = F.col("swaps_") - F.coalesce("set_.swaps", F.lit(0))
    return F.coalesce(F.col("set_.to"), start) != (since % 2 == 1)


def _block_states(lines: DataFrame) -> DataFrame:
    """(source_path, block, inside, lines that stay or not): per block whether it begins inside a quoted field.

    quiet blocks begin outside and leave no field open at any line's end.
    """
    facts = lines.groupBy(*PLACE).agg(F.bool_or("opens").alias("any"), F.bool_and("stays").alias("all_stay"))
    # Blocks in which a field stays open: their function takes their lines in order.
    open_places = facts.where("any").select(*PLACE)
    in_order = _running(lines.join(open_places, PLACE, "left_semi"), PLACE, "at")
    last = in_order.groupBy(*PLACE).agg(F.max_by(F.struct("set_", "swaps_"), "at").alias("last")).select(*PLACE, "last.*")
    exact = last.select(*PLACE, _after(F.lit(False)).alias("opens"), _after(F.lit(True)).alias("stays"))
    # Of the others it is known: from outside they end outside, from inside they do if any line closes the field.
    quiet = facts.where("not any").select(*PLACE, F.lit(False).alias("opens"), F.col("all_stay").alias("stays"))
    blocks = _running(quiet.unionByName(exact), ["source_path"], "block")
    before = F.lag(_after(F.lit(False)), 1, False).over(Window.partitionBy("source_path").orderBy("block"))
    return blocks.withColumn("inside", before).join(facts.select(*PLACE, "any"), PLACE).select(*PLACE, "inside", "any", _after(F.lit(False)).alias("left_open"))


def _records(lines: DataFrame, states: DataFrame) -> DataFrame:
    """(source_path, value, long): every record with its line breaks, and whether it was cut for its length."""
    loud = written(states.where(F.col("inside") | F.col("any")).select(*PLACE, "inside"), "open_blocks")
    quiet = lines.join(loud, PLACE, "left_anti").select("source_path", "value", F.lit(False).alias("long"))
    if loud.isEmpty():
        return quiet
    own = _running(lines.join(loud, PLACE), PLACE, "at").withColumn("open_after", _after(F.col("inside")))
    in_block = Window.partitionBy(*PLACE).orderBy("at")
    begins = ~F.coalesce(F.lag("open_after").over(in_block), F.col("inside"))
    own = own.withColumn("begins", begins)
    whole = own.where(F.col("begins") & ~F.col("open_after")).select("source_path", "value", F.lit(False).alias("long"))
    # The line at which a record begins: in the block, or the last one that began in a block before it.
    start = F.struct("block", "at")
    started = F.last(F.when(F.col("begins"), start), ignorenulls=True).over(in_block.rowsBetween(Window.unboundedPreceding, 0))
    parts = own.where(~F.col("begins") | F.col("open_after")).select(*PLACE, "at", "value", "begins")
    own_start = own.select(*PLACE, "at", started.alias("start"))
    ends = own_start.groupBy(*PLACE).agg(F.max("start").alias("last"))
    earlier = F.last("last", ignorenulls=True).over(Window.partitionBy("source_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    carried = ends.select(*PLACE, earlier.alias("carried"))
    placed = parts.join(own_start, [*PLACE, "at"]).join(carried, PLACE).withColumn("record", F.coalesce("start", "carried"))
    sizes = placed.groupBy("source_path", "record").agg(F.sum(F.octet_length("value") + 1).alias("bytes"))
    sized = placed.join(sizes, ["source_path", "record"])
    fits = sized.where(F.col("bytes") <= MOST_BYTES).groupBy("source_path", "record")
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"])
    joined = fits.agg(pieces.alias("pieces")).select("source_path", _glued("pieces").alias("value"), F.lit(False).alias("long"))
    cut = sized.where((F.col("bytes") > MOST_BYTES) & F.col("begins")).select("source_path", "value", F.lit(True).alias("long"))
    return quiet.unionByName(whole).unionByName(joined).unionByName(cut)


def _glued(pieces: str) -> Column:
    """Binary lines put together with the line breaks between them."""
    newline = F.lit(b"\n")
    return F.aggregate(F.slice(F.col(pieces), 2, F.size(pieces)), F.element_at(pieces, 1), lambda whole, x: F.concat(whole, newline, x))


@dataclass(frozen=True)
class Scan:
    """Lines of a set of files, written once, and what is known of each file.

    files: source_path, length (bytes), utf8, header (text, null without one), at (the header's place), problem: why its
    rows cannot be used, or null.
    """

    spark: SparkSession
    lines: DataFrame
    states: DataFrame
    files: DataFrame

    def records(self, chosen: DataFrame | None = None, encoding: str | None = None) -> DataFrame:
        """(source_path, text, long) of the chosen files (source_path), or all: records after the header, decoded."""
        facts = self.files if chosen is None else self.files.join(chosen, "source_path", "left_semi")
        facts = facts.select("source_path", "utf8", F.col("at").alias("header_at"))
        lines = self.lines.join(facts.select("source_path", "header_at"), "source_path")
        lines = lines.where((F.col("block") > 0) | (F.col("at") > F.col("header_at"))).drop("header_at")
        found = _records(lines, self.states).join(facts.select("source_path", "utf8"), "source_path")
        latin, own = F.decode("value", LATIN1), F.decode("value", UTF8)
        text = F.decode("value", encoding) if encoding else F.when(F.col("utf8"), own).otherwise(latin)
        text = F.regexp_replace(text, r"\r\z", "")
        return found.select("source_path", text.alias("text"), "long").where(F.col("text") != "")

    def rows(self, names: Sequence[str], chosen: DataFrame | None = None, encoding: str | None = None) -> DataFrame:
        """Text columns of these names, MALFORMED and source_path, one row a record."""
        schema = ", ".join(f"`{name}` string" for name in (*names, MALFORMED))
        parsed = self.records(chosen, encoding).select("source_path", "text", "long", F.from_csv("text", schema, _CSV).alias("_row"))
        wrong = F.when(F.col("long"), F.col("text")).otherwise(F.col(f"_row.{MALFORMED}")).alias(MALFORMED)
        return parsed.select(*[F.col(f"_row.`{name}`") for name in names], wrong, "source_path")


def list_paths(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """Every file under the paths as rows name it, also one of 0 bytes, which no reader hands on."""
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths)).inputFiles()
    return sorted(re.sub(r"^(\w+):///", r"\1:/", name) for name in files)


def scan(spark: SparkSession, paths: str | Sequence[str]) -> Scan:
    """Look at all files under the paths, each of which must exist; no file's content stops this."""
    named = spark.createDataFrame([(path,) for path in list_paths(spark, paths)], "source_path string")
    sized = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    sized = sized.select(F.col("_metadata.file_path").alias("source_path"), "length")
    listed = named.join(sized, "source_path", "left").select("source_path", F.coalesce("length", F.lit(0)).alias("length"))
    lines = written(_lines(spark, paths), "lines")
    states = written(_block_states(lines), "block_states")
    filled = ~lines["value"].isin([F.lit(b""), F.lit(b"\r")])
    first = F.when((F.col("block") == 0) & filled, F.col("at"))
    facts = lines.groupBy("source_path").agg(
        F.bool_and("utf8").alias("utf8"), F.sum(F.octet_length("value") + 1).alias("read"), F.min_by("value", first).alias("header"), F.min(first).alias("at")
    )
    ends = states.groupBy("source_path").agg(F.max_by("left_open", "block").alias("left_open"))
    known = listed.join(facts, "source_path", "left").join(ends, "source_path", "left")
    header = F.when(F.col("utf8"), F.decode("header", UTF8)).otherwise(F.decode("header", LATIN1))
    header = F.regexp_replace(header, "^(﻿|ï»¿)|\\r\\z", "")
    missing = F.coalesce("read", F.lit(0)) + MARK_BYTES < F.col("length")
    problem = (
        F.when(missing, F.format_string("unreadable: %d of %d bytes", F.coalesce("read", F.lit(0)), "length"))
        .when(header.isNull(), "no header")
        .when(F.col("left_open"), "a quote is never closed")
    )
    files = known.select("source_path", "length", F.coalesce("utf8", F.lit(True)).alias("utf8"), header.alias("header"), "at", problem.alias("problem"))
    return Scan(spark, lines, states, written(files, "files"))


def column_names(header: str) -> list[str]:
    """Names in a header line; one without a name is _c and its place, one that comes again gets its place added."""
    names = next(csv.reader([header], strict=False), [])
    lower = [name.lower() for name in names]
    return [f"_c{k}" if not name else f"{name}{k}" if lower.count(name.lower()) > 1 else name for k, name in enumerate(names)]
