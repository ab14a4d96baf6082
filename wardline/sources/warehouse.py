"""Catalog tables of raw incidents, keys, cube and marts, and the published state that says which of their parts count.

Tables only ever get new parts: a load's rows and keys, a month's cube and area sums, a mart. Which parts are read is
one small state (sources.versions), with the load marks and what became of each planned month in it. A publication
collects what a job adds and swaps the state at its end, so rows, marts and marks appear together; a job that dies leaves
parts that nobody reads. Two jobs that began at the same state cannot both publish.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardline.operators import marts
from wardline.operators.cube import added_cubes, incident_cube
from wardline.operators.incremental import PAIR, first_files, rows_without
from wardline.operators.staging import clean, stage
from wardline.schema import RAW_COLUMNS, RAW_PARTITIONS, ROW_KEY
from wardline.session import ROWS_PER_PARTITION, spread, written
from wardline.sources import marks
from wardline.sources.versions import ConflictError, Versions  # noqa: F401  (callers catch the first)

STAGING_VIEW = "staged_incidents"
MART_NAMES = ("by_category", "by_month", "by_force", "hotspots")
# Marts of one part, and those of a part for each month.
WHOLE_MARTS, MONTHLY = ("by_category", "by_month", "by_force"), ("incident_cube", "area_sums", "hotspots")
_SUFFIX = r"~[0-9a-f]{12}$"


@contextmanager
def _replacing_partitions(spark: SparkSession) -> Iterator[None]:
    """Overwrite only partitions that get rows. insertInto takes this from the session alone."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@dataclass(frozen=True)
class Load:
    """What a batch added. keyless rows have no ID and come again when their batch does."""

    load_id: str
    inserted: int
    keyless: int


def _empty() -> dict:
    """loads: parts of the raw table and the (force, month) in them that a later part replaced; summed: those that the marts
    hold; months: the part of each month by table; whole: the part of each mart; marks and status: by force."""
    return {"loads": {}, "summed": [], "months": {name: {} for name in MONTHLY}, "whole": {}, "marks": {}, "status": {}}


@dataclass
class Draft:
    """A state that is being changed, the version it began at, and its name for new parts."""

    expected: int
    state: dict
    part: str = field(default_factory=lambda: uuid.uuid4().hex[:12])


@dataclass(frozen=True)
class Warehouse:
    """Tables in the databases raw and marts, each name with an optional prefix.

    With a root folder the databases live below it, otherwise where the catalog puts them. buckets is how many parts
    the keys of a load are kept in; with at least as many as the session has shuffle partitions, a load
    compares its keys without moving the stored ones.
    """

    spark: SparkSession
    root: str | None = None
    prefix: str = ""
    buckets: int | None = None
    draft: Draft | None = field(default=None, compare=False)

    def _name(self, database: str, table: str) -> str:
        return f"{self.prefix}{database}.{table}"

    def initialise(self) -> None:
        """Create databases and tables that are not there yet."""
        for database in ("raw", "staging", "marts"):
            location = f" LOCATION '{self.root}/{database}'" if self.root else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{database}{location}")
        columns = ", ".join(f"{name} {kind}" for name, kind in RAW_COLUMNS.items())
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name('raw', 'incidents')} ({columns}) "
            f"USING parquet PARTITIONED BY ({', '.join(RAW_PARTITIONS)})"
        )
        count = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        keys = ", ".join(f"{name} string" for name in (*ROW_KEY, "load_id", "key_month"))
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name('raw', 'incident_keys')} ({keys}) USING parquet "
            f"PARTITIONED BY (load_id, key_month) CLUSTERED BY ({', '.join(ROW_KEY)}) INTO {count} BUCKETS"
        )
        verdicts = "source_path string, file_name string, force string, month string, row_count bigint, reason string, noted_at timestamp, load_id string"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._name('raw', 'file_verdicts')} ({verdicts}) USING parquet PARTITIONED BY (load_id)")

    # -- published state --------------------------------------------------------------------------

    def _versions(self) -> Versions:
        where = self.spark.catalog.getDatabase(f"{self.prefix}raw").locationUri
        return Versions(self.spark, f"{where}/_published")

    def state(self) -> dict:
        """What counts now: in a publication its own state, else the newest published one."""
        if self.draft:
            return self.draft.state
        return self._versions().newest()[1] or _empty()

    @contextmanager
    def publication(self, spark: SparkSession | None = None) -> Iterator[Warehouse]:
        """A warehouse whose changes are seen by nobody else until the block ends without an error, and then at once.

        Raises ConflictError if another job has published meanwhile: nothing of this one counts then.
        """
        if self.draft:
            yield self
            return
        versions = self._versions()
        number, state = versions.newest()
        house = replace(self, draft=Draft(number, state or _empty()), spark=spark or self.spark)
        yield house
        versions.publish(number, house.draft.state)
        self._remove_outdated(versions)

    def _remove_outdated(self, versions: Versions) -> None:
        """Drop old states and the parts that only they name; parts of jobs under way are in no state yet."""
        outdated = versions.outdated()
        if not outdated:
            return
        kept = set().union(*[_parts(versions.read(n)) for n in versions.numbers()[len(outdated) :]])
        for table, spec in sorted(set().union(*[_parts(versions.read(n)) for n in outdated]) - kept):
            for part in self.spark.sql(f"SHOW PARTITIONS {self.prefix}{table} PARTITION ({spec})").collect():
                cells = [unquote(cell).replace("'", "\\'").split("=", 1) for cell in part[0].split("/")]
                values = ", ".join(f"{name}='{value}'" for name, value in cells)
                self.spark.sql(f"ALTER TABLE {self.prefix}{table} DROP IF EXISTS PARTITION ({values})")
        for number in outdated:
            versions.forget(number)

    # -- raw table and staging --------------------------------------------------------------------

    def _counted(self, rows: DataFrame, month: str = "month") -> DataFrame:
        """Rows of the parts that count; load_id is the partition's value. Everything here is about partitions."""
        loads = self.state()["loads"]
        chosen = F.col("load_id").isin(sorted(loads)) if loads else F.lit(False)
        gone = [
            (F.col("load_id") == part) & F.col("force").eqNullSafe(F.lit(force)) & F.col(month).eqNullSafe(F.lit(name))
            for part, pairs in sorted(loads.items())
            for force, name in pairs
        ]
        rows = rows.where(chosen)
        return rows.where(~reduce(Column.__or__, gone)) if gone else rows

    def raw(self) -> DataFrame:
        rows = self._counted(self.spark.table(self._name("raw", "incidents")))
        return rows.withColumn("load_id", F.regexp_replace("load_id", _SUFFIX, ""))

    def keys(self) -> DataFrame:
        """ROW_KEY of every row that counts and has an ID, bucketed by the key, with load_id (the part) and key_month."""
        return self._counted(self.spark.table(self._name("raw", "incident_keys")), "key_month")

    def staged(self, strict: bool = True) -> DataFrame:
        return stage(self.raw(), strict)

    def create_staging_view(self) -> None:
        """Staging stays a view: nothing is stored, filters reach the raw table."""
        self.staged().createOrReplaceTempView(STAGING_VIEW)

    def load(
        self, batch: DataFrame, load_id: str, dedupe_within_batch: bool = False, file_order: str | None = None
    ) -> Load:
        """Append the rows of a batch that are new.

        With file_order, a column that orders the files a batch consists of, the result is the same as if
        they had been loaded one by one in that order.

        A force-month written under a load_id belongs to that batch. Repeated, the batch replaces what it
        wrote before, so no row is lost or doubled, and it is compared with the rows of other batches only. A
        load_id must not be used for another batch.

        The batch is written once and all else is taken from that; its keys are compared with the key table, and what is
        added is counted while it is written.
        """
        # A streaming batch has a session of its own.
        with self.publication(batch.sparkSession) as house:
            return house._load(batch, load_id, dedupe_within_batch, file_order)

    def _load(self, batch: DataFrame, load_id: str, dedupe_within_batch: bool, file_order: str | None) -> Load:
        stored = [name for name in RAW_COLUMNS if name not in RAW_PARTITIONS]
        loose = [name for name in RAW_PARTITIONS if name != "load_id"]
        batch = written(batch.select(*stored, *loose, *([file_order] if file_order else [])), "batch")
        with spread(batch.sparkSession, size := batch.count()):
            return self._store(batch, size, stored, loose, load_id, dedupe_within_batch, file_order)

    def _store(
        self, batch: DataFrame, size: int, stored: list[str], loose: list[str], load_id: str, dedupe_within_batch: bool, file_order: str | None
    ) -> Load:
        """Compare a written batch of so many rows with the keys and write what is new of it."""
        if file_order is not None:
            batch = first_files(batch, file_order).drop(file_order)
        # As many as forces and months.
        pairs = [(row["force"], row["month"]) for row in batch.select(*PAIR).distinct().collect()]
        part, loads = f"{load_id}~{self.draft.part}", self.draft.state["loads"]
        same = [other for other in loads if other.rsplit("~", 1)[0] == load_id]
        known = self.keys().where(F.col("key_month").isin([month for _, month in pairs if month is not None]))
        if same:
            known = known.where(~F.col("load_id").isin(same))
        fresh = rows_without(batch, known, dedupe_within_batch)
        seen = Observation()
        rows = fresh.select(*stored, F.lit(part).alias("load_id"), *loose).observe(
            seen, F.count(F.lit(1)).alias("inserted"), F.count_if(F.col("crime_id").isNull()).alias("keyless")
        )
        table = self._name("raw", "incidents")
        with _replacing_partitions(rows.sparkSession):
            rows.write.mode("overwrite").insertInto(table)
        counts = seen.get
        own = self.spark.table(table).where(F.col("load_id") == part)
        keys = own.where(F.col("crime_id").isNotNull()).select(*ROW_KEY).distinct()
        count = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # All keys of a month and bucket meet in one task, for one file; no task has to hold a bucket's keys of all months.
        tasks = max(count, -(-size // ROWS_PER_PARTITION))
        keys = keys.repartition(tasks, "month", F.pmod(F.hash(*ROW_KEY), F.lit(count))).select(*ROW_KEY, F.lit(part).alias("load_id"), F.col("month").alias("key_month"))
        with _replacing_partitions(self.spark):
            keys.write.mode("overwrite").insertInto(self._name("raw", "incident_keys"))
        filled = [(row["force"], row["month"]) for row in own.select(*PAIR).distinct().collect()]
        for other in same:
            if other != part:
                loads[other] = sorted({*map(tuple, loads[other]), *filled}, key=str)
        loads[part] = []
        return Load(load_id, counts["inserted"], counts["keyless"])

    def loaded(self, load_id: str) -> DataFrame:
        return self.raw().where(F.col("load_id") == load_id)

    # -- marts ------------------------------------------------------------------------------------

    def _write_whole(self, frame: DataFrame, table: str) -> None:
        name, part = self._name("marts", table), self.draft.part
        rows = frame.hint("rebalance").withColumn("part", F.lit(part))
        self._add(rows, name, ["part"])
        self.draft.state["whole"][table] = part

    def _write_months(self, frame: DataFrame, table: str, months: list[str], replace_all: bool) -> None:
        """Write a part of each of the months; with replace_all no other month counts any more."""
        name, part = self._name("marts", table), self.draft.part
        rows = frame.hint("rebalance", "month").withColumn("part", F.lit(part))
        self._add(rows, name, ["month", "part"])
        own = dict.fromkeys(months, part)
        before = {} if replace_all else self.draft.state["months"][table]
        self.draft.state["months"][table] = {**before, **own}

    def _add(self, rows: DataFrame, name: str, by: list[str]) -> None:
        if not self.spark.catalog.tableExists(name):
            rows.limit(0).write.partitionBy(*by).saveAsTable(name)
        with _replacing_partitions(self.spark):
            rows.select(*self.spark.table(name).columns).write.mode("overwrite").insertInto(name)

    def _months_of(self, table: str, months: list[str] | None = None) -> DataFrame:
        """Rows of a table by months: of each month the part that counts."""
        parts = self.state()["months"][table]
        wanted: dict[str, list[str]] = {}
        for month, part in sorted(parts.items()):
            if months is None or month in months:
                wanted.setdefault(part, []).append(month)
        rows = self.spark.table(self._name("marts", table))
        chosen = [(F.col("part") == part) & F.col("month").isin(own) for part, own in wanted.items()]
        return rows.where(reduce(Column.__or__, chosen) if chosen else F.lit(False)).drop("part")

    def refresh_marts(self, months: list[str] | None = None) -> None:
        """Rebuild all marts, reading all raw rows or only those of the months that changed.

        Cube and area sums hold no figure that spans months, so unchanged months are kept. The other
        marts are computed from the cube, which has one row per month, force, category and outcome.
        """
        with self.publication() as house:
            rows = house.raw()
            if months is not None:
                rows = rows.where(F.col("month").isin(months))
            cleaned = clean(rows)
            present = sorted(row["month"] for row in cleaned.select("month").distinct().collect())
            house._rebuild(incident_cube(cleaned), marts.area_sums(cleaned), present if months is None else sorted(months), months is None)
            state = house.draft.state
            left = set(state["loads"]) - set(state["summed"])
            if months is not None and left:  # a part counts as summed if all its months were
                parts = house._parts_of(left).where(F.col("month").isNull() | ~F.col("month").isin(months))
                left -= {row["load_id"] for row in parts.select("load_id").distinct().collect()}
            state["summed"] = sorted({*state["summed"], *left} & set(state["loads"]))

    def grow_marts(self, load_id: str) -> None:
        """Add a load to the marts: its rows are read, and the sums of its months, but no raw row of another load.

        Where the load replaced rows that it had written before, its months are rebuilt.
        """
        with self.publication() as house:
            state = house.draft.state
            own = [part for part in state["loads"] if part.rsplit("~", 1)[0] == load_id]
            fresh = [part for part in own if part not in state["summed"]]
            stale = [part for part in own if part in state["summed"] and state["loads"][part]]
            rows = house._parts_of(fresh)
            months = {row["month"] for row in rows.where("month is not null").select("month").distinct().collect()}
            if not all(house.spark.catalog.tableExists(house._name("marts", name)) for name in MONTHLY) or not house.ready():
                house.refresh_marts()
                return
            if stale:
                months |= {month for part in stale for _, month in state["loads"][part] if month is not None}
                house.refresh_marts(sorted(months))
            else:
                added = clean(rows)
                cube = added_cubes(house._months_of("incident_cube", sorted(months)).unionByName(incident_cube(added)))
                areas = marts.added_areas(house._months_of("area_sums", sorted(months)).unionByName(marts.area_sums(added)))
                house._rebuild(cube, areas, sorted(months), False)
            state["summed"] = sorted({*state["summed"], *fresh})

    def _parts_of(self, parts: Iterable[str]) -> DataFrame:
        """Raw rows of these parts that count."""
        return self._counted(self.spark.table(self._name("raw", "incidents"))).where(F.col("load_id").isin(sorted(parts)) if parts else F.lit(False))

    def _rebuild(self, cube: DataFrame, areas: DataFrame, months: list[str], whole: bool) -> None:
        self._write_months(cube, "incident_cube", months, whole)
        self._write_months(areas, "area_sums", months, whole)
        self._write_months(marts.hotspots_of(self._months_of("area_sums", months)), "hotspots", months, whole)
        cube = self.cube()
        self._write_whole(marts.by_category(cube), "by_category")
        self._write_whole(marts.by_month(cube), "by_month")
        self._write_whole(marts.by_force(cube), "by_force")

    def cube(self) -> DataFrame:
        return self._months_of("incident_cube")

    def mart(self, name: str, in_order: bool = False) -> DataFrame:
        if name in MONTHLY:
            frame = self._months_of(name)
        else:
            frame = self.spark.table(self._name("marts", name)).where(F.col("part") == self.state()["whole"][name])
        frame = frame.select(*marts.MART_COLUMNS[name])
        return marts.ordered(frame, name) if in_order else frame

    def models(self, months: list[str] | None = None) -> dict[str, DataFrame]:
        """Staging and marts by the names the column tests use, of all months or only of some."""
        frames = {"staging": self.staged(), **{name: self.mart(name) for name in MART_NAMES}}
        if months is None:
            return frames
        # Staging keeps the month as it is, so the filter is one on the raw table's partitions.
        return {name: frame.where(F.col("month").isin(months)) for name, frame in frames.items()}

    def ready(self) -> bool:
        """True only if the month mart can be queried."""
        if "by_month" not in self.state()["whole"]:
            return False
        try:
            self.mart("by_month").limit(1).collect()
        except Exception:  # files gone or unreadable: not ready
            return False
        return True

    # -- verdicts on files ------------------------------------------------------------------------

    def note_files(self, verdicts: list[tuple], load_id: str) -> None:
        """Keep (source_path, file_name, force, month, row_count, reason) of a load's files; one that is repeated
        replaces what it noted."""
        rows = self.spark.createDataFrame(verdicts, "source_path string, file_name string, force string, month string, row_count bigint, reason string")
        stamped = rows.select("*", F.current_timestamp().alias("noted_at"), F.lit(load_id).alias("load_id"))
        with _replacing_partitions(self.spark):
            stamped.coalesce(1).write.mode("overwrite").insertInto(self._name("raw", "file_verdicts"))

    def file_verdicts(self) -> DataFrame:
        """Every file a load has looked at; reason says why it was held back, null if it was not."""
        return self.spark.table(self._name("raw", "file_verdicts"))

    # -- load marks -------------------------------------------------------------------------------

    def mark_log(self) -> DataFrame:
        """(force, month, updated_at): the mark of each force as last set."""
        rows = [(force, month, datetime.fromisoformat(at)) for force, (month, at) in self.state()["marks"].items()]
        return self.spark.createDataFrame(rows, marks.SCHEMA)

    def marks(self) -> DataFrame:
        return marks.latest_marks(self.mark_log())

    def mark(self, force: str) -> str | None:
        return marks.mark_of(self.mark_log(), force)

    def month_status(self) -> DataFrame:
        """(force, month, status) of every month that was ever planned."""
        rows = [(force, month, status) for force, months in self.state()["status"].items() for month, status in months.items()]
        return self.spark.createDataFrame(rows, "force string, month string, status string")

    def log_months(self, entries: list[tuple[str, str, str]]) -> None:
        """Note (force, month, status), as many entries as a run has months."""
        if not entries:
            return
        with self.publication() as house:
            status = house.draft.state["status"]
            for force, month, what in entries:
                if what == marks.FORGOTTEN:
                    status.get(force, {}).pop(month, None)
                else:
                    status.setdefault(force, {})[month] = what

    def advance_marks(self) -> None:
        """Move each mark to the last month before the first one that is not loaded."""
        moved = marks.advanced_marks(self.marks(), self.month_status()).collect()  # a row per force
        if moved:
            self._set_marks([(row["force"], row["month"]) for row in moved])

    def reload_after(self, force: str, month: str) -> None:
        """Set a mark by hand and forget what is known of later months: they are planned anew."""
        with self.publication() as house:
            later = house.month_status().where((F.col("force") == force) & (F.col("month") > month)).collect()
            house.log_months([(force, row["month"], marks.FORGOTTEN) for row in later])
            house._set_marks([(force, month)])

    def set_marks(self, pairs: DataFrame) -> None:
        """Set the mark of each (force, month); the newest setting counts, not the latest month."""
        self._set_marks([(row["force"], row["month"]) for row in pairs.select("force", "month").collect()])  # a row per force

    def _set_marks(self, pairs: list[tuple[str, str]]) -> None:
        with self.publication() as house:
            now = datetime.now(timezone.utc).isoformat()
            for force, month in pairs:
                house.draft.state["marks"][force] = [month, now]


def _parts(state: dict) -> set[tuple[str, str]]:
    """(table, partition) that a state names, as far as the catalog's tables have them."""
    raw = {(table, f"load_id='{part}'") for part in state["loads"] for table in ("raw.incidents", "raw.incident_keys")}
    monthly = {(f"marts.{t}", f"month='{month}', part='{part}'") for t, months in state["months"].items() for month, part in months.items()}
    return raw | monthly | {(f"marts.{t}", f"part='{part}'") for t, part in state["whole"].items()}
