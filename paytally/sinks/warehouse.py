"""First-write-wins loads into catalog tables on Parquet.

Loads only add, and skip keys that are already stored, so a load that was cut off can
simply be run again: rows it had published are found and left alone. One writer per
table at a time; plain Parquet has no transactions.

**Days.** A reader sees all rows that a load adds to a day of a table, or none. New days
and days that get more rows are written aside as whole versions (``versions``) and then
published one by one, as locations of the catalog's partitions. A day that gets rows is
written again with those it had; a load that brings nothing new writes nothing.

**Users.** Their table is bucketed by id, so that joins with it shuffle the other side
only. The number of buckets is noted beside the files.

**Best rows.** With each day of a metric, its ``BEST_ROWS`` first rows in report order
are stored, marked with the version of the day that they were taken from.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from paytally.functions import valid
from paytally.operators import first_per_key, keep_known_users, new_keys_only
from paytally.schema import TABLES, TableSpec
from paytally.session import drop_path, file_system
from paytally.sinks.days import BatchDays
from paytally.sinks.jdbc import JdbcTarget
from paytally.sinks.versions import DAY_FOLDER, DayVersions, Version

# Rows per day and metric that reports can be answered from without reading the day.
BEST_ROWS = 1000
# Most buckets of a new users table, which has as many as the session's shuffles have
# partitions. Each is one task of a join, and one more file with each load.
MAX_BUCKETS = 4096
# The highest number of publication that the catalog has been told of.
_TOLD = "paytally.published"
# Partitions that one statement adds.
_PER_STATEMENT = 200


def ranking(spec: TableSpec) -> list[Column]:
    """Order of a metric's rows in reports: largest first, ties to the smaller ids."""
    return [F.col(spec.measure).desc(), *[F.col(c).asc() for c in spec.user_columns]]


def _on(days: Iterable[str]) -> Column:
    return F.col("transaction_date").isin(*map(dt.date.fromisoformat, days))


@dataclass(frozen=True)
class Warehouse:
    """The result tables in one catalog database, stored below ``location``."""

    spark: SparkSession
    location: str
    database: str = "paytally"
    user_buckets: int | None = None

    def full_name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def path(self, table: str) -> str:
        return f"{self.location.rstrip('/')}/{table}"

    def versions(self, table: str) -> DayVersions:
        return DayVersions(self.spark, self.path(table))

    def best_versions(self, table: str) -> DayVersions:
        return DayVersions(self.spark, self.path(f"{table}_best"))

    def ensure_database(self) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")

    def ensure_table(self, table: str) -> None:
        """Create the table if the catalog lacks it.

        Dated tables are split by day, users into buckets.
        """
        spec = TABLES[table]
        if self.spark.catalog.tableExists(self.full_name(table)):
            return
        self.ensure_database()
        split = "PARTITIONED BY (transaction_date)" if spec.is_dated else self._buckets(table)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.full_name(table)} ({spec.ddl}) "
            f"USING parquet {split} LOCATION '{self.path(table)}'"
        )
        if spec.is_dated:
            self.register_days(table)

    def _buckets(self, table: str) -> str:
        """How the files of a table without days are split, or shall be if there are none.

        Files of another session must be read in the buckets they were written in, so
        their number is noted as the name of an empty file; without it, files have none.
        """
        fs, folder = file_system(self.spark, self.path(table))
        names = []
        if fs.exists(folder):
            names = [entry.getPath().getName() for entry in fs.listStatus(folder)]
        noted = [name.removeprefix("_buckets-") for name in names if name.startswith("_buckets-")]
        if not noted and any(name.endswith(".parquet") for name in names):
            return ""
        if not noted:
            partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            noted = [str(self.user_buckets or min(partitions, MAX_BUCKETS))]
            mark = file_system(self.spark, f"{self.path(table)}/_buckets-{noted[0]}")[1]
            fs.create(mark, True).close()
        keys = ", ".join(TABLES[table].keys)
        return f"CLUSTERED BY ({keys}) INTO {int(noted[0])} BUCKETS"

    def buckets_of(self, table: str) -> int:
        """Number of buckets of a table; 0 if it has none."""
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.full_name(table)}").collect()
        return next((int(r.data_type) for r in rows if r.col_name == "Num Buckets"), 0)

    def register_days(self, table: str) -> None:
        """Tell the catalog of days, and versions of days, that it does not know.

        They come from a session with another catalog, or from a load that died between
        a publication and the catalog's statement. Compares names and numbers only.
        """
        name, versions = self.full_name(table), self.versions(table)
        current, loose = versions.current(), versions.loose()
        if not current and not loose:
            return
        partitions = self.spark.sql(f"SHOW PARTITIONS {name}").collect()
        known = {row.partition.removeprefix(DAY_FOLDER) for row in partitions}
        if loose - known - current.keys():
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            known |= loose
        properties = self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
        told = int(next((p.value for p in properties if p.key == _TOLD), 0))

        def place(version) -> tuple[str, str]:
            spec = f"PARTITION (transaction_date = '{version.day}')"
            return spec, f"LOCATION '{versions.day_folder(version)}'"

        added = [place(v) for v in current.values() if v.day not in known]
        for start in range(0, len(added), _PER_STATEMENT):
            part = " ".join(f"{s} {at}" for s, at in added[start : start + _PER_STATEMENT])
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {part}")
        for version in current.values():
            if version.day in known and version.number > told:
                spec, at = place(version)
                self.spark.sql(f"ALTER TABLE {name} {spec} SET {at}")
        newest = max((v.number for v in current.values()), default=0)
        if newest > told:
            self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_TOLD}' = '{newest}')")

    def read_table(self, table: str) -> DataFrame:
        """A result table in its declared column order."""
        self.ensure_table(table)
        return self.spark.table(self.full_name(table)).select(*TABLES[table].column_names)

    def read_staged(self, staging: str, table: str) -> DataFrame:
        return self.spark.table(self.full_name(staging))

    def _best(self, table: str) -> dict[str, Version]:
        """By day: the best rows that were taken from the day's published version."""
        current = self.versions(table).current()
        taken = self.best_versions(table).current()
        return {
            day: version
            for day, version in taken.items()
            if day in current and version.load.startswith(f"{current[day].load}_")
        }

    def read_best(self, table: str, day: str) -> DataFrame | None:
        """The first ``BEST_ROWS`` rows of a day in report order, or None if the day has
        none that were taken from its published version."""
        version = self._best(table).get(day)
        if version is None:
            return None
        rows = self.spark.read.schema(TABLES[table].ddl)
        return rows.parquet(self.best_versions(table).folder(version.load)).where(_on([day]))

    def snapshot(self, table: str) -> DataFrame:
        """The rows of now, read by path: still there when the catalog has forgotten."""
        spec = TABLES[table]
        reader = self.spark.read.schema(spec.ddl)
        if not spec.is_dated:
            return reader.parquet(self.path(table)).select(*spec.column_names)
        versions = self.versions(table)
        paths = [versions.day_folder(v) for v in versions.current().values()]
        if not paths:
            return self.spark.createDataFrame([], spec.ddl)
        reader = reader.option("basePath", f"{self.path(table)}/_loads")
        return reader.parquet(*paths).select(*spec.column_names)

    def known_users(self, one_row_a_day: bool) -> DataFrame:
        """The users, to check ids against.

        In their buckets, so that only the other side is shuffled, where that has a row
        per user and day at most and the buckets are not too few for a load of the size
        that the session is set for. Otherwise by path: then both sides are shuffled, and
        a user with very many rows can be split at run time.
        """
        self.ensure_table("users")
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if one_row_a_day and partitions <= 4 * self.buckets_of("users"):
            return self.read_table("users")
        return self.snapshot("users")

    def append(self, df: DataFrame, table: str) -> int:
        """Append rows to a table without days and return how many; counted while they
        are written. Each bucket is written by one task, so that a load leaves one file
        of it and not one per task. The count sits behind the last shuffle, where a task
        that had to be repeated is not counted twice.
        """
        self.ensure_table(table)
        name, buckets = self.full_name(table), self.buckets_of(table)
        df = df.repartition(buckets, *TABLES[table].keys) if buckets else df.hint("rebalance")
        written = Observation()
        rows = df.observe(written, F.count(F.lit(1)).alias("rows"))
        rows.select(*self.spark.table(name).columns).write.insertInto(name)
        return written.get["rows"]

    def _write_days(self, df: DataFrame, table: str, folder: str, one: str | None) -> int:
        """Write rows by day and return how many.

        Rows of several days are first gathered by day, in partitions that Spark sizes at
        run time, so that a load leaves a few files per day and not one per task and day.
        """
        spec = TABLES[table]
        rows = df.select(*[F.col(name).cast(kind).alias(name) for name, kind in spec.columns])
        if one is None:
            rows = rows.hint("rebalance", "transaction_date")
        written = Observation()
        rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
        if one is None:
            rows.write.partitionBy("transaction_date").parquet(folder)
        else:
            rows.drop("transaction_date").write.parquet(f"{folder}/{DAY_FOLDER}{one}")
        return written.get["rows"]

    def _read_days(self, table: str, folder: str) -> DataFrame:
        spec = TABLES[table]
        reader = self.spark.read.schema(spec.ddl).option("basePath", folder)
        return reader.parquet(folder).select(*spec.column_names)

    def _publish(self, table: str, load: str, days: Sequence[str]) -> None:
        self.versions(table).publish(load, days)
        self.register_days(table)

    def _keep_best(self, candidates: DataFrame, table: str, load: str, days: Sequence[str]) -> None:
        """Store the best of ``candidates`` for days that ``load`` has published.

        Each task ranks its own rows first and hands on ``BEST_ROWS`` per day at most.
        """
        best = self.best_versions(table)
        taken = f"{load}_{DayVersions.new_load()}"
        in_order = Window.partitionBy("transaction_date").orderBy(*ranking(TABLES[table]))
        place = F.row_number().over(in_order)
        rows = candidates.withColumn("__place", place).where(F.col("__place") <= BEST_ROWS)
        rows.drop("__place").write.parquet(best.folder(taken))
        best.publish(taken, days)

    def _add_days(self, rows: DataFrame, table: str, days: BatchDays) -> int:
        """Write and publish days of which nothing is stored yet."""
        versions, load = self.versions(table), DayVersions.new_load()
        one = None if days.several else str(days.first)
        count = self._write_days(rows, table, versions.folder(load), one)
        if not count:
            versions.discard(load)
            return 0
        written = versions.written(load)
        self._publish(table, load, written)
        self._keep_best(self._read_days(table, versions.folder(load)), table, load, written)
        return count

    def _extend_days(self, rows: DataFrame, table: str, known: Sequence[str]) -> int:
        """Publish those of ``known`` anew that get rows of new keys."""
        spec, versions, load = TABLES[table], self.versions(table), DayVersions.new_load()
        stored = self.read_table(table).where(_on(known))
        fresh = new_keys_only(rows.where(_on(known)), stored, *spec.keys)
        part = f"{load}-part"
        one = known[0] if len(known) == 1 else None
        count = self._write_days(fresh, table, versions.folder(part), one)
        if not count:
            versions.discard(part)
            return 0
        added = self._read_days(table, versions.folder(part))
        days = versions.written(part)
        one = days[0] if len(days) == 1 else None
        whole = stored.where(_on(days)).unionByName(added)
        self._write_days(whole, table, versions.folder(load), one)

        # The best so far and the new rows hold the best of now, where they are of the
        # version that is replaced. Other days are ranked whole.
        best = self._best(table)
        merged = [day for day in days if day in best]
        parts = [added.where(_on(merged))] if merged else []
        parts += (self.read_best(table, day) for day in merged)
        others = sorted(set(days) - set(merged))
        if others:
            parts.append(self._read_days(table, versions.folder(load)).where(_on(others)))
        self._publish(table, load, days)
        self._keep_best(reduce(DataFrame.unionByName, parts), table, load, days)
        versions.discard(part)
        return count

    def _mend_best(self, table: str, known: Sequence[str]) -> None:
        """Rank days whose best rows are missing, as after a load that died before them."""
        versions, best = self.versions(table), self._best(table)
        current = versions.current()
        by_load: dict[str, list[str]] = {}
        for day in known:
            if day in current and day not in best:
                by_load.setdefault(current[day].load, []).append(day)
        for load, days in by_load.items():
            rows = self._read_days(table, versions.folder(load)).where(_on(days))
            self._keep_best(rows, table, load, days)

    def known_days(self, table: str, days: BatchDays) -> list[str]:
        """Those of ``days`` that the catalog lists; of a range, all in it."""
        partitions = self.spark.sql(f"SHOW PARTITIONS {self.full_name(table)}").collect()
        stored = sorted(row.partition.removeprefix(DAY_FOLDER) for row in partitions)
        if days.listed is None:
            return [day for day in stored if str(days.first) <= day <= str(days.last)]
        listed = set(map(str, days.listed))
        return [day for day in stored if day in listed]

    def add_new(self, rows: DataFrame, table: str, days: BatchDays | None) -> int:
        """Add the rows whose key is not stored yet; return how many.

        The catalog's partitions tell which days are new. Their rows are written as they
        are, without a look at stored keys; rows of other days are compared with those.
        """
        self.ensure_table(table)
        if days is None:
            stored = self.read_table(table)
            return self.append(new_keys_only(rows, stored, *TABLES[table].keys), table)
        self.register_days(table)
        known = self.known_days(table, days)
        written = 0
        if days.listed is None or len(known) < len(days.listed):
            fresh = rows.where(~_on(known)) if known else rows
            written += self._add_days(fresh, table, days)
        if known:
            written += self._extend_days(rows, table, known)
            self._mend_best(table, known)
        return written

    def drop_unused(self) -> int:
        """Delete versions of days that are not published (any more), of all tables.

        For times when no load is under way and nobody reads what has been replaced.
        Returns how many loads and days of loads were deleted.
        """
        dated = [table for table, spec in TABLES.items() if spec.is_dated]
        kinds = (self.versions, self.best_versions)
        return sum(kind(table).drop_unused() for table in dated for kind in kinds)

    def drop_files(self) -> None:
        """Delete the folder of the tables, whatever the catalog says."""
        drop_path(self.spark, self.location)


def insert_ignore(
    df: DataFrame,
    warehouse: Warehouse | JdbcTarget,
    table: str,
    *,
    order_by: Sequence[str] = (),
    unique: bool = False,
    known_users: bool = False,
    days: BatchDays | None = None,
) -> int:
    """Add the rows whose key is not stored yet; return how many.

    Rows without a key column, or without a column that is not null, are left out.
    Within the batch the first row per key by ``order_by`` stays; pass
    ``unique=True`` if keys are unique already, and ``known_users=True`` if the
    user columns have been checked. ``days`` are the batch's days, if known.
    """
    spec = TABLES[table]
    warehouse.ensure_table(table)
    extra = [c for c in order_by if c not in spec.column_names]
    rows = valid(df.select(*spec.column_names, *extra), *spec.required)
    if not unique:
        rows = first_per_key(rows, spec.keys, *order_by)
    rows = rows.select(*spec.column_names)
    if spec.user_columns and not known_users:
        users = warehouse.known_users(one_row_a_day=len(spec.user_columns) == 1)
        rows = keep_known_users(rows, users, *spec.user_columns)

    if not spec.is_dated:
        return warehouse.add_new(rows, table, None)

    held = None
    if days is None:
        # The days are needed before the write: compute the batch once for both.
        held = rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        days = BatchDays.of(rows)
    try:
        return 0 if days.is_empty else warehouse.add_new(rows, table, days)
    finally:
        if held is not None:
            held.unpersist()


def stage(df: DataFrame, warehouse: Warehouse | JdbcTarget, table: str) -> str:
    """Replace the staging table of ``table`` with ``df``; return its name."""
    if isinstance(warehouse, JdbcTarget):
        return warehouse.stage(df, table)
    staging = f"{table}_temp"
    warehouse.ensure_database()
    rows = df.select(*TABLES[table].column_names)
    writer = rows.write.format("parquet").mode("overwrite")
    writer.option("path", warehouse.path(staging)).saveAsTable(warehouse.full_name(staging))
    return staging


def merge_staged(warehouse: Warehouse | JdbcTarget, staging: str, table: str) -> int:
    """Move staged rows into ``table``, keeping rows that are already there."""
    return insert_ignore(warehouse.read_staged(staging, table), warehouse, table)
