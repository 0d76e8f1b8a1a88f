"""Loading payments: parse once, then the users, then the four metrics."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paytally.functions import valid
from paytally.operators import (
    keep_known_users,
    new_keys_only,
    pair_activity,
    user_day_totals,
    user_mentions,
    users_dim,
)
from paytally.schema import PAYMENTS, TABLES
from paytally.session import drop_path, listed_bytes, scratch_path, sized_for
from paytally.sinks import JdbcTarget, Warehouse, insert_ignore
from paytally.sinks.days import BatchDays
from paytally.sources import parse_payments, scan_lines

# Sets of ids are broadcast up to this many (8 bytes each), after a count.
MAX_BROADCAST_IDS = 1_000_000


class MissingAmounts(ValueError):
    """No payment of the source carries ``amount_cents``."""


def staged_columns(wanted: set[str]) -> list[str]:
    """Columns of the payments that the wanted tables are made from."""
    needed = {"sender_id", "receiver_id"}
    if "users" in wanted:
        needed |= {"payment_id", "created_time", "sender", "receiver"}
    if wanted - {"users"}:
        needed |= {"transaction_date", "amount_cents"}
    return [name for name in PAYMENTS.names if name in needed]


def stage_payments(
    payments: DataFrame, spark: SparkSession, path: str, wanted: set[str]
) -> DataFrame:
    """Write the parsed payments below the shared folder and read them back.

    The JSON is decoded once, in a job without a shuffle, and only what the wanted
    tables need is kept. The metrics then read only their own columns, and a lost
    executor costs no second decode.
    """
    columns = staged_columns(wanted)
    seen = Observation()
    complete = F.col("sender_id").isNotNull() & F.col("receiver_id").isNotNull()
    payments.observe(
        seen,
        F.count_if(complete).alias("complete"),
        F.count_if(complete & F.col("amount_cents").isNotNull()).alias("with_amount"),
    ).select(*columns).write.option("compression", "zstd").parquet(path)
    if "net_spending" in wanted and seen.get["complete"] and not seen.get["with_amount"]:
        raise MissingAmounts("the source has no amount_cents; net spending needs it")
    return spark.read.schema(T.StructType([PAYMENTS[name] for name in columns])).parquet(path)


def _few(ids: DataFrame) -> bool:
    """Counted in the map tasks; ``ids`` are held, so nothing is computed for it alone."""
    return ids.count() <= MAX_BROADCAST_IDS


def _load_users(staged: DataFrame, warehouse: Warehouse | JdbcTarget) -> int:
    """Append the users that are not stored yet.

    The ids alone tell which ones are new, in a cheap hash aggregate. Usually they
    are few; then only their mentions are compared, and those of everyone else never
    sorted. Otherwise, as in a first load, all mentions are.
    """
    warehouse.ensure_table("users")
    ids = valid(user_mentions(staged, ("username",)), "username").select("id").distinct()
    new_ids = new_keys_only(ids, warehouse.read_table("users"), "id")
    new_ids = new_ids.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        mentions = user_mentions(staged)
        if not _few(new_ids):
            return insert_ignore(users_dim(mentions), warehouse, "users", unique=True)
        fresh = mentions.join(F.broadcast(new_ids), "id", "left_semi")
        return warehouse.append(users_dim(fresh), "users")
    finally:
        new_ids.unpersist()


def _known_pairs(pairs: DataFrame, unknown: DataFrame, users: DataFrame) -> DataFrame:
    """Pairs of two known users.

    Both ids of a pair occur in the daily totals, so the ids found unknown there
    are all there can be. They are usually few and then are broadcast, which saves
    shuffling the pairs once per role; beyond the limit the ids are semi-joined.
    """
    if not _few(unknown):
        return keep_known_users(pairs, users, "user1", "user2")
    for column in ("user1", "user2"):
        ids = F.broadcast(unknown)
        pairs = pairs.join(ids, F.col(column) == F.col("user_id"), "left_anti")
    return pairs


def _side_by_side(spark: SparkSession, jobs: dict[str, Callable[[], int]]) -> dict[str, int]:
    """Run independent writes at the same time, so that their small last stages
    fill the cluster together. The first failure is raised after all have ended.
    """
    with ThreadPoolExecutor(max_workers=max(len(jobs), 1)) as pool:
        # Each with a copy of the thread's properties of its own: Spark notes the running
        # query there, and would lose it to another thread.
        running = {
            name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()
        }
    return {name: done.result() for name, done in running.items()}


def load_payments(
    payments: DataFrame, warehouse: Warehouse | JdbcTarget, tables: Iterable[str] = tuple(TABLES)
) -> dict[str, int]:
    """Load ``tables`` from a payments frame; return the rows written per table.

    Users come first, since the metrics keep only rows of known users. Any failure
    raises; running the load again then adds only what is missing.
    """
    # Not the session of the frame: a streaming batch brings its own, with settings
    # of its own, and would not see what this one has just appended.
    spark = warehouse.spark
    wanted = set(tables)
    if not wanted <= set(TABLES):
        raise ValueError(f"unknown tables: {sorted(wanted - set(TABLES))}")

    path = scratch_path(spark, "payments")
    written = {}
    totals = unknown = None
    try:
        staged = stage_payments(payments, spark, path, wanted)
        if "users" in wanted:
            written["users"] = _load_users(staged, warehouse)
        if wanted - {"users"}:
            # One row per user and day: no user is hot, so buckets may hold them.
            users = warehouse.known_users(one_row_a_day=True)
            # Reduced to one row per id first: Parquet does not keep ids unique, and a
            # user who is stored twice must not double the metrics.
            ids = users.select("id").distinct().withColumn("listed", F.lit(True))
            daily = user_day_totals(staged)
            totals = (
                daily.join(ids, daily["user_id"] == ids["id"], "left")
                .select(*daily.columns, F.col("listed").isNotNull().alias("known"))
                .persist(StorageLevel.MEMORY_AND_DISK)
            )
            days = BatchDays.of(totals)
            unknown = totals.where(~F.col("known")).select("user_id").distinct()
            unknown = unknown.persist(StorageLevel.MEMORY_AND_DISK)

            def append(table: str, rows: Callable[[], DataFrame]) -> Callable[[], int]:
                return lambda: insert_ignore(
                    rows(), warehouse, table, unique=True, known_users=True, days=days
                )

            known = totals.where("known")
            rows_of = {
                "sender_activity": lambda: known.where("send_freq > 0"),
                "receiver_activity": lambda: known.where("recv_freq > 0"),
                "net_spending": lambda: known.where("amount_cents IS NOT NULL"),
                "pair_activity": lambda: _known_pairs(
                    pair_activity(staged), unknown, warehouse.known_users(one_row_a_day=False)
                ),
            }
            jobs = {t: append(t, rows) for t, rows in rows_of.items() if t in wanted}
            written.update(_side_by_side(spark, jobs))
    finally:
        for held in (unknown, totals):
            if held is not None:
                held.unpersist()
        drop_path(spark, path)
    return written


def run_period(
    spark: SparkSession,
    source: str | list[str],
    warehouse: Warehouse | JdbcTarget,
    tables: Iterable[str] = tuple(TABLES),
) -> dict[str, int]:
    """Load the JSON lines at ``source`` (see ``period_path``).

    Shuffles get as many partitions as the listed size of the files asks for.
    """
    lines = scan_lines(spark, source)
    with sized_for(warehouse.spark, listed_bytes(lines)):
        return load_payments(parse_payments(lines), warehouse, tables)
