"""Top-N reports of one day.

Shape of every report: the day's rows, cut to users that exist (ids only), then
the top N, and only for those N rows the names and pictures. The wide user columns
of everyone else are never shuffled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytally.functions import display_name, on_day, to_units
from paytally.operators import keep_known_users
from paytally.schema import TABLES
from paytally.sinks.warehouse import BEST_ROWS, ranking

# The N ranked rows are broadcast to look up their users, up to this many.
MAX_BROADCAST_ROWS = 100_000


def _ranked(
    activity: DataFrame,
    users: DataFrame,
    day: dt.date | str,
    n: int,
    measure: str,
    ids: tuple[str, ...],
    users_known: bool,
) -> DataFrame:
    rows = on_day(activity, day).select(*ids, measure)
    if not users_known:
        rows = keep_known_users(rows, users, *ids)
    return rows.orderBy(*_ranking(measure, ids)).limit(_checked(n))


def _ranking(measure: str, ids: tuple[str, ...]) -> list[Column]:
    return [F.col(measure).desc(), *[F.col(c).asc() for c in ids]]


def _checked(n: int) -> int:
    if n < 1:
        raise ValueError(f"a report needs a positive number of rows, not {n}")
    return n


def _with_user(top: DataFrame, users: DataFrame, id_column: str, name: str, image: str, n: int):
    """Add the name and picture of the user in ``id_column``."""
    profile = users.select(
        F.col("id").alias(f"{id_column}_id"),
        display_name(F.col("firstname"), F.col("lastname")).alias(name),
        F.col("picture").alias(image),
    )
    side = F.broadcast(top) if n <= MAX_BROADCAST_ROWS else top
    return side.join(profile, F.col(id_column) == F.col(f"{id_column}_id"), "inner")


def _top_users(activity, users, day, n, measure, users_known) -> DataFrame:
    top = _ranked(activity, users, day, n, measure, ("user_id",), users_known)
    named = _with_user(top, users, "user_id", "name", "image", n)
    return named.orderBy(*_ranking(measure, ("user_id",))).limit(n)


def top_senders(
    activity: DataFrame, users: DataFrame, day: dt.date | str, n: int, users_known: bool = False
) -> DataFrame:
    """The ``n`` users who sent most often on a day: ``name, image, send_freq``.

    Ties go to the smaller id. Users missing from ``users`` do not take a place;
    ``users_known`` says that ``activity`` has none, as in tables loaded here.
    """
    top = _top_users(activity, users, day, n, "send_freq", users_known)
    return top.select("name", "image", "send_freq")


def top_receivers(
    activity: DataFrame, users: DataFrame, day: dt.date | str, n: int, users_known: bool = False
) -> DataFrame:
    """The ``n`` users who received most often on a day: ``name, image, recv_freq``."""
    top = _top_users(activity, users, day, n, "recv_freq", users_known)
    return top.select("name", "image", "recv_freq")


def top_spenders(
    activity: DataFrame, users: DataFrame, day: dt.date | str, n: int, users_known: bool = False
) -> DataFrame:
    """The ``n`` largest net spenders of a day in currency units: ``name, image, amount``."""
    top = _top_users(activity, users, day, n, "amount_cents", users_known)
    return top.select("name", "image", to_units(F.col("amount_cents")).alias("amount"))


def top_pairs(
    activity: DataFrame, users: DataFrame, day: dt.date | str, n: int, users_known: bool = False
) -> DataFrame:
    """The ``n`` busiest pairs of a day with both names and pictures."""
    ids = ("user1", "user2")
    top = _ranked(activity, users, day, n, "transaction_freq", ids, users_known)
    named = _with_user(top, users, "user1", "user1_name", "user1_img", n)
    named = _with_user(named, users, "user2", "user2_name", "user2_img", n)
    return (
        named.orderBy(*_ranking("transaction_freq", ids))
        .limit(n)
        .select(
            F.col("user1_name").alias("user1"),
            "user1_img",
            F.col("user2_name").alias("user2"),
            "user2_img",
            "transaction_freq",
        )
    )


def top_pair_ids(activity: DataFrame, day: dt.date | str, n: int) -> DataFrame:
    """The ``n`` busiest pairs of a day by id: ``user1, user2, transaction_freq``."""
    ids = ("user1", "user2")
    rows = on_day(activity, day).select(*ids, "transaction_freq")
    return rows.orderBy(*_ranking("transaction_freq", ids)).limit(_checked(n))


REPORTS = {
    "active_senders": (top_senders, "sender_activity"),
    "active_receivers": (top_receivers, "receiver_activity"),
    "active_pairs": (top_pairs, "pair_activity"),
    "active_spenders": (top_spenders, "net_spending"),
}


def _enough_best(
    warehouse, table: str, day: str, n: int, users_known: bool
) -> tuple[DataFrame, DataFrame] | None:
    """The day's best rows and the users of a report, if these rows hold all of it.

    Best rows are few and fetched. From the first on, twice as many at a time, their
    users are looked up by value, which prunes the scan of the users to buckets and row
    groups, until the report is full. Rows of users who are gone take places among the
    best; if too few others are left, the day has to be read.
    """
    read_best = getattr(warehouse, "read_best", None)
    best = read_best(table, day) if read_best and n <= BEST_ROWS else None
    if best is None:
        return None
    spec = TABLES[table]
    ids = spec.user_columns
    rows = [tuple(row) for row in best.orderBy(*ranking(spec)).select(*ids).collect()]
    users = warehouse.read_table("users")

    def of(mentioned: list[tuple]) -> DataFrame:
        return users.where(F.col("id").isin(sorted({i for row in mentioned for i in row})))

    if users_known:
        return best, of(rows[:n])
    known: list[tuple] = []
    begin, size = 0, 2 * n
    while len(known) < n and begin < len(rows):
        part = rows[begin : begin + size]
        there = {row.id for row in of(part).select("id").collect()}
        known += (row for row in part if there.issuperset(row))
        begin, size = begin + size, 2 * size
    if len(known) < n and len(rows) >= BEST_ROWS:
        return None
    return best, of(known[:n])


def report(
    warehouse, metric: str, day: dt.date | str, n: int, users_known: bool = False
) -> DataFrame:
    """The report called ``metric`` over stored tables (a ``Warehouse`` or ``JdbcTarget``).

    Rows of users that are not stored (any more) take no place. ``users_known=True``
    leaves that check out, where nobody but the loads writes to the tables. A warehouse
    answers from the best rows of the day, as long as these suffice.
    """
    if metric not in REPORTS:
        raise ValueError(f"unknown report {metric!r}; choose from {', '.join(REPORTS)}")
    build, table = REPORTS[metric]
    found = _enough_best(warehouse, table, str(day), _checked(n), users_known)
    activity, users = found or (warehouse.read_table(table), warehouse.read_table("users"))
    return build(activity, users, day, n, users_known=users_known)
