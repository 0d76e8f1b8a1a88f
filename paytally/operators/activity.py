"""Daily activity metrics over the payments frame.

Every aggregate here is a count or a sum, which Spark reduces in the map tasks
first: a user or pair that holds a third of all payments reaches the shuffle as
one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytally.functions import valid
from paytally.schema import CENTS

DAY = "transaction_date"


def sender_keys(payments: DataFrame) -> DataFrame:
    """``(user_id, transaction_date)`` of every payment with a sender and a day."""
    return valid(payments, "sender_id", DAY).select(F.col("sender_id").alias("user_id"), DAY)


def receiver_keys(payments: DataFrame) -> DataFrame:
    """``(user_id, transaction_date)`` of every payment with a receiver and a day."""
    return valid(payments, "receiver_id", DAY).select(F.col("receiver_id").alias("user_id"), DAY)


def canonical_pairs(payments: DataFrame) -> DataFrame:
    """``(user1, user2, transaction_date)`` with the smaller id first."""
    # least() and greatest() skip NULLs, hence the filter comes first.
    both = valid(payments, "sender_id", "receiver_id", DAY)
    return both.select(
        F.least("sender_id", "receiver_id").alias("user1"),
        F.greatest("sender_id", "receiver_id").alias("user2"),
        DAY,
    )


def exact_cents() -> Column:
    """Cents in a type that holds the negative and any sum of BIGINT amounts.

    An extreme amount then costs nobody else's record: no sum can overflow.
    """
    return F.col("amount_cents").cast(CENTS)


def signed_legs(payments: DataFrame) -> DataFrame:
    """Two rows per payment: the sender's ``+amount`` and the receiver's ``-amount``."""
    complete = valid(payments, "sender_id", "receiver_id", DAY, "amount_cents")
    legs = F.array(
        F.struct(F.col("sender_id").alias("user_id"), exact_cents().alias("amount_cents")),
        F.struct(F.col("receiver_id").alias("user_id"), (-exact_cents()).alias("amount_cents")),
    )
    return complete.select(F.explode(legs).alias("leg"), DAY).select(
        "leg.user_id", DAY, "leg.amount_cents"
    )


def sender_activity(payments: DataFrame) -> DataFrame:
    """Number of sends per user and day."""
    return sender_keys(payments).groupBy("user_id", DAY).agg(F.count("*").alias("send_freq"))


def receiver_activity(payments: DataFrame) -> DataFrame:
    """Number of receives per user and day."""
    return receiver_keys(payments).groupBy("user_id", DAY).agg(F.count("*").alias("recv_freq"))


def pair_activity(payments: DataFrame) -> DataFrame:
    """Number of payments per unordered pair of users and day."""
    return (
        canonical_pairs(payments)
        .groupBy("user1", "user2", DAY)
        .agg(F.count("*").alias("transaction_freq"))
    )


def net_spending(payments: DataFrame) -> DataFrame:
    """Amount sent minus amount received per user and day, in cents."""
    return (
        signed_legs(payments)
        .groupBy("user_id", DAY)
        .agg(F.sum("amount_cents").alias("amount_cents"))
    )


def user_day_totals(payments: DataFrame) -> DataFrame:
    """The three per-user metrics side by side, from one scan and one shuffle.

    ``send_freq`` and ``recv_freq`` are 0, and ``amount_cents`` is NULL, where the
    user has no such row on that day. A leg counts by the rules of its own metric:
    a send needs only its sender and day, an amount needs both parties.
    """
    amount = F.when(
        F.col("sender_id").isNotNull() & F.col("receiver_id").isNotNull(), exact_cents()
    )
    legs = F.array(
        F.struct(
            F.col("sender_id").alias("user_id"),
            F.lit(1).alias("sent"),
            F.lit(0).alias("received"),
            amount.alias("amount"),
        ),
        F.struct(
            F.col("receiver_id").alias("user_id"),
            F.lit(0).alias("sent"),
            F.lit(1).alias("received"),
            (-amount).alias("amount"),
        ),
    )
    rows = valid(payments, DAY).select(F.explode(legs).alias("leg"), DAY)
    return (
        rows.select("leg.*", DAY)
        .where(F.col("user_id").isNotNull())
        .groupBy("user_id", DAY)
        .agg(
            F.sum("sent").alias("send_freq"),
            F.sum("received").alias("recv_freq"),
            F.sum("amount").alias("amount_cents"),
        )
    )
