"""The user dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytally.functions import valid
from paytally.schema import PROFILE_FIELDS


def user_mentions(
    payments: DataFrame, fields: tuple[str, ...] = PROFILE_FIELDS
) -> DataFrame:
    """Two rows per payment, its sender (role 0) and its receiver (role 1).

    A payment counts only if both parties have an id and all profile keys; the
    day is not looked at. ``fields`` are the profile fields to carry along: what
    goes into the explode is read from storage, used later or not.
    """
    complete = valid(payments, "sender_id", "receiver_id", "sender", "receiver")

    def mention(role: int, party: str) -> Column:
        profile = [F.col(f"{party}.{field}").alias(field) for field in fields]
        return F.struct(
            F.lit(role).alias("role"), F.col(f"{party}_id").alias("id"), *profile
        )

    both = F.array(mention(0, "sender"), mention(1, "receiver"))
    rows = complete.select("created_time", "payment_id", F.explode(both).alias("mention"))
    return rows.select("created_time", "payment_id", "mention.*")


def users_dim(mentions: DataFrame) -> DataFrame:
    """One row per user id: the earliest mention that has a username.

    Order: time as written (unknown last), payment id, sender before receiver, and
    the profile itself for exact repeats. ``min`` is reduced in the map tasks, so a
    user mentioned everywhere is one row per map task in the shuffle.
    """
    candidate = F.struct(
        F.col("created_time").isNull().alias("undated"),
        "created_time",
        "payment_id",
        "role",
        *PROFILE_FIELDS,
    )
    return (
        valid(mentions, "username")
        .groupBy("id")
        .agg(F.min(candidate).alias("first"))
        .select("id", *[F.col(f"first.{field}").alias(field) for field in PROFILE_FIELDS])
    )
