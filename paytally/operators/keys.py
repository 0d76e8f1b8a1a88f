"""Key checks: one row per key, known users only, new keys only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str] | tuple[str, ...], *order_by: str) -> DataFrame:
    """One row per key, the first by ``order_by`` and then by the other columns.

    A ``min`` over a struct, reduced in the map tasks before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    ordered = [*order_by, *[c for c in rest if c not in order_by]]
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*ordered)).alias("first"))
        .select(*[F.col(c) if c in keys else F.col(f"first.{c}").alias(c) for c in df.columns])
    )


def keep_known_users(df: DataFrame, users: DataFrame, *user_columns: str) -> DataFrame:
    """Rows whose user columns all occur in ``users``.

    A semi join per column on the ids alone. Spark broadcasts the ids if they are
    small and splits hot users at run time otherwise (adaptive skew join).
    """
    for column in user_columns:
        ids = users.select(F.col("id").alias("known_id"))
        df = df.join(ids, df[column] == ids["known_id"], "left_semi")
    return df


def new_keys_only(df: DataFrame, existing: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key does not occur in ``existing``."""
    return df.join(existing.select(*keys), list(keys), "left_anti")
