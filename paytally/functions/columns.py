"""Scalar expressions and predicates."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the timestamp texts that count as valid. A date from year 1 on,
# optionally followed by a time of day and a zone.
ISO_TIMESTAMP = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}"
    r"([T ]([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d([.,]\d+)?)?)?"
    r"\s*(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)


def integer_id(text: Column) -> Column:
    """Id text to BIGINT; NULL for anything that is not an integer."""
    return text.try_cast("bigint")


def calendar_date(timestamp_text: Column) -> Column:
    """Calendar day of an ISO timestamp as written, ignoring its zone offset."""
    day = F.substring(timestamp_text, 1, 10).try_cast("date")
    return F.when(timestamp_text.rlike(ISO_TIMESTAMP), day)


def display_name(first: Column, last: Column) -> Column:
    """``first last``; NULL if either part is."""
    return F.concat(first, F.lit(" "), last)


def to_units(amount_cents: Column) -> Column:
    """Whole cents to currency units with two decimals, in exact arithmetic."""
    return (amount_cents.cast("decimal(36,2)") * F.lit(0.01).cast("decimal(2,2)")).cast(
        "decimal(38,2)"
    )


def valid(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in which all ``keys`` are present; each metric names its own."""
    return df.where(reduce(and_, [F.col(key).isNotNull() for key in keys]))


def on_day(df: DataFrame, day: dt.date | str) -> DataFrame:
    """Rows of one day. Equality on the partition column prunes the scan."""
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    return df.where(F.col("transaction_date") == F.lit(day))
