"""The days a batch touches, to prune the stored side of a key check."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Up to this many days are listed one by one; beyond it a first-to-last range is used.
MAX_LISTED_DAYS = 1000


@dataclass(frozen=True)
class BatchDays:
    """First and last day of a batch, and all of them unless they are too many."""

    first: dt.date | None
    last: dt.date | None
    listed: tuple[dt.date, ...] | None

    @classmethod
    def of(cls, df: DataFrame) -> BatchDays:
        """Collects at most ``MAX_LISTED_DAYS + 1`` dates to the driver."""
        distinct = df.select("transaction_date").distinct().limit(MAX_LISTED_DAYS + 1)
        found = sorted(row.transaction_date for row in distinct.collect())
        if not found:
            return cls(None, None, ())
        if len(found) <= MAX_LISTED_DAYS:
            return cls(found[0], found[-1], tuple(found))
        ends = df.agg(F.min("transaction_date"), F.max("transaction_date")).first()
        return cls(ends[0], ends[1], None)

    @property
    def is_empty(self) -> bool:
        return self.first is None

    @property
    def several(self) -> bool:
        return self.first != self.last

    def predicate(self) -> Column:
        """Predicate on ``transaction_date`` that prunes partitions."""
        day = F.col("transaction_date")
        if self.listed is None:
            return day.between(F.lit(self.first), F.lit(self.last))
        return day.isin(*self.listed)
