"""Which documents models may be learned from, and bounded samples of those."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPAN = 1 << 30


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the crc32 of the id as text leaves 2 when divided by 4; null ids do not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def learnable(doc_id: str = "doc_id") -> Column:
    return F.col(doc_id).isNotNull() & ~held_out(doc_id)


def sample_per_class(rows: DataFrame, label: str, each: int) -> DataFrame:
    """About ``each`` rows per value of ``label``, chosen by hash of ``doc_id``.

    Chosen alike on every run. The counts per value are all that reaches the driver.
    """
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    if not counts:
        return rows
    rates = [(value, int(min(1.0, each / n) * _SPAN)) for value, n in counts.items()]
    schema = rows.select(F.col(label).alias("__label")).schema.add("__most", "long")
    limits = rows.sparkSession.createDataFrame(rates, schema)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(_SPAN))
    joined = rows.join(F.broadcast(limits), F.col(label) == F.col("__label"))
    return joined.where(drawn < F.col("__most")).drop("__label", "__most")
