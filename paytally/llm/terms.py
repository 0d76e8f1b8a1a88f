"""Words of a text as bytes, and a stated set of queries in blocks of bounded size."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from paytally.llm.common import MB, materialised

# Texts of queries that go to every task at once, in characters. A text is not split.
BLOCK_CHARS = 4 * MB


def _byte_classes() -> bytes:
    """By byte: itself beyond ASCII, digits and a-z; a-z for A-Z; else a space."""
    kept = bytearray(b" " * 128) + bytearray(range(128, 256))
    for first, last, shift in ((0x30, 0x39, 0), (0x61, 0x7A, 0), (0x41, 0x5A, 0x20)):
        kept[first : last + 1] = bytes(range(first + shift, last + shift + 1))
    return bytes(kept)


_CLASSES = _byte_classes()


def words(text: str | None) -> list[bytes]:
    """Maximal runs of digits, letters and characters beyond ASCII; A-Z lower-cased."""
    return text.encode().translate(_CLASSES).split() if text else []


def query_blocks(
    items: DataFrame, key: str = "item_id", most: int = BLOCK_CHARS
) -> Iterator[list[Row]]:
    """Rows (key, text) of ``items`` in blocks of about ``most`` characters of text.

    All rows of a key are in one block. There is one block at least.
    """
    rows = items.select(F.col(key), F.col("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / most))
    if blocks == 1:
        yield rows.collect()
        return
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).alias("__block")
    rows = materialised(rows.select("*", block), "queries")
    for k in range(blocks):
        yield rows.where(F.col("__block") == k).drop("__block").collect()
