"""What the operators of this package share: tables, scratch tables, sizes, id lists."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paytally.session import scratch_path

MB = 1 << 20
# Texts are worked on in slices of about this many characters, whatever the batch.
SLICE_CHARS = 2 * MB


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once a row however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def planned_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of ``df``, from file sizes; reads no data."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def partitions(df: DataFrame, bytes_each: int = 32 * MB) -> int:
    """Enough partitions for ``df`` that each holds about ``bytes_each``.

    Where Spark knows no size (it then gives one beyond any store), its setting for
    shuffles is taken.
    """
    spark, size = df.sparkSession, planned_bytes(df)
    if size >= 1 << 60:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(spark.sparkContext.defaultParallelism, math.ceil(size / bytes_each))


def materialised(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: what comes later reads the files and computes nothing again,
    also after an executor is lost.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(sizes: Iterable[int], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges that each hold about ``most`` characters and one row at least."""
    start = held = end = 0
    for end, size in enumerate(sizes):
        if held and held + size > most:
            yield start, end
            start, held = end, 0
        held += size
    if held or start <= end:
        yield start, end + 1


class IdLists:
    """Lists of ids by key, stored one after the other; forgets all when too large."""

    def __init__(self, most: int = 24 * MB) -> None:
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.starts = np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.uint32)
        self.used = self.weight = 0
        self.starts[0] = 0

    def add(self, keys: list[str], lists: list) -> None:
        """Store a list for each key, none of which is stored yet."""
        base = len(self.place)
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        total = int(lengths.sum())
        while base + len(keys) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.starts[base + 1 : base + 1 + len(keys)] = self.used + np.cumsum(lengths)
        if total:
            self.ids[self.used : self.used + total] = np.fromiter(
                chain.from_iterable(lists), np.uint32, total
            )
        self.used += total
        self.place.update(zip(keys, range(base, base + len(keys)), strict=True))
        self.weight += sum(map(len, keys)) + 32 * len(keys) + total

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the lists at ``places`` in turn, and how many each has."""
        starts, ends = self.starts[places], self.starts[places + 1]
        lengths = ends - starts
        offsets = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        return self.ids[np.arange(int(lengths.sum())) + offsets], lengths


def id_lists_of(
    texts: list[str],
    pieces: Callable[[str], list[str]],
    encode: Callable[[list[str]], list],
    known: IdLists,
) -> Iterator[tuple[int, np.ndarray]]:
    """The ids of each text, from its ``pieces``; each new piece is encoded once.

    Yields (index, ids). ``known`` holds the pieces met before, up to its limit.
    """
    for first, last in slices(map(len, texts)):
        if known.weight > known.most:
            known.clear()
        cut = [pieces(text) for text in texts[first:last]]
        place = known.place
        new = [p for p in set().union(*cut) if p not in place]
        if new:
            known.add(new, encode(new))
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        places = map(place.__getitem__, chain.from_iterable(cut))
        flat = np.fromiter(places, np.int64, int(counts.sum()))
        ids, lengths = known.gather(flat)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)]
        begin = 0
        for k, end in enumerate(ends):
            yield first + k, ids[begin:end]
            begin = end
