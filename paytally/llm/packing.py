"""Best-fit packing of documents into sequences, improved by swap-based local search.

Documents longer than a sequence are cut into full pieces, of which the first may be
shorter. Full pieces have a sequence each. The others are dealt by hash into groups of
about ``GROUP`` pieces; each group is packed best fit, largest first, and then improved:
pieces move, or are exchanged one for one or two for one, between underfull sequences
whenever that raises the sum of squared fills, until sequences empty or nothing helps.
What lies in a group's sequences that stay loose is dealt again to fewer groups, until
one is left.

Defined results for odd input: a null or empty text is a piece of the end id alone;
repeated rows and null doc_ids are packed like any other row; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytally.llm.common import materialised
from paytally.llm.tokenizer import definition, library_encoder

GROUP = 4096
# A sequence that lacks more than this share is loose: its pieces are dealt again.
LOOSE = 1 / 64

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row long, key long"
PLACED = PIECES + ", bin long, offset long, loose boolean"


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of indices: each piece, largest first, goes where the least room is left."""
    bins: list[list[int]] = []
    rooms: list[tuple[int, int]] = []  # (room, bin), ordered
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        k = bisect_left(rooms, (lengths[i], -1))
        room, b = rooms.pop(k) if k < len(rooms) else (size, len(bins))
        if b == len(bins):
            bins.append([])
        bins[b].append(i)
        if room > lengths[i]:
            insort(rooms, (room - lengths[i], b))
    return bins


class LocalSearch:
    """Exchanges between underfull bins, each of which raises the sum of squared fills.

    The fuller bin of an exchange takes one piece or two out of the other, and gives it
    nothing, one piece or two: a move, one for one, two for one, one for two. What bins
    can give is kept in order of length, as single pieces and as pairs, so that the one
    that fills a gap best is found by bisection. Bins are filled in turn, the fullest
    first, until a whole turn finds no exchange or no bin more than necessary is left.
    """

    def __init__(self, bins: list[list[int]], lengths: list[int], size: int) -> None:
        self.bins = [list(b) for b in bins]
        self.lengths = lengths
        self.size = size
        self.fill = [sum(lengths[i] for i in b) for b in bins]
        # (length or sum of two, bin), in order; of bins that are not full.
        self.given: tuple[list, list] = ([], [])
        for b in range(len(bins)):
            if self.fill[b] < size:
                for known, sums in zip(self.given, self._sums(b), strict=True):
                    known += ((s, b) for s in sums)
        for known in self.given:
            known.sort()

    def _sums(self, b: int) -> tuple[dict, dict]:
        """Lengths of single pieces and of pairs in a bin, with pieces that have them."""
        ones: dict[int, tuple] = {}
        twos: dict[int, tuple] = {}
        for i in self.bins[b]:
            length = self.lengths[i]
            if length not in ones:
                for other, (j,) in ones.items():
                    twos.setdefault(length + other, (i, j))
                ones[length] = (i,)
            else:
                twos.setdefault(2 * length, (i, *ones[length]))
        return ones, twos

    def _enter(self, b: int) -> None:
        for known, sums in zip(self.given, self._sums(b), strict=True):
            for s in sums:
                insort(known, (s, b))

    def _leave(self, b: int) -> None:
        for known, sums in zip(self.given, self._sums(b), strict=True):
            for s in sums:
                del known[bisect_left(known, (s, b))]

    def _exchange(self, b: int) -> bool:
        """Make the exchange that fills bin ``b`` most, if there is any."""
        fill, room = self.fill, self.size - self.fill[b]
        ones, twos = self._sums(b)
        offers = [(0, ()), *ones.items()]
        gain, chosen = 0, None
        for number, known in enumerate(self.given):
            for freed, out in offers if number else [*offers, *twos.items()]:
                k = bisect_right(known, (freed + room, len(fill))) - 1
                while k >= 0 and known[k][0] - freed > gain:
                    taken, giver = known[k]
                    if giver != b and fill[b] + taken - freed > fill[giver]:
                        gain, chosen = taken - freed, (out, giver, number, taken)
                        break
                    k -= 1
        if chosen is None:
            return False
        out, giver, number, taken = chosen
        into = self._sums(giver)[number][taken]
        for bin_, gone, come in ((b, out, into), (giver, into, out)):
            self._leave(bin_)
            self.bins[bin_] = [i for i in self.bins[bin_] if i not in gone] + list(come)
        fill[b] += gain
        fill[giver] -= gain
        for bin_ in (b, giver):
            if fill[bin_] < self.size:
                self._enter(bin_)
        return True

    def run(self) -> list[list[int]]:
        least = -(-sum(self.fill) // self.size)
        moved = True
        while moved and sum(map(bool, self.fill)) > least:
            moved = False
            for b in sorted(range(len(self.fill)), key=lambda b: -self.fill[b]):
                while 0 < self.fill[b] < self.size and self._exchange(b):
                    moved = True
        return [b for b in self.bins if b]


def local_search(bins: list[list[int]], lengths: list[int], size: int) -> list[list[int]]:
    """The same pieces in fewer bins, where exchanges can empty some."""
    return LocalSearch(bins, lengths, size).run()


def pack_group(lengths: list[int], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset in it and whether it is loose, for each piece of a group."""
    bins = local_search(best_fit(lengths, size), lengths, size)
    of, offset, loose = (np.zeros(len(lengths), np.int64) for _ in range(3))
    for b, members in enumerate(bins):
        at = 0
        for i in members:
            of[i], offset[i] = b, at
            at += lengths[i]
        if size - at > size * LOOSE:
            loose[members] = 1
    return of, offset, loose.astype(bool)


def cut(docs: DataFrame, path: str, size: int, end_id: int) -> DataFrame:
    """The pieces of each document: ``doc_id, piece, start, length, ids_crc32``."""
    shared = docs.sparkSession.sparkContext.broadcast(definition(path))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(shared.value)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows: list[tuple] = []
            for key, ids in zip(keys, encoder.encode(texts), strict=True):
                ids = np.concatenate([ids, end]).astype("<u4")
                begin, stop, k = 0, len(ids) % size or min(size, len(ids)), 0
                while begin < len(ids):
                    rows.append((key, k, begin, stop - begin, zlib.crc32(ids[begin:stop])))
                    begin, stop, k = stop, stop + size, k + 1
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def pack(pieces: DataFrame, size: int, group: int = GROUP) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; a piece has 1 to ``size`` tokens."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("length", "doc_id", "piece", "row")])
        of, offset, loose = pack_group(table.column("length").to_pylist(), size)
        for name, values in (("bin", of), ("offset", offset), ("loose", loose)):
            table = table.append_column(name, pa.array(values))
        return table.select([c.split()[0] for c in PLACED.split(", ")])

    # Rows that are equal have numbers of their own, so they are dealt apart as well.
    pieces = materialised(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = F.col("length") >= size
    wanted = ["doc_id", "piece", "start", "length", "ids_crc32"]
    done = [
        pieces.where(full).select(
            *wanted,
            # Below zero, so apart from the sequences of all groups.
            (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
        )
    ]
    rest = pieces.where(~full)
    base, count = 0, rest.count()
    while count:
        groups = -(-count // group)
        # Dealt at random but repeatably: a lost task deals the same rows the same way.
        key = F.pmod(F.xxhash64("row", F.lit(base)), F.lit(groups))
        dealt = rest.select(*wanted, "row", key.alias("key"))
        placed = materialised(dealt.groupBy("key").applyInArrow(run, PLACED), "packed")
        seen = placed.agg(F.max("bin").alias("last"), F.count_if(F.col("loose")).alias("loose")).first()
        again = seen.loose if groups > 1 else 0
        if again >= count:
            again = 0
        settled = placed.where("not loose") if again else placed
        # As many numbers for each group as the largest has sequences.
        stride = seen.last + 1
        sequence = F.lit(base) + F.col("key") * stride + F.col("bin")
        done.append(settled.select(*wanted, sequence.alias("sequence_id"), "offset"))
        base += groups * stride
        rest, count = placed.where("loose"), again
    return reduce(DataFrame.unionByName, done)


def pack_documents(docs: DataFrame, path: str, size: int, end_id: int) -> DataFrame:
    """Place every document of ``docs`` in sequences of ``size`` tokens at most."""
    return pack(cut(docs, path, size, end_id), size)
