"""Byte-level BPE: a minimal perfect hash for whole pre-tokens, a heap for the others.

``encode`` adds ``ids`` (array of int), ``decode`` adds ``decoded`` (binary). Each chunk
of text that a task has not met lately is cut into pre-tokens; those of the vocabulary
come from the hash in one call; the bytes of each other one are a linked list, of which
the neighbours of lowest rank are merged until no two neighbours form a token.

Defined results for odd input: a null text counts as empty and has no ids; texts are
encoded whole, however long; a repeated row gives a row; an empty table gives none;
further columns pass through, unless they are called like an output column.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytally.llm.common import IdLists, id_lists_of
from paytally.llm.perfect_hash import PerfectHash
from paytally.llm.vocab import chunks, read_ranks


class Bpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, tokens: list[bytes], pattern: str) -> None:
        self.tokens = tokens
        self.whole = PerfectHash(tokens)
        self.ranks = {token: rank for rank, token in enumerate(tokens)}
        self.split = regex.compile(pattern).findall
        self.known = IdLists()

    def merged(self, piece: bytes) -> list[int]:
        """The ids of a pre-token that is no token itself."""
        ranks, n = self.ranks, len(piece)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        gone = bytearray(n + 1)
        heap = [
            (rank, i, i + 2)
            for i in range(n - 1)
            if (rank := ranks.get(piece[i : i + 2])) is not None
        ]
        heapify(heap)
        while heap:
            _, left, end = heappop(heap)
            right = after[left]
            if gone[left] or right >= n or after[right] != end:
                continue  # one of the two has been merged with another since
            gone[right] = 1
            after[left] = end
            if end < n:
                before[end] = left
                rank = ranks.get(piece[left : after[end]])
                if rank is not None:
                    heappush(heap, (rank, left, after[end]))
            if left:
                first = before[left]
                rank = ranks.get(piece[first:end])
                if rank is not None:
                    heappush(heap, (rank, first, end))
        ids, at = [], 0
        while at < n:
            ids.append(ranks[piece[at : after[at]]])
            at = after[at]
        return ids

    def encode_chunks(self, texts: list[str]) -> list[list[int]]:
        cut = [self.split(text) for text in texts]
        distinct = list({p for own in cut for p in own})
        encoded = [p.encode() for p in distinct]
        found = self.whole.find(encoded).tolist()
        ids = {
            p: [k] if k >= 0 else self.merged(raw)
            for p, raw, k in zip(distinct, encoded, found, strict=True)
        }
        return [[i for p in own for i in ids[p]] for own in cut]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for _, ids in id_lists_of(texts, chunks, self.encode_chunks, self.known):
            yield ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def _bpe(tokens: tuple[bytes, ...], pattern: str) -> Bpe:
    return Bpe(list(tokens), pattern)


def _with(
    docs: DataFrame, path: str, pattern: str, source: str, added: dict[str, str], row: Callable
) -> DataFrame:
    """``docs`` with columns that ``row(bpe, values)`` yields for each ``source`` value.

    The vocabulary is read on the driver and broadcast; its size is fixed.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tuple(read_ranks(path)))
    kept = [c for c in docs.columns if c.lower() not in added]
    frame = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(source).alias("__source"))
    fields = ", ".join(f"`{name}` {kind}" for name, kind in added.items())
    empty = spark.createDataFrame([], fields).schema
    schema = docs.select(*(F.col(f"`{c}`") for c in kept)).schema
    for field in empty:
        schema = schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(shared.value, pattern)
        for batch in batches:
            values = batch.column(batch.num_columns - 1).to_pylist()
            new = row(bpe, values)
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + new, names=schema.names)

    return frame.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the ids of ``text``."""

    def row(bpe: Bpe, texts: list) -> list[pa.Array]:
        ids = list(bpe.encode([t or "" for t in texts]))
        ends = np.cumsum([0, *map(len, ids)])
        flat = np.concatenate(ids) if ids else np.zeros(0)
        if ends[-1] >= 1 << 31:
            raise ValueError("a batch has over 2**31 ids: lower arrow.maxRecordsPerBatch")
        return [pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(flat.astype(np.int32)))]

    return _with(docs, path, pattern, text, {"ids": "array<int>"}, row)


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``, the bytes of ``ids`` (null: none)."""

    def row(bpe: Bpe, lists: list) -> list[pa.Array]:
        return [pa.array([bpe.decode(x or []) for x in lists], pa.binary())]

    return _with(docs, path, pattern, ids, {"decoded": "binary"}, row)


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of ``text``.

    The same encoding and decoding; ids are digested where they are made, so that
    neither they nor the decoded bytes travel back to the JVM.
    """

    def row(bpe: Bpe, texts: list) -> list[pa.Array]:
        counts, of_ids, of_bytes = [], [], []
        for ids in bpe.encode([t or "" for t in texts]):
            counts.append(len(ids))
            of_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            of_bytes.append(hashlib.sha256(bpe.decode(ids.tolist())).hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_bytes)]

    added = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    return _with(docs, path, pattern, text, added, row)
