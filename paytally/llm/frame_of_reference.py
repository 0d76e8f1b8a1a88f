"""Patched frame-of-reference blocks: the bytes of one file of token ids.

A file is a sequence of blocks of 512 ids, an index of where each block starts, a table
of documents (id, count) and a footer. A block holds its minimum, a bit width that nine
in ten of the differences to it fit in, their low bits packed at that width, and for
those that do not fit a list of positions and of high bits.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 512
PERCENTILE = 90
MAGIC = b"PFORTOK1"
_HEAD = np.dtype([("least", "<u4"), ("width", "u1"), ("spare", "u1"), ("outliers", "<u2")])
_FOOT = np.dtype(
    [
        ("ids", "<u8"),
        ("docs", "<u8"),
        ("blocks", "<u8"),
        ("index_at", "<u8"),
        ("docs_at", "<u8"),
        ("crc", "<u4"),
        ("spare", "<u4"),
        ("magic", "S8"),
    ]
)
_DOC = np.dtype([("doc_id", "<i8"), ("is_null", "u1"), ("count", "<u8")])


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def _pack(low: np.ndarray, width: int) -> np.ndarray:
    """(blocks, 512) values below 2**width as (blocks, 64 * width) bytes."""
    bits = (low[:, :, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).reshape(len(low), -1), axis=1, bitorder="little")


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(packed), BLOCK, width)
    return bits.astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Each block of ``ids`` (unsigned 32-bit); the last is filled up with its minimum."""
    if not len(ids):
        return []
    count = -(-len(ids) // BLOCK)
    blocks = np.full(count * BLOCK, ids[-1], np.uint32)
    blocks[: len(ids)] = ids
    blocks = blocks.reshape(count, BLOCK)
    least = blocks.min(axis=1)
    rest = blocks - least[:, None]
    rank = BLOCK * PERCENTILE // 100
    widths = _bit_lengths(np.partition(rest, rank, axis=1)[:, rank])
    out: list[bytes] = [b""] * count
    for width in np.unique(widths).tolist():
        mine = np.flatnonzero(widths == width)
        for begin in range(0, len(mine), 256):
            some = mine[begin : begin + 256]
            part = rest[some]
            mask = np.uint32((1 << width) - 1)
            packed = _pack(part & mask, width).tobytes() if width else b""
            owner, where = np.nonzero(part > mask)  # none of 32 bits
            high = (part[owner, where] >> np.uint32(min(width, 31))).astype("<u4").tobytes()
            place = where.astype("<u2").tobytes()
            ends = np.searchsorted(owner, np.arange(len(some) + 1)).tolist()
            heads = np.zeros(len(some), _HEAD)
            heads["least"], heads["width"], heads["outliers"] = least[some], width, np.diff(ends)
            head, size, wide = heads.tobytes(), _HEAD.itemsize, BLOCK // 8 * width
            for k, block in enumerate(some.tolist()):
                a, b = ends[k], ends[k + 1]
                out[block] = b"".join(
                    (
                        head[size * k : size * (k + 1)],
                        packed[wide * k : wide * (k + 1)],
                        place[2 * a : 2 * b],
                        high[4 * a : 4 * b],
                    )
                )
    return out


def _numbers(raw: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The little-endian numbers of ``size`` bytes that begin at ``at``."""
    return raw[at[:, None] + np.arange(size)].copy().view(f"<u{size}")[:, 0]


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``starts`` in ``data``, in turn."""
    out = np.zeros((len(starts), BLOCK), np.uint32)
    if not len(starts):
        return out.ravel()
    raw = np.frombuffer(data, np.uint8)
    size = _HEAD.itemsize
    heads = raw[starts[:, None] + np.arange(size)].copy().view(_HEAD)[:, 0]
    for width in np.unique(heads["width"]).tolist():
        mine = np.flatnonzero(heads["width"] == width)
        for begin in range(0, len(mine), 256):
            some = mine[begin : begin + 256]
            if width:
                at = starts[some][:, None] + size + np.arange(BLOCK // 8 * width)
                out[some] = _unpack(raw[at], width)
            counts = heads["outliers"][some].astype(np.int64)
            lists = np.repeat(starts[some] + size + BLOCK // 8 * width, counts)
            order = np.arange(len(lists)) - np.repeat(np.cumsum(counts) - counts, counts)
            where = _numbers(raw, lists + 2 * order, 2)
            high = _numbers(raw, lists + 2 * np.repeat(counts, counts) + 4 * order, 4)
            out[np.repeat(some, counts), where] |= high << np.uint32(min(width, 31))
    return (out + heads["least"][:, None]).ravel()


def file_bytes(ids: np.ndarray, doc_ids: list, counts: list[int]) -> bytes:
    """A whole file for documents in order, of which ``ids`` are all ids in turn."""
    blocks = encode_blocks(ids)
    starts = len(MAGIC) + np.cumsum([0, *map(len, blocks)])
    docs = np.zeros(len(counts), _DOC)
    docs["doc_id"] = [d or 0 for d in doc_ids]
    docs["is_null"] = [d is None for d in doc_ids]
    docs["count"] = counts
    body = b"".join((MAGIC, *blocks, starts[:-1].astype("<u8").tobytes(), docs.tobytes()))
    docs_at = len(body) - docs.nbytes
    index_at = docs_at - 8 * len(blocks)
    foot = (len(ids), len(docs), len(blocks), index_at, docs_at, zlib.crc32(body), 0, MAGIC)
    return body + np.array([foot], _FOOT).tobytes()


class TokenFile:
    """Reads ranges of ids from an open file, through its block index."""

    def __init__(self, source) -> None:
        self.source = source
        source.seek(0, 2)
        end = source.tell()
        source.seek(end - _FOOT.itemsize)
        self.foot = np.frombuffer(source.read(_FOOT.itemsize), _FOOT)[0]
        if self.foot["magic"] != MAGIC:
            raise ValueError("no file of token ids, or a cut one")
        source.seek(int(self.foot["index_at"]))
        self.starts = np.frombuffer(source.read(8 * int(self.foot["blocks"])), "<u8")
        source.seek(int(self.foot["docs_at"]))
        self.docs = np.frombuffer(source.read(int(self.foot["docs"]) * _DOC.itemsize), _DOC)

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from position ``start``; reads only the blocks that hold them."""
        if not count:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (start + count - 1) // BLOCK + 1
        begin = int(self.starts[first])
        end = int(self.starts[last] if last < len(self.starts) else self.foot["index_at"])
        self.source.seek(begin)
        data = self.source.read(end - begin)
        found = decode_blocks(data, self.starts[first:last].astype(np.int64) - begin)
        return found[start - first * BLOCK :][:count]
