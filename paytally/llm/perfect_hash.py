"""A minimal perfect hash over byte strings: hash, displace, compare."""

from __future__ import annotations

import numpy as np
import xxhash

_U = np.uint64
_PER_BUCKET = 2


def _halves(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two almost independent values of a 64-bit hash: a start and an odd step."""
    start = (hashes >> _U(32)) % _U(size)
    step = ((hashes & _U(0xFFFFFFFF)) % _U(max(size - 1, 1))) + _U(1)
    return start, step


def _mixed(start: np.ndarray, step: np.ndarray, shift, size: int) -> np.ndarray:
    """The slot under displacement ``shift``; multiplied so that steps do not line up."""
    value = (start + step * shift) * _U(0x9E3779B97F4A7C15) + shift
    return ((value >> _U(20)) % _U(size)).astype(np.int64)


class PerfectHash:
    """Maps each of ``keys`` to its index; everything else to -1."""

    def __init__(self, keys: list[bytes], seed: int = 0) -> None:
        if len(set(keys)) != len(keys):
            raise ValueError("keys repeat")
        self.size = len(keys)
        self.buckets = max(1, self.size // _PER_BUCKET)
        while True:
            self.seed = seed
            if self._build(keys):
                break
            seed += 1

    def _hashes(self, keys: list[bytes]) -> np.ndarray:
        seed, digest = self.seed, xxhash.xxh3_64_intdigest
        return np.fromiter((digest(k, seed) for k in keys), _U, len(keys))

    def _bucket(self, hashes: np.ndarray) -> np.ndarray:
        mixed = (hashes ^ (hashes >> _U(29))) * _U(0xBF58476D1CE4E5B9)
        return ((mixed >> _U(24)) % _U(self.buckets)).astype(np.int64)

    def _build(self, keys: list[bytes]) -> bool:
        hashes = self._hashes(keys)
        if len(np.unique(hashes)) < len(keys):
            return False
        bucket = self._bucket(hashes)
        start, step = _halves(hashes, self.size)
        order = np.argsort(bucket, kind="stable")
        ends = np.cumsum(np.bincount(bucket, minlength=self.buckets))
        sizes = np.diff(ends, prepend=0)
        taken = np.zeros(self.size, bool)
        owner = np.full(self.size, -1, np.int64)
        # Displacements from 0; a bucket of one key stores -1 - slot instead.
        self.shift = np.zeros(self.buckets, np.int64)
        by_size = np.argsort(-sizes, kind="stable")
        singles = []
        tries = np.arange(1 << 14, dtype=_U)
        for b in by_size:
            mine = order[ends[b] - sizes[b] : ends[b]]
            if len(mine) <= 1:
                singles += [(b, k) for k in mine]
                continue
            for block in range(0, len(tries), 64):
                shifts = tries[block : block + 64]
                slots = _mixed(start[mine][None], step[mine][None], shifts[:, None], self.size)
                free = ~taken[slots].any(axis=1)
                ranked = np.sort(slots, axis=1)
                free &= (np.diff(ranked, axis=1) > 0).all(axis=1)
                if free.any():
                    k = int(np.argmax(free))
                    self.shift[b] = shifts[k]
                    taken[slots[k]] = True
                    owner[slots[k]] = mine
                    break
            else:
                return False
        for (b, key), slot in zip(singles, np.flatnonzero(~taken), strict=False):
            self.shift[b] = -1 - slot
            owner[slot] = key
        self.owner = owner
        self.keys = keys
        return True

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The index of each key, -1 where it is none of ours."""
        if not keys or not self.size:
            return np.full(len(keys), -1, np.int64)
        hashes = self._hashes(keys)
        shift = self.shift[self._bucket(hashes)]
        start, step = _halves(hashes, self.size)
        slot = np.where(
            shift < 0, -1 - shift, _mixed(start, step, np.maximum(shift, 0).astype(_U), self.size)
        )
        found = self.owner[slot]
        own = self.keys
        same = np.fromiter(
            (own[i] == k for i, k in zip(found.tolist(), keys, strict=True)), bool, len(keys)
        )
        return np.where(same, found, -1)
