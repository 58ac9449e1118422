"""Minimal perfect hash of a shard of terms: bit levels with ranks, and the terms themselves to verify a hit."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from shelfline.llm.common import mixed

SEED = 42  # of Spark's own xxhash64, so that plans and tasks agree on the shard of a term
GAMMA = 2  # bits of a level for each term that reaches it
MOST_LEVELS = 40


def hashes_of(terms: list[bytes]) -> np.ndarray:
    """Unsigned 64-bit hash of each term, the same as Spark's xxhash64 of the string."""
    return np.fromiter((xxhash.xxh64_intdigest(t, SEED) for t in terms), np.uint64, len(terms))


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """pmod of the signed hash, as the plan deals terms to shards."""
    return np.mod(hashes.view(np.int64), shards)


def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(hashes + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0 to n-1 for n known terms. Unknown terms get -1: a hit counts only when the stored term is equal.

    A term rests in the first level where no other term of that level falls on its bit; its slot is the number
    of set bits before. Terms of one and the same hash never part; they follow at the end, looked up by name.
    """

    def __init__(self, terms: list[bytes], hashes: np.ndarray | None = None):
        hashes = hashes_of(terms) if hashes is None else hashes
        left, words, self.sizes, found = np.arange(len(terms)), [], [], []
        while len(left) and len(self.sizes) < MOST_LEVELS:
            size = 64 * -(-GAMMA * len(left) // 64)
            at = _place(hashes[left], len(self.sizes), size)
            bits = np.bincount(at, minlength=size) == 1
            own = bits[at]
            order = np.argsort(at[own])
            found.append(left[own][order])
            words.append(np.packbits(bits, bitorder="little").view(np.uint64))
            self.sizes.append(size)
            left = left[~own]
        order = np.concatenate([*found, left]).astype(np.int64) if len(terms) else np.zeros(0, np.int64)
        self.words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.terms = pa.array([terms[i] for i in order], pa.binary())
        first = len(terms) - len(left)
        self.alike = {terms[i]: first + k for k, i in enumerate(left.tolist())}

    def slots(self, terms: list[bytes], hashes: np.ndarray | None = None) -> np.ndarray:
        """Slot of each term, -1 for terms that the shard does not know."""
        hashes = hashes_of(terms) if hashes is None else hashes
        out, left, start = np.full(len(terms), -1, np.int64), np.arange(len(terms)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = _place(hashes[left], level, size) + start
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.before[at[hit] >> 6] + np.bitwise_count(below)
            left, start = left[~hit], start + size
        claimed = np.flatnonzero(out >= 0)
        if len(claimed):
            same = pc.equal(self.terms.take(pa.array(out[claimed])), pa.array([terms[i] for i in claimed], pa.binary()))
            out[claimed[~same.to_numpy(zero_copy_only=False)]] = -1
        if self.alike:
            for i in np.flatnonzero(out < 0).tolist():
                out[i] = self.alike.get(terms[i], -1)
        return out
