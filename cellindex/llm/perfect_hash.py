"""Minimal perfect hashing of 64-bit key hashes: levels of bit arrays with rank samples.

Keys that fall on a position of a level alone are settled there; the others go
on to the next level. A settled key's slot is the number of set bits before its
position, so ``n`` keys take the slots 0 to n - 1, and a look-up reads one or two
words in a few levels, whatever ``n`` is.
"""

from __future__ import annotations

import numpy as np

_GAMMA = 2
_LEVELS = 40


def mix(keys: np.ndarray, level: int) -> np.ndarray:
    """A further hash of each key for a level (splitmix64 finisher)."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """``words`` holds all levels one after another, ``sizes`` their words, ``ranks`` the set bits before each word."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        self.words, self.sizes = words, sizes
        self.first = np.cumsum(sizes) - sizes
        count = np.bitwise_count(words).astype(np.int64)
        self.ranks = np.cumsum(count) - count
        self.count = int(count.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` must be distinct."""
        left, levels = keys.astype(np.uint64), []
        while len(left):
            if len(levels) == _LEVELS:
                raise ValueError("keys are not distinct")
            bits = max(64, -(-_GAMMA * len(left) // 64) * 64)
            place = (mix(left, len(levels)) % np.uint64(bits)).astype(np.int64)
            alone = np.bincount(place, minlength=bits) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[place]]
        empty = np.zeros(0, "<u8")
        return cls(np.concatenate([empty, *levels]), np.array([len(x) for x in levels], np.int64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for some that were not given; others get the slot of another key."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (first, size) in enumerate(zip(self.first.tolist(), self.sizes.tolist())):
            place = (mix(keys[open_], level) % np.uint64(size * 64)).astype(np.int64)
            word, bit = first + place // 64, (place % 64).astype(np.uint64)
            value = self.words[word]
            hit = (value >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(value & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[hit]] = self.ranks[word[hit]] + below[hit]
            open_ = open_[~hit]
            if not len(open_):
                break
        return out
