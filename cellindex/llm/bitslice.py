"""Hamming distances of many 64-bit fingerprints at once, from vertical bit planes.

Plane ``b`` holds bit ``b`` of 64 fingerprints in each word. A query differs
from them in plane ``b`` where the plane does not equal its own bit; those
differences are added up lane by lane with carry-save adders, seven planes at a
time, into vertical counters. A query whose lanes all exceed the radius is
abandoned at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
BITS = np.arange(64, dtype=np.uint64)


def planes_of(prints: np.ndarray) -> np.ndarray:
    """Of prints in rows of 64 lanes a word, shape (groups, lanes), the planes: (64, groups, words)."""
    count, lanes_ = prints.shape
    bits = np.unpackbits(np.ascontiguousarray(prints, "<u8").view(np.uint8), axis=1, bitorder="little")
    bits = bits.reshape(count, lanes_, 64).transpose(2, 0, 1)
    return np.ascontiguousarray(np.packbits(bits, axis=2, bitorder="little")).view("<u8")


def _full_add(a, b, c):
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def _seven(d: list[np.ndarray]) -> list[np.ndarray]:
    """Seven difference planes as a three-bit number in each lane."""
    s1, c1 = _full_add(d[0], d[1], d[2])
    s2, c2 = _full_add(d[3], d[4], d[5])
    low, c3 = _full_add(s1, s2, d[6])
    mid, high = _full_add(c1, c2, c3)
    return [low, mid, high]


def _above(counter: list[np.ndarray], limit: int) -> np.ndarray:
    """Lanes whose count is larger than ``limit``."""
    over, equal = np.zeros_like(counter[0]), np.full_like(counter[0], ONES)
    for b in range(len(counter) - 1, -1, -1):
        if limit >> b & 1:
            equal &= counter[b]
        else:
            over |= equal & counter[b]
            equal &= ~counter[b]
    return over


def within(
    queries: np.ndarray,
    owner: np.ndarray,
    after: np.ndarray,
    planes: np.ndarray,
    counts: np.ndarray,
    radius: int,
    same: int = 0,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For blocks of queries: query numbers, and lanes at most ``radius`` bits away as words.

    Query ``k`` is compared with group ``owner[k]`` of the planes, which has
    ``counts`` fingerprints, in lanes above ``after[k]``. Bits set in ``same`` are
    known to agree and are skipped. Queries without such lanes are not returned.
    """
    words = planes.shape[2]
    used = [b for b in range(64) if not same >> b & 1]
    groups = [used[i : i + 7] for i in range(0, len(used), 7)]
    size = max(3, (radius + 1).bit_length() + 1)
    lane = np.arange(words, dtype=np.int64) * 64
    block = max(1, 8192 // words)
    for first in range(0, len(queries), block):
        alive = np.arange(first, min(first + block, len(queries)))
        dead = _below(after[alive, None] + 1 - lane) | ~_below(counts[owner[alive], None] - lane)
        counter = [np.zeros((len(alive), words), np.uint64) for _ in range(size)]
        most = dead  # lanes beyond what the counters hold
        for done, group in enumerate(groups, 1):
            own = (queries[alive, None] >> BITS[group]) & np.uint64(1)
            flip = np.where(own == 1, ONES, np.uint64(0))
            diff = [planes[b][owner[alive]] ^ flip[:, k, None] for k, b in enumerate(group)]
            diff += [np.zeros_like(diff[0])] * (7 - len(diff))
            low, mid, high = _seven(diff)
            carry = counter[0] & low
            counter[0] ^= low
            counter[1], carry = _full_add(counter[1], mid, carry)
            counter[2], carry = _full_add(counter[2], high, carry)
            for b in range(3, size):
                counter[b], carry = counter[b] ^ carry, counter[b] & carry
            most = most | carry
            if done < len(groups) and 7 * done < 2 * radius + 2:
                continue  # half of the planes differ by chance, so hardly any query is done yet
            over = _above(counter, radius) | most
            going = (over != ONES).any(axis=1)
            if not going.all():
                alive, over, most = alive[going], over[going], most[going]
                counter = [c[going] for c in counter]
                if not len(alive):
                    break
        if len(alive):
            yield alive, ~over


def _below(count: np.ndarray) -> np.ndarray:
    """Words whose first ``count`` lanes are set (none below 0, all from 64)."""
    some = np.clip(count, 0, 63).astype(np.uint64)
    return np.where(count >= 64, ONES, (np.uint64(1) << some) - np.uint64(1))


def lanes(words: np.ndarray) -> np.ndarray:
    """Numbers of the lanes set in one query's words."""
    return np.flatnonzero(np.unpackbits(words.astype("<u8").view(np.uint8), bitorder="little"))
