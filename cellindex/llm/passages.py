"""Passages of texts as numbers: what characters and words they are made of.

All passages of a batch of texts are measured together with numpy on the UTF-8
bytes. A passage is a run of ``size`` words (what stands between white space);
the last of a text may be shorter, and a text without words is one empty passage.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _classes() -> np.ndarray:
    """Lower case, upper case, digits, the lead and other bytes of longer characters, controls, and each mark."""
    kind = np.full(256, 5)
    kind[ord("a") : ord("z") + 1] = 0
    kind[ord("A") : ord("Z") + 1] = 1
    kind[ord("0") : ord("9") + 1] = 2
    kind[0xC0:], kind[0x80:0xC0] = 3, 4
    marks = [c for c in range(33, 127) if not chr(c).isalnum()]
    kind[marks] = 6 + np.arange(len(marks))
    return kind


_CLASS = _classes()
N_CLASSES = int(_CLASS.max()) + 1
_LETTER = (_CLASS <= 1) | (_CLASS == 3) | (_CLASS == 4)
N_FEATURES = N_CLASSES + 10
_POWER = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def measure(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Features (passages, N_FEATURES) of all passages in order, and the number of passages of each text."""
    raw = [(t or "").encode() for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    first = np.cumsum([0] + [len(r) + 1 for r in raw[:-1]])
    space = _SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    n_words = np.diff(np.append(np.searchsorted(starts, first), len(starts)))
    n_passages = np.maximum(1, -(-n_words // size))
    offset = np.cumsum(n_passages) - n_passages
    total = int(n_passages.sum())
    out = np.zeros((total, N_FEATURES), np.float32)
    if not len(starts):
        out[:, -1] = 1
        return out, n_passages
    rank = np.arange(len(starts)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
    passage = np.repeat(offset, n_words) + rank // size
    length = ends - starts

    solid = data[~space]
    kind = _CLASS[solid]
    per = np.bincount(np.repeat(passage, length) * N_CLASSES + kind, minlength=total * N_CLASSES)
    per = per.reshape(total, N_CLASSES).astype(np.float32)
    chars = np.maximum(per.sum(axis=1), 1)
    out[:, :N_CLASSES] = np.sqrt(per / chars[:, None])

    at = np.cumsum(length) - length
    place = np.arange(len(solid)) - np.repeat(at, length)
    name = np.add.reduceat((solid.astype(np.uint64) + np.uint64(1)) * _POWER[place % 64], at)
    upper = np.add.reduceat((kind == 1).astype(np.int64), at)
    lower = np.add.reduceat((kind == 0).astype(np.int64), at)
    letters = np.add.reduceat(_LETTER[solid].astype(np.int64), at)
    last = solid[at + length - 1]
    ending = ~_LETTER[last] & (length > 1) & ~_LETTER[solid[np.maximum(at + length - 2, at)]]
    words = np.bincount(passage, minlength=total)
    some = np.maximum(words, 1)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(passage, values, minlength=total) / some

    order = np.lexsort((name, passage))
    a, b = order[:-1], order[1:]
    again = np.zeros(len(name), bool)
    again[b] = (name[a] == name[b]) & (passage[a] == passage[b])
    run = np.zeros(len(name), bool)
    run[1:] = (name[1:] == name[:-1]) & (passage[1:] == passage[:-1])
    average = mean(length)
    columns = [
        np.log1p(average),
        np.sqrt(np.maximum(mean(length.astype(float) ** 2) - average**2, 0)) / 10,
        mean(again),
        mean(run),
        mean((upper > 1) & (lower == 0)),
        mean(ending),
        mean(letters == 0),
        mean(length > 30),
        np.log1p(words) / np.log1p(size),
        words == 0,
    ]
    for k, values in enumerate(columns):
        out[:, N_CLASSES + k] = values
    return out, n_passages
