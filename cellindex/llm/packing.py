"""Vector best-fit packing of documents into sequences.

Every sequence has three capacities: tokens, documents, and attention cost (the
sum of squared piece lengths). A piece goes into that open sequence which every
capacity allows and which fits best: the largest weighted dot product of needs
and room left (``score="dot"``) or the smallest norm of the room that would be
left (``score="norm"``). Pieces are taken longest first, and a sequence stays open
until none of the pieces left fits. A piece whose attention cost alone is above
the capacity has a sequence of its own.

Documents are encoded once. Full pieces are sequences as they are; the others are packed
in cells of bounded size, dealt by hash, from their lengths alone. So the number of
sequences depends on the table, not on its partitions, and of each cell only the last
sequences are partly filled. A lost task reads the same stored pieces again.

Null or empty texts are documents of the end id alone. Null and repeated
document ids are kept: every row is a document of its own. An empty table gives
an empty result. Other columns of the table are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellindex.llm import pieces
from cellindex.llm.tokens import WORDS


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds. ``None`` lifts a limit; ``weights`` are for the dot product or norm."""

    tokens: int = 4096
    documents: int | None = None
    attention: float | None = None
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    score: str = "norm"

    def __post_init__(self):
        if self.tokens < 1 or self.score not in ("norm", "dot"):
            raise ValueError("tokens must be positive and score be 'norm' or 'dot'")
        if self.documents is not None and self.documents < 1:
            raise ValueError("a sequence holds one document at least")
        if self.attention is not None and self.attention <= 0:
            raise ValueError("attention must be positive")

    def needs(self, length: int) -> np.ndarray:
        """Share of each capacity that a piece takes; a lifted limit is never touched."""
        return np.array(
            [
                length / self.tokens,
                1 / self.documents if self.documents else 0.0,
                length**2 / self.attention if self.attention else 0.0,
            ]
        )


class Sequences:
    """The sequences of one cell: tokens in each, and the room left of those that are open."""

    def __init__(self, capacity: Capacity):
        self.capacity = capacity
        self.weights = np.array(capacity.weights)
        self.count = 0
        self.room = np.zeros((256, 3))
        self.tokens = np.zeros(256, np.int64)
        self.ids = np.zeros(256, np.int64)
        self.next_id = 0

    def place(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece, longest first."""
        order = np.argsort(-lengths, kind="stable")
        least = int(lengths.min(initial=self.capacity.tokens))
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for n, k in enumerate(order.tolist()):
            if n % 512 == 511:
                self._close(least)
            sequence[k], offset[k] = self._best(int(lengths[k]))
        return sequence, offset

    def _best(self, length: int) -> tuple[int, int]:
        need = self.capacity.needs(length)
        room = self.room[: self.count]
        fits = np.flatnonzero(
            (self.tokens[: self.count] + length <= self.capacity.tokens)
            & (room[:, 1] >= need[1] - 1e-12)
            & (room[:, 2] >= need[2] - 1e-12)
        )
        if len(fits):
            left = room[fits]
            if self.capacity.score == "norm":
                best = fits[np.argmin((self.weights * (left - need) ** 2).sum(1))]
            else:
                best = fits[np.argmax(left @ (self.weights * need))]
            return self._put(int(best), length, need)
        if self.count == len(self.room):
            grow = ((0, len(self.room)),)
            self.room = np.pad(self.room, (*grow, (0, 0)))
            self.tokens, self.ids = np.pad(self.tokens, grow), np.pad(self.ids, grow)
        self.room[self.count], self.tokens[self.count], self.ids[self.count] = 1.0, 0, self.next_id
        self.count, self.next_id = self.count + 1, self.next_id + 1
        return self._put(self.count - 1, length, need)

    def _put(self, k: int, length: int, need: np.ndarray) -> tuple[int, int]:
        at = int(self.tokens[k])
        self.tokens[k] += length
        self.room[k] -= need
        return int(self.ids[k]), at

    def _close(self, least: int) -> None:
        """Leave out sequences that even the shortest piece does not fit."""
        need, n = self.capacity.needs(least), self.count
        room = self.room[:n]
        open_ = (self.tokens[:n] + least <= self.capacity.tokens) & (room[:, 1] >= need[1] - 1e-12) & (room[:, 2] >= need[2] - 1e-12)
        open_ = np.flatnonzero(open_)
        self.count = len(open_)
        for name in ("room", "tokens", "ids"):
            column = getattr(self, name)
            column[: self.count] = column[open_]


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    capacity: Capacity = Capacity(),
    key: str = "doc_id",
    text: str = "text",
    cut: str = WORDS,
    cell: int = 8192,
) -> DataFrame:
    """One row per piece with its ids (little-endian unsigned 32-bit), sequence and offset there.

    Only documents longer than a sequence are cut, into full pieces and a rest.
    ``cell`` is about how many pieces a task packs at a time.
    """
    docs = docs.select(docs[key].alias("doc_id"), docs[text].alias("text"))
    encoded = pieces.encoded(docs, tokenizer, end_id, capacity.tokens, cut)
    cells = -(-encoded.rests().count() // cell)

    def plan(lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        sequence, offset = Sequences(capacity).place(lengths)
        return np.arange(len(lengths)), np.zeros(len(lengths), np.int64), lengths, sequence, offset

    placed = pieces.laid_out(encoded, cells, plan)
    piece = (F.col("start") / capacity.tokens).cast("int").alias("piece")
    return placed.select("doc_id", piece, "start", "length", "ids", "sequence_id", "offset")
