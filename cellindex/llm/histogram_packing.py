"""Packing by non-negative least squares on the histogram of document lengths.

Documents above a window are cut into full windows and a rest. What is packed
are the rests, and all that has to be known of them is how many there are of each
length: a table of less than one row per token of a window. From it recipes are
solved: short lists of lengths that fill a window, and how often to repeat each so that
the lengths are used up, by non-negative least squares. Counts are rounded,
documents are dealt to the places of the recipes, and those left over are
packed greedily: cut, they fill what recipes left free, then windows of their own.

Recipes of up to four lengths cannot fill a long window with short documents. So
there are windows of several sizes, each a quarter of the next: a document belongs
to the smallest that holds it, and a filled window is one length of the next
recipe. Lengths count in bins of a 256th of a window, rounded up.

Rests are packed in cells of bounded size by hash, with the recipes of the whole
table, so no task holds more than a cell and the result does not depend on
partitions. Each cell ends with a few windows of less than full size; where
sequences of a power of two need no padding, these are such sequences.

Null or empty texts are documents of the end id alone. Null and repeated ids are
kept: every row is a document of its own. An empty table gives an empty result.
Other columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellindex.llm import pieces
from cellindex.llm.tokens import WORDS

#: Lengths in a recipe at most; bins of a window, and of the smallest one, whose lengths have no lower bound.
DEPTH, BINS, LOWEST_BINS = 4, 256, 64


@dataclass(frozen=True)
class Room:
    """A window of ``tokens``; sequences of a power of two need no padding if ``powers`` is set.

    ``cell`` is about how many documents are packed together; ``least`` bounds the smallest window.
    """

    tokens: int = 4096
    powers: bool = True
    cell: int = 8192
    least: int = 16

    def __post_init__(self):
        if self.tokens < 1 or self.cell < 1 or self.least < 1:
            raise ValueError("tokens, cell and least must be positive")

    def windows(self) -> list[int]:
        """Sizes of windows, smallest first."""
        sizes = [self.tokens]
        while sizes[-1] % DEPTH == 0 and sizes[-1] // DEPTH >= self.least:
            sizes.append(sizes[-1] // DEPTH)
        return sizes[::-1]


def fillings(total: int, least: int, depth: int = DEPTH) -> Iterator[tuple[int, ...]]:
    """All falling lists of up to ``depth`` numbers, none below ``least``, with this sum."""

    def longer(rest: int, most: int, left: int) -> Iterator[tuple[int, ...]]:
        if least <= rest <= most:
            yield (rest,)
        if left > 1:
            for first in range(min(most, rest - least), least - 1, -1):
                for others in longer(rest - first, first, left - 1):
                    yield (first, *others)

    yield from longer(total, total, depth)


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The non-negative ``x`` with the least ``|a x - b|``, by active sets."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    close = 1e-10 * max(1e-300, float(np.abs(a.T @ b).max(initial=0.0)))
    for _ in range(3 * a.shape[1]):
        slope = np.where(active, -np.inf, a.T @ (b - a @ x))
        if not len(slope) or slope.max() <= close:
            break
        active[int(slope.argmax())] = True
        while True:
            tried = np.zeros_like(x)
            tried[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            below = active & (tried <= 0)
            if not below.any():
                break
            step = float((x[below] / np.maximum(x[below] - tried[below], 1e-300)).min())
            x = x + step * (tried - x)
            active &= x > 1e-15
            x[~active] = 0
        x = tried
    return x


@dataclass(frozen=True)
class Recipes:
    """Recipes of one window size: bins of their lengths, and how often to use each for one document packed."""

    window: int
    unit: int
    bins: list[tuple[int, ...]]
    share: list[float]


def solve(histogram: Mapping[int, int], room: Room) -> list[Recipes]:
    """Recipes of all window sizes for this number of documents of each length."""
    everything = sum(histogram.values())
    out, filled, below = [], 0.0, 0
    for window in room.windows():
        unit = -(-window // (BINS if below else LOWEST_BINS))
        bins = window // unit
        wanted = np.zeros(bins + 1)
        for length, count in histogram.items():
            if below < length <= window:
                wanted[min(bins, -(-length // unit))] += count / everything
        if below:
            wanted[-(-below // unit)] += filled
        least = -(-below // unit) if below else 1
        lists = [r for r in fillings(bins, least) if all(wanted[b] > 0 for b in r)]
        share = np.zeros(0)
        if lists:
            made = np.zeros((bins + 1, len(lists)))
            for k, r in enumerate(lists):
                np.add.at(made[:, k], list(r), 1)
            weigh = np.arange(bins + 1)[:, None]  # what is left over counts by its tokens
            share = nnls(made * weigh, wanted * weigh[:, 0])
        used = [k for k in range(len(lists)) if share[k] > 0]
        out.append(Recipes(window, unit, [lists[k] for k in used], [float(share[k]) for k in used]))
        filled, below = float(share.sum()), window
    return out


class _Cell:
    """The documents of one cell while they are packed: pieces, and windows inside windows."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        self.doc: list[np.ndarray] = []
        self.start: list[np.ndarray] = []
        self.length: list[np.ndarray] = []
        self.window: list[np.ndarray] = []
        self.at: list[np.ndarray] = []
        self.size = np.zeros(0, np.int64)  # of windows, as are the following
        self.fill = np.zeros(0, np.int64)
        self.parent = np.zeros(0, np.int64)
        self.place = np.zeros(0, np.int64)

    def open(self, count: int, size: int) -> np.ndarray:
        first = len(self.size)
        self.size = np.append(self.size, np.full(count, size))
        for name in ("fill", "place"):
            setattr(self, name, np.append(getattr(self, name), np.zeros(count, np.int64)))
        self.parent = np.append(self.parent, np.full(count, -1))
        return np.arange(first, first + count)

    def put(self, doc: np.ndarray, start: np.ndarray, length: np.ndarray, window: np.ndarray, at: np.ndarray) -> None:
        for name, value in (("doc", doc), ("start", start), ("length", length), ("window", window), ("at", at)):
            getattr(self, name).append(np.asarray(value, np.int64))

    def cook(self, recipe: tuple[int, ...], times: int, window: int, items: dict[int, np.ndarray], taken: dict[int, int]) -> None:
        """Fill ``times`` windows with the next things of the recipe's bins; numbers from -1 down are windows."""
        made = self.open(times, window)
        for b in recipe:
            own = items[b][taken[b] : taken[b] + times]
            taken[b] += times
            docs, inner = own >= 0, -1 - own
            self.put(own[docs], np.zeros(docs.sum()), self.lengths[own[docs]], made[docs], self.fill[made[docs]])
            self.parent[inner[~docs]], self.place[inner[~docs]] = made[~docs], self.fill[made[~docs]]
            self.fill[made] += np.where(docs, self.lengths[np.where(docs, own, 0)], self.size[np.where(docs, 0, inner)])

    def roots(self) -> np.ndarray:
        """The outermost window around each window."""
        root = np.arange(len(self.size))
        while (inside := self.parent[root] >= 0).any():
            root = np.where(inside, self.parent[root], root)
        return root

    def pieces(self) -> tuple[np.ndarray, ...]:
        """Document, start, length, sequence and offset of all pieces, sequences numbered from 0."""
        doc, start, length, window, at = (np.concatenate(x) for x in (self.doc, self.start, self.length, self.window, self.at))
        while (inside := self.parent[window] >= 0).any():
            at = at + np.where(inside, self.place[window], 0)
            window = np.where(inside, self.parent[window], window)
        order = np.lexsort((at, window))
        doc, start, length, window = doc[order], start[order], length[order], window[order]
        new = np.append(True, window[1:] != window[:-1])
        before = np.cumsum(length) - length
        sequence = np.cumsum(new) - 1
        return doc, start, length, sequence, before - before[new][sequence]


def _counts(recipes: Recipes, documents: int, there: dict[int, int]) -> list[int]:
    """Whole numbers of repeats that the things of a cell allow: rounded, cut back, then filled up."""
    left = dict(there)
    times = [0] * len(recipes.bins)

    def use(k: int, most: int) -> None:
        bins = recipes.bins[k]
        n = min([most, *(left.get(b, 0) // bins.count(b) for b in set(bins))])
        times[k] += n
        for b in bins if n else ():
            left[b] -= n

    for k in np.argsort(recipes.share)[::-1].tolist():
        use(k, round(recipes.share[k] * documents))
    for k in range(len(times)):
        if all(left.get(b, 0) for b in recipes.bins[k]):
            use(k, documents)
    return times


def pack_cell(lengths: np.ndarray, recipes: list[Recipes], room: Room) -> tuple[np.ndarray, ...]:
    """Document, start, length, sequence and offset of every piece of documents of these lengths (all below a window)."""
    cell, below = _Cell(lengths), 0
    inner = np.zeros(0, np.int64)  # windows of the size before, to be used as lengths
    rest: list[np.ndarray] = []
    for r in recipes:
        own = np.flatnonzero((lengths > below) & (lengths <= r.window))
        binned = np.minimum(r.window // r.unit, -(-lengths[own] // r.unit))
        order = np.argsort(binned, kind="stable")
        own, binned = own[order], binned[order]
        names, first = np.unique(binned, return_index=True)
        items = dict(zip(names.tolist(), np.split(own, first[1:]))) if len(own) else {}
        b = -(-below // r.unit)
        if len(inner):
            items[b] = np.append(-1 - inner, items.get(b, np.zeros(0, np.int64)))
        taken = dict.fromkeys(items, 0)
        opened = len(cell.size)
        lists = list(zip(r.bins, _counts(r, len(lengths), {b: len(v) for b, v in items.items()})))
        if len(inner):  # filled windows that recipes leave fill windows alone
            lists.append(((b,) * DEPTH, max(0, len(inner) - sum(n * x.count(b) for x, n in lists)) // DEPTH))
        for bins, n in lists:
            if n:
                cell.cook(bins, n, r.window, items, taken)
        rest += [v[taken[x] :][v[taken[x] :] >= 0] for x, v in items.items()]
        inner, below = np.arange(opened, len(cell.size)), r.window
    _greedy(cell, np.concatenate(rest) if rest else np.zeros(0, np.int64), room)
    return cell.pieces()


def _greedy(cell: _Cell, rest: np.ndarray, room: Room) -> None:
    """Lay the documents left over end to end through the free ends of windows, then through new windows."""
    free = cell.size - cell.fill
    tokens, needed = int(cell.lengths[rest].sum()), int(free.sum())
    if tokens < needed and cell.window:
        # Too few to fill all free ends: the last sequences give their documents back.
        docs, window, length = (np.concatenate(x) for x in (cell.doc, cell.window, cell.length))
        roots = cell.roots()
        inside = np.bincount(roots[window], length, len(roots)) + np.bincount(roots, free, len(roots))
        some = np.unique(roots)[::-1]
        some = some[: int(np.searchsorted(np.cumsum(inside[some]), needed - tokens)) + 1]
        back = np.isin(roots[window], some)
        rest = np.append(rest, docs[back])
        keep = [np.concatenate(x)[~back] for x in (cell.doc, cell.start, cell.length, cell.window, cell.at)]
        cell.doc, cell.start, cell.length, cell.window, cell.at = ([k] for k in keep)
        free[np.isin(roots, some)] = 0
        tokens += int(length[back].sum())
    ends = np.flatnonzero(free)
    sizes = free[ends]
    places, at = ends, cell.fill[ends]
    more = max(0, tokens - int(sizes.sum()))
    tail = more % room.tokens
    new = [room.tokens] * (more // room.tokens)
    if tail:
        new += [1 << k for k in reversed(range(tail.bit_length())) if tail >> k & 1] if room.powers else [tail]
    if new:
        opened = cell.open(len(new), 0)
        places, at, sizes = np.append(places, opened), np.append(at, np.zeros(len(new), np.int64)), np.append(sizes, new)
    # Where documents end and where places end, in one line of tokens: between two such ends lies one piece.
    lengths = cell.lengths[rest]
    docs_end, room_end = np.cumsum(lengths), np.cumsum(sizes)
    cuts = np.unique(np.concatenate([docs_end, room_end[room_end < tokens]]))
    cuts = cuts[cuts <= tokens]
    begin = np.append(0, cuts[:-1]) if len(cuts) else cuts
    d, p = np.searchsorted(docs_end, begin, side="right"), np.searchsorted(room_end, begin, side="right")
    cell.put(rest[d], begin - (docs_end - lengths)[d], cuts - begin, places[p], at[p] + begin - (room_end - sizes)[p])


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    room: Room = Room(),
    key: str = "doc_id",
    text: str = "text",
    cut: str = WORDS,
) -> DataFrame:
    """One row per piece: its ids, the length of its document in ``doc_tokens``, its sequence and place there."""
    docs = docs.select(docs[key].alias("doc_id"), docs[text].alias("text"))
    encoded = pieces.encoded(docs, tokenizer, end_id, room.tokens, cut)
    histogram = encoded.rest_lengths()
    recipes = solve(histogram, room) if histogram else []
    cells = -(-sum(histogram.values()) // room.cell)
    return pieces.laid_out(encoded, cells, lambda lengths: pack_cell(lengths, recipes, room))


def padding(packed: DataFrame, room: Room = Room()) -> DataFrame:
    """One row: ``sequences``, their ``tokens`` and the ``padding`` they need."""
    sums = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    n = F.col("n")
    exempt = (n.bitwiseAND(n - 1) == 0) if room.powers else (n < 0)
    need = F.when(exempt, 0).otherwise(room.tokens - n)
    return sums.agg(F.count(F.lit(1)).alias("sequences"), F.sum("n").alias("tokens"), F.sum(need).alias("padding"))
