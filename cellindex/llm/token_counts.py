"""Token counts by section: encode a document once, then give every token to a section.

A token is an interval of characters, and so is a section. Tokens are joined to
the sections they touch by two binary searches in the sorted section starts;
those that cross a boundary are allotted by an explicit rule:

``start``     the section of the token's first character,
``end``       the section of its last character,
``majority``  the section with most of its characters, the earlier one on ties,
``share``     every section by its part of the characters.

Characters in no section count as section -1, which is reported if any token
falls there. Sections are taken by their start; one that reaches into the next
ends where that starts. Null or empty texts have no line sections and so no rows, unless
``empty`` asks for one row (section -1 without tokens) for each document that would have none.
Null and repeated document ids are kept, each row being a document of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cellindex.llm.shared import slices
from cellindex.llm.tokens import LEADING, encoder

RULES = ("start", "end", "majority", "share")
SCHEMA = "doc_id {key}, section long, first long, end long, n_tokens double, doc_tokens long"


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the lines of a text, each with its line feed."""
    ends = np.cumsum([len(x) for x in text.split("\n")], dtype=np.int64) + np.arange(1, text.count("\n") + 2)
    ends[-1] -= 1
    starts = np.concatenate([[0], ends[:-1]])
    full = ends > starts
    return starts[full], ends[full]


def allot(start: np.ndarray, end: np.ndarray, first: np.ndarray, last: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section; the last entry is for tokens in no section."""
    n = len(first)
    counts = np.zeros(n + 1)
    if not len(start):
        return counts
    if not n:
        counts[0] = len(start)
        return counts
    last = np.minimum(last, np.append(first[1:], last[-1]))

    def section_of(place: np.ndarray) -> np.ndarray:
        k = np.searchsorted(first, place, side="right") - 1
        return np.where((k >= 0) & (place < last[np.maximum(k, 0)]), k, n)

    a, b = section_of(start), section_of(np.maximum(end - 1, start))
    # Sections do not overlap: a token with both ends in one lies there whole. One with both
    # ends outside may still hold a short section.
    within = (a == b) & ((a < n) | (np.searchsorted(first, start) == np.searchsorted(first, end)))
    if rule in ("start", "end"):
        np.add.at(counts, a if rule == "start" else b, 1)
        return counts
    np.add.at(counts, a[within], 1)
    for s, e in zip(start[~within].tolist(), end[~within].tolist()):
        places, chars = np.unique(section_of(np.arange(s, e)), return_counts=True)
        if rule == "share":
            counts[places] += chars / (e - s)
        else:
            counts[places[np.argmax(chars)]] += 1
    return counts


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    rule: str = "majority",
    sections: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    cut: str = LEADING,
    empty: bool = False,
) -> DataFrame:
    """Per document and section: its characters, its tokens, and the document's tokens.

    ``sections`` names a column of arrays of structs with fields ``first`` and
    ``end`` (characters, end excluded); without it the sections are the lines.
    ``section`` counts from 0 in order of the starts. With ``empty`` every document has a row.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    given = [docs[sections].alias("sections")] if sections else []
    docs = docs.select(docs[key].alias("doc_id"), docs[text].alias("text"), *given)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, cut, 300_000)
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            spans = batch.column("sections").to_pylist() if sections else [None] * len(texts)
            which, out = [], []
            for k, (t, own, (start, end)) in enumerate(zip(texts, spans, encode.spans(texts))):
                if sections:
                    both = sorted((s["first"], s["end"]) for s in own or [] if s and None not in s.values())
                    both = np.array([x for x in both if x[1] > x[0]], np.int64).reshape(-1, 2)
                    first, last = both[:, 0], both[:, 1]
                else:
                    first, last = line_sections(t)
                counts = allot(start, end, first, last, rule)
                number = np.arange(len(counts))
                number[-1] = -1
                rows = np.column_stack([number, np.append(first, -1), np.append(last, -1)])
                if not counts[-1] and not (empty and len(counts) == 1):
                    rows, counts = rows[:-1], counts[:-1]
                which.append(np.full(len(rows), k))
                out.append((rows, counts, np.full(len(rows), len(start))))
            rows, counts, totals = (np.concatenate([x[i] for x in out]) for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(np.concatenate(which))),
                    *(pa.array(rows[:, i].astype(np.int64)) for i in range(3)),
                    pa.array(counts),
                    pa.array(totals.astype(np.int64)),
                ],
                names=["doc_id", "section", "first", "end", "n_tokens", "doc_tokens"],
            )

    return docs.mapInArrow(run, SCHEMA.format(key=docs.schema["doc_id"].dataType.simpleString()))
