"""Documents as pieces of token ids: full windows and a rest, encoded once and laid out by a plan made from lengths alone.

Ids are stored and shuffled in two bytes where the vocabulary allows it, and come back in four.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellindex.llm.shared import slices, stored
from cellindex.llm.tokens import ID, encoder

NARROW = np.dtype("<u2")
#: From the lengths of documents to document, start, length, sequence and offset of each piece.
Plan = Callable[[np.ndarray], tuple[np.ndarray, ...]]


@dataclass(frozen=True)
class Encoded:
    """Stored pieces: ``row``, ``doc_id``, ``start``, ``length``, ``ids`` and the document's ``doc_tokens``."""

    rows: DataFrame
    kind: np.dtype
    tokens: int

    def rests(self) -> DataFrame:
        return self.rows.filter(F.col("length") < self.tokens)

    def rest_lengths(self) -> dict[int, int]:
        """How many rests there are of each length: less than one number per token of a window."""
        counted = self.rests().groupBy("length").agg(F.count(F.lit(1)).alias("n"))
        return {r["length"]: r["n"] for r in counted.collect()}


def encoded(docs: DataFrame, tokenizer: str, end_id: int, tokens: int, cut: str) -> Encoded:
    """Cut each document (columns ``doc_id`` and ``text``) with its end id into full windows of ``tokens`` and a rest."""
    vocabulary = encoder(tokenizer, cut).library.get_vocab().values()
    kind = NARROW if max(end_id, *vocabulary) < 1 << 16 else ID

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, cut)
        for batch in slices(batches, "text"):
            keys, rows = batch.column("doc_id"), ([], [], [], [], [])
            for k, raw in enumerate(encode.ids(batch.column("text").to_pylist())):
                ids = np.append(np.frombuffer(raw, ID), end_id).astype(kind)
                for first in range(0, len(ids), tokens):
                    part = ids[first : first + tokens]
                    for column, value in zip(rows, (k, first, len(part), part.tobytes(), len(ids))):
                        column.append(value)
            k, first, length, ids, total = rows
            types = (pa.int64(), pa.int64(), pa.binary(), pa.int64())
            columns = [pa.array(x, t) for x, t in zip((first, length, ids, total), types)]
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(k, pa.int64())), *columns], names=["doc_id", "start", "length", "ids", "doc_tokens"]
            )

    name = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.mapInArrow(run, f"doc_id {name}, start long, length long, ids binary, doc_tokens long")
    # A name for every piece, fixed once it is written.
    return Encoded(stored(rows.withColumn("row", F.monotonically_increasing_id()), "encoded"), kind, tokens)


def laid_out(pieces: Encoded, cells: int, plan: Plan) -> DataFrame:
    """All pieces with their sequence and place: full windows alone, rests as ``plan`` says for each of ``cells`` cells by hash.

    Only names and lengths go to the cells; ids come to the finished plan, in one shuffle.
    """
    full = pieces.rows.filter(F.col("length") == pieces.tokens).select(
        "doc_id", "start", "length", "ids", "doc_tokens", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    if not cells:
        return _widened(full, pieces.kind)

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row")
        doc, start, length, sequence, offset = plan(rows["length"].to_numpy())
        return pd.DataFrame(
            {
                "row": rows["row"].to_numpy()[doc], "first": start, "size": length,
                "sequence_id": sequence + (int(rows["cell"].iloc[0]) << 32), "offset": offset,
            }
        )

    rests = pieces.rests()
    cell = F.pmod(F.xxhash64("row"), F.lit(cells)).alias("cell")
    planned = rests.select("row", "length", cell).groupBy("cell").applyInPandas(
        packed, "row long, first long, size long, sequence_id long, offset long"
    )
    width = pieces.kind.itemsize
    part = F.expr(f"substring(ids, cast(first * {width} + 1 as int), cast(size * {width} as int))")
    cut_up = rests.join(planned, "row").select(
        "doc_id", (F.col("start") + F.col("first")).alias("start"), F.col("size").alias("length"), part.alias("ids"),
        "doc_tokens", "sequence_id", "offset",
    )
    return _widened(full.unionByName(cut_up), pieces.kind)


def _widened(rows: DataFrame, kind: np.dtype) -> DataFrame:
    """Ids as little-endian unsigned 32-bit integers."""
    if kind == ID:
        return rows
    return rows.mapInArrow(lambda batches: wide_batches(batches, kind), rows.schema)


def wide_batches(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[pa.RecordBatch]:
    """Batches with ids in four bytes, cut so that few of them are held at a time; a whole batch may be above 100 MB."""
    for batch in slices(batches, "ids"):
        at = batch.schema.get_field_index("ids")
        wide = [np.frombuffer(x, kind).astype(ID).tobytes() for x in batch.column(at).to_pylist()]
        yield batch.set_column(at, "ids", pa.array(wide, pa.binary()))
