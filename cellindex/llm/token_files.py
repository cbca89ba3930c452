"""Token ids in binary shards, with a minimal perfect hash index from document keys to places.

A shard ``ids-<number>.bin`` holds, one after another, the ids of documents in ascending
order of their keys, then the end of each document and a footer:

    ids       16 or 32 bits each, little endian (16 if the vocabulary fits)
    ends      8 bytes per document: ids up to and with this document
    footer    magic, bytes per id, documents, ids (8 bytes each)

An index file ``index-<bucket>.bin`` serves the keys whose hash falls into its bucket:

    header    magic, keys, levels, words of all levels (8 bytes each)
    levels    words of each level, then the words (see ``perfect_hash``)
    slots     per key: fingerprint, shard, document in the shard, ids before it there, ids, documents of this key
    clashes   keys whose hashes are equal, looked up by their text: JSON to the end of the file

Keyed access hashes the key, finds its slot, checks the stored fingerprint and
reads one range of one shard: constant time, without any list of keys. Shards
are ranges of keys made by Spark's range partitioning; a task writes its shard
under a name of its own and then moves it, so a task that is run again replaces
it with the same bytes. Any file system that Arrow can write to serves as folder.

Null or empty texts are the end id alone. Null keys come first and are a key of
their own. Documents of one key follow each other (by digest of the text) and are all
read for it, also across shards. An empty table gives no files and an empty result. Other columns are
not read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellindex.llm.perfect_hash import PerfectHash
from cellindex.llm.shared import slices, stored
from cellindex.llm.tokens import ID, WORDS, encoder

#: Fixed values of the format.
SHARD_MAGIC, INDEX_MAGIC = 0x3130534449, 0x313058444E49
SLOT = np.dtype(
    [("print", "<u8"), ("shard", "<u4"), ("document", "<u8"), ("start", "<u8"), ("length", "<u8"), ("documents", "<u8")]
)
#: Documents an index file is made for, on average.
BUCKET = 200_000
#: Bytes of ids read at a time.
READ = 8 << 20


def _write(folder: str, name: str, parts: Iterator[bytes]) -> None:
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    own = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    system.move(own, f"{path}/{name}")


def _open(folder: str, name: str):
    system, path = fs.FileSystem.from_uri(folder)
    return system.open_input_file(f"{path}/{name}")


def shard_name(shard: int) -> str:
    return f"ids-{shard:06d}.bin"


def index_name(bucket: int) -> str:
    return f"index-{bucket:06d}.bin"


def key_text(key: Column) -> Column:
    """Keys as text; a null is not the same as any text."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("null"))


def hash_of(text: Column) -> Column:
    return F.xxhash64(text)


def print_of(text: Column) -> Column:
    return F.xxhash64(text, F.lit("print"))


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 2,
    key: str = "doc_id",
    text: str = "text",
    cut: str = WORDS,
    shards: int | None = None,
) -> DataFrame:
    """Write the shards and return one row per document: key, shard, place in it, ids before it there, ids."""
    docs = docs.select(docs[key].alias("doc_id"), F.xxhash64(docs[text]).alias("digest"), docs[text].alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest")]
    placed = docs.repartitionByRange(*([shards] if shards else []), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(tokenizer, cut), TaskContext.get().partitionId()
        wide = 2 if max(encode.library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], ID).tobytes()
        lengths: list[int] = []
        keys: list[pa.Array] = []

        def parts() -> Iterator[bytes]:
            for batch in slices(batches, "text"):
                found = [ids + end for ids in encode.ids(batch.column("text").to_pylist())]
                lengths.extend(len(x) // ID.itemsize for x in found)
                keys.append(batch.column("doc_id"))
                yield np.frombuffer(b"".join(found), ID).astype(f"<u{wide}").tobytes()
            ends = np.cumsum(lengths, dtype=np.int64)
            yield ends.astype("<u8").tobytes()
            total = int(ends[-1]) if len(ends) else 0
            yield np.array([SHARD_MAGIC, wide, len(lengths), total], "<u8").tobytes()

        first = next(batches, None)
        if first is None:
            return
        rest = batches
        batches = _chain(first, rest)
        _write(folder, shard_name(shard), parts())
        ends, at = np.cumsum(lengths, dtype=np.int64), 0
        for column in keys:
            n = len(column)
            some = slice(at, at + n)
            own = np.array(lengths[some], np.int64)
            yield pa.RecordBatch.from_arrays(
                [column, pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(at, at + n)), pa.array(ends[some] - own), pa.array(own)],
                names=["doc_id", "shard", "document", "start", "length"],
            )
            at += n

    kind = docs.schema["doc_id"].dataType.simpleString()
    return placed.mapInArrow(run, f"doc_id {kind}, shard int, document long, start long, length long")


def _chain(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def build_index(entries: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Write the index files; one row per bucket with its number of keys."""
    text = key_text(F.col("doc_id"))
    first = F.struct("shard", "document", "start", "length")
    keys = entries.groupBy(text.alias("text")).agg(F.min(first).alias("f"), F.count(F.lit(1)).alias("documents"))
    keys = keys.select(
        F.pmod(hash_of(F.col("text")), F.lit(buckets)).cast("int").alias("bucket"),
        hash_of(F.col("text")).alias("hash"), print_of(F.col("text")).alias("print"), "text", "f.*", "documents",
    )
    keys = keys.repartition(buckets, "bucket").sortWithinPartitions("bucket")

    def write_bucket(bucket: int, rows: pa.Table) -> pa.RecordBatch:
        hashes = rows["hash"].to_numpy().view(np.uint64)
        _, back, times = np.unique(hashes, return_inverse=True, return_counts=True)
        alone = times[back] == 1
        found = PerfectHash.build(hashes[alone])
        slots = np.zeros(found.count, SLOT)
        at = found.slots(hashes[alone])
        for name in ("shard", "document", "start", "length", "documents"):
            slots[name][at] = rows[name].to_numpy()[alone]
        slots["print"][at] = rows["print"].to_numpy().view(np.uint64)[alone]
        names = ["shard", "document", "start", "length", "documents"]
        clashes = {
            r["text"]: [r[n] for n in names] for r in rows.filter(pa.array(~alone)).to_pylist()
        }
        head = np.array([INDEX_MAGIC, found.count, len(found.sizes), len(found.words)], "<u8")
        parts = [head, found.sizes.astype("<u8"), found.words, slots]
        _write(folder, index_name(bucket), iter([*(p.tobytes() for p in parts), json.dumps(clashes).encode()]))
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([len(rows)])], names=["bucket", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            column = batch.column("bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), len(column)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and column[a] != now:
                    yield write_bucket(now, pa.Table.from_batches(held))
                    held = []
                now = int(column[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield write_bucket(now, pa.Table.from_batches(held))

    return keys.mapInArrow(run, "bucket int, keys long")


class Index:
    """One index file, opened for look-ups."""

    def __init__(self, folder: str, bucket: int):
        try:
            with _open(folder, index_name(bucket)) as f:
                raw = f.read()
        except FileNotFoundError:
            self.count, self.clashes = 0, {}
            return
        magic, self.count, levels, words = np.frombuffer(raw, "<u8", 4).tolist()
        if magic != INDEX_MAGIC:
            raise ValueError(f"{index_name(bucket)} is not an index file")
        at = 32
        sizes = np.frombuffer(raw, "<u8", levels, at).astype(np.int64)
        self.hash = PerfectHash(np.frombuffer(raw, "<u8", words, at + 8 * levels), sizes)
        at += 8 * (levels + words)
        self.slots = np.frombuffer(raw, SLOT, self.count, at)
        self.clashes = json.loads(raw[at + SLOT.itemsize * self.count :])

    def find(self, texts: list[str], hashes: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """The slot of each key; ``documents`` is 0 for keys that are not there."""
        out = np.zeros(len(texts), SLOT)
        if self.count:
            at = self.hash.slots(hashes.view(np.uint64))
            good = at >= 0
            good[good] = self.slots["print"][at[good]] == prints.view(np.uint64)[good]
            out[good] = self.slots[at[good]]
        for k, text in enumerate(texts if self.clashes else ()):
            if text in self.clashes:
                out[k] = (0, *self.clashes[text])
        return out


def find(keys: DataFrame, folder: str, buckets: int, key: str = "doc_id") -> DataFrame:
    """Look distinct keys up in the index: key, shard, document, start, length and documents; absent keys are left out."""
    text = key_text(keys[key])
    asked = keys.select(
        F.pmod(hash_of(text), F.lit(buckets)).cast("int").alias("bucket"), keys[key].alias("doc_id"), text.alias("text"),
        hash_of(text).alias("hash"), print_of(text).alias("print"),
    )
    asked = asked.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    names = ["shard", "document", "start", "length", "documents"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, now = None, None
        for batch in batches:
            column = batch.column("bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), len(column)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if column[a] != now:
                    now = int(column[a])
                    index = Index(folder, now)
                some = batch.slice(a, b - a)
                slots = index.find(some.column("text").to_pylist(), some.column("hash").to_numpy(), some.column("print").to_numpy())
                there = np.flatnonzero(slots["documents"] > 0)
                columns = [pa.array(slots[n][there].astype(np.int64)) for n in names]
                yield pa.RecordBatch.from_arrays([some.column("doc_id").take(pa.array(there)), *columns], names=["doc_id", *names])

    kind = keys.schema[key].dataType.simpleString()
    return asked.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names))


class Shard:
    """One shard, opened for reading ranges."""

    def __init__(self, folder: str, number: int):
        self.file = _open(folder, shard_name(number))
        size = self.file.size()
        magic, self.wide, self.documents, self.total = np.frombuffer(self.file.read_at(32, size - 32), "<u8").tolist()
        if magic != SHARD_MAGIC:
            raise ValueError(f"{shard_name(number)} is not a shard")
        self.ends = np.frombuffer(self.file.read_at(8 * self.documents, self.wide * self.total), "<u8").astype(np.int64)
        self.held, self.held_at = b"", 0

    def ids(self, start: int, length: int) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; reads ahead for neighbours."""
        a, n = start * self.wide, length * self.wide
        if not (self.held_at <= a and a + n <= self.held_at + len(self.held)):
            self.held, self.held_at = self.file.read_at(min(max(n, READ), self.wide * self.total - a), a), a
        part = self.held[a - self.held_at : a - self.held_at + n]
        return np.frombuffer(part, f"<u{self.wide}").astype(ID).tobytes()


def read(places: DataFrame, folder: str) -> DataFrame:
    """The documents at ``places`` (as ``find`` gives them): key, shard, start there, length and ids."""
    kind = places.schema["doc_id"].dataType.simpleString()
    placed = places.repartition("shard").sortWithinPartitions("shard", "start")

    def rows(batch: pa.RecordBatch, shards: dict) -> Iterator[tuple]:
        for at, (shard, document, documents) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("shard", "document", "documents")))):
            while documents:
                if shard not in shards:
                    shards.clear()
                    shards[shard] = Shard(folder, shard)
                own = shards[shard]
                for k in range(document, min(document + documents, own.documents)):
                    start = int(own.ends[k - 1]) if k else 0
                    yield at, shard, start, int(own.ends[k]) - start, own.ids(start, int(own.ends[k]) - start)
                # What is left of a repeated key opens the shards that follow.
                documents -= min(documents, own.documents - document)
                shard, document = shard + 1, 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[int, Shard] = {}

        def batch_of(batch: pa.RecordBatch, held: list[tuple]) -> pa.RecordBatch:
            at, shard, start, length, ids = zip(*held)
            columns = [pa.array(x, pa.int64()) for x in (shard, start, length)]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at)), *columns, pa.array(ids, pa.binary())],
                names=["doc_id", "shard", "start", "length", "ids"],
            )

        for batch in batches:
            held, size = [], 0
            for row in rows(batch, shards):
                held.append(row)
                size += len(row[-1])
                if size >= READ:
                    yield batch_of(batch, held)
                    held, size = [], 0
            if held:
                yield batch_of(batch, held)

    return placed.mapInArrow(run, f"doc_id {kind}, shard long, start long, length long, ids binary")


def shard_starts(entries: DataFrame) -> DataFrame:
    """Per shard the ids in all shards before it; there is one row per shard only."""
    totals = entries.groupBy("shard").agg(F.sum("length").alias("total"))
    before = F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select(F.col("shard").cast("long").alias("shard"), F.coalesce(before, F.lit(0)).alias("before"))


def round_trip(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents, index them, and read every one back by its key.

    Columns ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``.
    """
    entries = stored(write(docs, folder, tokenizer, end_id, key, text), "entries")
    buckets = max(1, -(-entries.count() // BUCKET))
    build_index(entries, folder, buckets).write.format("noop").mode("overwrite").save()
    asked = docs.select(docs[key].alias("doc_id")).distinct()
    found = read(find(asked, folder, buckets), folder)
    out = found.join(F.broadcast(shard_starts(entries)), "shard")  # one row per shard
    return out.select("doc_id", (F.col("before") + F.col("start")).alias("start"), F.col("length").alias("n_tokens"), "ids")
