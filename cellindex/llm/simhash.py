"""SimHash near-duplicates: 64-bit fingerprints of word shingles, compared in bit slices.

Candidates come from blocks: a fingerprint is cut into ``radius + agree`` runs
of bits, and two of at most ``radius`` differing bits agree in at least
``agree`` whole runs. Every fingerprint goes, once for each choice of runs, to
the bucket of its bits there, so no pair within the radius is missed. Buckets
too large for one task become tiles whose pairs are compared apart. In a bucket
vertical bit planes give all distances at once (see ``bitslice``); of the links
found only a spanning forest leaves the task, never all pairs of a group. Equal
fingerprints are one node.

With ``similar`` set, a link is that share of common five-word shingles instead.
Fingerprints (``prints`` of them, so that a pair beyond the radius in one may be
within it in another) and sketches of all shingles (one-permutation minimum
hashes, taken ``margin`` below ``similar``) then only name clusters of candidates.
Inside a cluster the whole sets of shingles decide, for all of its pairs, and groups
come from the links that hold. Texts of equal sets are one node.

Null and empty texts have no words and the fingerprint 0, which is linked like
any other. Null ids are kept; a group of null ids alone has a null component.
Repeated rows are members of the same group. Empty tables give empty results.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellindex.llm import bitslice
from cellindex.llm.components import components
from cellindex.llm.shared import columns_of, free_prefix, slices, stored

SEED = 42
SKETCH = 128
_HASHES_AT_ONCE = 1 << 15


@dataclass(frozen=True)
class Rule:
    """When two fingerprints link; ``agree`` more runs make smaller buckets in more copies."""

    shingle: int = 4
    radius: int = 4
    agree: int = 2
    similar: float | None = None
    sketch_shingle: int = 5
    tile: int = 4096
    prints: int = 1
    margin: float = 0.12
    #: Bytes of shingle sets that are compared in one piece; larger clusters are cut into tiles that meet in pairs.
    tile_bytes: int = 8 << 20

    def masks(self) -> list[int]:
        """The bits of every choice of ``agree`` runs."""
        runs = self.radius + self.agree
        edges = [64 * k // runs for k in range(runs + 1)]
        run = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
        return [sum(c) for c in combinations(run, self.agree)]


def shingle_hashes(joined: bytes, starts: list[int], ends: list[int], size: int) -> Iterator[np.ndarray]:
    """XXH64 of each run of ``size`` words (of all words if there are fewer), in parts."""
    from xxhash import xxh64_intdigest

    last = max(1, len(starts) - size + 1)
    stops = ends[size - 1 :] or ends[-1:]
    for i in range(0, last, _HASHES_AT_ONCE):
        spans = zip(starts[i : min(i + _HASHES_AT_ONCE, last)], stops[i:])
        yield np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """A further hash of every hash; the 0th is the hash itself."""
    if not k:
        return hashes
    hashes = (hashes + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(32))


def place_words(text: str | None) -> tuple[bytes, list[int], list[int]]:
    """The joined words with their starts and ends."""
    words = (text or "").encode().lower().split()
    if not words:
        return b"", [], []
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    return b" ".join(words), [0, *(ends[:-1] + 1).tolist()], ends.tolist()


def fingerprint(placed: tuple[bytes, list[int], list[int]], shingle: int, prints: int = 1) -> list[int]:
    """Signed 64-bit fingerprints; zero without words."""
    if not placed[1]:
        return [0] * prints
    ones, count = np.zeros((prints, 64), np.int64), 0
    for hashes in shingle_hashes(*placed, shingle):
        for k in range(prints):
            bits = np.unpackbits(_mixed(hashes, k).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones[k] += bits.sum(axis=0, dtype=np.int64)
        count += len(hashes)
    bits = np.packbits(2 * ones > count, axis=1, bitorder="little")
    return bits.view("<i8")[:, 0].tolist()


def shingle_set(placed: tuple[bytes, list[int], list[int]], size: int) -> np.ndarray:
    """Hashes of all different shingles, in order; none for a text without words."""
    parts = list(shingle_hashes(*placed, size)) if placed[1] else []
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, "<u8")


def sketch(hashes: np.ndarray) -> bytes:
    """Smallest hash in each of 128 classes of shingles as one byte; 0 marks an empty class."""
    least = np.full(SKETCH, bitslice.ONES)
    np.minimum.at(least, (hashes >> np.uint64(57)).astype(np.int64), hashes)
    byte = (least & np.uint64(0xFFFF)) % np.uint64(255) + np.uint64(1)
    return np.where(least == bitslice.ONES, 0, byte).astype(np.uint8).tobytes()


def fingerprints(docs: DataFrame, rule: Rule = Rule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns ``doc_id``, ``digest`` of the text, ``fp`` and, with ``similar``, ``fps``, ``node`` (the set's name), ``sketch``."""
    docs = docs.select(docs[key].alias("doc_id"), F.xxhash64(docs[text]).alias("digest"), docs[text].alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    sketched = rule.similar is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_hexdigest

        for batch in slices(batches, "text", 8 << 20):
            prints, names, sketches = [], [], []
            for value in batch.column("text").to_pylist():
                placed = place_words(value)
                prints.append(fingerprint(placed, rule.shingle, rule.prints))
                if sketched:
                    hashes = shingle_set(placed, rule.sketch_shingle)
                    names.append(xxh3_128_hexdigest(hashes.tobytes()))
                    sketches.append(sketch(hashes))
            columns = {c: batch.column(c) for c in ("doc_id", "digest")}
            columns["fp"] = pa.array([f[0] for f in prints], pa.int64())
            if sketched:
                columns["fps"] = pa.array(prints, pa.list_(pa.int64()))
                columns["node"], columns["sketch"] = pa.array(names, pa.string()), pa.array(sketches, pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = f"doc_id {kind}, digest long, fp long" + ", fps array<long>, node string, sketch binary" * sketched
    return docs.mapInArrow(run, schema)


def _buckets(nodes: DataFrame, rule: Rule) -> DataFrame:
    """Each node once for every choice of runs and every tile of its bucket it must meet."""
    choices = [F.struct(F.lit(k).alias("t"), F.lit(m - (1 << 64) * (m >> 63)).alias("m")) for k, m in enumerate(rule.masks())]
    spread = nodes.select("*", F.explode(F.array(*choices)).alias("c"))
    spread = spread.select(*nodes.columns, F.col("c.t").alias("t"), F.col("fp").bitwiseAND(F.col("c.m")).alias("bits"))
    # Bucket sizes from one node in 64 (by hash) decide only how work is laid out, not what is compared.
    one_in = 64
    sizes = (
        spread.filter(F.pmod(F.xxhash64("node"), F.lit(one_in)) == 0)
        .groupBy("t", "bits")
        .count()
        .filter(F.col("count") * one_in > rule.tile)
        .select("t", "bits", F.ceil(F.col("count") * one_in / rule.tile).cast("int").alias("tiles"))
    )
    # Stored, so that Spark plans the join by its measured size; while small, the copies are shuffled once.
    sizes = stored(sizes, "sizes")
    tiles = F.coalesce("tiles", F.lit(1))
    own = F.pmod(F.xxhash64("node", F.lit(1)), tiles).cast("int")
    met = F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other")
    spread = spread.join(sizes, ["t", "bits"], "left").withColumn("own", own).select("*", met)
    return spread.select(
        *nodes.columns, "t", "bits", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )


class _Forest:
    """Spanning forests of the links found, kept apart by group."""

    def __init__(self, size: int, rule: Rule, sketches: np.ndarray | None):
        self.label, self.rule, self.sketches = np.arange(size), rule, sketches
        self.a: list[int] = []
        self.b: list[int] = []

    def add(self, k: int, hits: np.ndarray, group: slice) -> None:
        """Links from row ``k`` to ``hits``, all rows of one group."""
        label = self.label
        hits = hits[label[hits] != label[k]]
        if self.sketches is not None and len(hits):
            hits = hits[_alike(self.sketches[k], self.sketches[hits]) >= self.rule.similar]
        while len(hits):
            j = int(hits[0])
            self.a.append(k), self.b.append(j)
            own = label[group]
            own[own == label[j]] = label[k]
            hits = hits[label[hits] != label[k]]


def _compare_groups(fp: np.ndarray, bounds: list[tuple[int, int, int]], same: int, forest: _Forest) -> None:
    """Link the rows of groups (first, middle, end) of one choice of runs.

    Rows from first to middle are queries; they meet those from middle to end or,
    if that is empty, the later ones among themselves. Groups of about the same size go
    through the bit planes together.
    """
    by_words: dict[int, list[tuple[int, int, int]]] = {}
    for first, middle, end in bounds:
        lanes = end - middle or middle - first
        by_words.setdefault(1 << (-(-lanes // 64) - 1).bit_length(), []).append((first, middle, end))
    for words, some in by_words.items():
        step = max(1, 65536 // (words * 64))
        for i in range(0, len(some), step):
            part = some[i : i + step]
            meet = [(m, e) if e > m else (f, m) for f, m, e in part]
            padded = np.zeros((len(part), words * 64), np.uint64)
            for g, (s, e) in enumerate(meet):
                padded[g, : e - s] = fp[s:e]
            queries = np.concatenate([np.arange(f, m) for f, m, _ in part])
            owner = np.repeat(np.arange(len(part)), [m - f for f, m, _ in part])
            after = np.concatenate([np.arange(m - f) if e == m else np.full(m - f, -1) for f, m, e in part])
            counts = np.array([e - s for s, e in meet])
            planes = bitslice.planes_of(padded)
            for found, rows in bitslice.within(fp[queries], owner, after, planes, counts, forest.rule.radius, same):
                for k, row in zip(found.tolist(), rows):
                    g = owner[k]
                    first, _, end = part[g]
                    forest.add(int(queries[k]), meet[g][0] + bitslice.lanes(row), slice(first, end))


def _alike(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Share of common shingles, estimated; two sketches without shingles are alike."""
    either = ((many > 0) | (one > 0)).sum(axis=1)
    both = ((many == one) & (one > 0)).sum(axis=1)
    return np.where(either == 0, 1.0, both / np.maximum(either, 1))


def _small(fp: np.ndarray, group: np.ndarray, rule: Rule, sketches) -> tuple[np.ndarray, np.ndarray]:
    """Links in groups of a few rows, by comparing each row with those that follow it."""
    a, b, step = [], [], 1
    while step < len(fp):
        near = np.flatnonzero(group[step:] == group[:-step])
        if not len(near):
            break
        near = near[np.bitwise_count(fp[near] ^ fp[near + step]) <= rule.radius]
        if sketches is not None and len(near):
            ones, others = sketches[near], sketches[near + step]
            either = ((ones > 0) | (others > 0)).sum(axis=1)
            both = ((ones == others) & (ones > 0)).sum(axis=1)
            near = near[np.where(either == 0, 1.0, both / np.maximum(either, 1)) >= rule.similar]
        a.append(near), b.append(near + step)
        step += 1
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64),) * 2


def _whole_groups(batches: Iterator[pa.RecordBatch], order: list[str]) -> Iterator[pa.Table]:
    """Sorted rows again, in tables of whole groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in order]
        new = np.zeros(batch.num_rows, bool)
        for column in keys:
            new[1:] |= column[1:] != column[:-1]
        cuts = np.flatnonzero(new)
        if held and any(held[-1].column(c)[-1].as_py() != k[0] for c, k in zip(order, keys)):
            yield pa.Table.from_batches(held)
            held = []
        if len(cuts):
            last = int(cuts[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


_FEW = 8


def links(nodes: DataFrame, rule: Rule) -> DataFrame:
    """Edges ``a``, ``b`` between nodes: in each bucket a spanning forest of its links.

    ``nodes`` has unique ``node``, ``fp`` and, with ``similar``, ``sketch``.
    """
    masks, sketched = rule.masks(), "sketch" in nodes.columns
    order = ["t", "bits", "low", "high"]
    placed = _buckets(nodes, rule).repartition(*order).sortWithinPartitions(*order, F.col("own") != F.col("low"))
    kind = nodes.schema["node"].dataType.simpleString()

    def compare(rows: pa.Table) -> pa.RecordBatch:
        keys = np.stack([rows.column(c).to_numpy() for c in order])
        fp = rows.column("fp").to_numpy().view(np.uint64)
        side = (rows.column("own").to_numpy() != keys[2]).astype(np.int8)
        raw = None
        if sketched:
            raw = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
        new = np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
        starts = np.append(np.flatnonzero(new), len(fp))
        size = np.diff(starts)
        tiled = keys[2] != keys[3]
        group, few = np.cumsum(new) - 1, np.repeat(size <= _FEW, size)
        pick = np.flatnonzero(few & ~tiled & np.repeat(size > 1, size))
        a, b = _small(fp[pick], group[pick], rule, raw[pick] if sketched else None)
        a, b = pick[a].tolist(), pick[b].tolist()
        forest = _Forest(len(fp), rule, raw)
        for t in np.unique(keys[0]).tolist():
            bounds = []
            for k in np.flatnonzero((keys[0, starts[:-1]] == t) & ((size > _FEW) | tiled[starts[:-1]])).tolist():
                s, e = int(starts[k]), int(starts[k + 1])
                middle = e - int(side[s:e].sum())
                # Of two tiles, one may have no rows here: the other meets itself elsewhere.
                if not tiled[s] or s < middle < e:
                    bounds.append((s, middle, e))
            _compare_groups(fp, bounds, masks[t], forest)
        a, b = a + forest.a, b + forest.b
        node = rows.column("node").combine_chunks()
        return pa.RecordBatch.from_arrays([node.take(pa.array(i, pa.int64())) for i in (a, b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches, order):
            yield compare(rows)

    return placed.mapInArrow(run, f"a {kind}, b {kind}")


def _linked_only(nodes: DataFrame, rule: Rule) -> DataFrame:
    """The nodes that have any other within the radius, before sketches are compared."""
    plain = Rule(rule.shingle, rule.radius, rule.agree, tile=rule.tile)
    prints = nodes.select(F.col("fp").alias("node"), "fp").distinct()
    near = links(prints, plain)
    # One fingerprint under several sketches needs no other to have a candidate.
    shared = nodes.groupBy("fp").count().filter("count > 1").select("fp")
    near = near.select(F.explode(F.array("a", "b")).alias("fp")).union(shared).distinct()
    return nodes.join(near, "fp", "left_semi").select("node", "fp", "sketch")


def _candidates(nodes: DataFrame, rule: Rule) -> DataFrame:
    """Clusters of nodes that may be similar: ``node`` and ``root``, for nodes of clusters of two and more."""
    loose, found = replace(rule, similar=rule.similar - rule.margin), None
    for k in range(rule.prints):
        own = nodes.select("node", F.col("fps")[k].alias("fp"), "sketch")
        edges = links(stored(_linked_only(own, loose), "candidates"), loose)
        found = edges if found is None else found.unionByName(edges)
    near = components(found)
    return near.unionByName(near.select(F.col("root").alias("node"), "root").distinct())


def similar_pairs(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets with a share of ``least`` or more in common; empty sets are alike.

    A set that was reached is compared once, with those that were not yet, so large groups of alike sets cost
    little more than their size.
    """
    sizes = np.array([len(s) for s in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.append(0, np.cumsum(sizes))
    mark = np.zeros(int(codes.max(initial=-1)) + 1, bool)
    rest, waiting, pairs = np.arange(len(sets)), [], []
    left, owner = codes, np.repeat(np.arange(len(sets)), sizes)
    while len(rest):
        if not waiting:
            waiting.append(int(rest[0]))
            rest, left, owner = rest[1:], left[owner != rest[0]], owner[owner != rest[0]]
        k = waiting.pop()
        own = codes[starts[k] : starts[k + 1]]
        mark[own] = True
        common = np.bincount(owner[mark[left]], minlength=len(sets))[rest]
        mark[own] = False
        either = sizes[k] + sizes[rest] - common
        hits = np.where(either == 0, 1.0, common / np.maximum(either, 1)) >= least
        if hits.any():
            found = rest[hits].tolist()
            pairs += [(k, j) for j in found]
            waiting += found
            reached = np.zeros(len(sets), bool)
            reached[found] = True
            stay = ~reached[owner]
            rest, left, owner = rest[~hits], left[stay], owner[stay]
    return pairs


def _similar_links(docs: DataFrame, prints: DataFrame, clusters: DataFrame, rule: Rule, key: str, text: str) -> DataFrame:
    """Edges ``a``, ``b``: in every cluster a spanning forest of its similar pairs, by whole sets of shingles."""
    # One text stands for each node. It is chosen before the join, as very many documents may share a node, and stored,
    # so that texts are shuffled only if there are too many of these rows to broadcast.
    one = prints.groupBy("node").agg(F.min(F.struct("doc_id", "digest")).alias("d")).join(clusters, "node")
    one = stored(one.select("node", "root", F.col("d.doc_id").alias("doc_id"), F.col("d.digest").alias("digest")), "spoken")
    spoken = docs.select(docs[key].alias("id"), F.xxhash64(docs[text]).alias("mark"), docs[text].alias("text"))
    spoken = spoken.join(one, spoken["id"].eqNullSafe(one["doc_id"]) & (spoken["mark"] == one["digest"]))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            texts = batch.column("text").to_pylist()
            sets = [shingle_set(place_words(t), rule.sketch_shingle).tobytes() for t in texts]
            columns = [batch.column("root"), batch.column("node"), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["root", "node", "hashes"])

    sets = spoken.select("root", "node", "text").mapInArrow(gather, "root string, node string, hashes binary")
    # Rows that repeat a document bring its set again.
    sets = stored(sets.dropDuplicates(["node"]), "sets")
    large = sets.groupBy("root").agg(F.ceil(F.sum(F.octet_length("hashes")) / rule.tile_bytes).cast("int").alias("tiles"))
    large = stored(large.filter("tiles > 1"), "large")
    tiles = F.coalesce("tiles", F.lit(1))
    own = F.pmod(F.xxhash64("node"), tiles).cast("int")
    dealt = sets.join(large, "root", "left").withColumn("own", own)
    dealt = dealt.select("root", "node", "hashes", "own", F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"))
    order = ["root", "low", "high"]
    dealt = dealt.select("root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "hashes")
    dealt = dealt.repartition(*order).sortWithinPartitions(*order)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches, order):
            keys = [rows.column(c).to_numpy() for c in order]
            new = np.zeros(rows.num_rows, bool)
            for column in keys:
                new[1:] |= column[1:] != column[:-1]
            cuts = [0, *np.flatnonzero(new).tolist(), rows.num_rows]
            node, hashes = (rows.column(c).to_pylist() for c in ("node", "hashes"))
            a, b = [], []
            for s, e in zip(cuts, cuts[1:]):
                for i, j in similar_pairs([np.frombuffer(h, "<u8") for h in hashes[s:e]], rule.similar):
                    a.append(node[s + i]), b.append(node[s + j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])

    return dealt.mapInArrow(compare, "a string, b string")


def groups(docs: DataFrame, rule: Rule = Rule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``digest``, ``fp``, ``component_id`` (its group's smallest id).

    A node is a fingerprint, with ``similar`` a set of shingles.
    """
    prints = fingerprints(docs, rule, key, text)
    if rule.similar is None:
        prints = stored(prints.withColumn("node", F.col("fp")), "fingerprints")
        found = links(prints.select("node", "fp").distinct(), rule)
    else:
        prints = stored(prints, "fingerprints")
        nodes = stored(prints.groupBy("node").agg(F.min("fps").alias("fps"), F.min("sketch").alias("sketch")), "nodes")
        clusters = stored(_candidates(nodes, rule), "clusters")
        found = _similar_links(docs, prints, clusters, rule, key, text)
    roots = components(found)
    classes = prints.groupBy("node").agg(F.min("doc_id").alias("least")).join(roots, "node", "left")
    classes = stored(classes.select("node", "least", F.coalesce("root", "node").alias("root")), "classes")
    # Stored, so that no sum by root stands between the shuffle and the join: Spark can then split a large group.
    ids = stored(classes.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    classes = classes.join(ids, "root").select("node", "component_id")
    return prints.join(classes, "node").select("doc_id", "digest", "fp", "component_id")


def keep_first(docs: DataFrame, rule: Rule = Rule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group: that of the smallest id (nulls last), all its columns unchanged.

    Ties (one id with several texts or rows in a group) go to the smallest text digest, then to any of equal rows.
    """
    members = groups(docs, rule, key, text)
    return _keep(docs, stored(members, "members"), key, text)


def _keep(docs: DataFrame, members: DataFrame, key: str, text: str) -> DataFrame:
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    # A group of null ids has no component id: its fingerprint stands in.
    group = [F.col("component_id").isNull().alias("none"), "component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("alone")]
    best = members.groupBy(*group).agg(F.min(order).alias("best")).select("best.doc_id", "best.digest").distinct()
    rows = members.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    same = (F.col("k.doc_id").eqNullSafe(F.col("r.doc_id"))) & (F.col("k.digest") == F.col("r.digest"))
    own = free_prefix(docs)
    kept = best.alias("k").join(rows.alias("r"), same).select(
        F.col("k.doc_id").alias(own + "id"), F.col("k.digest").alias(own + "digest"), F.col("r.n").alias(own + "rows")
    )
    columns = columns_of(docs)
    match = docs[key].eqNullSafe(F.col(own + "id")) & (F.xxhash64(docs[text]) == F.col(own + "digest"))
    found = docs.join(kept, match)
    once = found.filter(F.col(own + "rows") == 1).select(*columns)
    several = found.filter(F.col(own + "rows") > 1).dropDuplicates([own + "id", own + "digest"]).select(*columns)
    return once.unionByName(several)
