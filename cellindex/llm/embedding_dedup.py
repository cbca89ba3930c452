"""Near-duplicate vectors by NN-descent on cosine, within equal labels.

Equal vectors of one label are one node. The neighbour graph starts from random
hyperplanes: nodes whose signs agree meet in one chunk, several times over, and
keep their nearest as a list. Then lists are refined through neighbours of
neighbours: two nodes on the list of a third (in either direction) are compared
if one of those entries is new. A list whose entries all reach the threshold is
saturated and gets twice the room.

The number of sets grows with the hyperplanes that a label needs, so that a pair at
the threshold meets in one of them with ``meet``; chunks too large for one task become
tiles that all meet. An audit compares samples of nodes with all rows of their
labels, by number of hyperplanes and size of component, and judges the mean over
nodes of the share of their links that the graph connects, once for all nodes with links and once
for those with few. Labels with the numbers of hyperplanes where it is too small get more sets, and
in the end a comparison of all their pairs.

Lists only steer the search. Links are kept apart from them: of every chunk a spanning
forest of all its pairs that reach the threshold, and every such pair that a
refinement compares. They make the graph's components. The number of
links of a node is then counted exactly among the nodes of its component (all
its links lie there), in pairs of tiles that return counts, not pairs.

Vectors that are null, empty or zero or hold null or non-finite components, and
rows with a null label, link with nothing and are kept. Every row counts as a
vector, also one that repeats an id. A component whose ids are all null has a
null component. Vectors of different lengths do not link. Empty tables give
empty results. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellindex.llm.components import components
from cellindex.llm.shared import stored
from cellindex.llm.vectors import lists, matrix, usable


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.93
    #: Room of a list at first.
    room: int = 6
    #: Sets of hyperplanes at least. After ``most_planes // planes`` turns all pairs are compared where recall is missed.
    planes: int = 3
    most_planes: int = 12
    #: Chance that a pair at the threshold meets in one of the sets of a turn.
    meet: float = 0.99
    rounds: int = 4
    #: Nodes that meet in a chunk, about, and at most.
    chunk: int = 1024
    #: Entries below this are not worth a look at their neighbours.
    explore: float = 0.6
    #: Nodes of one component compared with each other in one task.
    tile: int = 512
    #: Sampled nodes of a stratum at first; more are taken until ``audit_few`` nodes with at most ``few`` links are seen.
    audit_nodes: int = 256
    audit_few: int = 50
    few: int = 4
    recall: float = 0.98
    seed: int = 5

    def sets(self, bits: int) -> int:
        """Sets of ``bits`` hyperplanes in which a pair at the threshold meets with ``meet``."""
        if not bits:
            return 1
        once = (1 - math.acos(max(-1.0, min(1.0, self.threshold))) / math.pi) ** bits
        return self.planes if once >= self.meet else max(self.planes, math.ceil(math.log(1 - self.meet) / math.log1p(-once)))


def nodes_of(vectors: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """All rows with their node (null if they take no part): ``vec_id``, ``node``, ``kind`` (label and length) and unit vector ``v``."""
    rows = vectors.select(vectors[key].alias("vec_id"), vectors[label].alias("label"), vectors[vector].alias("raw"))
    good = usable(F.col("raw")) & F.col("label").isNotNull()
    double = F.col("raw").cast("array<double>")
    rows = rows.select(
        "vec_id",
        F.when(good, F.xxhash64("label", double)).alias("node"),
        F.when(good, F.concat_ws(":", F.col("label").cast("string"), F.size("raw").cast("string"))).alias("kind"),
        F.when(good, double).alias("v"),
    )

    def unit(batches):
        for batch in batches:
            column = batch.column("v")
            out: list = [None] * len(column)
            for k, v in enumerate(column.to_pylist()):
                if v is not None:
                    a = np.array(v)
                    a = a / np.abs(a).max()  # else squares of very large or small numbers leave the range
                    out[k] = a / np.sqrt((a * a).sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(out, pa.list_(pa.float64()))], names=["vec_id", "node", "kind", "v"]
            )

    id_type = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(unit, f"vec_id {id_type}, node long, kind string, v array<double>")


def _top(sims: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``room`` largest entries of each row."""
    room = min(room, sims.shape[1])
    take = np.argpartition(-sims, room - 1, axis=1)[:, :room]
    return np.repeat(np.arange(len(sims)), room), take.ravel()


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray, near: np.ndarray, out: list[tuple[int, int]]) -> None:
    """Add to a spanning forest what joins rows ``a`` with columns ``b`` of ``near``; ``label`` numbers the trees."""
    for x in np.flatnonzero(near.any(axis=1)).tolist():
        k = int(a[x])
        hits = b[near[x]]
        hits = hits[label[hits] != label[k]]
        while len(hits):
            out.append((k, int(hits[0])))
            label[label == label[hits[0]]] = label[k]
            hits = hits[label[hits] != label[k]]


def _sized(nodes: DataFrame, settings: Settings) -> DataFrame:
    """Nodes with ``bits``, the hyperplanes that part their kind into chunks."""
    sizes = nodes.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / settings.chunk))).cast("int")
    return nodes.join(sizes.select("kind", bits.alias("bits")), "kind").select("node", "kind", "v", "bits")


def _met(sized: DataFrame, turn: int, settings: Settings) -> DataFrame:
    """What chunks of agreeing hyperplane signs give: list entries (u, v, sim) and, with ``link``, a forest of all links."""

    def sign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            # Lengths may differ between kinds, not within.
            width = np.array([len(x) for x in batch.column("v")])
            depths = batch.column("bits").to_numpy()
            for dim, most in sorted(set(zip(width.tolist(), depths.tolist()))):
                some = batch.take(pa.array(np.flatnonzero((width == dim) & (depths == most))))
                v, columns = matrix(some.column("v")), [some.column(c) for c in ("node", "kind", "v")]
                number = settings.sets(most)
                for s in range(turn * number, (turn + 1) * number):
                    plane = np.random.default_rng((settings.seed, dim, s)).standard_normal((most, dim))
                    code = (v @ plane.T > 0) @ (1 << np.arange(most, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(np.full(len(v), s)), pa.array(code.astype(np.int64))], names=["node", "kind", "v", "s", "code"]
                    )

    placed = stored(sized.mapInArrow(sign, "node long, kind string, v array<double>, s long, code long"), "signs")
    # Dense directions leave large chunks: their tiles meet in pairs.
    large = placed.groupBy("kind", "s", "code").agg(F.ceil(F.count(F.lit(1)) / (2 * settings.chunk)).cast("int").alias("tiles"))
    placed = placed.join(large, ["kind", "s", "code"]).withColumn("own", F.pmod(F.xxhash64("node", "s"), "tiles").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    key = ["kind", "s", "code", "i", "j"]
    placed = placed.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).select(*key, "own", "node", "v")

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        i, j = key[3].as_py(), key[4].as_py()
        v, node, own = matrix(rows["v"]), rows["node"].to_numpy(), rows["own"].to_numpy()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        a, b, sim = [], [], []
        label, forest = np.arange(len(v)), []
        for one, other in [(left, right)] if i == j else [(left, right), (right, left)]:
            for k in range(0, len(one) if len(other) else 0, 512):
                part = one[k : k + 512]
                sims = v[part] @ v[other].T
                if i == j:
                    sims[np.arange(len(part)), np.arange(k, k + len(part))] = -2
                r, c = _top(sims, settings.room)
                keep = sims[r, c] > -2
                a.append(node[part[r[keep]]]), b.append(node[other[c[keep]]]), sim.append(sims[r, c][keep])
                if one is left:
                    _join(label, part, other, sims >= settings.threshold, forest)
        ends = np.array(forest, np.int64).reshape(-1, 2)
        link = np.repeat([False, True], [sum(map(len, a)), len(ends)])
        a.append(node[ends[:, 0]]), b.append(node[ends[:, 1]]), sim.append(np.full(len(ends), settings.threshold))
        return pa.table({"u": np.concatenate(a), "v": np.concatenate(b), "sim": np.concatenate(sim), "link": link})

    return placed.groupBy(*key).applyInArrow(meet, "u long, v long, sim double, link boolean")


def _listed(entries: DataFrame, rooms: DataFrame | None, settings: Settings) -> DataFrame:
    """The best entries of each node, as many as it has room for; ``fresh`` entries have not been explored."""
    best = entries.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    if rooms is None:
        best = best.withColumn("room", F.lit(settings.room))
    else:
        best = best.join(rooms, "u", "left").withColumn("room", F.coalesce("room", F.lit(settings.room)))
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    return best.withColumn("rank", F.row_number().over(order)).filter("rank <= room").drop("rank")


def _refine(lists_: DataFrame, nodes: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame, int]:
    """One round: compare neighbours of neighbours, and give saturated lists twice the room.

    Returns the lists, the links found (whether lists have room for them or not) and the number of fresh entries.
    """
    near = lists_.filter(F.col("sim") >= settings.explore)
    # Who lists a node is ranked as well, and cut to the node's room; the audit judges what that costs.
    back = near.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim", "fresh", "room")
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    back = back.withColumn("rank", F.row_number().over(order)).filter("rank <= room").drop("rank")
    both = near.unionByName(back).groupBy("u", "v").agg(F.max("fresh").alias("fresh"))
    one = both.select("u", F.col("v").alias("a"), F.col("fresh").alias("fresh_a"))
    other = both.select("u", F.col("v").alias("b"), F.col("fresh").alias("fresh_b"))
    pairs = one.join(other, "u").filter("a < b AND (fresh_a = 1 OR fresh_b = 1)").select("a", "b").distinct()
    known = lists_.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    pairs = pairs.join(known, ["a", "b"], "left_anti")
    vector = nodes.select("node", "kind", "v")
    first = vector.select(F.col("node").alias("a"), F.col("kind").alias("kind_a"), F.col("v").alias("x"))
    second = vector.select(F.col("node").alias("b"), F.col("kind").alias("kind_b"), F.col("v").alias("y"))
    pairs = pairs.join(first, "a").join(second, "b").filter("kind_a = kind_b")

    def compare(batches):
        for batch in batches:
            if batch.num_rows:
                width = np.array([len(x) for x in batch.column("x")])
                for dim in np.unique(width).tolist():
                    some = batch.take(pa.array(np.flatnonzero(width == dim)))
                    sim = (matrix(some.column("x")) * matrix(some.column("y"))).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([some.column("a"), some.column("b"), pa.array(sim)], names=["a", "b", "sim"])

    found = pairs.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long, sim double")
    found = stored(found.filter(F.col("sim") >= min(settings.explore, settings.threshold)), "compared")
    linked = found.filter(F.col("sim") >= settings.threshold).select("a", "b")
    ends = F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))
    new = found.select(ends.alias("e"), "sim").select("e.u", "e.v", "sim", F.lit(1).alias("fresh"))
    full = lists_.groupBy("u").agg(
        F.max("room").alias("room"), F.sum((F.col("sim") >= settings.threshold).cast("int")).alias("close")
    )
    rooms = full.select("u", F.when(F.col("close") >= F.col("room"), F.col("room") * 2).otherwise(F.col("room")).alias("room"))
    old = lists_.select("u", "v", "sim", F.lit(0).alias("fresh"))
    refined = stored(_listed(old.unionByName(new), rooms, settings), "lists")
    return refined, linked, refined.filter("fresh = 1").count()


def _audit(sized: DataFrame, roots: DataFrame, settings: Settings) -> list[int]:
    """Those ``bits`` at which too many links of a node are not connected, by samples that are compared with all rows."""
    # Kinds without hyperplanes met as wholes.
    sized = sized.filter("bits > 0")
    placed = sized.select("node", "bits").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = placed.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    # Alone, few, many.
    part = F.when(F.col("size") == 1, 0).when(F.col("size") <= settings.few + 1, 1).otherwise(2)
    placed = stored(placed.join(sizes, "root").select("node", "bits", "root", part.alias("part")), "strata")
    totals = {(r["bits"], r["part"]): r["count"] for r in placed.groupBy("bits", "part").count().collect()}
    if not totals:
        return []
    drawn = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 30))
    levels = {bits for bits, _ in totals}
    number = settings.audit_nodes
    while True:
        chance = F.lit(0)
        for (bits, k), n in totals.items():
            share = math.ceil(min(1.0, number / n) * (1 << 30))
            chance = F.when((F.col("bits") == bits) & (F.col("part") == k), share).otherwise(chance)
        chosen = placed.filter(drawn < chance)
        # About number vectors of each stratum reach the driver.
        sample = sized.select("node", "kind", "v").join(chosen, "node").toArrow()
        seen = _shares(sized, placed, sample, settings)
        share, linked = seen["same"] / np.maximum(seen["n"], 1), seen["n"] > 0
        bits, parts = sample["bits"].to_numpy(), sample["part"].to_numpy()
        weight = np.zeros(len(bits))
        for (level, k), n in totals.items():
            own = (bits == level) & (parts == k)
            weight[own] = n / max(1, own.sum())
        scarce = seen["n"] <= settings.few
        whole = number >= max(totals.values()) or number >= 16 * settings.audit_nodes
        if whole or all(((bits == x) & linked & scarce).sum() >= settings.audit_few for x in levels):
            break
        number *= 4
    missed = []
    for level in sorted(levels):
        for some in (linked, linked & scarce):
            own = some & (bits == level)
            if own.any() and (weight * share)[own].sum() < settings.recall * weight[own].sum():
                missed.append(level)
                break
    return missed


def _shares(sized: DataFrame, placed: DataFrame, sample: pa.Table, settings: Settings) -> dict[str, np.ndarray]:
    """Per sampled node its links with all rows, and how many of them its component holds."""
    node, root, kind = sample["node"].to_numpy(), sample["root"].to_numpy(), np.array(sample["kind"].to_pylist(), object)
    asked = {}
    for k in set(kind.tolist()):
        at = np.flatnonzero(kind == k)
        asked[k] = (at, node[at], root[at], matrix(sample["v"].take(pa.array(at))))

    def count(batches):
        n, same = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
        for batch in batches:
            kinds = np.array(batch.column("kind").to_pylist(), object)
            nodes, roots = batch.column("node").to_numpy(), batch.column("root").to_numpy()
            for k in set(kinds.tolist()) & asked.keys():
                at, ids, trees, v = asked[k]
                own = np.flatnonzero(kinds == k)
                for i in range(0, len(own), 512):
                    rows = own[i : i + 512]
                    near = matrix(batch.column("v").take(pa.array(rows))) @ v.T >= settings.threshold
                    near &= nodes[rows][:, None] != ids
                    n[at] += near.sum(axis=0)
                    same[at] += (near & (roots[rows][:, None] == trees)).sum(axis=0)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), pa.array(same[at])], names=["at", "n", "same"])

    rows = sized.select("node", "kind", "v").join(placed.select("node", "root"), "node")
    found = rows.mapInArrow(count, "at long, n long, same long").groupBy("at").agg(F.sum("n").alias("n"), F.sum("same").alias("same"))
    found = found.toArrow()
    out = {}
    for name in ("n", "same"):
        out[name] = np.zeros(len(node), np.int64)
        out[name][found["at"].to_numpy()] = found[name].to_numpy()
    return out


def _search(sized: DataFrame, turns: int, settings: Settings) -> tuple[DataFrame, list[int]]:
    """``node`` and ``root`` by hyperplanes and refinement, and the ``bits`` where the audit still misses links."""
    entries, rooms, links, todo = None, None, [], sized
    for turn in range(turns):
        met = stored(_met(todo, turn, settings), "met")
        links.append(met.filter("link").select(F.col("u").alias("a"), F.col("v").alias("b")))
        met = met.filter("NOT link").select("u", "v", "sim", F.lit(1).alias("fresh"))
        if entries is not None:
            rooms = entries.groupBy("u").agg(F.max("room").alias("room"))
            met = entries.select("u", "v", "sim", "fresh").unionByName(met)
        entries = stored(_listed(met, rooms, settings), "lists")
        for _ in range(settings.rounds):
            entries, linked, new = _refine(entries, sized, settings)
            links.append(linked)
            if not new:
                break
        roots = components(reduce(DataFrame.unionByName, links))
        missed = _audit(sized, roots, settings)
        if not missed:
            break
        todo = sized.filter(F.col("bits").isin(missed))
    return roots, missed


def connect(nodes: DataFrame, settings: Settings) -> DataFrame:
    """``node`` and ``root`` of all nodes that the graph of links connects with a smaller one."""
    sized = stored(_sized(nodes, settings), "sized")
    roots, missed = _search(sized, max(1, settings.most_planes // settings.planes), settings)
    if not missed:
        return roots
    # One chunk for each of these kinds: all its tiles meet.
    rest = sized.filter(F.col("bits").isin(missed)).withColumn("bits", F.lit(0))
    links = stored(_met(rest, 0, settings).filter("link").select(F.col("u").alias("a"), F.col("v").alias("b")), "exact")
    return components(links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def count_links(members: DataFrame, settings: Settings) -> DataFrame:
    """Per node the number of vectors of other nodes that link with it.

    ``members`` has ``root``, ``node``, ``v`` and ``weight``, the vectors of the node.
    """
    sizes = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / settings.tile).cast("int").alias("tiles"))
    placed = members.join(sizes, "root").withColumn("own", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    placed = placed.select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "v", "weight")

    def count(key: tuple, rows: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        own, node = rows["own"].to_numpy(), rows["node"].to_numpy()
        v, weight = matrix(rows["v"]), rows["weight"].to_numpy()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        near = v[left] @ v[right].T >= settings.threshold
        if i == j:
            np.fill_diagonal(near, False)
            return pa.table({"node": node, "n": near @ weight[right]})
        out = np.concatenate([near @ weight[right], near.T @ weight[left]])
        return pa.table({"node": node[np.concatenate([left, right])], "n": out})

    return placed.groupBy("root", "i", "j").applyInArrow(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))


def near_duplicates(
    vectors: DataFrame, settings: Settings = Settings(), key: str = "vec_id", label: str = "label", vector: str = "embedding"
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id`` (smallest id reachable) and ``kept``."""
    rows = stored(nodes_of(vectors, key, label, vector), "vectors")
    good = rows.filter("node IS NOT NULL")
    nodes = good.groupBy("node").agg(
        F.first("kind").alias("kind"), F.first("v").alias("v"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least")
    )
    nodes = stored(nodes, "nodes")
    roots = connect(nodes.select("node", "kind", "v"), settings)
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = stored(placed, "placed")
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("nodes"))
    members = placed.join(ids.filter("nodes > 1").select("root"), "root", "left_semi")
    counts = count_links(members.select("root", "node", "v", "weight"), settings)
    known = placed.select("node", "root", "weight").join(ids, "root").join(counts, "node", "left").select(
        "node", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id"
    )
    out = rows.select("vec_id", "node").join(known, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
