import random

import pytest
from pyspark.sql import functions as F

from cellindex.operators import skew


@pytest.fixture
def lopsided(spark):
    """A third of the rows share one key."""
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}", i) for i in range(600)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, v int"), rows


def test_hot_keys_found(lopsided, salted):
    df, _ = lopsided
    hot = skew.hot_keys(df, ["k"])
    flagged = {r.k for r in df.filter(hot.flag()).select("k").distinct().collect()}
    assert flagged == {"hot"}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join(spark, lopsided, salted, capsys, how):
    df, _ = lopsided
    right = spark.createDataFrame([("hot", 1), ("k3", 2), ("other", 3)], "k string, w int")
    joined = skew.lookup_join(df, right, ["k"], how, ["v"], skew.hot_keys(df, ["k"]))
    joined.explain()
    assert "_salt" in capsys.readouterr().out
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, df.join(right, "k", how).collect()), key=repr)


def test_numbered(lopsided):
    df, rows = lopsided
    expected = {}
    for k, v in sorted(rows):
        expected[(k, v)] = sum(1 for a, b in rows if a == k and b < v)
    got = skew.numbered(df, ["k"], ["v"]).collect()
    assert {(r.k, r.v): r.pos for r in got} == expected


@pytest.mark.parametrize("spread", [False, True])
@pytest.mark.parametrize("limit", [1, 7, 50, 1000])
def test_collect_groups(lopsided, limit, spread):
    df, rows = lopsided
    groups = {}
    for k, v in sorted(rows):
        groups.setdefault(k, []).append(v)
    expected = {
        (k, p): vs[p * limit : (p + 1) * limit] for k, vs in groups.items() for p in range((len(vs) - 1) // limit + 1)
    }
    large = skew.large_groups(df, ["k"], 20) if spread else None
    assert not spread or 0 < large.count() < len(groups)
    got = skew.collect_groups(df, ["k"], ["v"], {"vs": (None, F.col("v"))}, limit, large=large).collect()
    assert {(r.k, r.part): list(r.vs) for r in got} == expected


def test_collect_groups_counts_only_marked_rows(spark):
    df = spark.createDataFrame([("a", i, i % 2 == 0) for i in range(10)] + [("b", 0, False)], "k string, v int, m boolean")
    lists = {"vs": (F.col("m"), F.col("v"))}
    got = {(r.k, r.part): list(r.vs) for r in skew.collect_groups(df, ["k"], ["v"], lists, 2, F.col("m")).collect()}
    assert got == {("a", 0): [0, 2], ("a", 1): [4, 6], ("a", 2): [8], ("b", 0): []}


@pytest.mark.parametrize("spread", [False, True])
def test_parts_are_bounded_by_bytes(spark, spread):
    df = spark.createDataFrame([("a", i, b"x" * (50 if i % 3 else 5)) for i in range(40)] + [("b", 0, b"y")], "k string, v int, b binary")
    large = skew.large_groups(df, ["k"], 10) if spread else None
    rows = skew.with_parts(df, ["k"], ["v"], 9, size=F.length("b"), max_bytes=120, large=large).collect()
    parts = {}
    for r in sorted(rows, key=lambda r: (r.k, r.v)):
        parts.setdefault((r.k, r.part), []).append(r)
    assert len(rows) == 41 and parts["b", 0][0].v == 0
    assert all(len(p) <= 9 and sum(len(r.b) for r in p[:-1]) <= 120 for p in parts.values())
    numbers = [p for k, p in parts if k == "a"]
    assert numbers == sorted(numbers) and len(numbers) > 10
    assert [r.v for k in parts if k[0] == "a" for r in parts[k]] == list(range(40))


def test_joins_start_no_job(spark, lopsided, jobs):
    df, _ = lopsided
    right = df.groupBy("k").count()
    started = jobs()
    joined = skew.lookup_join(df, right, ["k"], "left", ["v"])
    skew.collect_groups(joined, ["k"], ["v"], {"vs": (None, F.col("v"))}, 7)
    assert jobs() == started


@pytest.fixture
def many_tasks(spark, monkeypatch):
    """A cluster's worth of partitions that stay apart, and limits a small table can reach."""
    confs = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(skew, "ONE_TASK_BYTES", 1000)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def largest_read(spark, run):
    """The largest number of shuffled rows that one task read while ``run`` ran."""
    store, bus = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty()
    known = set(stages_of(store))
    run()
    bus.waitUntilEmpty()
    most = 0
    for stage in set(stages_of(store)) - known:
        tasks = store.taskList(stage, 0, 10_000)
        for k in range(tasks.size()):
            metrics = tasks.apply(k).taskMetrics()
            if metrics.isDefined():
                most = max(most, metrics.get().shuffleReadMetrics().recordsRead())
    return most


def stages_of(store):
    jobs = store.jobsList(None)
    return [s for k in range(jobs.size()) for s in (jobs.apply(k).stageIds().apply(i) for i in range(jobs.apply(k).stageIds().size()))]


def big_row(spark, n):
    """Cells of which a third belong to one row, as a stored table whose size Spark knows."""
    third = F.col("id") % 3 == 0
    row = F.when(third, F.lit("hot")).otherwise(F.concat(F.lit("r"), (F.col("id") % 97).cast("string")))
    text = F.concat(F.lit("q"), F.lpad(F.col("id").cast("string"), 7, "0"))
    return spark.range(n).select(
        F.lit("t").alias("tbl"), row.cast("binary").alias("row_key"), F.lit(b"a").alias("family"), text.cast("binary").alias("qualifier"),
        text.cast("binary").alias("value"), F.lit("Put").alias("op"), F.lit(None).cast("timestamp").alias("ts"), F.col("id").alias("seq"), F.col("id").alias("event_id"),
    )


@pytest.mark.parametrize("what", ["bulk_build", "row_changes", "assemble_row"])
def test_a_large_row_is_numbered_in_many_tasks(spark, many_tasks, monkeypatch, what):
    from cellindex.operators import mapping
    from cellindex.plans import build
    from cellindex.spec import FieldSpec, IndexSpec

    n = 6000
    spec = IndexSpec("t", [FieldSpec("q", "a:*", source="qualifier")])
    cells = skew.cut_lineage(big_row(spark, n), "cells")
    # Parts of 100 values; the default arguments name a limit that this table cannot reach.
    for f in (mapping.map_rows, mapping.row_view, build.bulk_build, build.row_changes):
        defaults = tuple(100 if d == skew.MAX_GROUP_VALUES else d for d in f.__defaults__)
        monkeypatch.setattr(f, "__defaults__", defaults)
    run = {
        "bulk_build": lambda: build.bulk_build(cells, spec).select("id", "part", "q"),
        "row_changes": lambda: build.row_changes(cells, spec, cells).select("id", "part", "doc.q"),
        "assemble_row": lambda: mapping.row_view(cells).select(F.col("row_key").cast("string").alias("id"), "part", F.col("cells.qualifier").alias("q")),
    }[what]
    found = []
    most = largest_read(spark, lambda: found.extend(run().collect()))
    assert most < n / 8, "a task read an outsized share of the cells"
    parts = sorted((r.part, [bytes(q).decode() if not isinstance(q, str) else q for q in r.q]) for r in found if r.id == "hot")
    assert [p for p, _ in parts] == list(range(len(parts))) and len(parts) == n // 300
    assert [q for _, v in parts for q in v] == [f"q{k:07d}" for k in range(0, n, 3)]
    assert sum(len(r.q) for r in found) == n and {r.part for r in found if r.id != "hot"} == {0}


@pytest.mark.parametrize("size", [None, 10])
def test_many_small_groups_beyond_the_limit_are_not_ranged(spark, monkeypatch, size):
    """Groups that one task can number are numbered in the shuffle of the grouping, however many they are."""
    df = skew.cut_lineage(spark.range(3000).select((F.col("id") % 300).alias("k"), F.col("id").alias("v")), "groups")
    monkeypatch.setattr(skew, "ONE_TASK_BYTES", 200)
    monkeypatch.setattr(skew, "numbered", lambda *a, **k: pytest.fail("numbered over many tasks"))
    got = skew.collect_groups(df, ["k"], ["v"], {"vs": (None, F.col("v"))}, 4, size=size and F.lit(size)).collect()
    assert {(r.k, r.part): list(r.vs) for r in got} == {
        (k, p): list(range(k, 3000, 300))[p * 4 : p * 4 + 4] for k in range(300) for p in range(3)
    }


def test_small_and_large_groups_beyond_the_limit(spark, monkeypatch):
    """A large group is numbered over many tasks, small ones beyond the limit are cut as well, a group without key stays."""
    key = F.when(F.col("id") < 1000, 0).when(F.col("id") < 1020, F.lit(None).cast("int")).otherwise(F.col("id") % 100 + 1)
    df = skew.cut_lineage(spark.range(3000).select(key.alias("k"), F.col("id").alias("v")), "groups")
    monkeypatch.setattr(skew, "ONE_TASK_BYTES", 500)
    rows = skew.collect_groups(df, ["k"], ["v"], {"vs": (None, F.col("v"))}, 7, size=F.lit(10)).collect()
    groups = {}
    for r in sorted(rows, key=lambda r: r.part):
        assert len(r.vs) <= 7
        groups.setdefault(r.k, []).extend(r.vs)
    assert groups[0] == list(range(1000)) and groups[None] == list(range(1000, 1020))
    assert len(groups) == 102 and all(v == sorted(v) for v in groups.values()) and sum(map(len, groups.values())) == 3000
