"""Documents and changes against a plain replay of the rules, event by event."""

import random

import pytest
from pyspark.sql import functions as F

from cellindex.functions.keys import HEX
from cellindex.operators import changelog, lookup, mapping, reduce
from cellindex.operators.hooks import RowFold, RowMapper
from cellindex.plans import build
from cellindex.plans.scratch import cut_lineage
from cellindex.spec import FieldSpec, IndexSpec, SpecError

COLUMN = IndexSpec(
    "table1", [FieldSpec("v", "a:*"), FieldSpec("v", "b:*")], mapping="column", row_field="row", family_field="fam"
)
ROW = IndexSpec("table1", [FieldSpec("v", "a:*"), FieldSpec("q", "a:*", source="qualifier")])
OPS = ["Put"] * 6 + ["DeleteColumn", "DeleteColumn", "DeleteFamily", "DeleteRow"]


def random_log(n, seed, hot=False):
    rng = random.Random(seed)
    log = []
    for i in range(n):
        row = "hot" if hot and rng.random() < 0.4 else f"r{rng.randrange(6)}"
        log.append((row, rng.choice("abc"), f"q{rng.randrange(4)}", f"v{i}", rng.choice(OPS)))
    return log


def replay(log, families):
    """Live cells, one mutation after the other."""
    live = {}
    for row, family, qualifier, value, op in log:
        if family not in families:
            continue
        if op == "Put":
            live[row, family, qualifier] = value
        elif op == "DeleteColumn":
            live.pop((row, family, qualifier), None)
        else:
            for key in [k for k in live if k[0] == row and (op == "DeleteRow" or k[1] == family)]:
                del live[key]
    return live


def docs_of(df):
    return {(r.id, r.row, r.fam): list(r.v) for r in df.collect()}


def expected_docs(log, families="ab"):
    return {("-".join(k), k[0], k[1]): [v] for k, v in replay(log, families).items()}


@pytest.mark.parametrize("hot", [False, True])
def test_column_index(cells, salted, hot):
    log = random_log(300, 1, hot)
    assert docs_of(build.column_index(cells(*log), COLUMN)) == expected_docs(log)


def test_column_index_ignores_other_tables(cells):
    log = random_log(50, 2)
    both = cells(*log).unionByName(cells(("x", "a", "q", "v", "Put"), tbl="other"))
    assert docs_of(build.column_index(both, COLUMN)) == expected_docs(log)


@pytest.mark.parametrize("cut", [1, 40, 119])
def test_changes_fold_the_same_wherever_batches_are_cut(cells, cut):
    log = random_log(120, 3, hot=True)
    whole = cells(*log)
    parts = [whole.filter(F.col("seq") < cut), whole.filter(F.col("seq") >= cut)]
    first, second = [cut_lineage(changelog.column_changes(p, COLUMN)) for p in parts]
    folded = changelog.fold(first.unionByName(second))
    applied = changelog.apply_changes(changelog.fold(first), second)
    late = changelog.apply_changes(changelog.fold(second), first)  # out of order
    for state in (folded, applied, late):
        assert docs_of(changelog.documents(state, COLUMN)) == expected_docs(log)


def test_deletes_by_type(cells):
    log = cells(*[("_row_", "a", "_q_", "", op) for op in ("Put", "DeleteColumn", "DeleteFamily", "DeleteRow", "Internal")])
    kinds = [r.kind for r in changelog.dispatch(log, COLUMN).orderBy("seq").collect()]
    assert kinds == ["upsert", "delete_id", "delete_row_family", "delete_row", "ignored"]
    bare = IndexSpec("table1", COLUMN.fields, mapping="column")
    assert [r.kind for r in changelog.dispatch(log, bare).orderBy("seq").collect()] == [
        "upsert", "delete_id", "ignored", "ignored", "ignored"
    ]


def test_spec_without_row_field_keeps_documents(cells):
    bare = IndexSpec("table1", [FieldSpec("v", "a:*")], mapping="column")
    log = cells(("r", "a", "q", "v", "Put"), ("r", "a", "q", "", "DeleteRow"))
    assert [r.id for r in build.column_index(log, bare).collect()] == ["r-a-q"]


def test_put_after_family_delete_survives_and_others_do_not(cells):
    log = [("r", "a", "q1", "x", "Put"), ("r", "a", "q2", "x", "Put"), ("r", "a", "q2", "", "DeleteFamily"), ("r", "a", "q2", "y", "Put")]
    assert docs_of(build.column_index(cells(*log), COLUMN)) == {("r-a-q2", "r", "a"): ["y"]}


def test_hex_keys(cells):
    spec = IndexSpec("table1", COLUMN.fields, mapping="column", row_field="row", family_field="fam", key_format=HEX)
    named = IndexSpec("table1", COLUMN.fields, mapping="column", row_field="row", family_field="fam", key_format="hex")
    log = random_log(60, 5)
    expected = {
        ("-".join(p.encode().hex() for p in k), k[0].encode().hex(), k[1].encode().hex()): [v]
        for k, v in replay(log, "ab").items()
    }
    for s in (spec, named):
        assert docs_of(build.column_index(cells(*log), s)) == expected


def changes_of(df):
    return {(r.id, r.part): (r.kind, r.seq, None if r.doc is None else (list(r.doc.v), list(r.doc.q))) for r in df.collect()}


def test_row_mode_never(cells):
    log = random_log(200, 6)
    spec = IndexSpec("table1", ROW.fields, read_row="never")
    last = {}
    for seq, (row, family, qualifier, value, op) in enumerate(log):
        if family == "a" or op != "Put":
            last[row] = (seq, op, value, qualifier)
    expected = {
        (row, 0): ("upsert", seq, ([value], [q])) if op == "Put" else ("delete_id", seq, None)
        for row, (seq, op, value, q) in last.items()
    }
    assert changes_of(build.row_changes(cells(*log), spec)) == expected


def test_row_mode_dynamic(cells, salted):
    log = random_log(200, 7, hot=True)
    source = reduce.live_cells(cells(*log))
    live = replay(log, "abc")
    touched = {}
    for seq, (row, family, _, _, op) in enumerate(log):
        if family == "a" or op != "Put":
            touched[row] = seq
    expected = {}
    for row, seq in touched.items():
        mine = sorted((k[2], v) for k, v in live.items() if k[0] == row and k[1] == "a")
        if not mine:
            expected[row, 0] = ("delete_id", seq, None)
        # Two values per cell, so a limit of 4 cuts after two cells of one field.
        pairs = [("v", v) for _, v in mine] + [("q", q) for q, _ in mine]
        for p in range((len(pairs) + 3) // 4):
            piece = pairs[4 * p : 4 * p + 4]
            expected[row, p] = ("upsert", seq, ([x for f, x in piece if f == "v"], [x for f, x in piece if f == "q"]))
    assert changes_of(build.row_changes(cells(*log), ROW, source, max_values=4)) == expected


def test_complete_events_are_not_read_again(cells):
    spec = IndexSpec("table1", [FieldSpec("v", "a:q1"), FieldSpec("q", "a:q2")])
    log = cells(
        ("r1", "a", "q1", "new", "Put", 0), ("r1", "a", "q2", "two", "Put", 0),
        ("r2", "a", "q1", "one", "Put", 1),
        ("r3", "a", "q1", "", "DeleteColumn", 2),
    )
    source = cells(("r1", "a", "q1", "stale", "Put"), ("r2", "a", "q1", "one", "Put"), ("r2", "a", "q2", "read", "Put"), ("r2", "a", "q3", "no", "Put"))
    assert changes_of(build.row_changes(log, spec, source)) == {
        ("r1", 0): ("upsert", 1, (["new"], ["two"])),
        ("r2", 0): ("upsert", 2, (["one"], ["read"])),
        ("r3", 0): ("delete_id", 3, None),
    }


def test_row_without_indexed_content_is_still_a_document(cells):
    spec = IndexSpec("table1", ROW.fields, read_row="never")
    log = cells(("r", "a", "q", "v", "Put", 0), ("r", "z", "q", "", "DeleteColumn", 1), ("r", "z", "q", "v", "Put", 1))
    assert changes_of(build.row_changes(log, spec)) == {("r", 0): ("upsert", 1, ([], []))}


def test_fields_append_in_definition_order(cells):
    spec = IndexSpec("table1", [FieldSpec("f", "b:*"), FieldSpec("f", "a:q1"), FieldSpec("f", "b:x*", source="qualifier"), FieldSpec("none", "c:*")])
    log = cells(("r", "a", "q1", "A", "Put"), ("r", "b", "x2", "B2", "Put"), ("r", "b", "x1", "B1", "Put"), ("r", "b", "w", "W", "Put"))
    doc = mapping.map_rows(log, spec).first()
    assert (list(doc.f), list(doc.none)) == (["W", "B1", "B2", "A", "x1", "x2"], [])
    parts = [list(r.f) for r in mapping.map_rows(log, spec, max_values=4).orderBy("part").collect()]
    assert parts == [["W", "B1", "B2", "A"], ["x1", "x2"]]


def test_overlapping_definitions_feed_a_field_twice(cells):
    spec = IndexSpec("table1", [FieldSpec("f", "a:*"), FieldSpec("f", "a:q*")], mapping="column")
    assert list(build.column_index(cells(("r", "a", "q1", "x", "Put")), spec).first().f) == ["x", "x"]


def test_row_parts_replace_as_a_whole(cells):
    """A document that shrinks loses its later parts; one that is replayed stays as it is."""
    long = build.row_changes(cells(*[("r", "a", f"q{i}", f"v{i}", "Put", 0) for i in range(5)]), IndexSpec("table1", [FieldSpec("v", "a:*")], read_row="never"), max_values=2)
    long = cut_lineage(long)
    short = long.filter("part = 0").withColumn("seq", F.lit(9).cast("bigint"))
    once = changelog.fold(long.unionByName(short), multipart=True)
    assert [(r.part, list(r.doc.v)) for r in once.collect()] == [(0, ["v0", "v1"])]
    twice = changelog.fold(long.unionByName(long), multipart=True)
    assert sorted((r.part, list(r.doc.v)) for r in twice.collect()) == [(0, ["v0", "v1"]), (1, ["v2", "v3"]), (2, ["v4"])]
    for applied in (
        changelog.apply_changes(changelog.fold(long, True), short, True),
        changelog.apply_changes(changelog.fold(short, True), long, True),
    ):
        assert [(r.part, list(r.doc.v)) for r in applied.collect()] == [(0, ["v0", "v1"])]


def summary(piece, params):
    names = [bytes(c["qualifier"]).decode() for c in piece]
    return {"n": len(piece), "low": names[0], "names": names, "text": params["mark"] + "".join(names)}


PLAIN_MERGE = {"n": "sum", "low": "first", "names": "concat", "text": "max"}


def joined(a, b):
    return {"n": a["n"] + b["n"], "low": a["low"], "names": [*a["names"], *b["names"]], "text": max(a["text"], b["text"])}


@pytest.mark.parametrize("merge", [PLAIN_MERGE, joined])
def test_row_mapper_does_not_depend_on_the_size_of_pieces(cells, merge):
    log = cells(*[("r", "a", f"q{i}", "v", "Put") for i in range(5)], ("s", "a", "q", "v", "Put"), ("s", "b", "q", "v", "Put"))
    found = []
    for size in (2, 3, 10_000):
        mapper = RowMapper(summary, "n INT, low STRING, names ARRAY<STRING>, text STRING", ("a:*",), size, merge, {"mark": "m"})
        docs = build.bulk_build(log, IndexSpec("table1", row_mapper=mapper, params={"mark": "unused"})).collect()
        found.append(sorted((r.id, r.part, r.n, r.low, tuple(r.names)) for r in docs))
    assert found == [[("r", 0, 5, "q0", ("q0", "q1", "q2", "q3", "q4")), ("s", 0, 1, "q", ("q",))]] * 3


def deeper(a, b):
    return {"names": [*a["names"], *b["names"]], "depth": max(a["depth"], b["depth"]) + 1}


def test_row_mapper_merges_in_rounds(cells, monkeypatch):
    """No call sees all pieces of a long row, and their order stays."""
    monkeypatch.setattr("cellindex.operators.hooks.MERGED_AT_ONCE", 2, raising=False)
    names = [f"q{i:02}" for i in range(16)]
    fn = lambda piece: {"names": [bytes(c["qualifier"]).decode() for c in piece], "depth": 0}
    mapper = RowMapper(fn, "names ARRAY<STRING>, depth INT", ("a:*",), 1, deeper)
    doc = build.bulk_build(cells(*[("r", "a", q, "v", "Put") for q in names]), IndexSpec("table1", row_mapper=mapper)).first()
    assert (list(doc.names), doc.depth) == (names, 5)


def test_row_mapper_without_merge_fails_on_long_rows(cells):
    mapper = RowMapper(lambda row: {"n": len(row)}, "n INT", ("a:*",), 2)
    spec = IndexSpec("table1", row_mapper=mapper)
    assert build.bulk_build(cells(*[("r", "a", f"q{i}", "v", "Put") for i in range(2)]), spec).first().n == 2
    with pytest.raises(Exception, match="no merge"):
        build.bulk_build(cells(*[("r", "a", f"q{i}", "v", "Put") for i in range(3)]), spec).collect()
    for wrong in ({"n": "sum", "m": "sum"}, {"n": "average"}):
        with pytest.raises(SpecError):
            build.bulk_build(cells(), IndexSpec("table1", row_mapper=RowMapper(len, "n INT", ("a:*",), 2, wrong)))


def test_row_mapper_in_column_mode(cells):
    mapper = RowMapper(lambda cell, params: {"v": params["p"] + bytes(cell[0]["value"]).decode()}, "v STRING", ("a:*",))
    spec = IndexSpec("table1", mapping="column", row_mapper=mapper, row_field="row", family_field="fam", params={"p": "+"})
    log = random_log(120, 12)
    want = {k: "+" + v[0] for k, v in expected_docs(log, "a").items()}
    assert {(r.id, r.row, r.fam): r.v for r in build.column_index(cells(*log), spec).collect()} == want
    state = changelog.fold(changelog.column_changes(cells(*log), spec))
    assert {(r.id, r.row, r.fam): r.v for r in changelog.documents(state, spec).collect()} == want


class Prefixed:
    """A key format with a parameter."""

    def __init__(self, before=""):
        self.before = before

    def configure(self, params):
        return Prefixed(params["before"])

    def row(self, row_key):
        return F.concat(F.lit(self.before), row_key.cast("string"))


def test_key_format_with_parameters(cells):
    spec = IndexSpec("table1", [FieldSpec("v", "a:*")], key_format=Prefixed(), params={"before": "k-"})
    assert build.bulk_build(cells(("r", "a", "q", "v", "Put")), spec).first().id == "k-r"


def test_order_is_that_of_seq(cells):
    """Event numbers fall while seq rises."""
    log = cells(("r", "a", "q", "old", "Put", 9), ("r", "a", "q", "new", "Put", 3))
    never = IndexSpec("table1", ROW.fields, read_row="never")
    assert changes_of(build.row_changes(log, never)) == {("r", 0): ("upsert", 1, (["new"], ["q"]))}
    exact = IndexSpec("table1", [FieldSpec("v", "a:q"), FieldSpec("q", "a:q", source="value")])
    assert changes_of(build.row_changes(log, exact, reduce.live_cells(log))) == {("r", 0): ("upsert", 1, (["new"], ["new"]))}
    assert reduce.last_event_per_row(log, never).first().event_id == 3


def test_building_starts_no_job(cells, jobs):
    log = cells(*random_log(30, 8))
    started = jobs()
    build.column_index(log, COLUMN), build.bulk_build(log, ROW), mapping.row_view(log), reduce.live_cells(log)
    assert jobs() == started


@pytest.mark.parametrize("limit", [2, 10_000])
def test_parts_are_judged_together(spark, limit):
    from cellindex.catalog import indexes

    for query in (indexes.typed_projection_parts, indexes.snapshot_diff_parts):
        rows = sorted(map(repr, query(spark, "/root/testdata/sf0.001", limit).collect()))
        assert rows == sorted(map(repr, query(spark, "/root/testdata/sf0.001", 3).collect()))


def test_merged_documents(spark):
    entries = [("d", "", "field", v, b, o, i) for v, b, o, i in (("A1", 0.5, 0, 0), ("A2", 0.5, 0, 1), ("B1", 1.5, 1, 0), ("B2", 1.5, 1, 1))]
    entries.append(("d", "pre_", "field", "C", 1.0, 1, 0))
    df = spark.createDataFrame(entries, "id string, prefix string, field string, value string, boost double, doc_ord int, value_ord int")
    merged = {r.field: (list(r["values"]), r.boost) for r in mapping.merge_documents(df).collect()}
    boost = 0.5 * 0.5 * 1.5 * 1.5
    assert merged == {"field": (["A1", "A2", "B1", "B2"], boost), "pre_field": (["C"], 1.0)}
    parts = mapping.merge_documents(df, max_values=3).filter("field = 'field'").orderBy("part").collect()
    assert [(list(r["values"]), r.boost) for r in parts] == [(["A1", "A2", "B1"], boost), (["B2"], boost)]


def test_spec_change_is_not_retroactive(cells):
    old, new = IndexSpec("table1", [FieldSpec("f", "a:*")], mapping="column"), IndexSpec("table1", [FieldSpec("f", "a:*"), FieldSpec("f", "b:*")], mapping="column")
    log = cells(("r1", "a", "q", "1", "Put"), ("r2", "b", "q", "2", "Put"), ("r3", "b", "q", "3", "Put"))
    seen = log.filter(build.versioned_relevance([(old, None, 2), (new, 2, None)]))
    assert sorted(r.id for r in build.column_index(seen, new).collect()) == ["r1-a-q", "r3-b-q"]


def test_lookup_over_parts(spark):
    docs = spark.createDataFrame([("a", 0, ["x"], "1"), ("a", 1, ["y"], "1"), ("b", 0, ["x"], "1"), ("c", 0, ["x", "y"], "2")], "id string, part int, f array<string>, g string")
    hits = lookup.find(docs.filter("id <> 'c'"), {"f": "x"}).select("id", "part")
    assert sorted(map(tuple, hits.collect())) == [("a", 0), ("a", 1), ("b", 0)]
    one = docs.select("id", "f", "g").filter("id = 'c'")
    assert [r.id for r in lookup.find(one, {"f": "y", "g": "2"}).collect()] == ["c"]


def test_typed_fields(spark):
    rows = [("good", ["5"], ["a", "b"]), ("text", ["five"], []), ("many", ["1", "2"], []), ("none", [], [])]
    docs = spark.createDataFrame(rows, "id string, n_i array<string>, t_ss array<string>")
    typed = {r.id: (r.n_i, r.error) for r in lookup.typed(docs, ["n_i", "t_ss"]).collect()}
    assert typed["good"] == (5, None) and typed["none"] == (None, None)
    assert "not a int" in typed["text"][1] and "more than one" in typed["many"][1]
    unknown = lookup.typed(docs.withColumnRenamed("t_ss", "t"), ["n_i", "t"])
    assert lookup.quarantined(unknown).count() == 3


def test_fields_the_schema_knows(spark):
    df = spark.createDataFrame([("a_s",), ("a_b_ds",), ("title",), ("x_zz",), ("s",)], "f string")
    known = lambda *names: [r.f for r in df.filter(lookup.in_schema(F.col("f"), names)).collect()]
    assert known() == ["a_s", "a_b_ds"]
    assert known("title") == ["a_s", "a_b_ds", "title"]


@pytest.mark.parametrize("batch", [2, 10_000])
def test_folded_rows(spark, cells, batch):
    """Cell by cell and in order, whatever the size of rows and Arrow batches; parameters of the spec reach the start."""
    def start(params):
        return {"text": params["before"], "n": 0}

    def add(state, cell):
        return {"text": state["text"] + bytes(cell["value"]).decode(), "n": state["n"] + 1}

    rows = [(f"r{k % 7}" if k % 3 else "hot", "ab"[k % 2], f"q{k * 7919 % 1000:03d}", str(k % 10), "Put") for k in range(900)]
    rows += [("late", "a", "x", "1", "Put"), ("other", "c", "x", "1", "Put")]
    log = cells(*rows)
    fold = RowFold(start, add, lambda s: {**s, "unknown": 1}, "n BIGINT, text STRING", ("a:*", "b:*"))
    spec = IndexSpec("table1", row_mapper=fold, params={"before": ">"}, read_row="never")
    expected = {}
    for r, f, q, v, _ in sorted(rows, key=lambda r: r[:3]):
        if f != "c":
            n, text = expected.get(r, (0, ">"))
            expected[r] = (n + 1, text + v)
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    spark.conf.set(conf, batch)
    try:
        docs = build.bulk_build(log, spec)
        assert {r.id: (r.n, r.text) for r in docs.collect()} == expected
        changes = build.row_changes(log.withColumn("event_id", F.xxhash64("row_key")), spec)
        assert {r.id: tuple(r.doc) for r in changes.filter("kind = 'upsert'").collect()} == expected
        column = IndexSpec("table1", row_mapper=fold, params={"before": "-"}, mapping="column")
        assert {r.text for r in build.column_index(log, column).collect()} == {f"-{k}" for k in range(10)}
        assert build.bulk_build(log.filter("false"), spec).collect() == []
    finally:
        spark.conf.set(conf, before)


def records(frame):
    return sorted(map(repr, frame.collect()))


@pytest.mark.parametrize("buckets", [1, 5, 4096])
def test_diff_by_digests(spark, buckets):
    rng = random.Random(buckets)
    old = {f"k{i}": rng.randrange(3) for i in range(300)}
    new = {k: v + (rng.random() < 0.02) for k, v in old.items() if rng.random() > 0.02} | {"n1": 1, "n2": 2}
    # Documents in parts, and copies of a row that would cancel out in a plain exclusive or.
    as_rows = lambda docs: [(k, v, p) for k, v in docs.items() for p in range(1 + len(k) % 3)]
    a, b = (spark.createDataFrame(as_rows(x), "id string, version int, part int") for x in (old, new))
    assert records(lookup.snapshot_diff_digest(a, b, "id", "version", buckets)) == records(lookup.snapshot_diff(a, b, "id", "version"))
    assert lookup.differing_buckets(a, a.orderBy("version"), "id", "version", buckets).count() == 0
    assert records(lookup.snapshot_diff_digest(a, b.limit(0), "id", "version", buckets)) == records(lookup.snapshot_diff(a, b.limit(0), "id", "version"))
    twice = a.filter("id = 'k7'")
    assert lookup.differing_buckets(twice, twice.union(twice).union(twice), "id", "version", buckets).count() == 1
    assert not lookup.differing_buckets(a, b, "id", "version", 4096).count() > 40


def test_reread_opens_the_buckets_of_touched_rows(spark, cells, tmp_path):
    import re

    from cellindex.sources.cells import of_rows, write_by_row

    log = cells(*[(f"r{k % 200}", "a", f"q{k}", "v", "Put") for k in range(1000)])
    write_by_row(log, str(tmp_path / "source"), 32)
    source = spark.read.parquet(str(tmp_path / "source"))
    touched = spark.createDataFrame([(f"r{k}".encode(),) for k in range(10)] + [(b"unknown",)], "row_key binary")
    spec = IndexSpec("table1", [FieldSpec("f", "a:*")])
    found = build.reread(source, touched, spec)
    assert found.count() == 50 and {bytes(r.row_key).decode() for r in found.collect()} == {f"r{k}" for k in range(10)}
    opened = of_rows(source, touched).select(F.input_file_name().alias("f")).distinct().collect()
    assert 0 < len({r.f.rsplit("/", 2)[1] for r in opened}) <= 11
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*row_bucket_of_32", plan)
    assert of_rows(source, source).count() == 1000 and of_rows(source, touched.limit(0)).count() == 0
    assert of_rows(log, touched) is log
    changes = build.row_changes(log.filter("seq < 10"), spec, source)
    assert {(r.id, len(r.doc.f)) for r in changes.collect()} == {(f"r{k}", 5) for k in range(10)}
