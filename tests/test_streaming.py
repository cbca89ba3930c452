"""Streams end with the documents of a full build, wherever batches are cut."""

import pytest
from pyspark.sql import functions as F

from cellindex.operators import reduce
from cellindex.plans import build, history
from cellindex.plans.table import IndexTable
from cellindex.sources.cells import read_cells, stream_cells
from cellindex.spec import ExtractSpec, FieldSpec, IndexSpec, SpecError
from cellindex.streaming.indexing import counters, index_batch, start_indexing
from tests.test_indexing import COLUMN, ROW, docs_of, expected_docs, random_log, replay


@pytest.fixture
def arrive(cells, tmp_path):
    """Add a piece of a log as a file of the stream's folder."""
    log = random_log(90, 11)
    whole = cells(*log)

    def add(start, stop):
        whole.filter(f"seq >= {start} AND seq < {stop}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    return log, add


def run(spark, tmp_path, table, **options):
    stream = stream_cells(spark, str(tmp_path / "in"), files_per_batch=1)
    start_indexing(stream, table, str(tmp_path / "checkpoint"), **options).awaitTermination()


def test_pause_compact_and_resume(spark, tmp_path, arrive):
    log, add = arrive
    table = IndexTable(spark, str(tmp_path / "index"), COLUMN)
    add(0, 30)
    add(30, 50)
    run(spark, tmp_path, table)
    assert docs_of(table.documents()) == expected_docs(log[:50])
    assert table.compact() == 0 and table.compact() == 0
    assert docs_of(table.documents()) == expected_docs(log[:50])
    add(50, 90)
    run(spark, tmp_path, table)
    assert docs_of(table.documents()) == expected_docs(log)
    assert table.compact() == 1
    assert docs_of(table.documents()) == expected_docs(log)
    stored = spark.read.parquet(str(tmp_path / "index" / "metrics"))
    total = stored.filter("metric = 'incoming_events'").agg(F.sum("value")).first()[0]
    assert total == len(log)


def test_replayed_and_late_batches(spark, tmp_path, arrive):
    log, add = arrive
    add(0, 90)
    cells = read_cells(spark, str(tmp_path / "in"))
    table = IndexTable(spark, str(tmp_path / "index"), COLUMN)
    late, early = cells.filter("seq >= 40"), cells.filter("seq < 60")  # they overlap
    for n, batch in enumerate((late, early)):
        index_batch(batch, n, table)
        index_batch(batch, n, table)
    assert docs_of(table.documents()) == expected_docs(log)


def test_row_mode_stream(spark, tmp_path, arrive):
    """Rows are read again from the source table, as it is at the end of each batch."""
    log, add = arrive
    add(0, 50)
    add(50, 90)
    table = IndexTable(spark, str(tmp_path / "index"), ROW)
    run(spark, tmp_path, table, snapshot=lambda s: reduce.live_cells(read_cells(s, str(tmp_path / "in"))))
    expected = {}
    for (row, family, qualifier), value in sorted(replay(log, "abc").items()):
        if family == "a":
            expected.setdefault(row, ([], []))
            expected[row][0].append(value)
            expected[row][1].append(qualifier)
    assert {r.id: (list(r.v), list(r.q)) for r in table.documents().collect()} == expected


def test_subscription_starts_after_its_moment(spark, tmp_path, cells):
    log = cells(("r", "a", "q1", "x", "Put"), ("r", "a", "q2", "x", "Put"))
    stamped = log.withColumn("ts", F.timestamp_seconds(F.col("seq")))
    stamped.write.parquet(str(tmp_path / "in"))
    moment = spark.sql("SELECT timestamp_seconds(0) AS t").first().t
    seen = read_cells(spark, str(tmp_path / "in"), since=moment)
    assert [r.id for r in build.column_index(seen, COLUMN).collect()] == ["r-a-q2"]


def test_nothing_written_yet(spark, tmp_path):
    table = IndexTable(spark, str(tmp_path / "none"), IndexSpec("t", [FieldSpec("f", "a:*")]))
    with pytest.raises(ValueError):
        table.state()


@pytest.mark.parametrize("compacted", [False, True])
def test_spec_change_applies_to_later_batches(spark, tmp_path, cells, compacted):
    log = cells(("r1", "a", "q", "1", "Put"), ("r2", "b", "q", "2", "Put"), ("r3", "b", "q", "3", "Put"))
    old = IndexSpec("table1", [FieldSpec("f", "a:*")], mapping="column")
    new = IndexSpec("table1", [FieldSpec("f", "a:*"), FieldSpec("g", "b:*")], mapping="column")
    path = str(tmp_path / "index")
    before, after = IndexTable(spark, path, old), IndexTable(spark, path, new)
    index_batch(log.filter("seq < 2"), 0, before)
    if compacted:
        before.compact()
    index_batch(log.filter("seq >= 2"), 1, after)
    found = {r.id: (list(r.f), list(r.g)) for r in after.documents().collect()}
    assert found == {"r1-a-q": (["1"], []), "r3-b-q": ([], ["3"])}
    assert {r.id: list(r.f) for r in before.documents().collect()} == {"r1-a-q": ["1"], "r3-b-q": []}


@pytest.mark.parametrize("compacted", [False, True])
def test_new_subscription_adds_to_what_is_there(spark, tmp_path, arrive, compacted):
    log, add = arrive
    add(0, 30)
    add(30, 60)
    table = IndexTable(spark, str(tmp_path / "index"), COLUMN)
    run(spark, tmp_path, table)
    if compacted:
        table.compact()
    add(60, 90)
    # The new subscription sees later cells only, in batches whose numbers start at 0 again.
    seen = stream_cells(spark, str(tmp_path / "in"), files_per_batch=1).filter("seq >= 60")
    start_indexing(seen, table, str(tmp_path / "second")).awaitTermination()
    assert docs_of(table.documents()) == expected_docs(log)
    table.compact()
    assert docs_of(table.documents()) == expected_docs(log)


def test_a_batch_is_replaced_as_a_whole(spark, tmp_path, cells):
    """Until its note is written, another attempt of a batch is not seen."""
    table = IndexTable(spark, str(tmp_path / "index"), COLUMN)
    index_batch(cells(("r", "a", "q", "1", "Put")), 0, table)
    stray = str(tmp_path / "index" / "changes" / "batches" / "0-unfinished")
    table.changes().withColumn("id", F.lit("other")).write.parquet(stray)
    assert [r.id for r in table.documents().collect()] == ["r-a-q"]
    index_batch(cells(("r", "a", "q2", "2", "Put")), 0, table)
    assert [r.id for r in table.documents().collect()] == ["r-a-q2"]


def test_late_event_in_row_mode(spark, tmp_path, cells):
    log = cells(("r", "a", "late", "1", "Put"), ("r", "a", "new", "2", "Put"))
    table = IndexTable(spark, str(tmp_path / "index"), ROW)
    first = log.filter("seq = 1")
    index_batch(first, 0, table, lambda s: reduce.live_cells(first))
    index_batch(log.filter("seq = 0"), 1, table, lambda s: reduce.live_cells(log))
    assert [list(r.q) for r in table.documents().collect()] == [["late", "new"]]


def bad(text):
    raise ValueError("no")


def test_bad_documents_are_set_aside(spark, tmp_path, cells):
    """An id keeps the document it had; in row mode no part of a bad document is published."""
    extract = ExtractSpec("d:*", type="text/x", params={"parsers": {"text/x": bad}})
    log = cells(("r1", "d", "q", "x", "Put"), ("r2", "f", "q", "x", "Put"), ("r1", "f", "q", "x", "Put"))
    for mode, good in (("row", {"r2"}), ("column", {"r2-f-q", "r1-f-q"})):
        spec = IndexSpec("table1", [FieldSpec("v", "f:*")], [extract], mapping=mode, read_row="never")
        table = IndexTable(spark, str(tmp_path / mode), spec)
        index_batch(log if mode == "column" else log.withColumn("event_id", F.lit(1)), 0, table)
        assert {r.id for r in table.documents().collect()} == good
        assert [r.error for r in table.quarantine().collect()] == ["ValueError: no"]
        counted = spark.read.parquet(str(tmp_path / mode / "metrics"))
        assert counted.filter("metric = 'document_errors'").first().value == 1
        fine, aside = build.set_aside(build.bulk_build(log, spec))
        assert {r.id for r in fine.collect()} == good and aside.count() == 1


def files_of(folder):
    return {str(p.relative_to(folder)) for p in folder.rglob("*.parquet")}


def test_compaction_writes_touched_buckets_alone(spark, tmp_path, arrive):
    log, _ = arrive
    table = IndexTable(spark, str(tmp_path / "index"), COLUMN, buckets=5)
    cells = arrive_all(spark, arrive, tmp_path)
    index_batch(cells.filter("seq < 60"), 0, table)
    assert table.compact() == 0
    before = files_of(tmp_path / "index" / "base")
    one_row = log[70][0]
    index_batch(cells.filter((F.col("seq") >= 60) & (F.col("row_key").cast("string") == one_row)), 1, table)
    assert table.compact() == 1
    after = files_of(tmp_path / "index" / "base")
    assert before < after  # nothing written before is touched
    assert {f.split("/")[1] for f in after - before} == {f"bucket={bucket_of(spark, one_row, 5)}"}
    kept = [c for k, c in enumerate(log) if k < 60 or c[0] == one_row]
    assert docs_of(table.documents()) == expected_docs(kept)
    # What no reader needs any more goes; readers find the same.
    assert table.vacuum() > 0 and not list((tmp_path / "index" / "changes" / "batches").iterdir())
    left = files_of(tmp_path / "index" / "base")
    folders = {f.rsplit("/", 1)[0] for f in left}
    assert len(folders) == len({f.split("/")[1] for f in folders})  # one of each bucket
    assert docs_of(table.documents()) == expected_docs(kept) and table.vacuum() == 0
    index_batch(cells.filter("seq >= 60"), 2, table)
    table.compact()
    assert docs_of(table.documents()) == expected_docs(log)


def arrive_all(spark, arrive, tmp_path):
    arrive[1](0, 90)
    return read_cells(spark, str(tmp_path / "in"))


def bucket_of(spark, row, of):
    return spark.range(1).select(F.pmod(F.xxhash64(F.lit(row)), F.lit(of))).first()[0]


def fault_of(text):
    if text.startswith("bad"):
        raise ValueError(text)
    return [("t", text)]


@pytest.mark.parametrize("compact", [False, True])
def test_faults_last_until_replaced(spark, tmp_path, cells, compact):
    extract = ExtractSpec("d:*", type="text/x", params={"parsers": {"text/x": fault_of}})
    spec = IndexSpec("table1", extracts=[extract], mapping="column", row_field="r", family_field="f")
    rows = [("r1", "d", "q", "bad 1", "Put"), ("r2", "d", "q", "bad 2", "Put"), ("r3", "d", "q", "bad 3", "Put"), ("r4", "d", "q", "bad 4", "Put")]
    rows += [("r1", "d", "q", "fine", "Put"), ("r2", "d", "q", "bad again", "Put"), ("r3", "d", "q", None, "DeleteRow"), ("r5", "d", "q", "fine", "Put")]
    log = cells(*rows)
    table = IndexTable(spark, str(tmp_path / "index"), spec)

    def faults():
        return {(r.id, r.error) for r in table.quarantine().collect()}

    assert table.quarantine() is None
    index_batch(log.filter("seq < 4"), 0, table)
    compact and table.compact()
    assert faults() == {(f"r{k}-d-q", f"ValueError: bad {k}") for k in (1, 2, 3, 4)}
    index_batch(log.filter("seq >= 4"), 1, table)
    wanted = {("r2-d-q", "ValueError: bad again"), ("r4-d-q", "ValueError: bad 4")}
    assert faults() == wanted
    compact and table.compact()
    assert faults() == wanted
    assert {r.id for r in table.documents().collect()} == {"r1-d-q", "r5-d-q"}


def test_schema_faults_of_documents_in_parts(spark, tmp_path, cells):
    """Counted once per document, however many parts it has; no part of it is published."""
    spec = IndexSpec("table1", [FieldSpec("one_s", "a:*"), FieldSpec("n_is", "b:*")], read_row="never", check_schema=True)
    log = [("r1", "a", f"q{k}", "x", "Put", 1) for k in range(7)] + [("r2", "a", "q", "x", "Put", 2), ("r3", "b", "q", "no number", "Put", 3)]
    log += [("r4", "b", f"q{k}", str(k), "Put", 4) for k in range(7)]
    table = IndexTable(spark, str(tmp_path / "index"), spec)
    changes = build.row_changes(cells(*log), spec, max_values=3)
    stored = table.write_batch(changes, 0)
    assert stored.filter("id = 'r1'").count() == 3
    assert {(r.id, r.error) for r in table.quarantine().collect()} == {("r1", "one_s: more than one value"), ("r3", "n_is: not a int")}
    assert {(r.id, r.part) for r in table.documents().collect()} == {("r2", 0), ("r4", 0), ("r4", 1), ("r4", 2)}
    from cellindex.operators import metrics

    observed = {}
    table.write_batch(changes, 0, observed=metrics.change_counts(changes), counts=observed)
    assert observed == metrics.change_counters(stored).first().asDict()
    counted = metrics.change_counters(stored).first()
    assert (counted.adds, counted.document_errors) == (2, 2)


def test_several_indexes_from_one_scan(spark, tmp_path, arrive):
    log, _ = arrive
    cells = arrive_all(spark, arrive, tmp_path)
    whole = IndexSpec("table1", COLUMN.fields, mapping="column")
    hexed = IndexSpec("table1", [FieldSpec("q", "b:*", source="qualifier")], mapping="column", row_field="row", family_field="fam", key_format="hex")
    specs = {"a": COLUMN, "b": whole, "c d": hexed, "none": IndexSpec("other", [FieldSpec("v", "a:*")], mapping="column")}
    built = build.multi_index(cells, specs)
    for name, spec in specs.items():
        one = build.column_index(cells, spec)
        got = build.of_index(built, name, spec)
        assert got.columns == one.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, one.collect())), name
    built.collect()
    plan = built._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1
    for wrong in ({}, {"row": ROW}):
        with pytest.raises(ValueError):
            build.multi_index(cells, wrong)


@pytest.mark.parametrize("cut", [[3], [1, 2], [2, 1], [1, 1, 1]])
@pytest.mark.parametrize("mode", ["column", "row"])
def test_spec_changes_while_indexing(spark, tmp_path, cells, mode, cut):
    """Two documents, not three, wherever the batches are cut; the spec comes from the table itself."""
    log = cells(("r1", "a", "q", "1", "Put"), ("r2", "b", "q", "2", "Put"), ("r3", "b", "q", "3", "Put"))
    old = IndexSpec("table1", [FieldSpec("f", "a:*")], mapping=mode)
    new = IndexSpec("table1", [FieldSpec("f", "a:*"), FieldSpec("g", "b:*")], mapping=mode)
    path, first = str(tmp_path / "index"), 0
    history.remember(spark, path, old)
    for n, size in enumerate(cut):
        if first <= 2 < first + size:
            history.remember(spark, path, new, since=2)
        batch = log.filter(f"seq >= {first} AND seq < {first + size}")
        index_batch(batch, n, history.open_table(spark, path), lambda s: reduce.live_cells(log))
        first += size
    tail = "-q" if mode == "column" else ""
    ends = {"column": ("r1-a-q", "r3-b-q"), "row": ("r1", "r3")}[mode]
    found = {r.id: (list(r.f), list(r.g)) for r in history.open_table(spark, path).documents().collect()}
    assert found == {ends[0]: (["1"], []), ends[1]: ([], ["3"])} and all(i.endswith(tail) for i in found)


def test_older_versions_lose_to_newer(spark, tmp_path, cells):
    """One row under both versions in one batch; the source has later cells of it."""
    log = cells(("r", "a", "q1", "1", "Put"), ("r", "b", "q", "2", "Put"), ("r", "a", "q2", "3", "Put"))
    old, new = IndexSpec("table1", [FieldSpec("f", "a:*")]), IndexSpec("table1", [FieldSpec("f", "a:*"), FieldSpec("g", "b:*")])
    path = str(tmp_path / "index")
    history.remember(spark, path, old)
    history.remember(spark, path, new, since=1)
    index_batch(log, 0, history.open_table(spark, path), lambda s: reduce.live_cells(log))
    assert [(list(r.f), list(r.g)) for r in history.open_table(spark, path).documents().collect()] == [(["1", "3"], ["2"])]


def test_stored_specs(spark, tmp_path):
    path = str(tmp_path / "index")
    spec = IndexSpec(
        "t", [FieldSpec("n_i", "a:q", type="int"), FieldSpec("d", "a:*", source="qualifier", type="bigdecimal", params={"scale": 3})],
        [ExtractSpec("d:*", prefix="x_", schema_fields=("a", "b"))], read_row="never", key_format="hex", check_schema=True,
    )
    assert IndexSpec.from_dict(spec.to_dict()) == spec
    with pytest.raises(ValueError):
        history.open_table(spark, path)
    with pytest.raises(SpecError):
        history.remember(spark, path, spec, since=4)
    history.remember(spark, path, spec)
    assert history.open_table(spark, path).spec == spec
    for wrong in (
        IndexSpec("other"), IndexSpec("t", mapping="column"), IndexSpec("t", [FieldSpec("f", "a:q", type=len)]), IndexSpec("t", key_format=object()),
        IndexSpec("t", extracts=[ExtractSpec("d:*", params={"parsers": {}})]),
    ):
        with pytest.raises(SpecError):
            history.remember(spark, path, wrong, since=9)
    again = IndexSpec("t", [FieldSpec("n_i", "a:q", type="long")])
    history.remember(spark, path, again)
    assert [v.spec for v in history.recall(spark, path)] == [again]


def test_failed_attempts_are_system_errors(spark, tmp_path, arrive, monkeypatch):
    cells = arrive_all(spark, arrive, tmp_path)
    table = IndexTable(spark, str(tmp_path / "index"), COLUMN)
    with monkeypatch.context() as broken:
        broken.setattr(IndexTable, "_note", lambda *a: (_ for _ in ()).throw(OSError("no space")))
        with pytest.raises(OSError):
            index_batch(cells, 0, table)
    index_batch(cells, 0, table)
    found = {r.metric: r.value for r in counters(table).collect()}
    assert found["system_errors"] == 1 and found["incoming_events"] == 90
    assert docs_of(table.documents()) == expected_docs(arrive[0])
