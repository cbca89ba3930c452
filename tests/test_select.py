import datetime as dt

from cellindex.operators import select
from cellindex.sources.cells import read_cells, write_cells
from cellindex.spec import ExtractSpec, FieldSpec, IndexSpec, Target
from pyspark.sql import functions as F

NAMES = ["A", "AB", "ABB", "ABC", "AC", "AAC", "ACC"]


def qualifiers(df):
    return sorted(bytes(r.qualifier).decode() for r in df.collect())


def test_prefixes_and_columns(cells):
    log = cells(*[("r", "cf", n, "v", "Put") for n in NAMES], ("r", "other", "AB", "v", "Put"))
    match = lambda text: qualifiers(log.filter(select.matches(Target.parse(text))))
    assert match("cf:AB*") == ["AB", "ABB", "ABC"]
    assert match("cf:ABC*") == ["ABC"]
    assert match("cf:X*") == []
    assert match("cf:*") == sorted(NAMES)
    assert match("cf:AB") == ["AB"]


def test_prefix_of_high_bytes(cells):
    log = cells(*[("r", "cf", q, "v", "Put") for q in (b"\xfe", b"\xff", b"\xff\xff", b"\xff\x01", b"a\xff", b"a\xffz", b"b")])
    found = lambda q: {bytes(r.qualifier) for r in log.filter(select.matches(Target(b"cf", q, True))).collect()}
    assert found(b"\xff") == {b"\xff", b"\xff\xff", b"\xff\x01"}
    assert found(b"a\xff") == {b"a\xff", b"a\xffz"}


def test_relevance_covers_extracts(cells):
    spec = IndexSpec("table1", [FieldSpec("f", "cf:a")], [ExtractSpec("doc:*")])
    log = cells(("r", "cf", "a", "v", "Put"), ("r", "cf", "b", "v", "Put"), ("r", "doc", "z", "v", "DeleteColumn"))
    assert qualifiers(log.filter(select.relevant(spec))) == ["a", "z"]


def test_row_events(cells):
    """A delete of any kind in any family makes an event count in row mode."""
    spec = IndexSpec("table1", [FieldSpec("f", "cf:a")])
    log = cells(
        ("r", "cf", "a", "v", "Put", 0), ("r", "cf", "b", "v", "Put", 0),
        ("r", "cf", "b", "v", "Put", 1),
        ("r", "x", "y", "v", "DeleteFamily", 2),
    )
    assert {r.event_id: r.is_relevant for r in select.relevant_events(log, spec).collect()} == {0: True, 1: False, 2: True}


def test_complete_events(cells):
    spec = IndexSpec("table1", [FieldSpec("f", "cf:a"), FieldSpec("g", "cf:b")])
    log = cells(
        ("r", "cf", "a", "v", "Put", 0), ("r", "cf", "b", "v", "Put", 0),
        ("r", "cf", "a", "v", "Put", 1), ("r", "cf", "b", "v", "DeleteColumn", 1),
    )
    assert {r.event_id: r.is_complete for r in select.complete_events(log, spec).collect()} == {0: True, 1: False}
    prefixed = IndexSpec("table1", [FieldSpec("f", "cf:a*")])
    assert not any(r.is_complete for r in select.complete_events(log, prefixed).collect())


def test_cutoff_is_strict(spark):
    moment = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(moment,), (moment + dt.timedelta(seconds=1),)], "ts timestamp")
    assert df.filter(select.after(moment)).count() == 1


def test_predicates_reach_the_scan(cells, spark, tmp_path, capsys):
    spec = IndexSpec("table1", [FieldSpec("f", "cf:AB*"), FieldSpec("g", "cf:Z")])
    write_cells(cells(*[("r", "cf", n, "v", "Put") for n in NAMES]), str(tmp_path / "log"))
    log = read_cells(spark, str(tmp_path / "log"))
    found = log.filter(select.of_table(spec)).filter(select.relevant(spec)).select("row_key", "qualifier")
    found.explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "EqualTo(tbl,table1)" in pushed and "GreaterThanOrEqual(qualifier" in pushed
    assert "value" not in next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert qualifiers(found) == ["AB", "ABB", "ABC"]
    assert found.agg(F.count("*")).first()[0] == 3
