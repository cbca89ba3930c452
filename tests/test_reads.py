"""Lookups over a layout for reads: the rows that a scan finds, from a small part of the files."""

import math

import pytest
from pyspark.sql import functions as F

from cellindex.operators import lookup
from cellindex.plans import reads

SMALL = {"parquet.block.size": "65536", "parquet.page.size": "4096", "parquet.page.row.count.limit": "500"}


def rows_read(df):
    """Rows that scans of ``df`` gave to the next operator, after files and row groups were skipped."""
    df.collect()
    total = 0

    def walk(plan):
        nonlocal total
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(plan.plan())
        if name == "FileSourceScanExec":
            total += plan.metrics().apply("numOutputRows").value()
        children = plan.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return total


def same(found, expected):
    def key(rows):
        return sorted((tuple(map(repr, r)) for r in rows))

    assert found.columns == expected.columns
    assert key(found.collect()) == key(expected.collect())


@pytest.fixture(scope="module")
def docs(spark):
    n = F.col("id")
    return spark.range(40_000).select(
        F.concat(F.lit("d-"), n.cast("string")).alias("id"),
        F.lit(0).cast("long").alias("part"),
        F.array(F.concat(F.lit("t"), (n % 4000).cast("string")), F.when(n % 3 == 0, F.lit("hot"))).alias("tags"),
        (n / 8).alias("size"),
        F.when(n % 5 != 0, n.cast("int")).alias("number"),
    )


@pytest.fixture(scope="module")
def path(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("reads") / "index")
    reads.write(docs, path, ["tags", "size", "number"], buckets=128, options=SMALL)
    return path


@pytest.mark.parametrize(
    "wanted",
    [
        {"tags": "t17"},
        {"tags": "t18", "number": 4018},
        {"tags": "t18", "number": 4019},
        {"size": 12.5},
        {"number": 5},
        {"id": "d-77"},
        {"id": "d-77", "tags": "t77"},
        {"id": "d-77", "tags": "t78"},
        {"id": "unknown"},
        {"tags": "unknown"},
        {"tags": "hot"},
        {"tags": "hot", "number": 33},
        {},
    ],
    ids=str,
)
def test_the_rows_of_a_scan(spark, docs, path, wanted):
    same(reads.find(spark, path, wanted), lookup.find(docs, wanted))


def test_few_rows_are_read(spark, docs, path):
    whole = docs.count()
    assert rows_read(reads.find(spark, path, {})) == whole  # the measure itself
    for wanted in ({"tags": "t17"}, {"id": "d-77"}, {"size": 12.5}):
        assert 0 < rows_read(reads.find(spark, path, wanted)) < whole / 10
    terms = reads._matched(spark, path, {"tags": "t17"}, {f.name: f.dataType for f in docs.schema.fields}, "id")
    assert 0 < rows_read(terms) < whole / 10


def test_a_hot_term_lies_in_several_files(spark, docs, tmp_path):
    hot, where = docs.withColumn("tags", F.array(F.lit("hot"))), str(tmp_path / "x")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # too small to need several tasks
    try:
        reads.write(hot, where, ["tags"], buckets=2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(f"{where}/terms").select(F.input_file_name()).distinct().count()
    assert files > 1
    same(reads.find(spark, where, {"tags": "hot"}), hot)


def test_parts_hold_the_terms_together(spark, tmp_path):
    docs = spark.createDataFrame(
        [("a", 0, ["x"]), ("a", 1, ["y"]), ("b", 0, ["x", "x"]), ("c", 0, ["y"]), ("d", 0, None), (None, 0, ["x"])],
        "id string, part long, tags array<string>",
    )
    reads.write(docs, str(tmp_path / "x"), ["tags"], buckets=4)
    assert sorted(r.part for r in reads.find(spark, str(tmp_path / "x"), {"tags": "x"}).filter("id = 'a'").collect()) == [0, 1]
    twice = docs.select("id", "part", "tags", F.col("tags").alias("more"))
    reads.write(twice, str(tmp_path / "y"), ["tags", "more"], buckets=4)
    assert {(r.id, r.part) for r in reads.find(spark, str(tmp_path / "y"), {"tags": "x", "more": "y"}).collect()} == {("a", 0), ("a", 1)}


def test_values_of_other_kinds(spark, tmp_path):
    docs = spark.createDataFrame(
        [("a", -0.0, b"\x00\x01", 1), ("b", math.nan, b"", 2), ("c", None, None, None)], "id string, d double, raw binary, n int"
    )
    where = str(tmp_path / "x")
    reads.write(docs, where, ["d", "raw", "n"], buckets=4)
    for wanted in ({"d": 0.0}, {"d": math.nan}, {"raw": bytearray(b"\x00\x01")}, {"raw": bytearray()}, {"n": 1.5}, {"n": 2.0}):
        same(reads.find(spark, where, wanted), lookup.find(docs, wanted))
    with pytest.raises(ValueError, match="other"):
        reads.find(spark, where, {"other": 1})
    with pytest.raises(ValueError):
        reads.write(docs, where, [])


def test_an_empty_index(spark, tmp_path):
    docs = spark.createDataFrame([], "id string, part long, tags array<string>")
    reads.write(docs, str(tmp_path / "x"), ["tags"])
    for wanted in ({"tags": "x"}, {"id": "a"}, {}):
        assert reads.find(spark, str(tmp_path / "x"), wanted).collect() == []
