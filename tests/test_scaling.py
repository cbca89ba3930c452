"""Steps that once read their input again or left it to few tasks."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cellindex.catalog import streams
from cellindex.operators import lookup, skew
from cellindex.plans import reads
from cellindex.plans.table import IndexTable
from cellindex.sources.cells import CELL_SCHEMA, without_dictionary, write_by_row


@pytest.fixture
def counted(spark):
    """Documents in parts, and how many of them were made."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<string>", useArrow=False)
    def values(n):
        made.add(1)
        return [f"v{n}"]

    number = F.when(F.col("id") != 7, F.format_string("d%03d", F.floor(F.col("id") / 2)))
    docs = spark.range(100).select(number.alias("id"), (F.col("id") % 2).alias("part"), values("id").alias("a_s"))
    return docs, made


def test_documents_in_parts_are_made_once_to_be_judged(counted):
    docs, made = counted
    rows = lookup.typed(docs, ["a_s"]).collect()
    assert made.value <= 100
    assert {(r.id, r.part, r.a_s, r.error) for r in rows} == {
        (f"d{n // 2:03d}", n % 2, f"v{n}", None if n == 6 else "a_s: more than one value") for n in range(100) if n != 7
    }


def test_documents_are_made_once_to_be_laid_out(spark, counted, tmp_path):
    docs, made = counted
    reads.write(docs.filter("id IS NOT NULL"), str(tmp_path / "copy"), ["a_s"], buckets=4)
    assert made.value <= 100
    assert [r.id for r in reads.find(spark, str(tmp_path / "copy"), {"a_s": "v5"}).filter("part = 1").collect()] == ["d002"]


def test_a_batch_of_a_large_log_has_many_files(spark, tmp_path, monkeypatch):
    at = F.floor(F.col("id") / 4)  # four cells an event
    text = F.concat(F.lit("r"), at.cast("string")).cast("binary")
    cells = spark.range(4000).select(
        F.lit("orders").alias("tbl"), text.alias("row_key"), F.lit(b"item").alias("family"),
        F.format_string("02-%d", F.col("id")).cast("binary").alias("qualifier"), text.alias("value"), F.lit("Put").alias("op"),
        F.lit(None).cast("timestamp").alias("ts"), at.alias("seq"), at.alias("event_id"),
    )
    cells = skew.cut_lineage(cells.select(*CELL_SCHEMA.fieldNames()), "cells")
    monkeypatch.setattr(skew, "ONE_TASK_BYTES", 2000)
    path = str(tmp_path / "in")
    files = streams._arrive(cells, path, 2)
    assert files > 3 and len(list(Path(path).glob("*.parquet"))) == 2 * files
    placed = spark.read.parquet(path).select("seq", "_metadata.file_name").toDF("seq", "file").groupBy("seq").agg(F.count_distinct("file").alias("n"))
    assert placed.filter("n > 1").count() == 0
    table = IndexTable(spark, str(tmp_path / "index"), streams.CHECKED_ORDER)
    streams._run(spark, path, table, str(tmp_path / "checkpoint"), files)
    assert spark.read.parquet(str(tmp_path / "index/batches")).count() == 2
    assert table.documents().filter(F.size("lines_ss") == 4).count() == 1000


def _cells_of(spark, n, key, qualifier):
    """``n`` cells of eight tasks; ``key`` and ``qualifier`` are columns over ``id``."""
    return spark.range(0, n, 1, 8).select(
        F.lit("orders").alias("tbl"), key.cast("binary").alias("row_key"), F.lit(b"item").alias("family"),
        qualifier.cast("binary").alias("qualifier"), F.lit(b"v").alias("value"), F.lit("Put").alias("op"),
        F.lit(None).cast("timestamp").alias("ts"), F.col("id").alias("seq"), F.col("id").alias("event_id"),
    )


def test_a_source_table_is_read_once_to_be_laid_out_by_row(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string", useArrow=False)
    def name(n):
        made.add(1)
        return f"q{n}"

    key = F.when(F.col("id") % 10 != 7, F.format_string("r%03d", F.col("id") % 10))  # a row without key stays too
    cells = _cells_of(spark, 100, key, name("id"))
    path = str(tmp_path / "by-row")
    write_by_row(cells, path, 4, options=without_dictionary("qualifier"))
    assert made.value <= 100
    laid = spark.read.parquet(path)
    assert laid.columns == [*CELL_SCHEMA.fieldNames(), "row_bucket_of_4"]
    assert {(r.row_key and bytes(r.row_key).decode(), bytes(r.qualifier).decode()) for r in laid.collect()} == {
        (None if n % 10 == 7 else f"r{n % 10:03d}", f"q{n}") for n in range(100)
    }
    assert laid.filter(F.col("row_bucket_of_4") != F.pmod(F.xxhash64("row_key"), F.lit(4))).count() == 0


def test_a_large_row_is_laid_out_by_several_tasks_each_sorted(spark, tmp_path):
    hot = F.when(F.col("id") % 4 != 0, F.lit("hot")).otherwise(F.format_string("r%05d", F.xxhash64("id") % 500))
    cells = skew.cut_lineage(_cells_of(spark, 20000, hot, F.format_string("q%05d", F.pmod(F.xxhash64("id"), F.lit(90000)))), "cells")
    path, sizes = str(tmp_path / "by-row"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(sizes)
    spark.conf.set(sizes, "20k")
    try:
        write_by_row(cells, path, 4)
    finally:
        spark.conf.set(sizes, before)
    laid = spark.read.parquet(path)
    assert laid.count() == 20000 and laid.drop("row_bucket_of_4").exceptAll(cells).count() == 0
    files = laid.filter(F.col("row_key") == F.lit(b"hot")).select(F.input_file_name()).distinct().count()
    assert files > 1
    for file in Path(path).rglob("*.parquet"):
        keys = [(bytes(r.row_key), bytes(r.qualifier)) for r in spark.read.parquet(str(file)).select("row_key", "qualifier").coalesce(1).collect()]
        assert keys == sorted(keys)
