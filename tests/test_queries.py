"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) or hasattr(value, "as_tuple"):
        return round(float(value), 6)
    return value


def in_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, db, name):
    result = entry.queries()[name](spark, FOLDER)
    rows = in_order(result.columns, result.collect())
    assert rows
    sql = entry.oracle_sql().get(name)
    if sql is not None:
        expected = db.execute(sql)
        columns = [c[0] for c in expected.description]
        assert sorted(columns) == sorted(result.columns)
        assert rows == in_order(columns, expected.fetchall())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
