import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [str(ROOT), os.environ.get("PYTHONPATH")]))

from pyspark.sql import SparkSession  # noqa: E402

from cellindex.plans.scratch import cleanup  # noqa: E402
from cellindex.sources.cells import CELL_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("cellindex-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    cleanup(session)
    assert not list(Path(session.conf.get("spark.checkpoint.dir")).rglob("*.parquet")), "scratch tables are left"
    session.stop()


@pytest.fixture
def jobs(spark):
    """The number of jobs started so far."""
    tracker = spark.sparkContext._jsc.sc().statusStore()
    bus = spark.sparkContext._jsc.sc().listenerBus()

    def count():
        bus.waitUntilEmpty()
        return tracker.jobsList(None).size()

    return count


@pytest.fixture
def cells(spark):
    """Build a cell log from (row, family, qualifier, value, op[, event]) tuples in order."""

    def build(*rows, tbl="table1"):
        data = []
        for seq, row in enumerate(rows):
            key, family, qualifier, value, op, *event = row
            as_bytes = [x.encode() if isinstance(x, str) else x for x in (key, family, qualifier, value)]
            data.append((tbl, *as_bytes, op, None, seq, event[0] if event else seq))
        return spark.createDataFrame(data, CELL_SCHEMA)

    return build


@pytest.fixture
def salted(monkeypatch):
    """Treat keys as hot from a handful of rows, so that small tests spread them."""
    from cellindex.operators import skew

    monkeypatch.setattr(skew, "MIN_HOT_ROWS", 3)
    monkeypatch.setattr(skew, "HOT_SHARE", 10)
