import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellindex.functions.keys import HEX, STRING, key_format
from cellindex.spec import SpecError

PARTS = ("row_key", "family", "qualifier")


def frame(spark, rows):
    return spark.createDataFrame([(i, *map(bytearray, r)) for i, r in enumerate(rows)], "i int, row_key binary, family binary, qualifier binary")


def test_formats(spark):
    df = frame(spark, [(b"ro-w", b"c-f", b"quali-fier"), (bytes([161]), bytes([177]), bytes([193]))])
    cols = [F.col(p) for p in PARTS]
    first, second = df.orderBy("i").select(
        STRING.cell(*cols).alias("s"), HEX.cell(*cols).alias("h"), STRING.row(cols[0]).alias("r"), HEX.family(cols[1]).alias("f")
    ).collect()
    assert (first.s, first.r) == ("ro\\-w-c\\-f-quali\\-fier", "ro-w")
    assert (second.h, second.f) == ("a1-b1-c1", "b1")


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    texts=st.lists(st.tuples(*[st.text(alphabet="ab-é:*", max_size=6)] * 3), min_size=20, max_size=20),
    raw=st.lists(st.tuples(*[st.binary(max_size=6)] * 3), min_size=20, max_size=20),
)
def test_round_trips(spark, texts, raw):
    for fmt, rows in ((STRING, [tuple(t.encode() for t in row) for row in texts]), (HEX, raw)):
        key = fmt.cell(*(F.col(p) for p in PARTS))
        back = frame(spark, rows).select("i", fmt.must_parse_cell(key).alias("k")).orderBy("i").collect()
        assert [tuple(bytes(r.k[p]) for p in PARTS) for r in back] == rows


def test_malformed_keys(spark):
    df = spark.createDataFrame([("a-b",), ("a-b-c-d",), ("zz-11-22",), ("abc-11-22",)], "k string")
    assert [r.p is None for r in df.select(STRING.parse_cell(F.col("k")).alias("p")).collect()] == [True, True, False, False]
    assert [r.p is None for r in df.select(HEX.parse_cell(F.col("k")).alias("p")).collect()] == [True] * 4
    with pytest.raises(Exception, match="not a row, family and qualifier"):
        df.select(HEX.must_parse_cell(F.col("k"))).collect()


def test_names():
    assert key_format("hex") is HEX
    with pytest.raises(SpecError):
        key_format("base64")
