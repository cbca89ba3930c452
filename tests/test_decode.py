import math
import struct
from decimal import Context, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellindex.functions import encode
from cellindex.functions.decode import decode, register_decoder
from cellindex.spec import SpecError

# Type -> struct format of its big-endian bytes.
FORMATS = {"int": ">i", "long": ">q", "short": ">h", "float": ">f", "double": ">d"}
ENCODERS = {
    "int": encode.int_bytes,
    "long": encode.long_bytes,
    "short": encode.short_bytes,
    "double": encode.double_bytes,
}
slow = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def decoded(spark, type, *values, params=None):
    rows = [(i, bytearray(v) if v is not None else None) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, b binary")
    return [list(r.v) for r in df.select("i", decode(F.col("b"), type, params).alias("v")).orderBy("i").collect()]


def same(a, b):
    return a == b and math.copysign(1, a) == math.copysign(1, b) or (math.isnan(a) and math.isnan(b))


@slow
@given(data=st.data())
@pytest.mark.parametrize("type,bits", [("int", 32), ("long", 64), ("short", 16)])
def test_integers(spark, type, bits, data):
    edge = [0, 1, -1, 42, (1 << bits - 1) - 1, -(1 << bits - 1)]
    some = data.draw(st.lists(st.integers(-(1 << bits - 1), (1 << bits - 1) - 1), min_size=50, max_size=50))
    values = edge + some
    packed = [struct.pack(FORMATS[type], v) for v in values]
    assert decoded(spark, type, *packed) == [[v] for v in values]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v bigint")
    ours = [bytes(r.b) for r in df.select("i", ENCODERS[type]("v").alias("b")).orderBy("i").collect()]
    assert ours == packed


@slow
@given(some=st.lists(st.floats(), min_size=100, max_size=100))
def test_doubles(spark, some):
    powers = [2.0**k for k in range(-1074, 1024, 7)]
    values = some + powers + [math.nextafter(p, 0) for p in powers] + [0.0, -0.0, math.inf, -math.inf, math.nan]
    packed = [struct.pack(">d", v) for v in values]
    assert all(same(a[0], b) for a, b in zip(decoded(spark, "double", *packed), values))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    ours = [bytes(r.b) for r in df.select("i", encode.double_bytes("v").alias("b")).orderBy("i").collect()]
    assert all(a == b or math.isnan(v) for a, b, v in zip(ours, packed, values))


@slow
@given(some=st.lists(st.floats(width=32), min_size=100, max_size=100))
def test_floats(spark, some):
    values = some + [0.0, -0.0, 4.199999809265137, math.inf, -math.inf, math.nan, 2.0**-149, -(2.0**-130)]
    got = decoded(spark, "float", *(struct.pack(">f", v) for v in values))
    assert all(same(a[0], b) for a, b in zip(got, values))


def test_text_and_booleans(spark):
    assert decoded(spark, "string", "forty-two".encode(), b"", b"a\xffb") == [["forty-two"], [""], ["a�b"]]
    assert decoded(spark, "boolean", b"\xff", b"\x00", b"\x01", b"", b"\x00\x01") == [[True], [False], [True], [], []]


def test_wrong_lengths(spark):
    four = struct.pack(">i", 42)
    assert decoded(spark, "long", four) == [[]]
    assert decoded(spark, "double", four, b"") == [[], []]
    assert decoded(spark, "int", four + b"more", b"\x01") == [[42], []]
    assert decoded(spark, "long", struct.pack(">q", -7) + b"\xff") == [[-7]]
    assert decoded(spark, "int", None) == [[]]


def big_decimal(unscaled, scale):
    return struct.pack(">i", scale) + unscaled.to_bytes(unscaled.bit_length() // 8 + 1, "big", signed=True)


def test_decimals(spark):
    cases = [(1234, 3), (-1234, 3), (0, 0), (5, -2), (10**37 - 1, 0), (-(10**30), 10), (1 << 64, 2), (-(1 << 63), 0)]
    got = decoded(spark, "bigdecimal", *(big_decimal(u, s) for u, s in cases), params={"scale": 0})
    wide = Context(prec=60)
    exact = [Decimal(u).scaleb(-s, wide) for u, s in cases]
    # What the scale cannot hold exactly has no value.
    whole = [[e.quantize(Decimal(1), "ROUND_HALF_UP", wide)] if e == e.to_integral_value() else [] for e in exact]
    assert [list(g) for g in got] == whole and [] in whole and whole[0] == []
    assert decoded(spark, "bigdecimal", big_decimal(1234, 3), params={"scale": 3}) == [[Decimal("1.234")]]


def test_decimals_out_of_range(spark):
    wide = [big_decimal(10**40, 0), big_decimal(-(1 << 200), 0), b"\x00\x00\x00\x02", b"\x00"]
    assert decoded(spark, "bigdecimal", *wide) == [[], [], [], []]
    padded = struct.pack(">i", 1) + (-15).to_bytes(24, "big", signed=True)
    assert decoded(spark, "bigdecimal", padded, params={"scale": 1}) == [[Decimal("-1.5")]]


def test_csv(spark):
    lines = [b"blue,green,black,orange", b"a,,", b"", b",,", b",a"]
    assert decoded(spark, "csv", *lines, params={"defaults": "d1,d2"}) == [
        ["blue", "green", "black", "orange", "d1", "d2"],
        ["a", "d1", "d2"],
        ["", "d1", "d2"],
        ["d1", "d2"],
        ["", "a", "d1", "d2"],
    ]
    assert decoded(spark, "csv", b"x,y") == [["x", "y"]]


def test_own_decoders(spark):
    register_decoder("length", lambda b, params: F.array(F.length(b) + params.get("plus", 0)))
    assert decoded(spark, "length", b"abc", params={"plus": 1}) == [[4]]
    assert decoded(spark, lambda b, params: F.array(F.hex(b)), b"\x0a") == [["0A"]]
    with pytest.raises(SpecError):
        decode(F.lit(b""), "no.such.Type")
