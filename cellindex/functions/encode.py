"""Encoders: Spark values to big-endian cell bytes, all inside the JVM.

They feed tables into cell form. Tests compare them byte for byte with
``struct.pack``, so they are checked apart from the decoders.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _low_bytes(bits: Column, size: int) -> Column:
    digits = F.lpad(F.hex(bits.cast("bigint")), 16, "0")
    return F.unhex(F.substring(digits, 17 - 2 * size, 2 * size))


def string_bytes(c: Column | str) -> Column:
    return _col(c).cast("string").cast("binary")


def long_bytes(c: Column | str) -> Column:
    return _low_bytes(_col(c), 8)


def int_bytes(c: Column | str) -> Column:
    return _low_bytes(_col(c), 4)


def short_bytes(c: Column | str) -> Column:
    return _low_bytes(_col(c), 2)


def boolean_bytes(c: Column | str) -> Column:
    return F.when(_col(c), F.lit(b"\xff")).otherwise(F.lit(b"\x00"))


def double_bytes(c: Column | str) -> Column:
    """IEEE-754 bytes, built from exponent and mantissa with exact powers of two."""
    x = _col(c).cast("double")
    size = F.abs(x)
    guess = F.floor(F.log2(size))
    scaled = size * F.pow(F.lit(2.0), (-guess).cast("double"))
    # log2 may round across a power of two; the scaled value settles it.
    exponent = guess + F.when(scaled >= 2.0, 1).when(scaled < 1.0, -1).otherwise(0)
    fraction = F.when(scaled >= 2.0, scaled / 2.0).when(scaled < 1.0, scaled * 2.0).otherwise(scaled) - 1.0
    normal = (exponent + 1023) * F.lit(1 << 52) + (fraction * float(1 << 52)).cast("bigint")
    # Two exact steps: 2^1074 itself is not a double.
    subnormal = (size * float(2**537) * float(2**537)).cast("bigint")
    bits = (
        F.when(F.isnan(x), F.lit(0x7FF8000000000000))
        .when(size == float("inf"), F.lit(0x7FF0000000000000))
        .when(size < 2.2250738585072014e-308, subnormal)
        .otherwise(normal)
    )
    negative = (x < 0) | ((x == 0) & (x.cast("string") == "-0.0"))
    signed = bits.bitwiseOR(F.when(negative, F.lit(-(1 << 63))).otherwise(F.lit(0)))
    return F.unhex(F.lpad(F.hex(signed), 16, "0"))


def decimal_bytes(unscaled: Column | str, scale: int) -> Column:
    """A decimal given as unscaled 64-bit integer and a fixed scale."""
    return F.concat(int_bytes(F.lit(scale)), long_bytes(unscaled))
