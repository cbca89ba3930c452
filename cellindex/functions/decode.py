"""Value decoders: cell bytes to typed, multi-valued fields.

Every decoder maps a BINARY column to an ARRAY column: one element, several, or
none when the bytes do not fit the type. All built-in decoders are plain
expressions, so they stay inside whole-stage codegen and never start a Python
worker.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellindex.spec import SpecError

Decoder = Callable[[Column, Mapping[str, Any]], Column]

# Type name -> Spark type of one decoded value.
SPARK_TYPES = {
    "int": "int",
    "long": "bigint",
    "short": "smallint",
    "float": "float",
    "double": "double",
    "boolean": "boolean",
    "string": "string",
}
DEFAULT_DECIMAL_SCALE = 18


def text(b: Column) -> Column:
    """UTF-8 text; broken byte sequences become replacement characters."""
    return F.make_valid_utf8(b.cast("string"))


def _unsigned(b: Column, start: int, size: int) -> Column:
    return F.conv(F.hex(F.substring(b, start, size)), 16, 10)


def _signed(b: Column, size: int) -> Column:
    if size == 8:
        return F.conv(F.hex(F.substring(b, 1, 8)), 16, -10).cast("bigint")
    raw = _unsigned(b, 1, size).cast("bigint")
    top = 1 << (8 * size - 1)
    return F.when(raw >= top, raw - 2 * top).otherwise(raw)


def _ieee(bits: Column, exponent_bits: int, mantissa_bits: int) -> Column:
    """Value of an IEEE-754 bit pattern; powers of two keep every step exact.

    The largest exponent overflows to infinity by itself.
    """
    bias = (1 << (exponent_bits - 1)) - 1
    full = (1 << exponent_bits) - 1
    exponent = F.shiftright(bits, mantissa_bits).bitwiseAND(F.lit(full))
    mantissa = bits.bitwiseAND(F.lit((1 << mantissa_bits) - 1))
    whole = mantissa + F.when(exponent == 0, F.lit(0)).otherwise(F.lit(1 << mantissa_bits))
    power = F.greatest(exponent, F.lit(1)) - (bias + mantissa_bits)
    size = whole.cast("double") * F.pow(F.lit(2.0), power.cast("double"))
    magnitude = bits.bitwiseAND(F.lit((1 << (exponent_bits + mantissa_bits)) - 1))
    is_nan = magnitude > F.lit(full << mantissa_bits)
    return F.when(is_nan, F.lit(float("nan"))).otherwise(F.when(bits < 0, -1.0).otherwise(1.0) * size)


def _fixed(size: int, value: Callable[[Column], Column], spark_type: str) -> Decoder:
    """A decoder of ``size`` leading bytes; shorter input has no value."""

    def decode(b: Column, params: Mapping[str, Any]) -> Column:
        return _if(F.length(b) >= size, value(b).cast(spark_type), spark_type)

    return decode


def _if(ok: Column, value: Column, spark_type: str) -> Column:
    return F.when(ok, F.array(value)).otherwise(F.array().cast(f"array<{spark_type}>"))


def _boolean(b: Column, params: Mapping[str, Any]) -> Column:
    return _if(F.length(b) == 1, b != F.lit(b"\x00"), "boolean")


def _string(b: Column, params: Mapping[str, Any]) -> Column:
    return _if(b.isNotNull(), text(b), "string")


def _decimal(b: Column, params: Mapping[str, Any]) -> Column:
    """Four scale bytes, then a two's complement number of any length.

    Numbers are read as two 64-bit halves, which covers DECIMAL(38); wider ones, and
    those that the scale cannot hold exactly, have no value.
    """
    scale = int(params.get("scale", DEFAULT_DECIMAL_SCALE))
    spark_type = f"decimal(38,{scale})"
    digits = F.hex(F.substring(b, 5, 1 << 30))
    fill = F.when(F.substring(digits, 1, 1) >= "8", F.lit("F")).otherwise(F.lit("0"))
    wide = F.concat(F.repeat(fill, F.lit(32)), digits)
    low = F.right(wide, F.lit(16))
    high = F.substring(wide, -32, 16)
    # Digits before the last 32 must only repeat the sign; so must bit 127.
    extra = F.greatest(F.length(digits) - 32, F.lit(0))
    lead = F.left(digits, extra) == F.repeat(fill, extra)
    signed_high = F.conv(high, 16, -10).cast("decimal(20,0)")
    unscaled = F.try_add(
        F.try_multiply(signed_high, F.lit(str(1 << 64)).cast("decimal(20,0)")),
        F.conv(low, 16, 10).cast("decimal(20,0)"),
    )
    same_sign = F.when(F.substring(high, 1, 1) >= "8", F.lit("F")).otherwise(F.lit("0")) == fill
    number = F.concat(unscaled.cast("string"), F.lit("E"), (-_signed(b, 4)).cast("string")).try_cast(spark_type)
    # Digits beyond the scale must be zeros, else the number would be rounded.
    digits_out = unscaled.cast("string")
    zeros = F.length(digits_out) - F.length(F.rtrim(digits_out, F.lit("0")))
    exact = (unscaled == 0) | (zeros >= _signed(b, 4) - scale)
    ok = (F.length(b) > 4) & lead & same_sign & number.isNotNull() & exact
    return _if(F.coalesce(ok, F.lit(False)), number, spark_type)


def _csv(b: Column, params: Mapping[str, Any]) -> Column:
    """Comma-separated values, then the configured default entries."""
    line = text(b)
    kept = F.regexp_replace(line, ",+$", "")
    parts = F.when((kept == "") & (line != ""), F.array().cast("array<string>")).otherwise(
        F.split(kept, ",", -1)
    )
    defaults = [d for d in params.get("defaults", "").split(",") if params.get("defaults")]
    extra = F.array(*[F.lit(d) for d in defaults]).cast("array<string>")
    return F.when(b.isNull(), F.array().cast("array<string>")).otherwise(F.concat(parts, extra))


_DECODERS: dict[str, Decoder] = {
    "int": _fixed(4, lambda b: _signed(b, 4), "int"),
    "long": _fixed(8, lambda b: _signed(b, 8), "bigint"),
    "short": _fixed(2, lambda b: _signed(b, 2), "smallint"),
    "float": _fixed(4, lambda b: _ieee(_signed(b, 4), 8, 23), "float"),
    "double": _fixed(8, lambda b: _ieee(_signed(b, 8), 11, 52), "double"),
    "boolean": _boolean,
    "string": _string,
    "bigdecimal": _decimal,
    "csv": _csv,
}


def register_decoder(name: str, decoder: Decoder) -> None:
    """Add a value mapper of your own: (bytes column, params) -> ARRAY column."""
    _DECODERS[name] = decoder


def decode(b: Column, type: str | Decoder, params: Mapping[str, Any] | None = None) -> Column:
    """Decode bytes as ``type``: a built-in or registered name, or a function."""
    decoder = type if callable(type) else _DECODERS.get(type)
    if decoder is None:
        raise SpecError(f"no value mapper is called '{type}'")
    return decoder(b, params or {})
