"""Unsigned 64-bit values on Spark's signed types.

The inner form of a value v is the BIGINT with the same 64 bits, so equality,
grouping and joins need nothing; order, modulus and display have functions here.
All are built-in expressions that stay in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_63 = 1 << 63
TWO_64 = 1 << 64


def _dec(v: int) -> Column:
    return F.lit(str(v)).cast("decimal(38,0)")


def wrap(c: Column) -> Column:
    """Any whole decimal, taken modulo 2**64, in the inner form; negatives wrap as two's complement."""
    d = c.cast("decimal(38,0)")
    m = F.pmod(d, _dec(TWO_64))
    return F.when(m >= _dec(TWO_63), m - _dec(TWO_64)).otherwise(m).cast("bigint")


def from_decimal(c: Column) -> Column:
    """The inner form of a DECIMAL(20,0) in [0, 2**64), as Spark reads Parquet's UINT_64."""
    return F.when(c >= _dec(TWO_63), c - _dec(TWO_64)).otherwise(c).cast("bigint")


def to_decimal(c: Column) -> Column:
    """The unsigned value of the inner form as DECIMAL(20,0)."""
    d = c.cast("decimal(21,0)")
    return F.when(c < 0, d + _dec(TWO_64)).otherwise(d).cast("decimal(20,0)")


def to_string(c: Column) -> Column:
    """The unsigned value in decimal digits."""
    return to_decimal(c).cast("string")


def mod(c: Column, m: int) -> Column:
    """Unsigned value modulo m, 0 < m < 2**31, as INT."""
    return F.when(c < 0, F.pmod(c % F.lit(m) + F.lit(TWO_64 % m), F.lit(m))).otherwise(c % F.lit(m)).cast("int")


def order_key(c: Column) -> Column:
    """A BIGINT whose signed order is the unsigned order of the values."""
    return c.bitwiseXOR(F.lit(-TWO_63))


def from_hex(c: Column) -> Column:
    """The inner form of up to 16 hexadecimal digits."""
    padded = F.lpad(c, 16, "0")
    high = F.conv(F.substring(padded, 1, 8), 16, 10).cast("bigint")
    low = F.conv(F.substring(padded, 9, 8), 16, 10).cast("bigint")
    return F.shiftleft(high, 32).bitwiseOR(low)
