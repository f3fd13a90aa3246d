"""Shard numbers: a digest of a name, taken as one big number, modulo n.

A digest is folded eight hexadecimal digits at a time, so every intermediate stays below
2**63 while n < 2**31.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = {"md5": 32, "sha1": 40, "sha256": 64}


def digest(name: Column, kind: str) -> Column:
    if kind == "md5":
        return F.md5(name)
    if kind == "sha1":
        return F.sha1(name)
    return F.sha2(name, 256)


def hex_mod(digits: Column, length: int, n: int) -> Column:
    out = F.lit(0).cast("bigint")
    for at in range(1, length + 1, 8):
        out = (out * F.lit(1 << 32) + F.conv(F.substring(digits, at, 8), 16, 10).cast("bigint")) % F.lit(n)
    return out


def shard(name: Column, n: int, kind: str = "md5") -> Column:
    """Number of the shard of a name, 0 to n - 1, as INT."""
    if not 0 < n < 1 << 31:
        raise ValueError("n is between 1 and 2**31 - 1")
    return hex_mod(digest(name, kind), DIGITS[kind], n).cast("int")


def shard_dir(name: Column, n: int, kind: str = "md5") -> Column:
    """Directory of a shard: md5 ``bucket=`` padded to the width of n - 1, sha1 (of the base name) ``bucket=`` padded to four, sha256 the bare number."""
    if kind == "sha256":
        return shard(name, n, kind).cast("string")
    if kind == "sha1":
        base = F.substring_index(name, "/", -1)
        return F.concat(F.lit("bucket="), F.format_string("%04d", shard(base, n, kind)))
    return F.concat(F.lit("bucket="), F.lpad(shard(name, n, kind).cast("string"), len(str(n - 1)), "0"))
