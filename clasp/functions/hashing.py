"""Stable, partitioning-independent hash bucket of a key (used by M13b), and
the bucket of a term as hashed vectors have it (M3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_bucket(key: Column | str, buckets: int = 100, salt: str = "") -> Column:
    """First 32 bits of ``md5(salt || key)`` modulo ``buckets``.

    Same value on every run, cluster size and partitioning (unlike
    ``randomSplit``), and equal to the SQL form
    ``('0x' || substr(md5(k), 1, 8))::bigint % buckets``.
    """
    k = F.col(key) if isinstance(key, str) else key
    if salt:
        k = F.concat(F.lit(salt), k.cast("string"))
    hex8 = F.substring(F.md5(k.cast("string")), 1, 8)
    return (F.conv(hex8, 16, 10).cast("bigint") % F.lit(buckets)).cast("int")


# The public MurmurHash3 (x86, 32 bits), seed 42.
_SEED, _MASK = 42, 0xFFFFFFFF
_C1, _C2, _F1, _F2 = 0xCC9E2D51, 0x1B873593, 0x85EBCA6B, 0xC2B2AE35


def _times(x: Column, c: int) -> Column:
    """x * c mod 2^32 of numbers below 2^32, without overflow of a long."""
    low = x * F.lit(c & 0xFFFF)
    high = (x * F.lit(c >> 16)).bitwiseAND(F.lit(0xFFFF))
    return (low + F.shiftleft(high, 16)).bitwiseAND(F.lit(_MASK))


def _fold(x: Column, *shifts: int) -> Column:
    for s in shifts:
        x = x.bitwiseXOR(F.shiftrightunsigned(F.col("_h"), s))
    return x


def with_term_bucket(df: DataFrame, term: str, buckets: int, out: str = "bucket") -> DataFrame:
    """``out``: the bucket of a text as ``HashingTF`` numbers it, in built-in
    expressions only.

    That hash takes the bytes left over after the last whole group of four as
    one group; Spark's ``hash`` takes them one by one. Both agree on the whole
    groups, so their state is had from ``hash`` by undoing its last mixing
    (every step of which can be undone mod 2^32); the left-over bytes and the
    last mixing of the whole length follow. Null terms give null."""
    h, n = F.col("_h"), F.col("_n")
    back1, back2 = pow(_F2, -1, _MASK + 1), pow(_F1, -1, _MASK + 1)
    raw = F.col(term).cast("string").cast("binary")
    whole = n - n % 4
    byte = lambda i: F.when(n % 4 > i, F.shiftleft(F.conv(
        F.hex(F.substr(F.col("_raw"), whole + 1 + i, F.lit(1))), 16, 10).cast("bigint"), 8 * i)).otherwise(F.lit(0).cast("bigint"))
    rows = df.withColumn("_raw", raw).withColumn("_n", F.octet_length("_raw"))
    rows = rows.withColumn("_h", F.hash(F.substr(F.col("_raw"), F.lit(1), whole)).cast("bigint").bitwiseAND(F.lit(_MASK)))
    rows = rows.withColumn("_k", _times(byte(0) + byte(1) + byte(2), _C1))
    rows = rows.withColumn("_k", _times((F.shiftleft("_k", 15) + F.shiftrightunsigned("_k", 17)).bitwiseAND(F.lit(_MASK)), _C2))
    # undo the last mixing of the whole groups, add the rest, mix again
    steps = [_fold(h, 16), _times(h, back1), _fold(h, 13, 26), _times(h, back2), _fold(h, 16).bitwiseXOR(whole.cast("bigint")),
             h.bitwiseXOR(F.col("_k")).bitwiseXOR(n.cast("bigint")),
             _fold(h, 16), _times(h, _F1), _fold(h, 13), _times(h, _F2), _fold(h, 16)]
    for step in steps:
        rows = rows.withColumn("_h", step)
    signed = F.when(h > 0x7FFFFFFF, h - (_MASK + 1)).otherwise(h)
    return rows.withColumn(out, F.when(F.col(term).isNotNull(), F.pmod(signed, F.lit(buckets))).cast("int")).drop("_raw", "_n", "_h", "_k")
