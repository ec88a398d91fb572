"""Sort, limit, top-k (T1–T4). Every order ends with a unique key, so a
limited result is the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clasp.operators.filters import filter_eq, filter_typed_eq, parse_int_param

DEFAULT_LIMIT = 50


def parse_limit(n, default: int = DEFAULT_LIMIT) -> int | None:
    """T2 parameter rules: not an integer -> default; 0 -> no limit;
    negative -> its absolute value (document-store ``limit`` rules)."""
    v = parse_int_param(n) if n is not None else default
    if v is None:
        v = default
    if v == 0:
        return None
    return abs(v)


def tie_order(df: DataFrame, key: str | list[str] | None = None) -> list[str]:
    """Columns that settle ties: the given key, or every column that has an
    order, so that equal rows alone are interchangeable."""
    if key:
        return [key] if isinstance(key, str) else list(key)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def latest(df: DataFrame, ts: str, key: str | list[str] | None = None, n=DEFAULT_LIMIT) -> DataFrame:
    """Newest ``n`` rows by ``ts`` (nulls last), ties by ``key`` (a
    unique one; without it, by all columns). A
    sort + limit becomes ``TakeOrderedAndProject``: each task keeps its
    top n, only those reach the final merge."""
    lim = parse_limit(n)
    out = df.orderBy(F.col(ts).desc_nulls_last(), *[F.col(c).asc() for c in tie_order(df, key)])
    return out.limit(lim) if lim is not None else out


def listing(df: DataFrame, label_col: str, label, ts: str, key: str | list[str] | None = None, n: int = DEFAULT_LIMIT) -> DataFrame:
    """Optional label filter, then the newest ``n`` (the reference
    returned an arbitrary 50; here the order is defined)."""
    return latest(filter_eq(df, label_col, label), ts, key, n)


def latest_by_value(df: DataFrame, col: str, value, ts: str, key: str | list[str] | None = None, n: int = 100) -> DataFrame:
    """Typed filter then the newest ``n``."""
    return latest(filter_typed_eq(df, col, value), ts, key, n)


def latest_one(df: DataFrame, ts: str, tiebreak: list[str] | None = None) -> DataFrame:
    """T4: the single newest row, as one aggregate (``max_by``) rather than
    a sort. Empty input gives no row."""
    cols = df.columns
    order = F.struct(F.col(ts), *[F.col(c) for c in tie_order(df, tiebreak)])
    best = df.agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_row"),
                  F.count(F.lit(1)).alias("_n"))
    return best.where(F.col("_n") > 0).select("_row.*")
