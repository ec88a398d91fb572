"""Filters and predicates (F1–F6). Built-in predicates only, so every one
of them is pushed into the parquet scan where the column allows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """drop rows with any null (in ``subset`` when given)."""
    return df.dropna("any", subset=subset)


def filter_eq(df: DataFrame, col: str, value=None) -> DataFrame:
    """optional equality filter; ``None`` or ``""`` keeps every row. As
    in a document store, values of different types are never equal: decided
    from the schema, so a text never reaches a numeric column's cast."""
    if value is None or value == "":
        return df
    kind = df.schema[col].dataType
    comparable = (isinstance(value, bool) if isinstance(kind, T.BooleanType)
                  else isinstance(value, (int, float, Decimal)) and not isinstance(value, bool)
                  if isinstance(kind, T.NumericType)
                  else isinstance(value, str) if isinstance(kind, T.StringType)
                  else not isinstance(value, (str, int, float)))
    return df.where(F.col(col) == F.lit(value)) if comparable else df.where(F.lit(False))


def parse_int_param(value) -> int | None:
    """Parse a request parameter as ``int()`` does; None when it is not one."""
    if value is None:
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, int):
        return value
    try:
        return int(str(value).strip())
    except ValueError:
        return None


def filter_typed_eq(df: DataFrame, col: str, value) -> DataFrame:
    """the parameter is parsed as an int; if it is not one, it is
    compared as text, which never equals a numeric column (no rows).
    ``None`` means no filter."""
    if value is None:
        return df
    as_int = parse_int_param(value)
    if as_int is not None:
        return df.where(F.col(col) == F.lit(as_int))
    dtype = dict(df.dtypes)[col]
    if dtype in ("string",):
        return df.where(F.col(col) == F.lit(str(value)))
    return df.where(F.lit(False))


def equal_cols(a: str, b: str, null_safe: bool = True) -> Column:
    """column = column. ``null_safe`` is the document-store rule
    (null equals null); ``False`` is the pandas rule (null never equal)."""
    return F.col(a).eqNullSafe(F.col(b)) if null_safe else (F.col(a) == F.col(b))


def search_expr(col: str, pattern: str | None) -> Column:
    """case-insensitive regex match (Unicode case folding, as Python's
    ``re.IGNORECASE``: 'É' matches 'é'); null text never matches; an empty
    pattern matches every row (including null text)."""
    if not pattern:
        return F.lit(True)
    return F.coalesce(F.col(col).rlike("(?iu)" + pattern), F.lit(False))


def search(df: DataFrame, col: str, pattern: str | None) -> DataFrame:
    return df if not pattern else df.where(search_expr(col, pattern))


def explore(df: DataFrame, label_col: str, label, text_col: str,
            pattern: str | None) -> tuple[DataFrame, DataFrame]:
    """the filtered rows, and a one-row ``(shown, total)`` count made
    in a single aggregate over the unfiltered input."""
    cond = F.lit(True)
    if label is not None and label != "":
        cond = cond & F.coalesce(F.col(label_col) == F.lit(label), F.lit(False))
    cond = cond & search_expr(text_col, pattern)
    rows = df.where(cond)
    counts = df.agg(F.count_if(cond).alias("shown"), F.count(F.lit(1)).alias("total"))
    return rows, counts
