"""Projections and column operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from clasp.functions.scalars import format_ts, format_ts_pystr, map_values_expr, parse_ts


def select(df: DataFrame, cols: list[str | Column]) -> DataFrame:
    """Select / reorder."""
    return df.select(*cols)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns that exist (missing names ignored)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def with_const(df: DataFrame, name: str, value) -> DataFrame:
    """Constant column."""
    return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))


def with_processed_at(df: DataFrame, name: str = "processed_at") -> DataFrame:
    """P5: processing-time stamp; one value per query (or micro-batch)."""
    return df.withColumn(name, F.current_timestamp())


def typed_cast(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Casts that give null on a bad value (ANSI-off behaviour of the
    reference's Spark 3.5) instead of failing the job."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` as {t})") for c, t in casts.items()})


def map_values(df: DataFrame, col: str, mapping: dict, out: str | None = None) -> DataFrame:
    """Map codes to names; unmapped -> null. For a mapping too large to
    inline, join with a small dimension instead."""
    return df.withColumn(out or col, map_values_expr(col, mapping))


def ensure_columns(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add each missing column with its default (a literal or a Column).
    Decided at plan time from the schema; no data is touched."""
    missing = {c: (v if isinstance(v, Column) else F.lit(v))
               for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def select_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep only the listed columns that exist, in the listed order."""
    return df.select(*[c for c in cols if c in df.columns])


def has_columns(df: DataFrame, cols: list[str]) -> bool:
    """A view that needs absent columns is skipped by its caller."""
    return all(c in df.columns for c in cols)


def drop(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns (absent names ignored)."""
    return df.drop(*cols)


def stringify_ts(df: DataFrame, cols: list[str] | None = None,
                 fmt: str | None = None) -> DataFrame:
    """P10: timestamp columns -> text, only those present (all timestamp
    columns when ``cols`` is None). Without ``fmt`` as Python's ``str``
    writes them, with a fraction where there is one."""
    ts_types = (TimestampType, TimestampNTZType)
    names = [f.name for f in df.schema.fields
             if isinstance(f.dataType, ts_types) and (cols is None or f.name in cols)]
    render = (lambda c: format_ts(c, fmt)) if fmt else format_ts_pystr
    return df.withColumns({c: render(c) for c in names}) if names else df


def parse_timestamps(df: DataFrame, cols: list[str], fmt: str | None = None) -> DataFrame:
    """Parse text to timestamps; bad values -> null."""
    return df.withColumns({c: parse_ts(c, fmt) for c in cols if c in df.columns})
