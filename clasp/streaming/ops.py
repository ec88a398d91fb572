"""Stream operators beyond decode/score: de-duplication of replays
and event-time bucket counts (X4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clasp.operators.timeseries import stream_window_counts as _window_counts


def stream_window_counts(df: DataFrame, ts: str, every: str = "1 minute",
                         watermark: str = "10 minutes", out_n: str = "n") -> DataFrame:
    """Event-time bucket counts, for ``update`` mode."""
    return _window_counts(event_time(df, ts), ts, every, watermark, out_n)


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP; a TIMESTAMP_NTZ column is read as a
    session-time-zone time (UTC in our sessions)."""
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def dedup_replays(df: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drop repeated records (a replayer re-sending its file) within
    ``delay`` of event time; state is bounded by the watermark."""
    ntz = dict(df.dtypes)[ts] == "timestamp_ntz"
    out = event_time(df, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)
    return out.withColumn(ts, F.col(ts).cast("timestamp_ntz")) if ntz else out
