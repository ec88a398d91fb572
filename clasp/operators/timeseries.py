"""Zero-filled time buckets.

pandas ``resample(freq)`` with a fixed-width frequency anchors buckets at
midnight of the first day seen (``origin='start_day'``), closes them on
the left and labels them by their start; every bucket between the first
and the last row is present, empty ones with 0. Spark's ``window()`` is
anchored at the epoch instead (a 7-day window may start two days before
the first row), so buckets are numbered from the first day here.

Plan: one tiny aggregate gives the first day and the last time (two
scalars to the driver); each row gets a bucket number from calendar
arithmetic (no time zone involved for TIMESTAMP_NTZ); counts are a grouped
aggregate; the spine is ``spark.range`` over the bucket numbers, spread over
many partitions, left-joined to the counts. The spine grows with the time
span / width, never with the row count.
"""

from __future__ import annotations

import re
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clasp.session import materialise

DAY = 86_400
_UNITS = {"s": 1, "sec": 1, "min": 60, "t": 60, "h": 3600, "d": 86400, "w": 604800}


def freq_seconds(freq: str | int) -> int:
    """'7D' -> 604800, '1min' -> 60, '30s' -> 30; an int is seconds."""
    if isinstance(freq, int):
        return freq
    m = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+)\s*", freq)
    if not m:
        raise ValueError(f"bad frequency {freq!r}")
    n = int(m.group(1) or 1)
    unit = m.group(2).lower()
    if unit not in _UNITS:
        raise ValueError(f"unsupported frequency unit {unit!r}")
    return n * _UNITS[unit]


def _seconds_since(ts: Column, origin_day: Column) -> Column:
    """Whole seconds from midnight of ``origin_day`` to ``ts``."""
    day_idx = F.datediff(F.to_date(ts), origin_day).cast("bigint")
    sod = (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))).cast("bigint")
    return day_idx * 86400 + sod


def bucket_index(ts: str | Column, origin_day: Column, width_s: int) -> Column:
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(_seconds_since(t, origin_day) / F.lit(width_s)).cast("bigint")


def resample_count(df: DataFrame, ts: str, freq: str | int, value_col: str | None = None,
                   out_ts: str = "bucket_start", out_n: str = "n",
                   spine_partitions: int | None = None) -> DataFrame:
    """Count of non-null ``value_col`` (all rows when None) per
    bucket of any whole-second width ``freq``; rows with a null time are
    ignored. One scan: rows are counted per day and in-day bucket of the
    greatest width that divides both ``freq`` and a day, which no origin is
    needed for, and written; origin, ends and buckets come from those few
    rows."""
    width = freq_seconds(freq)
    if width < 1:
        raise ValueError("a bucket is a second wide at least")
    counted = F.count(F.col(value_col)) if value_col else F.count(F.lit(1))
    fine = gcd(width, DAY)
    ts_type = dict(df.dtypes)[ts]
    timed = df.where(F.col(ts).isNotNull())
    small = materialise(timed.groupBy(
        F.to_date(ts).alias("_d"), bucket_index(ts, F.to_date(ts), fine).alias("_i")).agg(counted.alias("_c")), "buckets")
    return fill_buckets(small, width, ts_type, out_ts, out_n, spine_partitions)


def fill_buckets(small: DataFrame, width: int, ts_type: str = "timestamp_ntz", out_ts: str = "bucket_start",
                 out_n: str = "n", spine_partitions: int | None = None) -> DataFrame:
    """Counts ``_c`` per day ``_d`` and in-day bucket ``_i`` (of the width
    that divides both ``width`` and a day) -> one row for every bucket from
    the first to the last, zero where nothing was."""
    spark, fine = small.sparkSession, gcd(width, DAY)
    ends = small.agg(F.min(F.struct("_d", "_i")).alias("a"), F.max(F.struct("_d", "_i")).alias("z")).first()
    if ends["a"] is None:
        return spark.createDataFrame([], f"{out_ts} {ts_type}, {out_n} bigint")
    d0 = F.lit(ends["a"]["_d"]).cast("date")
    span = (ends["z"]["_d"] - ends["a"]["_d"]).days
    first_b = ends["a"]["_i"] * fine // width
    last_b = (span * DAY + ends["z"]["_i"] * fine) // width
    number = F.floor((F.datediff("_d", d0).cast("bigint") * DAY + F.col("_i") * fine) / width)
    counts = small.groupBy(number.cast("bigint").alias("_b")).agg(F.sum("_c").alias(out_n))
    parts = spine_partitions or max(1, min(spark.sparkContext.defaultParallelism, (last_b - first_b) // 100_000 + 1))
    spine = spark.range(first_b, last_b + 1, numPartitions=parts).withColumnRenamed("id", "_b")
    start = F.to_timestamp(d0).cast(ts_type) if ts_type == "timestamp_ntz" else F.to_timestamp(d0)
    return (spine.join(counts, "_b", "left")
            .select((start + F.make_dt_interval(secs=F.col("_b") * width)).cast(ts_type).alias(out_ts),
                    F.coalesce(F.col(out_n), F.lit(0)).cast("bigint").alias(out_n)))


def stream_window_counts(df: DataFrame, ts: str, every: str = "1 minute",
                         watermark: str = "10 minutes", out_n: str = "n") -> DataFrame:
    """The streaming form of A13: counts per event-time window (for
    minute buckets the same edges). Run in ``update`` mode: every batch
    gives the windows it has changed, open ones too, and the watermark only
    bounds the state; :func:`latest_counts` reads the sink."""
    return (df.withWatermark(ts, watermark)
            .groupBy(F.window(ts, every).alias("w"))
            .agg(F.count(F.lit(1)).alias(out_n))
            .select(F.col("w.start").alias("bucket_start"), F.col(out_n)))


def latest_counts(sink: DataFrame, every: str | int = "1min", out_n: str = "n") -> DataFrame:
    """X4 read side: each window's count of its newest batch, zero-filled."""
    width = freq_seconds(every)
    now = sink.groupBy("bucket_start").agg(F.max_by(out_n, "batch_id").alias("_c"))
    at = F.col("bucket_start").cast("timestamp_ntz")
    small = materialise(now.select(F.to_date(at).alias("_d"), bucket_index(at, F.to_date(at), width).alias("_i"), "_c"), "windows")
    return fill_buckets(small, width, out_n=out_n)
