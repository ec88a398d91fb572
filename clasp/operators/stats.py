"""Aggregations.

Every statistic is one aggregate pass with map-side partial aggregation:
the reference issued one store round trip per number; here counts,
conditional counts and accuracy come out of the same ``agg``. Results are
small (one row, or one row per class), so nothing large reaches the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clasp.functions.scalars import round_half_even, safe_ratio_pct
from clasp.operators.topk import tie_order


def total(df: DataFrame) -> DataFrame:
    """A1: row count."""
    return df.agg(F.count(F.lit(1)).alias("total"))


def str_key(key: str) -> Column:
    """A key rendered as Python's ``str`` renders it for a JSON object key
    (a null group becomes ``"None"``)."""
    return F.coalesce(F.col(key).cast("string"), F.lit("None")).alias(key)


def distribution(df: DataFrame, key: str, as_string: bool = False,
                 out: str = "total") -> DataFrame:
    """A2: group count; a null key is a group of its own (store ``$group``).
    ``as_string``: keys as text, the way the record service sent them."""
    k = str_key(key) if as_string else F.col(key)
    return df.groupBy(k).agg(F.count(F.lit(1)).alias(out))


def value_counts(df: DataFrame, key: str, out: str = "count") -> DataFrame:
    """A3: pandas ``value_counts``: null keys dropped, count descending
    (ties by key for a stable order)."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias(out))
            .orderBy(F.desc(out), F.asc(key)))


def confusion(df: DataFrame, label: str, pred: str, out: str = "n") -> DataFrame:
    """A4: label x prediction counts; rows with a null in either are dropped."""
    return (df.where(F.col(label).isNotNull() & F.col(pred).isNotNull())
            .groupBy(label, pred).agg(F.count(F.lit(1)).alias(out)))


def cross_count(df: DataFrame, a: str, b: str, out: str = "n") -> DataFrame:
    """A5: category x outcome counts (same rule as :func:`confusion`)."""
    return confusion(df, a, b, out)


def count_where(df: DataFrame, preds: dict[str, Column], with_total: str | None = "total") -> DataFrame:
    """Several conditional counts in one pass."""
    aggs = [F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in preds.items()]
    if with_total:
        aggs = [F.count(F.lit(1)).alias(with_total)] + aggs
    return df.agg(*aggs)


def accuracy_pct(correct: str | Column, total_: str | Column, digits: int = 2) -> Column:
    """``round(correct / total * 100, digits)``; 0 when total is 0."""
    return safe_ratio_pct(correct, total_, digits)


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a one-row frame (totals, a latest metrics row)
    on every row of ``df``: an equi-join on a constant key with the
    one-row side broadcast, so ``df`` is not shuffled. When both sides are
    computed from the same aggregate, Spark reuses its exchange and the
    input is read once."""
    key = "__one"
    return (df.withColumn(key, F.lit(1))
            .join(F.broadcast(one_row.withColumn(key, F.lit(1))), key, "left")
            .drop(key))


def label_stats(df: DataFrame, key: str, label: str, pred: str, null_safe: bool = True,
                key_as_string: bool = False) -> DataFrame:
    """Per value of ``key`` its count ``n`` and how many of those are
    right (``class_correct``); and, repeated on each row, ``total``,
    ``correct`` (``label`` equals ``pred``) and ``accuracy``. One grouped
    pass (map-side partial counts); the totals are the sums of the grouped
    rows (one per class), and since both sides carry the same columns the
    aggregate's shuffle is computed once and reused."""
    eq = F.col(label).eqNullSafe(F.col(pred)) if null_safe else (F.col(label) == F.col(pred))
    k = str_key(key) if key_as_string else F.col(key)
    per = df.groupBy(k).agg(F.count(F.lit(1)).alias("n"),
                            F.count_if(F.coalesce(eq, F.lit(False))).alias("_correct"))
    tot = per.agg(F.sum("n").alias("total"), F.sum("_correct").alias("correct"))
    return attach_row(per, tot).select(
        F.col(key), F.col("n"), F.col("_correct").alias("class_correct"), "total", "correct",
        accuracy_pct("correct", "total").alias("accuracy"))


def stats_record(stats: DataFrame, key: str) -> DataFrame:
    """A8 as one record: total, ``{label: n}`` map, accuracy. The map is
    built from the per-class rows of :func:`label_stats` (one per class)."""
    return stats.groupBy("total", "accuracy").agg(
        F.map_from_entries(F.collect_list(
            F.struct(F.coalesce(F.col(key).cast("string"), F.lit("null")), F.col("n")))
        ).alias("distribution"))


def _safe_name(v) -> str:
    return re.sub(r"[^0-9A-Za-z_]", "_", str(v)).lower()


def kpi_row(df: DataFrame, col: str, classes: list, digits: int = 1) -> DataFrame:
    """Total, a count per fixed class (0 when absent) and its share of
    the total in percent, in one aggregate."""
    aggs = [F.count(F.lit(1)).alias("total")]
    for c in classes:
        aggs.append(F.count_if(F.coalesce(F.col(col) == F.lit(c), F.lit(False)))
                    .alias(f"n_{_safe_name(c)}"))
    row = df.agg(*aggs)
    return row.select("*", *[safe_ratio_pct(f"n_{_safe_name(c)}", "total", digits)
                             .alias(f"pct_{_safe_name(c)}") for c in classes])


def share(df: DataFrame, key: str, digits: int = 1) -> DataFrame:
    """A10: value counts with each class's percent of all counted rows."""
    vc = (df.where(F.col(key).isNotNull()).groupBy(key)
          .agg(F.count(F.lit(1)).alias("n")))
    tot = vc.agg(F.sum("n").alias("_tot"))
    return attach_row(vc, tot).select(key, "n", safe_ratio_pct("n", "_tot", digits).alias("pct"))


def latest_value(metrics: DataFrame, value: str, ts: str, tiebreak: list[str] | None = None) -> Column:
    """Scalar subquery: ``value`` of the latest metrics row (by ``ts``)."""
    order = F.struct(F.col(ts), *[F.col(c) for c in tie_order(metrics, tiebreak)])
    return metrics.select(F.max_by(F.col(value), order)).scalar()


def risk_summary(df: DataFrame, pred: str, metrics: DataFrame | None = None,
                 metric_value: str = "accuracy", metric_ts: str = "fecha",
                 high=1, low=0) -> DataFrame:
    """Total, high, low, high % (2 decimals, 0 when empty) and the
    accuracy of the latest metrics row (0 when there is none)."""
    row = df.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.coalesce(F.col(pred) == F.lit(high), F.lit(False))).alias("high"),
                 F.count_if(F.coalesce(F.col(pred) == F.lit(low), F.lit(False))).alias("low"))
    acc = (F.coalesce(latest_value(metrics, metric_value, metric_ts), F.lit(0.0))
           if metrics is not None else F.lit(0.0))
    return row.select("total", "high", "low",
                      accuracy_pct("high", "total").alias("high_pct"),
                      acc.cast("double").alias("model_accuracy"))


def evaluate_accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Share of rows whose prediction equals the label (one row:
    ``accuracy`` fraction and ``n``). Same number as the ML evaluator's
    ``accuracy`` metric, but computed as one aggregate."""
    return df.agg(
        F.try_divide(F.count_if(F.col(label) == F.col(pred)).cast("double"),
                     F.count(F.lit(1))).alias("accuracy"),
        F.count(F.lit(1)).alias("n"))


def metrics_row(df: DataFrame, split_col: str, label: str, pred: str,
                train_value: str = "train", test_value: str = "test",
                stamp: bool = True) -> DataFrame:
    """``accuracy`` (% of test rows right, 2 decimals), train and
    test sizes, and the time the row was made. One aggregate, no driver
    round trip."""
    is_test = F.col(split_col) == F.lit(test_value)
    row = df.agg(
        F.count_if(F.col(split_col) == F.lit(train_value)).alias("train_size"),
        F.count_if(is_test).alias("test_size"),
        F.count_if(is_test & F.col(label).eqNullSafe(F.col(pred))).alias("_correct"))
    out = row.select(accuracy_pct("_correct", "test_size").alias("accuracy"),
                     "train_size", "test_size")
    return out.withColumn("fecha", F.current_timestamp()) if stamp else out


def accuracy_or_metrics(scored: DataFrame, metrics: DataFrame | None, label: str, pred: str,
                        metric_value: str = "accuracy", metric_ts: str = "fecha") -> DataFrame:
    """The stored model accuracy when a metrics row exists, else the
    share of scored rows whose prediction equals the label (1 decimal)."""
    computed = scored.agg(
        accuracy_pct(F.count_if(F.coalesce(F.col(label) == F.col(pred), F.lit(False))),
                     F.count(F.lit(1)), 1).alias("computed_accuracy"))
    if metrics is None:
        row = computed.withColumn("_stored", F.lit(None).cast("double"))
    else:
        order = F.struct(F.col(metric_ts), *[F.col(c) for c in tie_order(metrics)])
        stored = metrics.agg(F.max_by(F.col(metric_value), order).cast("double").alias("_stored"))
        row = attach_row(computed, stored)
    return row.select(
        F.coalesce("_stored", "computed_accuracy").alias("accuracy"),
        F.when(F.col("_stored").isNotNull(), F.lit("metrics")).otherwise(F.lit("computed")).alias("source"),
        "computed_accuracy")


__all__ = [
    "total", "distribution", "value_counts", "confusion", "cross_count", "count_where",
    "accuracy_pct", "label_stats", "stats_record", "kpi_row", "share", "risk_summary",
    "evaluate_accuracy", "metrics_row", "accuracy_or_metrics", "latest_value", "attach_row",
    "round_half_even",
]
