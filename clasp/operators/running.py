"""Counts, time buckets and fits as summaries that grow with their table
(``sources.appends.Running``): each is a pair of what is summed per append,
and how the wanted result follows from the sums."""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clasp.functions.stopwords import ENGLISH_STOP_WORDS
from clasp.functions.text import WHITESPACE_CLASS
from clasp.operators.partitioning import spread
from clasp.operators.timeseries import DAY, bucket_index, fill_buckets, freq_seconds
from clasp.session import materialise
from clasp.sources.appends import AppendTable, Running


def running_counts(table: AppendTable, root: str, key: str) -> Running:
    """A2/A3: rows per value of ``key``, null kept."""
    return Running(table, root, lambda df: df.select(key, F.lit(1).cast("bigint").alias("n")), [key], ["n"])


def running_buckets(table: AppendTable, root: str, ts: str, freq: str | int, value_col: str | None = None) -> Running:
    """Rows per day and in-day bucket; see :func:`buckets_of`."""
    fine = gcd(freq_seconds(freq), DAY)

    def summarise(df: DataFrame) -> DataFrame:
        one = F.col(value_col).isNotNull().cast("bigint") if value_col else F.lit(1).cast("bigint")
        return df.where(F.col(ts).isNotNull()).select(F.to_date(ts).alias("_d"), bucket_index(ts, F.to_date(ts), fine).alias("_i"), one.alias("_c"))
    return Running(table, root, summarise, ["_d", "_i"], ["_c"])


def buckets_of(sums: DataFrame, freq: str | int, ts_type: str = "timestamp_ntz") -> DataFrame:
    """The zero-filled buckets of :func:`running_buckets`."""
    return fill_buckets(materialise(sums, "buckets"), freq_seconds(freq), ts_type)


def running_terms(table: AppendTable, root: str, text: str, stop_words: list[str] | None = None) -> Running:
    """M4: documents per term, and under the null term the documents."""
    words = [w.lower() for w in (stop_words or ENGLISH_STOP_WORDS)]

    def summarise(df: DataFrame) -> DataFrame:
        toks = F.array_distinct(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), WHITESPACE_CLASS, -1))
        every = F.array_append(toks, F.lit(None).cast("string"))
        rows = spread(df.select(text)).select(F.explode(every).alias("term")).where(
            F.col("term").isNull() | ((F.col("term") != "") & ~F.col("term").isin(words)))
        return rows.select("term", F.lit(1).cast("bigint").alias("doc_freq"))
    return Running(table, root, summarise, ["term"], ["doc_freq"])


def idf_of(sums: DataFrame, digits: int = 6) -> DataFrame:
    """``term, doc_freq, idf`` as a fit on all rows gives them."""
    m = sums.where("term IS NULL").select(F.coalesce(F.max("doc_freq"), F.lit(0))).scalar()
    return sums.where("term IS NOT NULL").select("term", "doc_freq", F.round(F.log((m + 1) / (F.col("doc_freq") + 1)), digits).alias("idf"))


def label_order_of(sums: DataFrame, label: str) -> DataFrame:
    """M5: ``label, label_index`` from :func:`running_counts`: by count,
    ties by the label's text. One row per label, as the indexer holds them."""
    by = Window.orderBy(F.desc("n"), F.col("label"))
    return sums.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("label"), "n").select(
        "label", (F.row_number().over(by) - 1).cast("int").alias("label_index"))
