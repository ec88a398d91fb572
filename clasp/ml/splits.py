"""Train/test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clasp.functions.hashing import hash_bucket


def hash_split_col(key: str | Column, train_pct: int, salt: str = "") -> Column:
    """``'train'`` when the key's hash bucket (0–99) is below
    ``train_pct``, else ``'test'``. Equal keys always land together, so
    copies of a text cannot leak from train into test (Q8)."""
    return F.when(hash_bucket(key, 100, salt) < F.lit(train_pct), F.lit("train")).otherwise(F.lit("test"))


def hash_split(df: DataFrame, key: str, train_pct: int = 70, salt: str = "",
               out: str = "split") -> DataFrame:
    return df.withColumn(out, hash_split_col(key, train_pct, salt))


def random_split(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    """Spark's sampled split, as the reference did. Its sizes depend
    on the partitioning of ``df``; prefer :func:`hash_split`."""
    return df.randomSplit(weights, seed=seed)
