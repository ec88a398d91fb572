"""Partition-count helpers.

A scan of a large table already has one partition per file split; a
scan of a small file (one parquet row group) has one partition, and any
CPU-heavy per-row step on it (tokenising whole texts, regex over whole
texts, fitting a forest) then runs in a single task. ``spread`` gives such
an input one partition per core with a round-robin shuffle, and does
nothing when the input is already split that finely, which is the case for
every scan at cluster scale.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_SHUFFLE = re.compile(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning"
                      r"|SinglePartition)")


def has_shuffle(df: DataFrame) -> bool:
    """Whether the physical plan (planned, not run) shuffles anywhere."""
    return bool(_SHUFFLE.search(df._jdf.queryExecution().executedPlan().toString()))


def num_partitions(df: DataFrame) -> int:
    """Partition count of a scan (or a narrow plan over one). Do not use
    on plans with exchanges: under AQE asking for their RDD runs the
    stages below the last one."""
    return int(df._jdf.rdd().getNumPartitions())


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """At least ``min_partitions`` (default: the cluster's parallelism)
    partitions for a scan-like plan. A plan that already shuffles is left
    as it is: it is as wide as its shuffle, and asking for its partition
    count would run its earlier stages."""
    if has_shuffle(df):
        return df
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if num_partitions(df) < target else df
