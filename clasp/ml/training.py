"""Fitting helpers: persist the training input once (every estimator in
a pipeline scans it again), fit, release."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clasp.ml import forest_cells
from clasp.session import ensure_checkpoint_dir

# Execution setting only: a forest keeps about 1.7 KB for a row of a dozen
# features and 9 KB for one of a thousand, and a task reads its whole partition
# of them on every level. More rows than this make more tasks, not larger ones.
ROWS_PER_TASK = 100_000
TEXT_ROWS_PER_TASK = 25_000


def fit_persisted(pipeline: Pipeline, train: DataFrame, rows_per_task: int = ROWS_PER_TASK,
                  cells: bool = False) -> PipelineModel:
    """Fit on ``train`` persisted (memory, then disk). Give it at least one
    partition per core (``operators.partitioning.spread`` on its scans) so
    tree building uses every core. Where a partition holds more than
    ``rows_per_task`` rows, all are dealt out again evenly, at most about that
    many to each. With ``cells`` (for forests over few features) rows that are
    one to the learner are read as one, where that spares it most of them
    (``forest_cells``)."""
    ensure_checkpoint_dir(train.sparkSession)
    cached = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = forest_cells.fit(pipeline, cached) if cells else None
        if model is None:
            cached = _dealt(cached, rows_per_task)
            model = pipeline.fit(cached)
        return model
    finally:
        cached.unpersist()


def _dealt(cached: DataFrame, rows_per_task: int) -> DataFrame:
    """``cached`` itself, or its rows persisted in smaller partitions in its
    place."""
    parts = cached.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    rows, most = parts.agg(F.sum("n"), F.max("n")).first()
    if not rows or most <= rows_per_task:
        return cached
    width = max(cached.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_per_task))
    even = cached.repartition(width).persist(StorageLevel.MEMORY_AND_DISK)
    even.count()  # in place before what it is dealt from goes
    cached.unpersist()
    return even
