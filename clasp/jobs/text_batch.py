"""Text classification batch job: read labelled text, split by text hash,
fit the TF-IDF + forest pipeline, save it, score every row, write the
scored table and one metrics row."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clasp.jobs.config import TextJobConfig
from clasp.jobs.schemas import TEXT_SCHEMA
from clasp.ml import models, splits, text
from clasp.ml.training import TEXT_ROWS_PER_TASK, fit_persisted
from clasp.operators.filters import drop_incomplete
from clasp.operators.partitioning import spread
from clasp.operators.stats import metrics_row
from clasp.sources import sinks
from clasp.sources.tables import read_csv


def load(spark: SparkSession, cfg: TextJobConfig) -> DataFrame:
    if cfg.data_format == "csv":
        df = read_csv(spark, cfg.data_path, TEXT_SCHEMA, multiline=cfg.multiline)
    else:
        df = spark.read.format(cfg.data_format).load(cfg.data_path).select("texto", "etiqueta")
    return drop_incomplete(spread(df))


def run(spark: SparkSession, cfg: TextJobConfig, data: DataFrame | None = None):
    data = splits.hash_split(data if data is not None else load(spark, cfg), "texto", cfg.train_pct)
    pipe = text.text_pipeline(num_trees=cfg.num_trees, max_depth=cfg.max_depth, seed=cfg.seed)
    model = fit_persisted(pipe, data.where(F.col("split") == "train"), rows_per_task=TEXT_ROWS_PER_TASK)
    sinks.save_model(model, cfg.model_path)
    scored = models.decode_prediction(models.score(model, data, "etiqueta"), model).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        sinks.require_rows(scored, "scored text")
        metrics = metrics_row(scored, "split", "etiqueta", "prediction")
        table = models.scored_table(scored, "texto", "etiqueta", "prediction",
                                    metrics.select("accuracy"))
        sinks.write_table(table, cfg.results)
        sinks.write_table(metrics, cfg.metrics)
    finally:
        scored.unpersist()
    return model


def main() -> None:
    from clasp.session import build_session
    spark = build_session("text-batch")
    try:
        run(spark, TextJobConfig())
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
