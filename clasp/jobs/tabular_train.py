"""Tabular training job: read records, split, fit index/one-hot/assemble
+ forest, save the pipeline (the hand-off to the stream job), write one
metrics row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clasp.jobs.config import TabularJobConfig
from clasp.jobs.schemas import RECORD_SCHEMA
from clasp.ml import models, splits, tabular
from clasp.ml.training import fit_persisted
from clasp.operators.filters import drop_incomplete
from clasp.operators.partitioning import spread
from clasp.operators.stats import metrics_row
from clasp.sources import sinks
from clasp.sources.tables import read_csv


def load(spark: SparkSession, cfg: TabularJobConfig) -> DataFrame:
    if cfg.data_format == "csv":
        df = read_csv(spark, cfg.data_path, RECORD_SCHEMA)
    else:
        df = spark.read.format(cfg.data_format).load(cfg.data_path)
    # training rows must be complete (the assembler rejects nulls)
    return drop_incomplete(spread(df), [*cfg.categorical, *cfg.numeric, cfg.label])


def run(spark: SparkSession, cfg: TabularJobConfig, data: DataFrame | None = None):
    data = data if data is not None else load(spark, cfg)
    key = F.col(cfg.key) if cfg.key else F.to_json(F.struct(*[F.col(c) for c in data.columns]))
    data = data.withColumn("split", splits.hash_split_col(key.cast("string"), cfg.train_pct))
    pipe = tabular.tabular_pipeline(list(cfg.categorical), list(cfg.numeric), cfg.label,
                                    num_trees=cfg.num_trees, max_depth=cfg.max_depth, seed=cfg.seed)
    model = fit_persisted(pipe, data.where(F.col("split") == "train"), cells=True)
    sinks.save_model(model, cfg.model_path)
    # only held-out rows are scored; train rows are only counted
    test = models.decode_prediction(models.score(model, data.where(F.col("split") == "test"), cfg.label), model,
                                    label_type=dict(data.dtypes)[cfg.label]).select("split", cfg.label, "prediction")
    train = data.where(F.col("split") == "train").select("split", cfg.label, F.col(cfg.label).alias("prediction"))
    sinks.write_table(metrics_row(test.unionByName(train), "split", cfg.label, "prediction"), cfg.metrics)
    return model


def main() -> None:
    from clasp.session import build_session
    spark = build_session("tabular-train")
    try:
        run(spark, TabularJobConfig())
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
