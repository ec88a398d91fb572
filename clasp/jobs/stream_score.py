"""Streaming scoring job: records from the stream are decoded, invalid
ones quarantined, valid ones scored with the saved pipeline, and each
micro-batch is written once (partition ``batch_id``)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from clasp.jobs.config import StreamJobConfig, TabularJobConfig
from clasp.jobs.schemas import RECORD_SCHEMA
from clasp.sources.tables import load_model
from clasp.streaming.scoring import scored_stream
from clasp.streaming.sinks import idempotent_batch_writer, write_stream
from clasp.streaming.sources import open_stream


def start(spark: SparkSession, cfg: StreamJobConfig, available_now: bool = False):
    fields = TabularJobConfig()
    features = [*fields.categorical, *fields.numeric]
    model = load_model(cfg.model_path)
    decoded, fn = scored_stream(open_stream(spark, cfg.source), RECORD_SCHEMA, model,
                                required=features, label_col=cfg.label,
                                label_alias=cfg.label_alias, label_type=cfg.label_type,
                                keep_cols=[*features, cfg.label_alias])
    writer = idempotent_batch_writer(cfg.sink_path, split=fn, quarantine_path=cfg.quarantine_path)
    trigger = {"availableNow": True} if available_now else {"processingTime": cfg.trigger}
    return write_stream(decoded, writer, cfg.checkpoint, "stream_score", trigger=trigger)


def main() -> None:
    from clasp.session import build_session
    spark = build_session("stream-score")
    query = start(spark, StreamJobConfig())
    try:
        query.awaitTermination()
    finally:
        if query.isActive:
            query.stop()
        spark.stop()


if __name__ == "__main__":
    main()
