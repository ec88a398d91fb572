"""The scoring stream job (R2 + X1 + K2): decode -> validate -> score ->
decode label -> stamp -> per-batch idempotent sink."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clasp.ml.models import decode_prediction, score
from clasp.streaming.decode import decode_json, split_valid


def scored_stream(stream: DataFrame, schema: StructType | str, model: PipelineModel,
                  required: list[str], label_col: str | None, label_alias: str | None,
                  label_type: str | None, keep_cols: list[str]) -> tuple[DataFrame, callable]:
    """Returns the decoded stream and a per-batch function that splits
    valid/invalid rows and scores the valid ones. The label column is
    renamed before scoring so the label stage is skipped and a missing or
    null label never stops a record from being scored (Q2)."""
    decoded = decode_json(stream, schema, keep_raw=True)

    def split_and_score(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        good, bad = split_valid(batch, required, raw_col="_raw")
        if label_col and label_alias:
            good = good.withColumnRenamed(label_col, label_alias)
        scored = decode_prediction(score(model, good), model, label_type=label_type)
        out = scored.select(*keep_cols, "prediction_index", "prediction",
                            F.current_timestamp().alias("fecha_proceso"))
        return out, bad

    return decoded, split_and_score
