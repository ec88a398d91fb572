"""Forest, label decoding, scoring and the scored-output record
(M10, M14–M17)."""

from __future__ import annotations

import re

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clasp.ml.forest_cells import above

# The forest settings of both reference pipelines.
NUM_TREES = 100
MAX_DEPTH = 10
SEED = 42


# Execution settings only (the fitted trees are the same): keep each row's
# node id cached between levels instead of re-descending every tree, and
# give each pass enough memory to split more nodes at once.
CACHE_NODE_IDS = True
MAX_MEMORY_MB = 1024
MAX_SORTED_FEATURES = 64  # beyond, rows are scored in the order they come


def forest(features: str = "features", label: str = "label", num_trees: int = NUM_TREES,
           max_depth: int = MAX_DEPTH, seed: int = SEED) -> RandomForestClassifier:
    """Random forest (gini, auto feature subset, 32 bins by default);
    the seed is always set (Q12). With node-id caching the lineage is cut
    every 10 iterations in the session's checkpoint folder."""
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=num_trees,
                                  maxDepth=max_depth, seed=seed, cacheNodeIds=CACHE_NODE_IDS,
                                  maxMemoryInMB=MAX_MEMORY_MB, checkpointInterval=10)


def label_stage(model: PipelineModel, output_col: str = "label") -> StringIndexerModel:
    """The fitted label indexer, found by its output column (never by
    stage position)."""
    for st in model.stages:
        if isinstance(st, StringIndexerModel):
            outs = st.getOutputCols() if st.isSet("outputCols") else [st.getOutputCol()]
            if output_col in outs:
                return st
    raise LookupError(f"no StringIndexerModel writes {output_col!r}")


def label_list(model: PipelineModel, output_col: str = "label") -> list[str]:
    st = label_stage(model, output_col)
    outs = st.getOutputCols() if st.isSet("outputCols") else [st.getOutputCol()]
    return list(st.labelsArray[outs.index(output_col)])


def decode_prediction(df: DataFrame, model: PipelineModel, label_type: str | None = None,
                      pred_col: str = "prediction", out: str = "prediction",
                      index_out: str = "prediction_index") -> DataFrame:
    """Keep the raw index as ``prediction_index`` and put the
    decoded label in ``prediction``, cast back to the label's own type."""
    labels = label_list(model)
    conv = IndexToString(inputCol=pred_col, outputCol="_decoded", labels=labels)
    dec = conv.transform(df.withColumnRenamed(pred_col, index_out)
                          .withColumn(pred_col, F.col(index_out)))
    value = F.col("_decoded")
    if label_type and label_type != "string":
        value = F.expr(f"try_cast(_decoded as {label_type})")
    return dec.drop(pred_col).withColumn(out, value).drop("_decoded")


def _thresholds(forest: RandomForestClassificationModel) -> dict[int, list[float]]:
    """The values that the forest's trees part each numeric feature at."""
    if not hasattr(forest, "_thresholds"):
        found: dict = {}
        for feature, value in re.findall(r"If \(feature (\d+) <= ([^)]+)\)", forest.toDebugString):
            found.setdefault(int(feature), set()).add(float(value))
        forest._thresholds = {f: sorted(v) for f, v in found.items()}
    return forest._thresholds


def _transformed(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``model.transform(df)``. A forest of thousands of nodes waits for
    memory at every step of a row; over few features, rows are therefore
    taken in the order of the forest's bins within their partition, so that a
    row goes the way of the one before it."""
    *prep, forest = model.stages
    if df.isStreaming or not isinstance(forest, RandomForestClassificationModel) or forest.numFeatures > MAX_SORTED_FEATURES:
        return model.transform(df)
    prepared = PipelineModel(stages=prep).transform(df).withColumn("__x", vector_to_array(forest.getFeaturesCol()))
    cuts, place, size = _thresholds(forest), F.lit(0).cast("bigint"), 1
    for i in range(forest.numFeatures):
        wide = len(cuts.get(i, [0])) + 1
        if size * wide < 2 ** 62:
            place, size = place * wide + F.coalesce(above(F.get("__x", F.lit(i)), cuts.get(i, [0.0])), F.lit(0)), size * wide
    # below a join Spark drops an order of rows, but not past a filter that isn't deterministic
    ordered = prepared.withColumn("__x", place).sortWithinPartitions("__x").drop("__x").where(F.monotonically_increasing_id() >= 0)
    return forest.transform(ordered)


def score(model: PipelineModel, df: DataFrame, label_col: str | None = None) -> DataFrame:
    """Apply a fitted pipeline (batch or stream). The label
    indexer is skipped when its input column is absent, so ``label_col``
    is hidden during the transform and restored after: rows whose label is
    null or was never seen in training are scored instead of failing."""
    if not label_col or label_col not in df.columns:
        return _transformed(model, df)
    hidden = f"__kept_{label_col}"
    out = _transformed(model, df.withColumnRenamed(label_col, hidden))
    return out.withColumnRenamed(hidden, label_col)


def scored_table(df: DataFrame, text_col: str, label_col: str, pred_col: str,
                 accuracy: DataFrame | None = None, keep: list[str] | tuple = ()) -> DataFrame:
    """Text, label, prediction, processing time and the held-out
    accuracy (a one-row frame, attached as a scalar subquery)."""
    acc = accuracy.select(F.first("accuracy")).scalar() if accuracy is not None else F.lit(None)
    return df.select(
        *keep, F.col(text_col), F.col(label_col), F.col(pred_col),
        F.current_timestamp().alias("fecha_proceso"),
        acc.cast("double").alias("accuracy_test"))
