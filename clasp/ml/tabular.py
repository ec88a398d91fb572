"""Tabular classification: index categories, one-hot, assemble, label
index, forest (M6–M9, M12)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

from clasp.ml.models import MAX_DEPTH, NUM_TREES, SEED, forest


def category_indexer(cat_cols: list[str]) -> StringIndexer:
    """M6: one multi-column indexer (one pass, not one per column). Unseen
    and null values get the extra index ``n``."""
    return StringIndexer(inputCols=cat_cols, outputCols=[f"{c}_idx" for c in cat_cols],
                         handleInvalid="keep")


def one_hot(cat_cols: list[str]) -> OneHotEncoder:
    """M7: one-hot with the last slot dropped; after ``keep`` that slot is
    the unknown one, so unseen/null encode as all zeros of width ``n``."""
    return OneHotEncoder(inputCols=[f"{c}_idx" for c in cat_cols],
                         outputCols=[f"{c}_vec" for c in cat_cols])


def assembler(num_cols: list[str], cat_cols: list[str], handle_invalid: str = "error") -> VectorAssembler:
    """M8: numeric columns then the one-hot vectors, in that fixed order.
    A null numeric raises (``error``); split invalid rows off first."""
    return VectorAssembler(inputCols=list(num_cols) + [f"{c}_vec" for c in cat_cols],
                           outputCol="features", handleInvalid=handle_invalid)


def tabular_stages(cat_cols: list[str], num_cols: list[str], label_col: str,
                   num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH, seed: int = SEED):
    """M12. The label indexer uses ``error`` (Q2: ``keep`` adds a phantom
    third class)."""
    return [
        category_indexer(cat_cols),
        one_hot(cat_cols),
        assembler(num_cols, cat_cols),
        StringIndexer(inputCol=label_col, outputCol="label", handleInvalid="error"),
        forest(num_trees=num_trees, max_depth=max_depth, seed=seed),
    ]


def tabular_pipeline(cat_cols: list[str], num_cols: list[str], label_col: str, **kw) -> Pipeline:
    return Pipeline(stages=tabular_stages(cat_cols, num_cols, label_col, **kw))
