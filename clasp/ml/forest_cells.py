"""A forest fitted on cells instead of rows.

The forest learner reads a numeric feature only as one of ``maxBins`` bins and
a row only as often as a tree's bootstrap draws it. Rows with the same bins,
categories and label are therefore one to it: over few features they make at
most the product of their bins, however many rows there are. A tree's
bootstrap gives each row a Poisson(1) number of copies, so a cell of ``n``
rows has a Poisson(n) number, drawn here for every tree and cell. Spark's
learner then grows each tree on the cells with that weight. The forest has the
distribution it has on rows, and a level of a tree costs a pass over cells.

Bin edges are taken as Spark takes them: from a sample of about 10,000 rows
(or the square of the bins), half way between neighbouring values. The trees
are grown over the numbers of the bins and get the edges as thresholds.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clasp.session import materialise, scratch_path

# Execution settings only: below so many rows, or with more than a row in so
# many a cell of its own, the learner reads the rows themselves.
LEAST_ROWS = 1_000_000
ROWS_PER_CELL = 4
MAX_FEATURES = 64
CELLS_PER_TASK = 100_000


def above(value: Column, cuts: list[float]) -> Column:
    """How many of ``cuts`` a value lies above."""
    return sum(((value > t).cast("int") for t in cuts[1:]), (value > cuts[0]).cast("int")) if cuts else F.lit(0)


def edges(values: np.ndarray, bins: int) -> list[float]:
    """Edges between the bins of a sampled feature, as the learner finds them:
    all midpoints of few values, else those next to equal shares."""
    found, counts = np.unique(values, return_counts=True)
    mid = (found[:-1] + found[1:]) / 2
    if len(mid) < bins:
        return mid.tolist()
    stride, out, held = len(values) / bins, [], int(counts[0])
    target = stride
    for at in range(1, len(found)):
        more = held + int(counts[at])
        if abs(held - target) < abs(more - target):
            out.append(float(mid[at - 1]))
            target += stride
        held = more
    return out


def _numeric(features: dict, width: int) -> list[int]:
    """Features that are no categories, by the vector's attributes."""
    kinds = features.get("attrs", {})
    named = {a["idx"] for k in ("binary", "nominal") for a in kinds.get(k, [])}
    return [i for i in range(width) if i not in named]


def _bagged(trees: int, seed: int):
    """Copies of a cell in each tree's bootstrap, by the cell's own numbers
    whatever task it is in."""
    def run(batches):
        for batch in batches:
            drawn = [np.random.Generator(np.random.Philox(key=[seed, name & (2 ** 64 - 1)])).poisson(n, trees)
                     for name, n in zip(batch.column("_name").to_pylist(), batch.column("_n").to_pylist())]
            flat = pa.array(np.concatenate(drawn) if drawn else np.empty(0), pa.int64())
            bag = pa.ListArray.from_arrays(pa.array(np.arange(len(drawn) + 1) * trees, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("_bins"), batch.column("_label"), bag], names=["_bins", "_label", "_bag"])
    return run


def fit(pipeline: Pipeline, rows: DataFrame, least_rows: int = LEAST_ROWS, rows_per_cell: int = ROWS_PER_CELL) -> PipelineModel | None:
    """``pipeline``, whose last stage is a forest, fitted on the cells of
    ``rows`` (persist them: they are read several times), or nothing where
    there are too few rows for each cell to gain by it."""
    *stages, forest = pipeline.getStages()
    plain = (isinstance(forest, RandomForestClassifier) and forest.getBootstrap() and forest.getSubsamplingRate() == 1.0
             and forest.getNumTrees() > 1 and not forest.isSet("weightCol"))
    n = rows.count()
    if not plain or n < least_rows:
        return None
    prep = Pipeline(stages=stages).fit(rows)
    features, label = forest.getFeaturesCol(), forest.getLabelCol()
    prepared = prep.transform(rows).select(features, F.col(label).alias("_label"))
    about, classes = prepared.schema[features].metadata, prepared.schema["_label"].metadata
    width = about.get("ml_attr", {}).get("num_attrs", 0)
    if not 0 < width <= MAX_FEATURES:
        return None
    numeric, bins = _numeric(about["ml_attr"], width), forest.getMaxBins()
    arrays = prepared.select(vector_to_array(features).alias("_x"), "_label")
    share = max(bins * bins, 10_000) / n
    sample = np.array([r[0] for r in (arrays.sample(False, share, forest.getSeed()) if share < 1 else arrays).select("_x").collect()])
    if not len(sample) or not np.isfinite(sample).all():
        return None
    cuts = {i: edges(sample[:, i], bins) for i in numeric}
    bin_of = [above(F.get("_x", F.lit(i)), cuts[i]) if i in cuts else F.get("_x", F.lit(i)).cast("int") for i in range(width)]
    placed = arrays.select(F.array(*[F.coalesce(b, F.lit(-1)) for b in bin_of]).alias("_bins"), "_label")
    if placed.agg(F.approx_count_distinct(F.struct("_bins", "_label"))).first()[0] * rows_per_cell > n:
        return None
    cells = materialise(placed.groupBy("_bins", "_label").agg(F.count(F.lit(1)).alias("_n")), "forest-cells")
    named = cells.withColumn("_name", F.xxhash64("_bins", "_label"))
    trees, seed = forest.getNumTrees(), forest.getSeed()
    bags = named.mapInArrow(_bagged(trees, seed & (2 ** 64 - 1)), "_bins array<int>, _label double, _bag array<bigint>").select(
        array_to_vector(F.col("_bins").cast("array<double>")).alias(features, metadata=about),
        F.col("_label").alias(label, metadata=classes), "_bag")
    bags = bags.repartition(max(1, -(-cells.count() // CELLS_PER_TASK))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        bags.count()
        grown = _grown(forest, bags, features, label)
    finally:
        bags.unpersist()
    return PipelineModel(stages=[*prep.stages, _joined(forest, grown, cuts)])


def _grown(forest: RandomForestClassifier, bags: DataFrame, features: str, label: str) -> list:
    """A forest of one tree for each bootstrap, several at a time."""
    spark, trees = bags.sparkSession, forest.getNumTrees()
    strategy = forest.getFeatureSubsetStrategy()
    strategy = "sqrt" if strategy == "auto" else strategy  # what auto is for several trees

    def grow(tree: int):
        copies = F.get("_bag", F.lit(tree))
        one = forest.copy({forest.numTrees: 1, forest.bootstrap: False, forest.featureSubsetStrategy: strategy, forest.weightCol: "_copies",
                           forest.cacheNodeIds: False, forest.seed: forest.getSeed() + 1 + tree})
        return one.fit(bags.where(copies > 0).select(features, label, copies.cast("double").alias("_copies")))

    pool = ThreadPool(min(trees, spark.sparkContext.defaultParallelism, 16))
    try:
        return pool.map(inheritable_thread_target(spark)(grow), range(trees), chunksize=1)
    finally:
        pool.close()


def _joined(forest: RandomForestClassifier, grown: list, cuts: dict[int, list[float]]) -> RandomForestClassificationModel:
    """One forest of the trees, with bin edges as thresholds and training
    rows counted as drawn, not by cells."""
    spark = SparkSession.active()
    sc = spark.sparkContext
    ml = sc._jvm.org.apache.spark.ml.classification
    trees = sc._gateway.new_array(ml.DecisionTreeClassificationModel, len(grown))
    for i, one in enumerate(grown):
        trees[i] = one._java_obj.trees()[0]
    by_bins, path = scratch_path(spark, "forest-by-bins"), scratch_path(spark, "forest-fitted")
    whole = RandomForestClassificationModel(ml.RandomForestClassificationModel(
        forest.uid, trees, grown[0].numFeatures, grown[0].numClasses))
    for param, value in forest._paramMap.items():
        if whole.hasParam(param.name):
            whole.set(whole.getParam(param.name), value)
    whole.write().overwrite().save(by_bins)
    node, split, edge = F.col("nodeData"), F.col("nodeData.split"), F.lit(None).cast("double")
    goes = split["leftCategoriesOrThreshold"]
    at = F.floor(F.get(goes, F.lit(0))).cast("int")
    for feature, cut in cuts.items():
        if cut:
            edge = F.when(split["featureIndex"] == feature, F.get(F.array(*map(F.lit, cut)), at)).otherwise(edge)
    numeric = (node["leftChild"] >= 0) & (split["numCategories"] < 0)
    drawn = F.aggregate(node["impurityStats"], F.lit(0.0), lambda a, x: a + x).cast("bigint")
    spark.read.parquet(f"{by_bins}/data").withColumn("nodeData", node.withField(
        "split.leftCategoriesOrThreshold", F.when(numeric, F.array(edge)).otherwise(goes)).withField("rawCount", drawn)).write.parquet(f"{path}/data")
    spark.read.parquet(f"{by_bins}/treesMetadata").write.parquet(f"{path}/treesMetadata")
    spark.read.text(f"{by_bins}/metadata").write.text(f"{path}/metadata")
    return RandomForestClassificationModel.load(path)
