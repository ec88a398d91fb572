"""A fitted forest as a relation, and an evaluator that walks it by joins
(M10, M12, M15).

A saved forest lies as one row per node. :func:`forest_nodes` makes of it a
table ``(tree, node, feature, threshold, categories, left, right, votes,
rows)`` that SQL can read. :func:`tree_votes` scores rows with that table
alone: every row stands at the root of every tree and goes down one level per
join, so its result owes nothing to the ML transformer and can be held
against it (:func:`agreement`).

The node table is bounded by the forest's own size, which every scoring task
holds anyway; below ``MAX_SENT_NODES`` it is sent to all tasks, and all levels
run in one stage without a shuffle. A larger forest is joined by Spark's own
choice.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clasp.ml.forest_cells import above
from clasp.operators.joins import join_derived
from clasp.session import materialise, scratch_path

MAX_SENT_NODES = 1_000_000


def forest_nodes(model: RandomForestClassificationModel) -> DataFrame:
    """The fitted trees, one row per node, written in the shared folder.

    ``left`` and ``right`` are node numbers of the same tree, null at a leaf.
    A row goes left if its ``feature`` is at most ``threshold``, or, for a
    categorical feature, one of ``categories``. ``votes`` are the node's
    shares of each class times the tree's weight; ``rows`` the training rows
    that met it."""
    spark = SparkSession.active()
    path = scratch_path(spark, "forest")
    model.write().overwrite().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    n, split = F.col("nodeData"), F.col("nodeData.split")
    inner = n["leftChild"] >= 0
    total = F.aggregate(n["impurityStats"], F.lit(0.0), lambda a, x: a + x)
    nodes = spark.read.parquet(f"{path}/data").withColumnRenamed("treeID", "tree").join(F.broadcast(weights), "tree").select(
        "tree", n["id"].alias("node"), F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & (split["numCategories"] < 0), split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & (split["numCategories"] >= 0), split["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(inner, n["leftChild"]).alias("left"), F.when(inner, n["rightChild"]).alias("right"),
        F.transform(n["impurityStats"], lambda x: x / total * F.col("weight")).alias("votes"), n["impurityStats"].alias("counts"),
        n["rawCount"].alias("rows"))
    return materialise(nodes, "forest-nodes")


def tree_votes(rows: DataFrame, keep: list[str], nodes: DataFrame, depth: int, features: str = "features") -> DataFrame:
    """``keep``, ``tree``, ``steps`` (levels gone down) and ``votes`` of the
    leaf that each row reaches in each tree. ``features`` is an array of
    double, ``depth`` the deepest a tree goes."""
    trees, count, wide, sets = nodes.agg(F.max("tree") + 1, F.count(F.lit(1)), F.greatest(F.max("node"), F.max("left"), F.max("right")) + 1,
                                         F.count("categories")).first()
    # places lie close together, so a level's lookup goes by position, not by hash
    place = F.col("tree").cast("bigint") * F.lit(int(wide or 1))
    send = F.broadcast if count <= MAX_SENT_NODES else (lambda df: df)
    # a leaf leads to itself. No column can be null: all levels are generated
    # as one method, and the JVM compiles none that is longer than 8000 bytes
    here = F.coalesce(place + F.col("node"), F.lit(-1))
    steps = nodes.select(here.alias("at"), F.coalesce("feature", F.lit(0)).alias("feature"),
                         F.coalesce("threshold", F.lit(0.0)).alias("threshold"), *(["categories"] if sets else []),
                         F.coalesce(place + F.col("left"), here).alias("left"), F.coalesce(place + F.col("right"), here).alias("right"),
                         F.col("left").isNotNull().cast("int").alias("inner"))
    leaves = nodes.select(here.alias("at"), "votes")
    out = rows.select(*keep, F.col(features).alias("_x")).withColumn(
        "tree", F.explode(F.sequence(F.lit(0), F.lit(int(trees) - 1)))).withColumn("at", place).withColumn("steps", F.lit(0))
    value = F.get(F.col("_x"), F.col("feature"))
    goes_left = value <= F.col("threshold")
    if sets:
        goes_left = F.when(F.col("categories").isNull(), goes_left).otherwise(F.array_contains("categories", value))
    for _ in range(depth):
        out = out.join(send(steps), "at").select(
            *keep, "_x", "tree", (F.col("steps") + F.col("inner")).alias("steps"),
            F.when(goes_left, F.col("left")).otherwise(F.col("right")).alias("at"))
    return out.join(send(leaves), "at").select(*keep, "tree", "steps", "votes")


def forest_votes(rows: DataFrame, keys: list[str], nodes: DataFrame, depth: int, classes: int,
                 same: list[str] | tuple = ()) -> DataFrame:
    """``keys``, ``trees`` (that voted), ``steps`` over all trees, and the
    summed votes ``v0``, ``v1``, ... of each row; ``keys`` name a row, and
    ``same`` are numbers of it that come along."""
    return tree_votes(rows, [*keys, *same], nodes, depth).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trees"), F.sum("steps").alias("steps"), *[F.max(c).alias(c) for c in same],
        *[F.sum(F.col("votes")[i]).alias(f"v{i}") for i in range(classes)])


def _cell_columns(nodes: DataFrame, x: Column, width: int) -> tuple[list[Column], Column]:
    """For each feature that the forest asks for, which of the forest's own thresholds a value lies
    above (the value itself if categorical), and from those columns a feature
    array that takes the same way through every tree."""
    cuts = {r.feature: sorted(r.t) for r in nodes.where("threshold is not null").groupBy("feature")
            .agg(F.collect_set("threshold").alias("t")).collect()}
    used = {r.feature for r in nodes.where("feature is not null").select("feature").distinct().collect()}
    cell, back = [], []
    for f in range(width):
        value = F.get(x, F.lit(f))
        if f in cuts:
            cell.append(F.coalesce(above(value, cuts[f]), F.lit(-1)).alias(f"_cell{f}"))
            ends = F.array(*map(F.lit, cuts[f]), F.lit(float("inf")))
            back.append(F.get(ends, F.col(f"_cell{f}")))
        elif f in used:
            cell.append(F.coalesce(value, F.lit(float("nan"))).alias(f"_cell{f}"))
            back.append(F.col(f"_cell{f}"))
        else:
            back.append(F.lit(0.0))
    return cell, F.array(*back)


def agreement(scored: DataFrame, model: RandomForestClassificationModel, nodes: DataFrame, keep: list[str],
              keys: list[str] | None = None, digits: float = 1e-9, by_cell: bool | None = None) -> DataFrame:
    """Rows that ``model`` scored, held against the walk: ``keep``, ``trees``
    (that voted), ``steps`` (over all trees: 0 for a classifier without
    splits), ``walked`` (the class with the most votes, the first of equals)
    and ``agrees``: every class's share of the votes is the model's
    ``probability``, and ``prediction`` is a class with the most.

    A forest over few features parts them into cells, at most the product of
    its bins, however many rows there are: each occurring cell is walked once
    and rows are joined to their cell. For vectors of many features, give
    ``keys`` that name a row; then each row is walked. With ``by_cell`` too,
    cells are walked, and rows of the same ``keys`` and ``keep`` come as one
    as they do in a walk by row."""
    k, names = model.numClasses, ["_c", *[f"_p{i}" for i in range(model.numClasses)]]
    every = list(dict.fromkeys([*(keys or []), *keep]))
    # arrays are made once for each row, whatever many columns read them
    rows = scored.select(*every, F.col("prediction").alias("_c"), vector_to_array("probability").alias("_p"), vector_to_array("features").alias("_x"))
    own = ["_c", *[F.get("_p", F.lit(i)).alias(f"_p{i}") for i in range(k)]]
    if keys and not by_cell:
        out = forest_votes(rows.select(*every, *own, F.col("_x").alias("features")), every, nodes, model.getMaxDepth(), k, names)
    else:
        cell, back = _cell_columns(nodes, F.col("_x"), model.numFeatures)
        rows = rows.select(*every, *own, F.lit(0).alias("_cell"), *cell)  # a forest without splits has one cell
        places = [c for c in rows.columns if c.startswith("_cell")]
        # cells are few and each is walked through every tree: one partition a core at least
        spark = scored.sparkSession
        wide = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        one = rows.select(*places).distinct().repartition(wide, *places).select(*places, back.alias("features"))
        out = join_derived(rows, forest_votes(one, places, nodes, model.getMaxDepth(), k), places)
        if keys:
            out = out.groupBy(*every).agg(F.sum("trees").alias("trees"), F.sum("steps").alias("steps"), *[F.max(c).alias(c) for c in names],
                                          *[F.sum(f"v{i}").alias(f"v{i}") for i in range(k)])
    total = sum((F.col(f"v{i}") for i in range(1, k)), F.col("v0"))
    near = F.lit(True)
    for i in range(k):
        near = near & (F.abs(F.col(f"v{i}") / total - F.col(f"_p{i}")) <= digits)
    every = F.array(*[F.col(f"v{i}") for i in range(k)])
    most = F.get(every, F.col("_c").cast("int")) >= F.array_max(every) - digits * total
    return out.select(*keep, "trees", "steps", (F.array_position(every, F.array_max(every)) - 1).cast("int").alias("walked"),
                      (near & most).alias("agrees"))


def tree_checks(nodes: DataFrame, depth: int) -> DataFrame:
    """One row per tree: ``linked`` (every node is reached from the root by
    exactly one way of at most ``depth`` steps, and inner nodes have two
    children), ``adds_up`` (an inner node's class counts and training rows
    are those of its children) and ``splits`` (it has an inner node)."""
    inner = F.col("left").isNotNull()
    edges = nodes.where(inner).select("tree", F.explode(F.array("left", "right")).alias("node"), F.col("node").alias("above"))
    level = nodes.where("node = 0").select("tree", "node")
    met = level
    for _ in range(depth):
        level = edges.join(level.withColumnRenamed("node", "above"), ["tree", "above"]).select("tree", "node")
        met = met.unionByName(level)
    ways = nodes.join(met.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("ways")), ["tree", "node"], "left").groupBy("tree").agg(
        F.bool_and(F.coalesce(F.col("ways"), F.lit(0)) == 1).alias("linked"), F.bool_or(inner).alias("splits"))
    below = edges.join(nodes.select("tree", "node", F.col("counts").alias("c"), F.col("rows").alias("r")), ["tree", "node"])
    k = F.size("counts")
    sums = (below.select("tree", F.col("above").alias("node"), "r", F.posexplode("c").alias("i", "c")).groupBy("tree", "node", "i")
            .agg(F.sum("c").alias("c"), F.sum("r").alias("r"), F.count(F.lit(1)).alias("children")))
    same = (F.abs(F.get("counts", F.col("i")) - F.col("c")) <= 1e-6) & (F.col("r") == F.col("rows")) & (F.col("children") == 2)
    adds = (nodes.where(inner).join(sums, ["tree", "node"], "left").groupBy("tree", "node")
            .agg(F.count_if(same).alias("n"), F.max(k).alias("k")).groupBy("tree").agg(F.bool_and(F.col("n") == F.col("k")).alias("adds_up")))
    return ways.join(adds, "tree", "left").select("tree", "linked", F.coalesce("adds_up", F.lit(True)).alias("adds_up"), "splits")
