"""The forest's node table: structure, and votes equal to the ML
transformer's tree by tree; wrong or constant classifiers turn it red."""

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clasp.ml import forest_table, models, tabular, text

CATS, NUMS = ["Sex", "ChestPainType"], ["Age", "Oldpeak"]


@pytest.fixture(scope="module")
def patients(spark):
    r = random.Random(5)
    rows = []
    for i in range(300):
        cp, age = r.choice(["ATA", "NAP", "ASY", "TA"]), r.randint(30, 80)
        rows.append((i, r.choice(["M", "F"]), cp, float(age), r.random() * 6, ["low", "mid", "high"][(cp == "ASY") + (age > 60)]))
    return spark.createDataFrame(rows, "pid int, Sex string, ChestPainType string, Age double, Oldpeak double, risk string").repartition(3)


def fitted(data, **kw):
    return tabular.tabular_pipeline(CATS, NUMS, "risk", **({"num_trees": 7, "max_depth": 5} | kw)).fit(data)


@pytest.fixture(scope="module")
def model(patients):
    return fitted(patients)


@pytest.fixture(scope="module")
def nodes(model):
    return forest_table.forest_nodes(model.stages[-1])


def test_node_table_is_the_forest(model, nodes):
    forest = model.stages[-1]
    assert nodes.count() == forest.totalNumNodes
    rows = forest_table.tree_checks(nodes, 5).collect()
    assert sorted(x.tree for x in rows) == list(range(7)) and all(x.linked and x.adds_up and x.splits for x in rows)


def test_votes_of_every_tree_equal_the_transformer(model, nodes, patients):
    scored = model.transform(patients)
    votes = {(x.pid, x.tree): list(x.votes) for x in forest_table.tree_votes(
        scored.select("pid", vector_to_array("features").alias("features")), ["pid"], nodes, 5).collect()}
    assert len(votes) == 300 * 7
    for t, tree in enumerate(model.stages[-1].trees):
        own = tree.transform(scored.select("pid", "features")).select("pid", vector_to_array("probability").alias("p")).collect()
        assert all(votes[x.pid, t] == pytest.approx(list(x.p), abs=1e-12) for x in own)


@pytest.mark.parametrize("keys", [None, ["pid"]])
def test_agreement_by_row_and_by_cell(model, nodes, patients, keys):
    odd = patients.withColumn("Age", F.when(F.col("pid") % 50 == 0, float("inf")).otherwise(F.col("Age"))).withColumn(
        "Sex", F.when(F.col("pid") % 40 == 0, "never seen").otherwise(F.col("Sex")))
    scored = models.score(model, odd, "risk")
    out = forest_table.agreement(scored, model.stages[-1], nodes, ["pid", "risk", "prediction"], keys=keys).collect()
    assert len(out) == 300 and all(x.agrees and x.trees == 7 and 0 < x.steps <= 35 for x in out)


def test_cells_are_fewer_than_rows(spark, model, nodes, patients):
    many = patients.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20))))
    out = forest_table.agreement(models.score(model, many, "risk"), model.stages[-1], nodes, ["pid", "copy"])
    assert out.count() == 6000 and out.where("agrees").count() == 6000


def test_a_wrong_turn_a_lost_tree_and_a_wrong_prediction_show(model, nodes, patients):
    scored, forest = models.score(model, patients, "risk"), model.stages[-1]
    turned = nodes.withColumns({"left": F.col("right"), "right": F.col("left")})
    assert not forest_table.agreement(scored, forest, turned, ["pid"]).where("agrees").count() == 300
    fewer = nodes.where("tree != 3 or node != 0")
    assert forest_table.agreement(scored, forest, fewer, ["pid"]).where("trees = 7").count() == 0
    assert not all(x.linked for x in forest_table.tree_checks(fewer, 5).collect())
    constant = scored.withColumn("prediction", F.lit(0.0))
    assert forest_table.agreement(constant, forest, nodes, ["pid"]).where("not agrees").count() > 0
    lost = nodes.withColumn("counts", F.transform("counts", lambda x: x + F.col("node") % 2))
    assert not all(x.adds_up for x in forest_table.tree_checks(lost, 5).collect())


def test_a_classifier_without_splits_shows(patients):
    flat = fitted(patients, max_depth=0)
    nodes = forest_table.forest_nodes(flat.stages[-1])
    out = forest_table.agreement(models.score(flat, patients, "risk"), flat.stages[-1], nodes, ["pid"]).collect()
    assert len(out) == 300 and {x.steps for x in out} == {0}
    assert not any(x.splits for x in forest_table.tree_checks(nodes, 0).collect())


def test_text_forest(spark):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(["good", "fine", "nice"] if i % 2 else ["bad", "poor", "sad"]) + str(r.randint(0, 9)) for _ in range(12)), i % 2)
            for i in range(60)]
    docs = spark.createDataFrame(rows + [(98, None, 0), (99, "", 1)], "doc int, texto string, etiqueta int")
    model = text.text_pipeline(num_trees=6, max_depth=4).fit(docs)
    nodes = forest_table.forest_nodes(model.stages[-1])
    out = forest_table.agreement(models.score(model, docs, "etiqueta"), model.stages[-1], nodes, ["doc"], keys=["doc"]).collect()
    assert len(out) == 62 and all(x.agrees and x.trees == 6 for x in out)


def test_one_stage_without_a_shuffle(model, nodes, patients):
    """All levels of the walk run where the rows are."""
    scored = model.transform(patients).select("pid", vector_to_array("features").alias("features"))
    plan = forest_table.tree_votes(scored, ["pid"], nodes, 5)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 6


def test_a_deep_walk_is_compiled(spark, model, nodes, patients):
    """The method generated for ten levels stays below the 8000 bytes beyond
    which the JVM only interprets it."""
    scored = model.transform(patients).select("pid", "risk", "Sex", vector_to_array("features").alias("features"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = forest_table.forest_votes(scored, ["pid", "risk", "Sex"], nodes, 10, 3)
        made = plan._jdf.queryExecution().debug().codegenToSeq()
        sizes = [made.apply(i)._3().maxMethodCodeSize() for i in range(made.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert 0 < max(sizes) < 8000, sizes


def test_a_pointer_to_a_lost_node_leads_nowhere(model, nodes, patients):
    """Without the last nodes of every tree, rows that go there lose the tree."""
    last = nodes.groupBy("tree").agg(F.max("node").alias("node"))
    rows = model.transform(patients).select("pid", vector_to_array("features").alias("features"))
    whole = forest_table.tree_votes(rows, ["pid"], nodes, 5)
    met = rows.crossJoin(last.select("tree")).count()
    left = forest_table.tree_votes(rows, ["pid"], nodes.join(last, ["tree", "node"], "left_anti"), 5)
    lost = whole.join(left.select("pid", "tree"), ["pid", "tree"], "left_anti")
    assert whole.count() == met and 0 < lost.count() == met - left.count()
    assert whole.join(left, ["pid", "tree", "steps", "votes"], "left_semi").count() == left.count()


def test_cells_give_the_rows_of_a_walk_by_row(model, nodes, patients):
    """Also where rows come twice, which a walk by row takes as one."""
    twice = patients.unionByName(patients.where("pid < 50")).withColumn("risk", F.when(F.col("pid") % 9 > 0, F.col("risk")))
    scored, keep = models.score(model, twice, "risk"), ["pid", "risk", "prediction"]
    rows, cells = (forest_table.agreement(scored, model.stages[-1], nodes, keep, keys=["pid"], by_cell=by) for by in (False, True))
    assert rows.count() == cells.count() == 300
    assert rows.select(cells.columns).exceptAll(cells).count() == 0 and cells.where("trees = 14").count() == 50


def test_features_are_read_once_for_all_cells(model, nodes, patients):
    """One array of a row's features for its cell and one for its place
    among the rows, not one for each threshold."""
    out = forest_table.agreement(models.score(model, patients, "risk"), model.stages[-1], nodes, ["pid"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("UDF(features") <= 3, plan.count("UDF(features")
