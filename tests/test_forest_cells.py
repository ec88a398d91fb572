"""A forest fitted on cells: the same bins, the same bootstrap in
distribution, real thresholds, and rows where cells spare nothing."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from clasp.ml import forest_cells, forest_table, models, tabular
from clasp.ml.training import fit_persisted

CATS, NUMS = ["sex", "kind"], ["age", "level"]


@pytest.fixture(scope="module")
def patients(spark):
    r = random.Random(8)
    rows = []
    for i in range(6000):
        kind, age = r.choice(["ATA", "NAP", "ASY", "TA"]), r.randint(30, 45)
        rows.append((i, r.choice(["M", "F", None]), kind, float(age), round(r.random(), 1), ["low", "mid", "high"][(kind == "ASY") + (age > 40)]))
    return spark.createDataFrame(rows, "pid int, sex string, kind string, age double, level double, risk string").repartition(3).persist()


def pipeline(**more):
    return tabular.tabular_pipeline(CATS, NUMS, "risk", **({"num_trees": 12, "max_depth": 4} | more))


@pytest.fixture(scope="module")
def model(patients):
    return forest_cells.fit(pipeline(), patients, least_rows=100, rows_per_cell=1)


def test_trees_are_grown_on_cells_and_count_rows(model, patients):
    """Every tree's root has about as many drawn rows as there are, not as
    there are cells, and no two trees the same bootstrap."""
    forest = model.stages[-1]
    assert forest.getNumTrees == 12 and forest.getMaxDepth() == 4 and forest.numClasses == 3 and forest.numFeatures == len(NUMS) + 3 + 4 - 1
    nodes = forest_table.forest_nodes(forest)
    roots = [r.rows for r in nodes.where("node = 0").collect()]
    assert len(set(roots)) > 6 and all(abs(n - 6000) < 6 * 6000 ** 0.5 for n in roots)
    checks = forest_table.tree_checks(nodes, 4).collect()
    assert len(checks) == 12 and all(c.linked and c.adds_up and c.splits for c in checks)
    edges = {(r.feature, r.threshold) for r in nodes.where("threshold is not null").collect()}
    assert {f for f, _ in edges} == {0, 1} and {t for f, t in edges if f == 0} <= {x + 0.5 for x in range(30, 45)}
    assert all(abs(t * 20 - round(t * 20)) < 1e-9 and 0 < t < 1 for f, t in edges if f == 1)


def test_it_predicts_as_a_forest_on_rows(model, patients):
    plain = pipeline().fit(patients)
    a, b = (models.score(m, patients, "risk").select("pid", F.col("prediction").alias(n)) for m, n in ((model, "a"), (plain, "b")))
    assert a.join(b, "pid").where("a = b").count() > 0.97 * 6000
    out = forest_table.agreement(models.score(model, patients, "risk"), model.stages[-1], forest_table.forest_nodes(model.stages[-1]), ["pid"])
    assert out.where("agrees and trees = 12").count() == 6000
    again = forest_cells.fit(pipeline(), patients.repartition(7), least_rows=100, rows_per_cell=1)
    assert again.stages[-1].toDebugString.split("\n")[1:] == model.stages[-1].toDebugString.split("\n")[1:]


def test_copies_of_rows_cost_no_more(spark, patients):
    """The learner reads cells, however many rows lie in them."""
    seen = []

    class Forest(type(models.forest())):
        def fit(self, df, params=None):
            seen.append(df.count())
            return super().fit(df, params)

    few = pipeline(num_trees=2)
    few.getStages()[-1].__class__ = Forest
    many = patients.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20)))).persist()
    cells = patients.select(*CATS, *NUMS, "risk").distinct().count()
    fitted = forest_cells.fit(few, many, least_rows=100)
    assert len(seen) == 2 and max(seen) <= cells < 6000 and fitted.stages[-1].getNumTrees == 2


def test_rows_are_read_where_cells_spare_nothing(patients):
    fit = lambda p, rows, **kw: forest_cells.fit(p, rows, **({"least_rows": 100} | kw))
    assert fit(pipeline(), patients, least_rows=7000) is None
    assert fit(pipeline(), patients, rows_per_cell=10 ** 6) is None
    assert fit(pipeline(num_trees=1), patients) is None
    assert fit(Pipeline(stages=pipeline().getStages()[:-1]), patients) is None
    assert fit(pipeline(), patients.withColumn("age", F.lit(float("inf")))) is None
    assert fit_persisted(pipeline(num_trees=3), patients, cells=True).stages[-1].getNumTrees == 3


def test_edges_lie_between_equal_shares():
    assert forest_cells.edges(np.array([1.0, 1.0, 2.0, 5.0]), 32) == [1.5, 3.5]
    assert forest_cells.edges(np.array([3.0, 3.0]), 32) == []
    assert forest_cells.edges(np.arange(100.0), 4) == [24.5, 49.5, 74.5]
    assert len(forest_cells.edges(np.random.default_rng(1).normal(size=10_000), 32)) == 31
