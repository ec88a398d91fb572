"""Model operators on literal rows (FIXTURES §3): label decode, the
phantom class of ``keep``, one-hot of unseen values, assembler nulls,
accuracy above the majority share, save/load parity."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clasp.ml import models, splits, tabular, text
from clasp.ml.training import fit_persisted


@pytest.fixture(scope="module")
def patients(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        sex = rng.choice(["M", "F"])
        cp = rng.choice(["ATA", "NAP", "ASY", "TA"])
        age = rng.randint(30, 80)
        chol = rng.randint(150, 300)
        # the label follows the chest-pain type and age: learnable signal
        hd = 1 if (cp == "ASY" or age > 65) else 0
        rows.append((i, age, sex, cp, chol, float(rng.random()), hd))
    return spark.createDataFrame(rows, "pid int, Age int, Sex string, ChestPainType string, "
                                       "Cholesterol int, Oldpeak double, HeartDisease int")


def test_label_keep_adds_phantom_class_error_does_not(spark, patients):
    cats, nums = ["Sex", "ChestPainType"], ["Age", "Cholesterol", "Oldpeak"]
    model = tabular.tabular_pipeline(cats, nums, "HeartDisease", num_trees=5, max_depth=3).fit(patients)
    assert model.stages[-1].numClasses == 2
    keep = Pipeline(stages=tabular.tabular_stages(cats, nums, "HeartDisease", num_trees=5, max_depth=3)[:3] + [
        StringIndexer(inputCol="HeartDisease", outputCol="label", handleInvalid="keep"),
        models.forest(num_trees=5, max_depth=3)]).fit(patients)
    assert keep.stages[-1].numClasses == 3


def test_forest_beats_majority_and_decodes_to_label_type(spark, patients):
    cats, nums = ["Sex", "ChestPainType"], ["Age", "Cholesterol", "Oldpeak"]
    data = splits.hash_split(patients, "pid", 80)
    model = tabular.tabular_pipeline(cats, nums, "HeartDisease", num_trees=20, max_depth=5).fit(
        data.where("split = 'train'"))
    test = data.where("split = 'test'")
    pred = models.decode_prediction(model.transform(test), model, label_type="int")
    assert dict(pred.dtypes)["prediction"] == "int"
    acc = pred.select(F.avg((F.col("prediction") == F.col("HeartDisease")).cast("double"))).first()[0]
    majority = test.groupBy("HeartDisease").count().agg(F.max("count")).first()[0] / test.count()
    assert acc > majority
    # decoded label agrees with the index through the fitted label list
    labels = models.label_list(model)
    for r in pred.select("prediction_index", "prediction").collect():
        assert str(r.prediction) == labels[int(r.prediction_index)]


def test_score_without_label_column(spark, patients):
    cats, nums = ["Sex", "ChestPainType"], ["Age", "Cholesterol", "Oldpeak"]
    model = tabular.tabular_pipeline(cats, nums, "HeartDisease", num_trees=5, max_depth=3).fit(patients)
    renamed = patients.withColumnRenamed("HeartDisease", "heart_disease_label")
    assert model.transform(renamed).count() == patients.count()


def test_one_hot_unseen_and_null_encode_as_zeros(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "c string")
    enc = Pipeline(stages=[tabular.category_indexer(["c"]), tabular.one_hot(["c"])]).fit(train)
    test = spark.createDataFrame([("a",), ("zzz",), (None,)], "c string")
    arrs = [list(r[0]) for r in enc.transform(test).select(vector_to_array("c_vec")).collect()]
    assert arrs == [[1.0, 0.0, 0.0], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]]


def test_assembler_null_raises(spark):
    df = spark.createDataFrame([(None, "a")], "x double, c string")
    pipe = Pipeline(stages=[tabular.category_indexer(["c"]), tabular.one_hot(["c"]),
                            tabular.assembler(["x"], ["c"])]).fit(df)
    with pytest.raises(Exception):
        pipe.transform(df).collect()


def test_decode_out_of_range_raises(spark):
    df = spark.createDataFrame([("x",), ("y",)], "l string")
    model = Pipeline(stages=[StringIndexer(inputCol="l", outputCol="label")]).fit(df)
    bad = spark.createDataFrame([(2.0,)], "prediction double")
    with pytest.raises(Exception):
        models.decode_prediction(bad, model).collect()


def test_label_stage_found_by_output_column(spark, patients):
    cats, nums = ["Sex", "ChestPainType"], ["Age", "Cholesterol", "Oldpeak"]
    model = tabular.tabular_pipeline(cats, nums, "HeartDisease", num_trees=3, max_depth=2).fit(patients)
    assert set(models.label_list(model)) == {"0", "1"}


def test_text_pipeline_scores_null_text_and_saves(spark, tmp_path):
    pos = [f"good{i}" for i in range(60)]
    neg = [f"bad{i}" for i in range(60)]
    rows = [(" ".join(pos[i:i + 30]), "pos") for i in range(30)] + \
           [(" ".join(neg[i:i + 30]), "neg") for i in range(30)]
    df = spark.createDataFrame(rows, "texto string, etiqueta string")
    model = text.text_pipeline(num_trees=30, max_depth=4).fit(df)
    new = spark.createDataFrame([(" ".join(pos[10:40]),), (None,)], "texto string")
    scored = models.decode_prediction(models.score(model, new), model)
    got = [r.prediction for r in scored.collect()]
    assert got[0] == "pos" and len(got) == 2
    from clasp.sources.sinks import save_model
    from clasp.sources.tables import load_model
    save_model(model, str(tmp_path / "m"))
    again = load_model(str(tmp_path / "m"))
    a = [r.prediction for r in model.transform(df).collect()]
    b = [r.prediction for r in again.transform(df).collect()]
    assert a == b


def test_hash_split_independent_of_partitioning(spark):
    base = spark.range(0, 2000).select(F.col("id").cast("string").alias("k"))
    one = splits.hash_split(base.repartition(1), "k", 70).where("split='train'").count()
    many = splits.hash_split(base.repartition(13), "k", 70).where("split='train'").count()
    assert one == many and 1200 < one < 1600


def test_no_training_task_holds_too_many_rows(spark, patients):
    """One large partition is dealt out before the fit; small ones stay."""
    class Fit:
        def fit(self, df):
            self.storage = df.storageLevel.useMemory
            self.ids = sorted(r.pid for r in df.select("pid").collect())
            return [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]

    for rows, limit, tasks, most in ((patients.coalesce(1), 30, 14, 40), (patients.coalesce(1), 400, 1, 400), (patients.repartition(2), 250, 2, 250)):
        fit = Fit()
        sizes = fit_persisted(fit, rows, rows_per_task=limit)
        assert len(sizes) == tasks and max(sizes) <= most and fit.ids == list(range(400)) and fit.storage
    assert fit_persisted(Fit(), patients.where("pid < 0"), rows_per_task=30) == []


def test_rows_are_scored_in_the_order_of_the_forests_bins(spark, patients):
    """Also below a join; the rows and their predictions are the same."""
    cats, nums = ["Sex", "ChestPainType"], ["Age", "Cholesterol", "Oldpeak"]
    model = tabular.tabular_pipeline(cats, nums, "HeartDisease", num_trees=5, max_depth=4).fit(patients)
    odd = patients.withColumn("Sex", F.when(F.col("pid") % 7 > 0, F.col("Sex"))).coalesce(1)
    plain = model.transform(odd.withColumnRenamed("HeartDisease", "hd")).select("pid", "prediction", "probability")
    scored = models.score(model, odd, "HeartDisease").select("pid", "prediction", "probability")
    assert sorted(map(str, plain.collect())) == sorted(map(str, scored.collect()))
    joined = scored.join(spark.range(400).select(F.col("id").cast("int").alias("pid")), "pid")
    assert "Sort [__x" in joined._jdf.queryExecution().optimizedPlan().toString()
    cuts = models._thresholds(model.stages[-1])
    ages = [sum(r.Age > t for t in cuts[0]) for r in models.score(model, odd, "HeartDisease").select("Age").collect()]
    assert ages == sorted(ages)
