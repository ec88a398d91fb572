"""End-to-end job flows on small literal inputs: text batch, tabular
train -> stream score (hand-off through the saved model), enrichment,
per-value typed replay messages."""

import json
import random
from datetime import datetime

from pyspark.sql import functions as F

from clasp.jobs import enrich, replay, stream_score, tabular_train, text_batch
from clasp.jobs.config import StreamJobConfig, TabularJobConfig, TextJobConfig
from clasp.session import scratch_path
from clasp.sources.specs import StreamSpec, TableSpec


def test_text_batch_job(spark):
    rows = [("great product love it", "positivo"), ("terrible awful waste", "negativo"),
            ("the file was uploaded", "neutral")] * 20
    df = spark.createDataFrame(rows, "texto string, etiqueta string")
    cfg = TextJobConfig(data_path="unused", model_path=scratch_path(spark, "tm"),
                        results=TableSpec(path=scratch_path(spark, "tr")),
                        metrics=TableSpec(path=scratch_path(spark, "tmet")), num_trees=10, max_depth=4)
    text_batch.run(spark, cfg, data=df)
    res = spark.read.parquet(cfg.results.path)
    assert res.count() == 60 and set(res.columns) == {"texto", "etiqueta", "prediction",
                                                     "fecha_proceso", "accuracy_test"}
    m = spark.read.parquet(cfg.metrics.path).first()
    assert m.train_size + m.test_size == 60 and m.fecha is not None


def _records(spark, n=300):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        cp = rng.choice(["ATA", "NAP", "ASY", "TA"])
        age = rng.randint(30, 80)
        rows.append((age, rng.choice(["M", "F"]), cp, rng.randint(100, 160), rng.randint(150, 300),
                     rng.randint(0, 1), rng.choice(["Normal", "ST"]), rng.randint(90, 190),
                     rng.choice(["Y", "N"]), round(rng.random() * 3, 1), rng.choice(["Up", "Flat"]),
                     1 if cp == "ASY" or age > 65 else 0))
    from clasp.jobs.schemas import RECORD_SCHEMA
    return spark.createDataFrame(rows, RECORD_SCHEMA)


def test_train_then_stream_score(spark):
    data = _records(spark)
    tcfg = TabularJobConfig(model_path=scratch_path(spark, "hm"),
                            metrics=TableSpec(path=scratch_path(spark, "hmet")), num_trees=10, max_depth=4)
    tabular_train.run(spark, tcfg, data=data)
    assert spark.read.parquet(tcfg.metrics.path).count() == 1
    src = scratch_path(spark, "hin")
    msgs = replay.guessed_json(data.select([F.col(c).cast("string").alias(c) for c in data.columns]))
    bad = spark.createDataFrame([('{"Age": "x"}',), ("not json",)], "value string")
    msgs.unionByName(bad).coalesce(2).write.text(src)
    scfg = StreamJobConfig(model_path=tcfg.model_path, source=StreamSpec(format="text", path=src),
                           sink_path=scratch_path(spark, "hout"), quarantine_path=scratch_path(spark, "hq"),
                           checkpoint=scratch_path(spark, "hck"))
    q = stream_score.start(spark, scfg, available_now=True)
    q.awaitTermination()
    out = spark.read.parquet(scfg.sink_path)
    assert out.count() == 300
    assert dict(out.dtypes)["prediction"] == "int"
    acc = out.select(F.avg((F.col("prediction") == F.col("heart_disease_label")).cast("double"))).first()[0]
    assert acc > 0.6
    assert spark.read.parquet(scfg.quarantine_path).count() == 2


def test_guessed_json_types_per_value(spark):
    df = spark.createDataFrame([("40", "M", "1.5"), ("40.0", "F", "x"), (None, "7", "nan")],
                               "a string, b string, c string")
    got = [json.loads(r.value) for r in replay.guessed_json(df).collect()]
    assert got[0] == {"a": 40, "b": "M", "c": 1.5}
    assert got[1] == {"a": 40.0, "b": "F", "c": "x"} and isinstance(got[1]["a"], float)
    assert got[2]["a"] is None and got[2]["b"] == 7 and got[2]["c"] != got[2]["c"]


def test_enrich_numbers_in_file_order(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("texto,etiqueta\n" + "".join(f"t{i},l{i % 3}\n" for i in range(50)))
    from clasp.jobs.schemas import TEXT_SCHEMA
    from clasp.sources.tables import read_csv
    out = enrich.run(read_csv(spark, str(p), TEXT_SCHEMA),
                     datetime(2025, 11, 1), datetime(2026, 2, 1), seed=1).orderBy("id").collect()
    assert [r.id for r in out] == list(range(1, 51))
    assert [r.texto for r in out] == [f"t{i}" for i in range(50)]
    assert [r.fecha for r in out] == sorted(r.fecha for r in out)


def test_texts_with_line_breaks_come_back_whole(spark, tmp_path, monkeypatch):
    """The text jobs read quoted line breaks if MULTILINE says so."""
    from clasp.sources.sinks import write_csv
    rows = [(f'line one {i}\nline "two", with commas\r\n\nand more', f"l{i % 2}") for i in range(20)] + [("plain", "l0"), ('"', "l1")]
    path = str(tmp_path / "texts")
    write_csv(spark.createDataFrame(rows, "texto string, etiqueta string").repartition(3), path)
    monkeypatch.setenv("MULTILINE", "true")
    got = text_batch.load(spark, TextJobConfig(data_path=path))
    assert sorted((r.texto, r.etiqueta) for r in got.collect()) == sorted(rows)
    monkeypatch.setenv("MULTILINE", "no")
    assert TextJobConfig(data_path=path).multiline is False
