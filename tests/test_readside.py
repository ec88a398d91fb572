"""The read-side API over literal scored tables (reference endpoint and
dashboard semantics)."""

from datetime import datetime

from clasp.plans.readside import RecordPredictions, TextResults


def _text(spark):
    rows = [("a b", "positivo", "positivo", datetime(2025, 11, 1, 10)),
            ("c d", "negativo", "positivo", datetime(2025, 11, 3, 10)),
            ("e f", "neutral", "neutral", datetime(2025, 11, 20, 10)),
            ("a b", "positivo", "positivo", datetime(2025, 11, 21, 10))]
    return spark.createDataFrame(rows, "texto string, etiqueta string, prediction string, "
                                       "fecha_proceso timestamp_ntz")


def test_text_readside(spark):
    tr = TextResults(_text(spark))
    assert tr.listing("positivo", 1).first().fecha_proceso == "2025-11-21 10:00:00"
    st = {r.etiqueta: (r.n, r.accuracy) for r in tr.stats().collect()}
    assert st == {"positivo": (2, 75.0), "negativo": (1, 75.0), "neutral": (1, 75.0)}
    k = tr.kpis().first()
    assert (k.total, k.n_positivo, k.n_negativo, k.n_neutral, k.pct_positivo) == (4, 3, 0, 1, 75.0)
    assert tr.accuracy().first().accuracy == 75.0
    weeks = [(r.bucket_start.day, r.n) for r in tr.timeline().orderBy("bucket_start").collect()]
    assert weeks == [(1, 2), (8, 0), (15, 2)]
    enriched = spark.createDataFrame([(1, "a b", datetime(2025, 11, 2)), (2, "a b", datetime(2025, 11, 30))],
                                     "id int, texto string, fecha timestamp_ntz")
    w2 = {r.bucket_start.day: r.n for r in tr.timeline(enriched).collect()}
    assert w2 == {2: 3, 9: 0, 16: 1}
    rows, counts = tr.explore("positivo", "A B")
    assert rows.count() == 2 and tuple(counts.first()) == (2, 4)


def test_text_defaults_when_columns_missing(spark):
    df = spark.createDataFrame([("x", "positivo")], "texto string, etiqueta string")
    tr = TextResults(df)
    r = tr.prepared().first()
    assert r.prediction == "desconocido" and r.fecha_proceso is None


def test_record_readside(spark):
    rows = [(0, 0, "ATA", datetime(2025, 1, 1, 0, 0, 5)), (1, 1, "ASY", datetime(2025, 1, 1, 0, 2, 0)),
            (1, 0, "ASY", datetime(2025, 1, 1, 0, 2, 30))]
    df = spark.createDataFrame(rows, "heart_disease_label int, prediction int, ChestPainType string, "
                                     "fecha_proceso timestamp_ntz")
    metrics = spark.createDataFrame([(80.0, 1, 1, datetime(2024, 1, 1)), (85.91, 1, 1, datetime(2024, 2, 1))],
                                    "accuracy double, train_size bigint, test_size bigint, fecha timestamp_ntz")
    rp = RecordPredictions(df, metrics)
    assert [r.prediction for r in rp.latest(2).collect()] == [0, 1]
    assert rp.by_risk("1").count() == 1 and rp.by_risk("x").count() == 0
    s = rp.risk_summary().first()
    assert (s.total, s.high, s.low, s.high_pct, s.model_accuracy) == (3, 1, 2, 33.33, 85.91)
    assert {r.prediction: r.n for r in rp.stats().collect()} == {"0": 2, "1": 1}
    assert rp.model_accuracy().first().accuracy == 85.91
    assert {(r.ChestPainType, r.prediction_label): r.n for r in rp.risk_by_category().collect()} == {
        ("ATA", "Sano"): 1, ("ASY", "Riesgo"): 1, ("ASY", "Sano"): 1}
    assert [r.n for r in rp.timeline().orderBy("bucket_start").collect()] == [1, 0, 2]
    assert RecordPredictions(df.drop("ChestPainType")).risk_by_category() is None
