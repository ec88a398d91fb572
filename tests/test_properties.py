"""Property tests against brute-force references: pandas ``resample`` for
time buckets, Python ``md5`` for the hash split, the ML Tokenizer for the
SQL token form, Python ``round`` for KPI percentages, and the ML IDF
stage for the term-level IDF."""

import hashlib
import math
from datetime import datetime, timedelta

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import HashingTF, IDF, Tokenizer
from pyspark.sql import functions as F

from clasp.functions.hashing import hash_bucket
from clasp.functions.text import tokens_expr
from clasp.ml.text import term_idf
from clasp.operators import stats, timeseries

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

BASE = datetime(2025, 11, 1)
offsets = st.lists(st.one_of(st.none(), st.integers(0, 40 * 86400)), min_size=1, max_size=40)


@SETTINGS
@given(offs=offsets, freq=st.sampled_from(["7D", "1D", "6h", "1min", "7min", "5h", "36h"]))
def test_resample_equals_pandas(spark, offs, freq):
    times = [None if o is None else BASE + timedelta(seconds=o, microseconds=o % 7) for o in offs]
    df = spark.createDataFrame([(t, 1) for t in times], "ts timestamp_ntz, v int")
    got = [(r.bucket_start, r.n) for r in
           timeseries.resample_count(df, "ts", freq, "v").orderBy("bucket_start").collect()]
    pdf = pd.DataFrame({"ts": pd.to_datetime(times), "v": [1] * len(times)}).dropna(subset=["ts"])
    if pdf.empty:
        assert got == []
        return
    exp = pdf.set_index("ts").resample(freq.replace("min", "min"))["v"].count()
    expected = [(t.to_pydatetime(), int(n)) for t, n in exp.items()]
    assert got == expected


@SETTINGS
@given(keys=st.lists(st.text(min_size=0, max_size=12), min_size=1, max_size=30))
def test_hash_bucket_equals_python_md5(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [r.b for r in df.select(hash_bucket("k").alias("b")).collect()]
    exp = [int(hashlib.md5(k.encode("utf-8")).hexdigest()[:8], 16) % 100 for k in keys]
    assert got == exp


ALPHABET = st.sampled_from(list("abAB!é ") + ["\t", "\n", "\x0b", "\r", "\f", "  "])


@SETTINGS
@given(texts=st.lists(st.lists(ALPHABET, max_size=12).map("".join), min_size=1, max_size=10))
def test_sql_tokens_equal_ml_tokenizer(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = (Tokenizer(inputCol="t", outputCol="ml").transform(df)
            .select("i", "ml", tokens_expr("t").alias("sql")).collect())
    for r in rows:
        assert list(r.ml) == list(r.sql), repr(texts[r.i])


@SETTINGS
@given(classes=st.lists(st.sampled_from(["Sano", "Riesgo", None]), min_size=1, max_size=60))
def test_kpi_percent_equals_python_round(spark, classes):
    df = spark.createDataFrame([(c,) for c in classes], "c string")
    r = stats.kpi_row(df, "c", ["Riesgo", "Sano"]).first()
    n = len(classes)
    for name in ("Riesgo", "Sano"):
        k = classes.count(name)
        assert r[f"n_{name.lower()}"] == k
        assert r[f"pct_{name.lower()}"] == round(k / n * 100, 1)


def test_term_idf_equals_ml_idf_without_collisions(spark):
    docs = ["alpha beta beta", "beta gamma", "gamma delta alpha", "epsilon"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id int, text string")
    sql = {r.term: r.idf for r in term_idf(df, "text").collect()}
    htf = HashingTF(inputCol="w", outputCol="tf", numFeatures=1 << 18)
    toks = Tokenizer(inputCol="text", outputCol="w").transform(df)
    model = IDF(inputCol="tf", outputCol="x").fit(htf.transform(toks))
    idf = model.idf.toArray()
    buckets = {t: htf.indexOf(t) for t in sql}
    assert len(set(buckets.values())) == len(buckets)  # no collisions
    for t, b in buckets.items():
        assert math.isclose(round(idf[b], 6), sql[t])


def test_share_percent_sums_near_100(spark):
    from tests.conftest import SF_SMALL
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    rows = stats.share(ev, "event_type").collect()
    assert sum(r.n for r in rows) == ev.where(F.col("event_type").isNotNull()).count()
    assert abs(sum(r.pct for r in rows) - 100) < 0.5


@SETTINGS
@given(vals=st.lists(st.one_of(
    st.floats(min_value=-1e6, max_value=1e6, allow_nan=False),
    st.builds(lambda c, t: c / t * 100, st.integers(0, 5000), st.integers(1, 5000)),
    st.decimals(min_value=0, max_value=100, places=3).map(float)), min_size=1, max_size=60),
    digits=st.sampled_from([1, 2]))
def test_round_like_python(spark, vals, digits):
    from clasp.functions.scalars import round_like_python
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(round_like_python("v", digits)).collect()]
    assert got == [round(v, digits) for v in vals]
