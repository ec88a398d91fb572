"""The bucket of a term: built-in expressions, the ML stage and a plain
MurmurHash3 agree."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clasp.functions.hashing import with_term_bucket
from clasp.ml import text


def murmur3(data: bytes, seed: int = 42) -> int:
    """As published, 32 bits, signed."""
    mask, h = 0xFFFFFFFF, seed
    mix = lambda k: (((k * 0xCC9E2D51 & mask) << 15 | (k * 0xCC9E2D51 & mask) >> 17) & mask) * 0x1B873593 & mask
    for i in range(0, len(data) - len(data) % 4, 4):
        h ^= mix(int.from_bytes(data[i:i + 4], "little"))
        h = ((h << 13 | h >> 19) & mask) * 5 + 0xE6546B64 & mask
    h ^= mix(int.from_bytes(data[len(data) - len(data) % 4:], "little")) ^ len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def check(spark, terms, buckets):
    df = spark.createDataFrame([(t,) for t in terms], "term string").repartition(2)
    got = {x.term: x.b for x in with_term_bucket(df, "term", buckets, "b").collect()}
    assert got == {t: None if t is None else murmur3(t.encode()) % buckets for t in terms}
    tf = HashingTF(inputCol="terms", outputCol="v", numFeatures=buckets)
    ml = tf.transform(df.where("term is not null").select("term", F.array("term").alias("terms")))
    assert {x.term: x.a.index(1.0) for x in ml.select("term", vector_to_array("v").alias("a")).collect()} == {
        t: b for t, b in got.items() if t is not None}


def test_terms_of_every_length(spark):
    r = random.Random(2)
    terms = ["", None, "a", "ab", "abc", "abcd", "é", "日本語", "\U0001f600", "\x00", "\x7f\x80", "x" * 1001]
    terms += ["".join(r.choice("abcé日\U0001f600 ~") for _ in range(n)) for n in range(1, 40) for _ in range(5)]
    check(spark, sorted(set(terms), key=str), 1000)
    check(spark, sorted(set(terms), key=str), 7)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(terms=st.sets(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), min_size=1, max_size=60), buckets=st.sampled_from([2, 1000, 1 << 18]))
def test_any_terms(spark, terms, buckets):
    df = spark.createDataFrame([(t,) for t in sorted(terms)], "term string")
    assert {x.term: x.b for x in with_term_bucket(df, "term", buckets, "b").collect()} == {t: murmur3(t.encode()) % buckets for t in terms}


def test_counts_equal_the_stage(spark):
    texts = [None, "", " ", "  a  b ", "the of and", "Word word WORD é", "tab\tline\nfeed\x0bx\x0c y\r", "a" * 5000, "trailing   ", "x y z x y x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc long, texto string")
    from pyspark.ml import PipelineModel
    stage = PipelineModel(stages=text.text_stages()[:4]).transform(docs)
    want = {(x.doc, i, v) for x in stage.select("doc", vector_to_array("rawFeatures").alias("a")).collect() for i, v in enumerate(x.a) if v}
    got = text.hashed_counts(docs, "doc", "texto")
    assert {tuple(x) for x in got.collect()} == want and got.count() == len(want)
