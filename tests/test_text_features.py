"""Text stages: SQL forms equal the ML stages; FIXTURES §3 literal cases."""

import math

from pyspark.ml.feature import HashingTF, IDF, StopWordsRemover, StringIndexer, Tokenizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clasp.functions.stopwords import ENGLISH_STOP_WORDS
from clasp.functions.text import drop_stop_words_expr, tokens_expr


def test_stop_word_list_is_sparks(spark):
    assert ENGLISH_STOP_WORDS == list(StopWordsRemover.loadDefaultStopWords("english"))
    assert len(ENGLISH_STOP_WORDS) == 181


def test_tokenizer_sql_form_equals_ml_form(spark):
    texts = ["I would  not recommend it!", "a b  ", " ", "", "Tab\tSep\nLine\x0bVT  end",
             "Ça Marche  Très Bien", "  lead"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    ml = Tokenizer(inputCol="t", outputCol="ml").transform(df)
    rows = ml.select("id", "ml", tokens_expr("t").alias("sql")).orderBy("id").collect()
    for r in rows:
        assert list(r["ml"]) == list(r["sql"]), (texts[r["id"]], r["ml"], r["sql"])
    got = {r["id"]: list(r["ml"]) for r in rows}
    assert got[0] == ["i", "would", "", "not", "recommend", "it!"]
    assert got[1] == ["a", "b"] and got[2] == [] and got[3] == [""]


def test_stop_words_removed_case_insensitively(spark):
    df = spark.createDataFrame([(["i", "would", "", "not", "recommend", "it!", "The"],)], "w array<string>")
    ml = StopWordsRemover(inputCol="w", outputCol="f").transform(df).first()["f"]
    sql = df.select(drop_stop_words_expr("w").alias("f")).first()["f"]
    assert list(ml) == ["", "recommend", "it!"] == list(sql)


def test_hashing_tf_buckets(spark):
    words = ["recommend", "tool", "highly", "a", "abcd", "café"]
    df = spark.createDataFrame([([w],) for w in words], "w array<string>")
    out = HashingTF(inputCol="w", outputCol="v", numFeatures=1000).transform(df).collect()
    assert [int(r["v"].indices[0]) for r in out] == [116, 111, 913, 467, 100, 61]


def test_idf_formula(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0, 0.0]),), (Vectors.dense([1.0, 1.0]),)], ["v"])
    idf = IDF(inputCol="v", outputCol="o").fit(df).idf.toArray()
    assert idf[0] == 0.0 and math.isclose(idf[1], math.log(3 / 2))


def test_label_order_frequency_then_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], ["l"])
    assert list(StringIndexer(inputCol="l", outputCol="i").fit(df).labels) == ["c", "a", "b"]
    ints = spark.createDataFrame([(1,)] * 5 + [(0,)] * 4, ["l"])
    assert list(StringIndexer(inputCol="l", outputCol="i").fit(ints).labels) == ["1", "0"]


def test_token_counts_match_ml_tokenizer_on_documents(spark):
    from tests.conftest import SF_SMALL
    from clasp.ml.text import token_counts
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    ml = (Tokenizer(inputCol="text", outputCol="w").transform(docs)
          .select(F.explode("w").alias("token")).where(F.col("token") != "")
          .groupBy("token").count())
    sql = token_counts(docs, "text").withColumnRenamed("n", "count")
    assert ml.exceptAll(sql).count() == 0 and sql.exceptAll(ml).count() == 0


def test_counted_tokens(spark):
    from collections import Counter
    from clasp.functions.text import counted_tokens
    rows = [["b", "a", "b", "", "b"], [], ["x"], [str(i % 97) for i in range(5000)], ["é", "e", "é"]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t array<string>")
    for x in df.select("i", counted_tokens(F.col("t")).alias("c")).collect():
        assert {y.term: y.n for y in x.c} == Counter(rows[x.i]) and len(x.c) == len(set(rows[x.i]))
