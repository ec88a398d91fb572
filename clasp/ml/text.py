"""Text classification: the six-stage pipeline (M1–M5, M11) and the SQL
forms of its feature stages used for checks and term reports."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    HashingTF, IDF, SQLTransformer, StopWordsRemover, StringIndexer, Tokenizer,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clasp.functions.stopwords import ENGLISH_STOP_WORDS
from clasp.functions.hashing import with_term_bucket
from clasp.functions.text import WHITESPACE_CLASS, counted_tokens, tokens_expr
from clasp.operators.joins import join_derived
from clasp.operators.partitioning import spread
from clasp.ml.models import MAX_DEPTH, NUM_TREES, SEED, forest

# Fixed value: hashed term-frequency width of the reference text pipeline.
NUM_FEATURES = 1000


def text_stages(text_col: str = "texto", label_col: str = "etiqueta",
                num_features: int = NUM_FEATURES, stop_words: list[str] | None = None,
                num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH, seed: int = SEED):
    """Null text becomes '' first (the Tokenizer throws on null, Q13)."""
    clean = SQLTransformer(statement=(
        f"SELECT *, coalesce(CAST(`{text_col}` AS STRING), '') AS `_text` FROM __THIS__"))
    tok = Tokenizer(inputCol="_text", outputCol="words")
    rm = StopWordsRemover(inputCol="words", outputCol="filtered")
    if stop_words is not None:
        rm.setStopWords(stop_words)
    tf = HashingTF(inputCol="filtered", outputCol="rawFeatures", numFeatures=num_features)
    idf = IDF(inputCol="rawFeatures", outputCol="features")
    lab = StringIndexer(inputCol=label_col, outputCol="label", handleInvalid="error")
    rf = forest(num_trees=num_trees, max_depth=max_depth, seed=seed)
    return [clean, tok, rm, tf, idf, lab, rf]


def text_pipeline(**kw) -> Pipeline:
    """Clean -> tokenize -> stop words -> hashed TF -> IDF -> label
    index -> forest."""
    return Pipeline(stages=text_stages(**kw))


# ---- SQL forms (M1, M2, M4) -------------------------------------------------
#
# Tokens are exploded first and stop words removed with ``isin`` (planned
# as a hash-set lookup), not with a per-row lambda over the word list.

def _token_rows(df: DataFrame, text_col: str, keep: list[str] | tuple = (),
                drop_stop: bool = False, stop_words: list[str] | None = None) -> DataFrame:
    toks = F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), WHITESPACE_CLASS, -1)
    rows = spread(df).select(*keep, F.explode(toks).alias("token")).where(F.col("token") != "")
    if drop_stop:
        words = [w.lower() for w in (stop_words or ENGLISH_STOP_WORDS)]
        rows = rows.where(~F.col("token").isin(words))
    return rows


def token_counts(df: DataFrame, text_col: str, drop_stop: bool = False,
                 stop_words: list[str] | None = None) -> DataFrame:
    """M1/M2: how often each non-empty token occurs over all texts."""
    return (_token_rows(df, text_col, drop_stop=drop_stop, stop_words=stop_words)
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))


def term_freqs(df: DataFrame, doc_col: str, text_col: str,
               stop_words: list[str] | None = None) -> DataFrame:
    """(doc, term, tf) of the filtered, non-empty tokens. A document is one
    row, so its terms are counted inside it."""
    words = [w.lower() for w in (stop_words or ENGLISH_STOP_WORDS)]
    toks = F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), WHITESPACE_CLASS, -1)
    rows = spread(df).select(doc_col, F.explode(counted_tokens(toks)).alias("_x"))
    return rows.select(doc_col, F.col("_x.term").alias("term"), F.col("_x.n").alias("tf")).where(
        (F.col("term") != "") & ~F.col("term").isin(words))


def hashed_counts(df: DataFrame, doc_col: str, text_col: str, num_features: int = NUM_FEATURES,
                  stop_words: list[str] | None = None) -> DataFrame:
    """M3 in built-in expressions: ``(doc, bucket, tf)`` of the non-zero
    buckets, equal to the ``HashingTF`` stage bit by bit. A document's tokens
    meet in the task that reads it, so what is shuffled is at most one row per
    document and bucket."""
    words = [w.lower() for w in (stop_words or ENGLISH_STOP_WORDS)]
    tokens = spread(df).select(doc_col, F.explode(tokens_expr(F.coalesce(F.col(text_col), F.lit("")))).alias("term"))
    return (with_term_bucket(tokens.where(~F.col("term").isin(words)), "term", num_features)
            .groupBy(doc_col, "bucket").agg(F.count(F.lit(1)).cast("double").alias("tf")))


def _idf(m, doc_freq: str = "doc_freq"):
    return F.log((m + 1) / (F.col(doc_freq) + 1))


def term_idf(df: DataFrame, text_col: str, stop_words: list[str] | None = None, digits: int = 6) -> DataFrame:
    """M4 (term level): ``idf = ln((m + 1) / (df + 1))`` where ``m`` is the
    number of rows and ``df`` the number of rows with the term. A row gives
    each of its terms once, so one shuffle, on the term, counts them."""
    m = df.select(F.count(F.lit(1))).scalar()
    toks = F.array_distinct(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), WHITESPACE_CLASS, -1))
    words = [w.lower() for w in (stop_words or ENGLISH_STOP_WORDS)]
    dfreq = (spread(df).select(F.explode(toks).alias("term")).where((F.col("term") != "") & ~F.col("term").isin(words))
             .groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq")))
    return dfreq.select("term", "doc_freq", F.round(_idf(m), digits).alias("idf"))


def tfidf_top_terms(df: DataFrame, doc_col: str, text_col: str, k: int = 3,
                    stop_words: list[str] | None = None, digits: int = 6) -> DataFrame:
    """M4 transform (term level), reported as each document's ``k``
    highest ``tf * idf`` terms (ties by term); a document is one row. Terms
    are counted inside their row, and document frequencies, one row a term,
    are all that is written; the texts are read once for each. The rank filter
    lets Spark keep a per-task top-k before the shuffle (window group limit);
    a term found in most documents is a hot join key, split by AQE skew
    handling."""
    m = df.select(F.count(F.lit(1))).scalar()
    tf = term_freqs(df, doc_col, text_col, stop_words)
    idf = (tf.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))
           .select("term", _idf(m).alias("_idf")))
    scored = join_derived(tf, idf, "term").withColumn("_score", F.col("tf") * F.col("_idf"))
    w = Window.partitionBy(doc_col).orderBy(F.desc("_score"), F.asc("term"))
    return (scored.withColumn("rank", F.row_number().over(w).cast("bigint"))
            .where(F.col("rank") <= k)
            .select(doc_col, "term", "tf", F.round("_score", digits).alias("tfidf"), "rank"))


def label_index_table(df: DataFrame, label_col: str) -> DataFrame:
    """M5/M9: fit the label indexer and report ``(label, label_index)``
    for each distinct label (frequency descending, ties alphabetical)."""
    src = df.where(F.col(label_col).isNotNull())
    model = StringIndexer(inputCol=label_col, outputCol="label_index",
                          handleInvalid="error").fit(src)
    distinct = src.select(F.col(label_col)).distinct()
    return model.transform(distinct).select(
        F.col(label_col).cast("string").alias("label"),
        F.col("label_index").cast("int").alias("label_index"))
