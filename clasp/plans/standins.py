"""Stand-in relations built from the driver tables.

The reference's own inputs (a 502-row labelled text file, a missing
patient file, two document collections) are replaced by relations Spark
derives from the given tables, so every query's work grows with them:

* ``scored_text``  (R(text)): every document, its quality label when one
  exists (left join, so unlabelled documents carry a null label) and a
  stand-in prediction ``n_chars >= 500``.
* ``scored_events`` (R(tab)): every event as a scored record:
  ``prediction = value > 100``, ``label = event_type = 'error'``.
* ``daily_metrics``: one model-metrics row per day of events, as the
  training job would append after each run.
* ``order_records``: orders joined to their customer, the tabular
  training input (categorical priority / segment, numeric balance / price,
  label = order status).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clasp.operators.joins import enrich_left
from clasp.operators.partitioning import spread
from clasp.ml.splits import hash_split
from clasp.operators.stats import accuracy_pct
from clasp.sources.specs import TableSpec
from clasp.sources.tables import read_table

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# The tabular stand-in's columns.
TAB_CATEGORICAL = ["o_orderpriority", "c_mktsegment"]
TAB_NUMERIC = ["c_acctbal", "o_totalprice"]
TAB_LABEL = "o_orderstatus"


def table(spark: SparkSession, sf_dir: str, name: str, spread_out: bool = False) -> DataFrame:
    """A driver table. ``spread_out`` for inputs of CPU-heavy work (model
    fitting, whole-text tokenising): at least one partition per core."""
    df = read_table(spark, TableSpec(path=f"{sf_dir.rstrip('/')}/{name}.parquet"))
    return spread(df) if spread_out else df


def scored_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("etiqueta"))
    return enrich_left(docs, labels, "doc_id").select(
        "doc_id", F.col("text").alias("texto"), "etiqueta",
        (F.col("n_chars") >= 500).cast("int").alias("prediction"),
        "lang", "source", "n_chars")


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R(text) without the label: for work that doesn't use it."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("texto"), (F.col("n_chars") >= 500).cast("int").alias("prediction"),
        "lang", "source", "n_chars")


def split_rows(spark: SparkSession, sf_dir: str, train_pct: int) -> DataFrame:
    """R(text) with each text's split in place of the text: ``doc_id, split,
    prediction, etiqueta``. The split is taken below the join with the
    labels, so texts never leave their scan."""
    docs = hash_split(document_rows(spark, sf_dir), "texto", train_pct).select("doc_id", "split", "prediction")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("etiqueta"))
    return enrich_left(docs, labels, "doc_id")


def labelled_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text training input: documents that have a (non-null) label."""
    docs = table(spark, sf_dir, "documents", spread_out=True).select(
        "doc_id", F.col("text").alias("texto"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("etiqueta"))
    return (docs.join(labels, "doc_id")
            .where(F.col("etiqueta").isNotNull()))


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", F.col("ts").alias("fecha_proceso"), "user_id", "event_type", "value", "props",
        (F.col("value") > 100).cast("int").alias("prediction"),
        (F.col("event_type") == "error").cast("int").alias("label"))


def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = scored_events(spark, sf_dir)
    correct = F.count_if(F.col("label") == F.col("prediction"))
    return (ev.groupBy(F.to_date("fecha_proceso").alias("day"))
            .agg(accuracy_pct(correct, F.count(F.lit(1))).alias("accuracy"),
                 F.count(F.lit(1)).alias("n"),
                 F.max("fecha_proceso").alias("fecha")))


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", spread_out=True).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment")
    return orders.join(cust, "o_custkey")
