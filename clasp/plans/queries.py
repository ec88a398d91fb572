"""Registered queries: one per operator of the survey inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables (or what Spark derives from them). The matching DuckDB SQL
is in :mod:`clasp.plans.oracle` under the same key, with the same column
names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clasp.functions.scalars import guess_scalar, parse_ts
from clasp.ml import splits
from clasp.ml import text as mltext
from clasp.operators import columns as cols
from clasp.operators import filters, joins, ordering, running, stats, timeseries, topk
from clasp.plans import standins as S
from clasp.plans.names import MISSING_PREDICTION, RISK_NAMES
from clasp.session import scratch_path
from clasp.sources import sinks
from clasp.sources.appends import AppendTable
from clasp.sources.specs import TableSpec
from clasp.sources.tables import first_row, read_csv, read_table

# The reference's defaults.
TEXT_TRAIN_PCT = 70
TAB_TRAIN_PCT = 80
SEARCH_PATTERN = "retition|ouen"
LISTING_LIMIT = 50
RISK_LISTING_LIMIT = 100


# ---- scans and sinks ---------------------------------------------------------

def q_table_scan(spark: SparkSession, d: str) -> DataFrame:
    """Scan a stored table (store-internal ``_id`` dropped if present)."""
    return S.table(spark, d, "events")


def q_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Write ``documents`` as CSV with a header, one file a task, and
    read them back with an explicit schema: whole texts, with their line
    breaks, quotes and commas."""
    path = scratch_path(spark, "csv")
    sinks.write_csv(S.table(spark, d, "documents", spread_out=True), path)
    return read_csv(spark, path, "doc_id bigint, text string, lang string, source string, n_chars bigint", multiline=True)


def q_csv_inferred(spark: SparkSession, d: str) -> DataFrame:
    """Write ``events`` as CSV, read it back with inferred types and
    the time column parsed (text JSON with quotes and commas survives)."""
    from clasp.sources.tables import read_csv_inferred
    path = scratch_path(spark, "csv")
    sinks.write_csv(S.table(spark, d, "events"), path)
    return read_csv_inferred(spark, path, ts_cols=["ts"])


def q_sink_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """K1: overwrite twice; the table holds the last write only."""
    spec = TableSpec(path=scratch_path(spark, "sink"))
    scored = S.scored_text(spark, d).select("doc_id", "etiqueta", "prediction")
    sinks.write_table(scored, spec)
    sinks.write_table(scored, spec)
    return read_table(spark, spec)


def q_to_json_rows(spark: SparkSession, d: str) -> DataFrame:
    """K3: one JSON message per row, read back and decoded."""
    spec = TableSpec(path=scratch_path(spark, "json"), format="text")
    cust = S.table(spark, d, "customer")
    sinks.publish_json(cust, spec)
    msgs = spark.read.text(spec.path)
    return msgs.select(F.from_json("value", cust.schema).alias("m")).select("m.*")


def q_run_counters(spark: SparkSession, d: str) -> DataFrame:
    """K8: run counters (processed, train, test) taken from the written
    scored rows (partitioned by split), not from extra counting jobs."""
    scored = splits.hash_split(S.document_rows(spark, d), "texto", TEXT_TRAIN_PCT)
    counts = sinks.write_counted(scored.select("doc_id", "split"),
                                 TableSpec(path=scratch_path(spark, "counted")), by="split")
    return counts.agg(F.sum("rows").cast("bigint").alias("processed"),
                      F.sum(F.when(F.col("split") == "train", F.col("rows")).otherwise(0))
                      .cast("bigint").alias("train"),
                      F.sum(F.when(F.col("split") == "test", F.col("rows")).otherwise(0))
                      .cast("bigint").alias("test"))


def q_metrics_row(spark: SparkSession, d: str) -> DataFrame:
    """The metrics record of a held-out evaluation (timestamp
    reduced to whether it is set)."""
    scored = S.split_rows(spark, d, TEXT_TRAIN_PCT).where(F.col("etiqueta").isNotNull())
    row = stats.metrics_row(scored, "split", "etiqueta", "prediction")
    return row.select("accuracy", "train_size", "test_size", F.col("fecha").isNotNull().alias("stamped"))


# ---- projections -------------------------------------------------------------

def q_project_rename(spark: SparkSession, d: str) -> DataFrame:
    """Select, reorder and rename."""
    ev = S.scored_events(spark, d)
    out = cols.select(ev, ["event_type", "event_id", "prediction", "label", "fecha_proceso"])
    return cols.rename(out, {"label": "heart_disease_label", "event_type": "category"})


def q_json_decode(spark: SparkSession, d: str) -> DataFrame:
    """Text -> JSON struct -> flat columns (malformed -> nulls)."""
    from clasp.streaming.decode import decode_json
    ev = S.table(spark, d, "events").select("event_id", F.col("props").alias("value"))
    return decode_json(ev, "k int", keep=["event_id"])


def q_json_corrupt(spark: SparkSession, d: str) -> DataFrame:
    """Records that are no JSON keep their text in a column of their own."""
    from clasp.streaming.decode import decode_json
    broken = F.concat(F.lit("broken "), F.col("event_id").cast("string"))
    ev = S.table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 5 == 0, broken).otherwise(F.col("props")).alias("value"))
    return decode_json(ev, "k int", keep=["event_id"], corrupt_col="corrupt")


def q_stamp_rows(spark: SparkSession, d: str) -> DataFrame:
    """Constant column and processing-time stamp."""
    rt = S.document_rows(spark, d).select("doc_id", "prediction")
    rt = cols.with_const(rt, "pipeline", "batch")
    rt = cols.with_processed_at(rt, "fecha_proceso")
    return rt.select("doc_id", "prediction", "pipeline",
                     F.col("fecha_proceso").isNotNull().alias("stamped"))


def q_typed_cast(spark: SparkSession, d: str) -> DataFrame:
    """Double -> int truncation, text -> int (bad -> null),
    text -> bytes -> text."""
    ev = S.table(spark, d, "events").select("event_id", "value", "event_type", "props")
    out = cols.typed_cast(ev, {"value": "int", "event_type": "int"})
    return out.select("event_id", F.col("value").alias("value_int"),
                      F.col("event_type").alias("event_type_int"),
                      F.col("props").cast("binary").cast("string").alias("props_text"))


def q_map_values(spark: SparkSession, d: str) -> DataFrame:
    """Code -> name; unmapped -> null."""
    ev = S.scored_events(spark, d).select("event_id", "prediction", "event_type")
    out = cols.map_values(ev, "prediction", RISK_NAMES, out="prediction_label")
    return cols.map_values(out, "event_type", {"click": "c", "view": "v"}, out="event_code")


def q_ensure_columns(spark: SparkSession, d: str) -> DataFrame:
    """Add missing columns with defaults; keep existing ones; select
    the listed columns that exist."""
    docs = S.table(spark, d, "documents").select("doc_id", "lang")
    out = cols.ensure_columns(docs, {"prediction": MISSING_PREDICTION,
                                     "fecha_proceso": F.lit(None).cast("timestamp_ntz"),
                                     "lang": "xx"})
    return cols.select_existing(out, ["doc_id", "lang", "prediction", "fecha_proceso", "etiqueta"])


def q_stringify_ts(spark: SparkSession, d: str) -> DataFrame:
    """P10: timestamps rendered as text, the way Python's ``str`` does
    (fraction only when there is one; two rows in three are given one)."""
    micros = F.expr("make_dt_interval(0, 0, 0, cast((event_id % 3) * 0.123456 as decimal(18, 6)))")
    ev = S.table(spark, d, "events").select("event_id", (F.col("ts") + micros).alias("ts_text"))
    return cols.stringify_ts(ev)


def q_parse_ts(spark: SparkSession, d: str) -> DataFrame:
    """Text -> timestamp; text that is not a time -> null."""
    ev = S.table(spark, d, "events")
    raw = F.when(F.col("event_type") == "error", F.lit("not a date")).otherwise(F.col("ts").cast("string"))
    return ev.select("event_id", parse_ts(raw).alias("parsed"))


def q_row_id(spark: SparkSession, d: str) -> DataFrame:
    """Consecutive ids in time order (distributed, no single-task window)."""
    ev = S.table(spark, d, "events").select("event_id", "ts")
    return ordering.with_row_id(ev, ["ts", "event_id"], out="id").select("event_id", "id")


def q_sorted_random_ts(spark: SparkSession, d: str) -> DataFrame:
    """Every document numbered in id order gets one of n sorted
    uniform random times in the enrichment window (seeded)."""
    from datetime import datetime
    docs = S.table(spark, d, "documents").select("doc_id", "lang")
    return ordering.with_sorted_random_ts(docs, "doc_id", datetime(2025, 11, 1),
                                          datetime(2026, 2, 1), seed=42)


ODD_SCALARS = ["12D", "3f", "1.0F", "0x1p3", "nan", "1_000", "12345678901234567890", " 7 ", "-5", ".5", "1e3", "007",
               "1__0", "+8", "5.", "-0"]
ODD_EVERY = 2 * len(ODD_SCALARS)


def q_infer_types(spark: SparkSession, d: str) -> DataFrame:
    """Per-value guess int -> double -> text, as Python reads text;
    some rows are given texts that are easily misread."""
    ev = S.table(spark, d, "events")
    odd = F.element_at(F.array(*[F.lit(x) for x in ODD_SCALARS]), (F.col("event_id") % ODD_EVERY + 1).cast("int"))
    raw = (F.when(F.col("event_id") % ODD_EVERY < len(ODD_SCALARS), odd).when(F.col("event_type") == "click", F.col("user_id").cast("string"))
           .when(F.col("event_type") == "view", F.col("value").cast("string"))
           .otherwise(F.col("event_type")))
    g = ev.select("event_id", raw.alias("raw")).select("event_id", guess_scalar("raw").alias("g"))
    return g.select("event_id", F.col("g.kind").alias("kind"), F.col("g.i").alias("as_int"),
                    F.when(~F.isnan("g.d"), F.col("g.d")).alias("as_double"), F.col("g.s").alias("as_text"))


def _events_as_text(spark: SparkSession, d: str) -> DataFrame:
    ev = S.table(spark, d, "events")
    return ev.select(*[F.col(c).cast("string").alias(c) for c in ev.columns])


def q_coerce_columns(spark: SparkSession, d: str) -> DataFrame:
    """P14 per column: every column of ``events`` as text, then each text
    column given the narrowest type all its values read as (int, else
    double, else text), decided by one aggregate."""
    from clasp.jobs.replay import typed_messages
    return typed_messages(_events_as_text(spark, d))


def q_guessed_json_rows(spark: SparkSession, d: str) -> DataFrame:
    """K3 + P14 per value: each text value written into the JSON message
    as an int, a float or a string, as the replayer did; read back."""
    from clasp.jobs.replay import guessed_json
    msgs = guessed_json(_events_as_text(spark, d))
    schema = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"
    return msgs.select(F.from_json("value", schema).alias("m")).select("m.*")


# ---- filters -----------------------------------------------------------------

def q_drop_incomplete(spark: SparkSession, d: str) -> DataFrame:
    """rows with any null dropped."""
    return filters.drop_incomplete(S.scored_text(spark, d).select("doc_id", "etiqueta", "prediction"))


def q_filter_label(spark: SparkSession, d: str) -> DataFrame:
    """optional label filter."""
    rt = S.scored_text(spark, d).select("doc_id", "etiqueta", "prediction")
    return filters.filter_eq(rt, "etiqueta", 1)


def q_filter_label_text(spark: SparkSession, d: str) -> DataFrame:
    """a text asked of a number column equals no row."""
    rt = S.scored_text(spark, d).select("doc_id", "etiqueta")
    return filters.filter_eq(rt, "etiqueta", "1").agg(F.count(F.lit(1)).alias("n"))


def q_filter_risk(spark: SparkSession, d: str) -> DataFrame:
    """parameter parsed as an int before comparing."""
    ev = S.scored_events(spark, d).select("event_id", "prediction")
    return filters.filter_typed_eq(ev, "prediction", "1")


def q_count_correct(spark: SparkSession, d: str) -> DataFrame:
    """label = prediction, store rule (null = null) and pandas rule."""
    rt = S.scored_text(spark, d)
    return rt.agg(
        F.count_if(filters.equal_cols("etiqueta", "prediction", True)).alias("correct_store"),
        F.count_if(F.coalesce(filters.equal_cols("etiqueta", "prediction", False), F.lit(False)))
        .alias("correct_pandas"))


def q_search_text(spark: SparkSession, d: str) -> DataFrame:
    """case-insensitive regex search over whole texts."""
    rt = S.document_rows(spark, d).select("doc_id", "texto")
    return filters.search(rt, "texto", SEARCH_PATTERN).select("doc_id")


def q_explore_counts(spark: SparkSession, d: str) -> DataFrame:
    """label filter and search combined; shown-of-total counts."""
    rt = S.document_rows(spark, d)
    _rows, counts = filters.explore(rt, "prediction", 1, "texto", SEARCH_PATTERN)
    return counts


# ---- joins -------------------------------------------------------------------

def q_dedup_first(spark: SparkSession, d: str) -> DataFrame:
    """First document (by id) of each distinct text, told apart by
    SHA-256; the texts stay in their scan."""
    docs = S.table(spark, d, "documents").select(
        "doc_id", "lang", joins.key_digest("text").alias("key"), F.md5("text").alias("text_md5"))
    return joins.dedup_first(docs, ["key"], ["doc_id"]).select("text_md5", "doc_id", "lang")


def q_merge_coalesce(spark: SparkSession, d: str) -> DataFrame:
    """J1+J2+J3+P9: conversation turns enriched with the id of the first
    document having the same text, else their own reference."""
    conv = S.table(spark, d, "conversations").select(
        "conv_id", "turn", "text", (F.col("conv_id") * 1000 + F.col("turn")).alias("ref"))
    docs = S.table(spark, d, "documents").select("doc_id", "text")
    out = joins.merge_coalesce(conv, docs, "text", "doc_id", "ref", order=["doc_id"])
    return out.select("conv_id", "turn", "ref")


# ---- aggregates ----------------------------------------------------------------

def q_label_distribution(spark: SparkSession, d: str) -> DataFrame:
    """A2: count per label, null label kept as its own group."""
    return stats.distribution(S.scored_text(spark, d), "etiqueta")


def q_risk_distribution(spark: SparkSession, d: str) -> DataFrame:
    """A2: count per prediction, key rendered as text."""
    return stats.distribution(S.scored_events(spark, d), "prediction", as_string=True)


def q_value_counts(spark: SparkSession, d: str) -> DataFrame:
    """A3: pandas-style counts (null dropped)."""
    return stats.value_counts(S.scored_text(spark, d), "etiqueta")


def q_confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    """A4: label x prediction."""
    return stats.confusion(S.scored_text(spark, d), "etiqueta", "prediction")


def q_risk_by_category(spark: SparkSession, d: str) -> DataFrame:
    """A5: category x named outcome."""
    ev = cols.map_values(S.scored_events(spark, d), "prediction", RISK_NAMES, out="prediction_label")
    return stats.cross_count(ev, "event_type", "prediction_label")


def q_risk_summary(spark: SparkSession, d: str) -> DataFrame:
    """Totals, high/low, high %, latest model accuracy."""
    return stats.risk_summary(S.scored_events(spark, d), "prediction",
                              S.daily_metrics(spark, d), "accuracy", "fecha")


def q_label_stats(spark: SparkSession, d: str) -> DataFrame:
    """Text stats: distribution by label, accuracy (store rules)."""
    return stats.label_stats(S.scored_text(spark, d), "etiqueta", "etiqueta", "prediction")


def q_risk_stats(spark: SparkSession, d: str) -> DataFrame:
    """Record stats: distribution by prediction (as text), accuracy."""
    return stats.label_stats(S.scored_events(spark, d), "prediction", "label", "prediction",
                             key_as_string=True)


def q_kpi_row(spark: SparkSession, d: str) -> DataFrame:
    """KPI row over the named risk classes."""
    ev = cols.map_values(S.scored_events(spark, d), "prediction", RISK_NAMES, out="prediction_label")
    return stats.kpi_row(ev, "prediction_label", ["Riesgo", "Sano"])


def q_class_share(spark: SparkSession, d: str) -> DataFrame:
    """A10: share of each class."""
    return stats.share(S.scored_events(spark, d), "event_type")


def q_resample_7d(spark: SparkSession, d: str) -> DataFrame:
    """7-day buckets from the first day, zero-filled."""
    return timeseries.resample_count(S.scored_events(spark, d), "fecha_proceso", "7D", "prediction")


def q_resample_1min(spark: SparkSession, d: str) -> DataFrame:
    """1-minute buckets, zero-filled."""
    return timeseries.resample_count(S.scored_events(spark, d), "fecha_proceso", "1min", "prediction")


def q_holdout_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Accuracy on the held-out (hash split) labelled rows."""
    rt = S.split_rows(spark, d, TEXT_TRAIN_PCT).where(F.col("etiqueta").isNotNull())
    return stats.evaluate_accuracy(rt.where(F.col("split") == "test"), "etiqueta", "prediction")


def q_accuracy_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Stored accuracy when a metrics row exists, else computed."""
    rt = S.split_rows(spark, d, TEXT_TRAIN_PCT)
    labelled = rt.where(F.col("etiqueta").isNotNull())
    metrics = stats.metrics_row(labelled, "split", "etiqueta", "prediction")
    return stats.accuracy_or_metrics(rt, metrics, "etiqueta", "prediction")


# ---- top-k -------------------------------------------------------------------

def q_list_labelled(spark: SparkSession, d: str) -> DataFrame:
    """Label filter then the last 50 (by id)."""
    rt = S.scored_text(spark, d).select("doc_id", "etiqueta", "prediction", "lang")
    return topk.listing(rt, "etiqueta", 1, "doc_id", "doc_id", LISTING_LIMIT)


def q_latest_n(spark: SparkSession, d: str) -> DataFrame:
    """Newest 50 records."""
    ev = S.scored_events(spark, d).select("event_id", "fecha_proceso", "event_type", "prediction")
    return topk.latest(ev, "fecha_proceso", "event_id", LISTING_LIMIT)


def q_latest_by_risk(spark: SparkSession, d: str) -> DataFrame:
    """Newest 100 high-risk records."""
    ev = S.scored_events(spark, d).select("event_id", "fecha_proceso", "prediction")
    return topk.latest_by_value(ev, "prediction", "1", "fecha_proceso", "event_id", RISK_LISTING_LIMIT)


def q_latest_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The newest metrics row."""
    return topk.latest_one(S.daily_metrics(spark, d), "fecha", ["day"])


def q_first_metrics(spark: SparkSession, d: str) -> DataFrame:
    """One metrics row, here the first by day."""
    return first_row(S.daily_metrics(spark, d), [F.col("day")])


def q_truncated_table(spark: SparkSession, d: str) -> DataFrame:
    """K6: a written table before and after it is emptied: rows, columns."""
    spec = TableSpec(path=scratch_path(spark, "emptied"))
    ev = S.table(spark, d, "events").select("event_id", "event_type")
    sinks.write_table(ev, spec)
    before = sinks.write_counted(ev, TableSpec(path=scratch_path(spark, "kept"))).select(F.col("rows").alias("before"))
    sinks.truncate_table(ev, spec)
    after = read_table(spark, spec)
    return stats.attach_row(before, after.agg(F.count(F.lit(1)).alias("after"))).withColumn(
        "columns", F.lit(",".join(after.columns)))


def q_required_rows(spark: SparkSession, d: str) -> DataFrame:
    """K7: an empty result is refused, another passes through."""
    ev = S.table(spark, d, "events")
    try:
        sinks.require_rows(ev.where("event_id < 0"), "events before the first")
        refused = False
    except sinks.EmptyResultError:
        refused = True
    return sinks.require_rows(ev).agg(F.count(F.lit(1)).alias("n")).withColumn("refused", F.lit(refused))


def q_optional_enrichment(spark: SparkSession, d: str) -> DataFrame:
    """Enrichment from a dimension that is there, and from one that isn't."""
    conv = S.table(spark, d, "conversations").select("conv_id", "turn", "text", F.lit(-1).cast("bigint").alias("ref"))
    load = lambda path: spark.read.parquet(path).select("doc_id", "text")
    there, gone = (joins.enrich_left_optional(spark, conv, f"{d}/{name}", load, "text", "doc_id", "ref", ["doc_id"])
                   for name in ("documents.parquet", "no_such_table.parquet"))
    count = lambda df, name: df.agg(F.count_if(F.col("ref") >= 0).alias(name), F.count(F.lit(1)).alias(f"{name}_rows"))
    return stats.attach_row(count(there, "enriched"), count(gone, "left_alone"))


# ---- text features (SQL forms) -------------------------------------------------

def q_token_counts(spark: SparkSession, d: str) -> DataFrame:
    """M1: token frequencies over all documents (Tokenizer rules)."""
    return mltext.token_counts(S.table(spark, d, "documents"), "text")


def q_token_counts_nostop(spark: SparkSession, d: str) -> DataFrame:
    """M2: the same after removing English stop words."""
    return mltext.token_counts(S.table(spark, d, "documents"), "text", drop_stop=True)


def q_term_idf(spark: SparkSession, d: str) -> DataFrame:
    """M4: document frequency and IDF per term."""
    return mltext.term_idf(S.table(spark, d, "documents"), "text")


def q_tfidf_top_terms(spark: SparkSession, d: str) -> DataFrame:
    """M4: each document's three highest TF-IDF terms."""
    return mltext.tfidf_top_terms(S.table(spark, d, "documents"), "doc_id", "text", k=3)


def q_label_index(spark: SparkSession, d: str) -> DataFrame:
    """M5/M9: fitted label order of the text labels."""
    return mltext.label_index_table(S.labelled_text(spark, d), "etiqueta")


def q_label_index_tab(spark: SparkSession, d: str) -> DataFrame:
    """M9: fitted label order of the tabular label."""
    return mltext.label_index_table(S.order_records(spark, d), S.TAB_LABEL)


def q_hash_split(spark: SparkSession, d: str) -> DataFrame:
    """Stable split by text hash."""
    rt = S.document_rows(spark, d).select("doc_id", "texto")
    from clasp.functions.hashing import hash_bucket
    return splits.hash_split(rt.withColumn("bucket", hash_bucket("texto")), "texto",
                             TEXT_TRAIN_PCT).select("doc_id", "bucket", "split")


SLICES = 3


def _appended(spark: SparkSession, df: DataFrame, key: str, order: list[str]) -> AppendTable:
    """``df`` appended in slices by ``key`` (each brings rows from all over
    the table's time), the second one twice."""
    table = AppendTable(spark, scratch_path(spark, "appends"))
    for i in (0, 1, 1, 2):
        table.append(df.where(F.col(key) % SLICES == i), f"slice {i}", order)
    return table


def q_append_ids(spark: SparkSession, d: str) -> DataFrame:
    """P12 over appends: gap-free ids that earlier appends keep."""
    table = _appended(spark, S.table(spark, d, "events").select("event_id", "ts"), "event_id", ["ts", "event_id"])
    return table.read().select("id", "event_id")


def q_running_counts(spark: SparkSession, d: str) -> DataFrame:
    """A2/A3 kept up to date: the counts after each of the appends."""
    table = _appended(spark, S.table(spark, d, "events").select("event_id", "ts", "event_type"), "event_id", ["ts", "event_id"])
    counts = running.running_counts(table, scratch_path(spark, "running"), "event_type")
    counts.update()
    steps = [counts.result(upto=i).select(F.lit(i).alias("step"), "event_type", "n") for i in range(SLICES)]
    return steps[0].unionByName(steps[1]).unionByName(steps[2])


def q_running_buckets(spark: SparkSession, d: str) -> DataFrame:
    """A12/A13 kept up to date, with late rows in every append: seven-minute
    buckets of all rows."""
    events = S.scored_events(spark, d).select("event_id", "fecha_proceso", "prediction")
    table = _appended(spark, events, "event_id", ["fecha_proceso", "event_id"])
    buckets = running.running_buckets(table, scratch_path(spark, "running"), "fecha_proceso", "7min", "prediction")
    buckets.update()
    return running.buckets_of(buckets.result(), "7min")


def q_running_idf(spark: SparkSession, d: str) -> DataFrame:
    """M4 as a mergeable fit: document frequencies of the appends added up,
    equal to a fit on all documents."""
    docs = S.table(spark, d, "documents", spread_out=True).select("doc_id", "text")
    table = _appended(spark, docs, "doc_id", ["doc_id"])
    terms = running.running_terms(table, scratch_path(spark, "running"), "text")
    terms.update()
    return running.idf_of(terms.result())


def q_running_labels(spark: SparkSession, d: str) -> DataFrame:
    """M5 as a mergeable fit: the label order from added-up counts."""
    labels = S.table(spark, d, "labels").select("doc_id", "quality")
    table = _appended(spark, labels, "doc_id", ["doc_id"])
    counts = running.running_counts(table, scratch_path(spark, "running"), "quality")
    counts.update()
    return running.label_order_of(counts.result(), "quality")



REGISTRY = {
    "append_ids": q_append_ids,
    "running_counts": q_running_counts,
    "running_buckets": q_running_buckets,
    "running_idf": q_running_idf,
    "running_labels": q_running_labels,
    "table_scan": q_table_scan,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_inferred": q_csv_inferred,
    "sink_overwrite": q_sink_overwrite,
    "to_json_rows": q_to_json_rows,
    "run_counters": q_run_counters,
    "metrics_row": q_metrics_row,
    "project_rename": q_project_rename,
    "json_decode": q_json_decode,
    "json_corrupt": q_json_corrupt,
    "stamp_rows": q_stamp_rows,
    "typed_cast": q_typed_cast,
    "map_values": q_map_values,
    "ensure_columns": q_ensure_columns,
    "stringify_ts": q_stringify_ts,
    "parse_ts": q_parse_ts,
    "row_id": q_row_id,
    "sorted_random_ts": q_sorted_random_ts,
    "infer_types": q_infer_types,
    "coerce_columns": q_coerce_columns,
    "guessed_json_rows": q_guessed_json_rows,
    "drop_incomplete": q_drop_incomplete,
    "filter_label": q_filter_label,
    "filter_label_text": q_filter_label_text,
    "filter_risk": q_filter_risk,
    "first_metrics": q_first_metrics,
    "truncated_table": q_truncated_table,
    "required_rows": q_required_rows,
    "optional_enrichment": q_optional_enrichment,
    "count_correct": q_count_correct,
    "search_text": q_search_text,
    "explore_counts": q_explore_counts,
    "dedup_first": q_dedup_first,
    "merge_coalesce": q_merge_coalesce,
    "label_distribution": q_label_distribution,
    "risk_distribution": q_risk_distribution,
    "value_counts": q_value_counts,
    "confusion_matrix": q_confusion_matrix,
    "risk_by_category": q_risk_by_category,
    "risk_summary": q_risk_summary,
    "label_stats": q_label_stats,
    "risk_stats": q_risk_stats,
    "kpi_row": q_kpi_row,
    "class_share": q_class_share,
    "resample_7d": q_resample_7d,
    "resample_1min": q_resample_1min,
    "holdout_accuracy": q_holdout_accuracy,
    "accuracy_fallback": q_accuracy_fallback,
    "list_labelled": q_list_labelled,
    "latest_n": q_latest_n,
    "latest_by_risk": q_latest_by_risk,
    "latest_metrics": q_latest_metrics,
    "token_counts": q_token_counts,
    "token_counts_nostop": q_token_counts_nostop,
    "term_idf": q_term_idf,
    "tfidf_top_terms": q_tfidf_top_terms,
    "label_index": q_label_index,
    "label_index_tab": q_label_index_tab,
    "hash_split": q_hash_split,
}
