"""Registered streaming queries.

Each stages a driver table as JSON-line files (the replay), runs a named
Structured Streaming query with its own checkpoint to completion
(``availableNow``), and returns the sink table it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clasp.ml import models
from clasp.operators.timeseries import latest_counts
from clasp.plans import standins as S
from clasp.plans.model_queries import CATS, LABEL, NUMS, fit_tabular
from clasp.plans.oracle import _resample
from clasp.session import STATE_STORE_CONF, scratch_path
from clasp.sources.sinks import save_model
from clasp.sources.specs import StreamSpec
from clasp.sources.tables import load_model
from clasp.streaming.decode import decode_json, split_valid
from clasp.streaming.diagnosis import Rule, diagnose, fault_counts, split_diagnosed
from clasp.streaming.live import added_up, class_changes, live_kpis, live_risk
from clasp.streaming.ops import dedup_replays, stream_window_counts
from clasp.streaming.paced import run_paced, stage_paced
from clasp.streaming.scoring import scored_stream
from clasp.streaming.sinks import idempotent_batch_writer, read_sink, run_until_idle, write_stream
from clasp.streaming.sources import json_message, open_stream, stage_replay

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
ORDER_SCHEMA = ("o_orderkey bigint, o_orderpriority string, c_mktsegment string, "
                "c_acctbal double, o_totalprice double, o_orderstatus string")
# Copies of a record arrive within this much event time of each other; later
# ones are dropped as late.
DEDUP_DELAY = "10 minutes"


def _run(df: DataFrame, writer, spark: SparkSession, name: str, checkpoint: str | None = None,
         output_mode: str = "append", conf: dict[str, str] | None = None) -> list[tuple[int, int]]:
    q = write_stream(df, writer, checkpoint or scratch_path(spark, "stream-ckpt", name), name,
                     trigger={"availableNow": True}, output_mode=output_mode, conf=conf)
    return run_until_idle(q)


def q_stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Replay events through a file stream in bounded
    micro-batches; each batch decoded and written once."""
    ev = S.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    spec = stage_replay(ev, scratch_path(spark, "replay"), None, ["ts", "event_id"])
    stream = decode_json(open_stream(spark, spec), EVENT_SCHEMA)
    sink = scratch_path(spark, "sink")
    _run(stream, idempotent_batch_writer(sink), spark, "stream_ingest")
    return read_sink(spark, sink).select("event_id", "ts", "user_id", "event_type", "value")


def q_stream_score_sink(spark: SparkSession, d: str) -> DataFrame:
    """The scoring stream: records decoded, invalid ones
    set aside, valid ones scored by the saved tabular pipeline, every
    micro-batch written once to its own partition."""
    model, _ = fit_tabular(spark, d)
    path = scratch_path(spark, "model")
    save_model(model, path)
    loaded = load_model(path)
    rec = S.order_records(spark, d).select("o_orderkey", *CATS, *NUMS, LABEL)
    spec = stage_replay(rec, scratch_path(spark, "replay"), None, ["o_orderkey"])
    decoded, fn = scored_stream(open_stream(spark, spec), ORDER_SCHEMA, loaded,
                                required=["o_orderkey", *CATS, *NUMS],
                                label_col=LABEL, label_alias="status_label", label_type="string",
                                keep_cols=["o_orderkey", *CATS, *NUMS, "status_label"])
    sink, quarantine = scratch_path(spark, "sink"), scratch_path(spark, "quarantine")
    _run(decoded, idempotent_batch_writer(sink, split=fn, quarantine_path=quarantine),
         spark, "stream_score")
    out = read_sink(spark, sink).select("o_orderkey", "status_label", "prediction_index")
    batch = models.score(model, S.order_records(spark, d), LABEL).select("o_orderkey", F.col("prediction").alias("_batch"))
    return out.join(batch, "o_orderkey").select(
        "o_orderkey", "status_label", (F.col("prediction_index") == F.col("_batch")).alias("as_in_batch"))


def q_stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The replay is sent twice; the stream keeps one copy per event."""
    ev = S.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    path = scratch_path(spark, "replay")
    spec = stage_replay(ev, path, None, ["ts", "event_id"])
    (ev.select(F.to_json(F.struct(*[F.col(c) for c in ev.columns])).alias("value"))
     .write.mode("append").text(path))
    stream = decode_json(open_stream(spark, spec), EVENT_SCHEMA)
    deduped = dedup_replays(stream, ["event_id"], "ts", DEDUP_DELAY)
    sink = scratch_path(spark, "sink")
    _run(deduped, idempotent_batch_writer(sink), spark, "stream_dedup")
    return read_sink(spark, sink).select("event_id", "ts")


def q_stream_window_counts(spark: SparkSession, d: str) -> DataFrame:
    """One-minute event counts on the stream, all windows, zero-filled."""
    ev = S.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    spec = stage_replay(ev, scratch_path(spark, "replay"), None, ["ts", "event_id"])
    stream = decode_json(open_stream(spark, spec), EVENT_SCHEMA)
    counts = stream_window_counts(stream, "ts", "1 minute", "10 minutes")
    sink = scratch_path(spark, "sink")
    _run(counts, idempotent_batch_writer(sink), spark, "stream_window_counts", output_mode="update")
    return latest_counts(read_sink(spark, sink))


def q_stream_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """NaN, missing and garbage records are set aside with a reason, and
    the stream runs to its end: rows and sum of values per reason."""
    ev = S.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    good = json_message(ev)
    message = (F.when(F.col("event_id") % 11 == 1, F.regexp_replace(good, r'"value":[^,}]+', '"value":NaN'))
               .when(F.col("event_id") % 11 == 2, F.regexp_replace(good, r'"value":[^,}]+', '"value":null'))
               .when(F.col("event_id") % 11 == 3, F.concat(F.lit("no json "), F.col("event_id")))
               .otherwise(good))
    spec = stage_replay(ev, scratch_path(spark, "replay"), None, ["ts", "event_id"], value=message)
    stream = decode_json(open_stream(spark, spec), EVENT_SCHEMA, keep_raw=True)
    sink, aside = scratch_path(spark, "sink"), scratch_path(spark, "quarantine")
    writer = idempotent_batch_writer(sink, split=lambda b: split_valid(b, ["event_id", "value"]), quarantine_path=aside)
    _run(stream, writer, spark, "stream_quarantine")
    bad = read_sink(spark, aside).select("reason", "event_id")
    rows = read_sink(spark, sink).select(F.lit("valid").alias("reason"), "event_id").unionByName(bad)
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


def q_stream_restart(spark: SparkSession, d: str) -> DataFrame:
    """Half of the events, then the rest, in two runs on one
    checkpoint: the second reads nothing of the first again."""
    ev = S.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    path, sink = scratch_path(spark, "replay"), scratch_path(spark, "sink")
    checkpoint = scratch_path(spark, "stream-ckpt", "stream_restart")
    runs = []
    for half in (0, 1):
        part = ev.where(F.col("event_id") % 2 == half)
        part.select(json_message(part).alias("value")).write.mode("append").text(path)
        stream = decode_json(open_stream(spark, StreamSpec(format="text", path=path)), EVENT_SCHEMA)
        runs.append(sum(n for _, n in _run(stream, idempotent_batch_writer(sink), spark, f"stream_restart_{half}", checkpoint)))
    return (read_sink(spark, sink).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("events"))
            .withColumn("read_by_second", F.lit(runs[1]).cast("bigint")))


def q_stream_diagnosis(spark: SparkSession, d: str) -> DataFrame:
    """Records broken in a dozen ways are set aside field by field:
    how often each fault with each offending value was met, and the valid."""
    ev = S.table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    good, kind = json_message(ev), F.col("event_id") % 16

    def put(field: str, text: str):
        return F.regexp_replace(good, f'"{field}":("[^"]*"|[^,}}]+)', f'"{field}":{text}')
    message = (F.when(kind == 1, put("value", "NaN")).when(kind == 2, put("value", "null"))
               .when(kind == 3, F.concat(F.lit("no json "), "event_id")).when(kind == 4, put("value", '"1.5"'))
               .when(kind == 5, F.regexp_replace(good, ',"value":[^,}]+', "")).when(kind == 6, put("user_id", "40.5"))
               .when(kind == 7, put("user_id", '"40"')).when(kind == 8, put("event_type", "5"))
               .when(kind == 9, put("event_type", "null")).when(kind == 10, F.concat(F.lit("["), "event_id", F.lit("]")))
               .when(kind == 11, put("value", "-99999")).when(kind == 12, F.regexp_replace(put("user_id", "40.0"), '"event_type":"[^"]*",', ""))
               .when(kind == 13, F.regexp_replace(good, "}$", ',"more":[1,2]}')).otherwise(good))
    rules = [Rule("event_id", "bigint"), Rule("user_id", "bigint"), Rule("event_type", "string"), Rule("value", "double", low=-1000.0)]
    spec = stage_replay(ev, scratch_path(spark, "replay"), None, ["event_id"], value=message)
    sink, aside = scratch_path(spark, "sink"), scratch_path(spark, "quarantine")
    _run(diagnose(open_stream(spark, spec), rules), idempotent_batch_writer(sink, split=split_diagnosed, quarantine_path=aside),
         spark, "stream_diagnosis")
    valid = read_sink(spark, sink).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(None).cast("string").alias("field"), F.lit("valid").alias("reason"), F.lit(None).cast("string").alias("value"), "n")
    return fault_counts(read_sink(spark, aside)).unionByName(valid)


RISK = ["Riesgo", "Sano"]


def q_stream_live_kpis(spark: SparkSession, d: str) -> DataFrame:
    """KPI and risk totals kept live. Every fifth event first
    comes with the wrong class and every third twice; the corrections come
    after a restart. The totals are those of the final classes."""
    ev = S.scored_events(spark, d).select("event_id", F.col("fecha_proceso").alias("ts"), F.col("prediction").alias("right"))
    first = ev.withColumn("seq", F.lit(0)).withColumn("prediction", F.when(F.col("event_id") % 5 == 0, 1 - F.col("right")).otherwise(F.col("right")))
    again = ev.where("event_id % 3 = 0 or event_id % 5 = 0").withColumn("seq", F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)).withColumn(
        "prediction", F.col("right"))
    path, sink, checkpoint = (scratch_path(spark, x) for x in ("replay", "sink", "stream-ckpt"))
    for part in (first, again):
        sent = part.select("event_id", "ts", "seq", "prediction")
        sent.select(json_message(sent).alias("value")).write.mode("append").text(path)
        stream = decode_json(open_stream(spark, StreamSpec(format="text", path=path)), "event_id bigint, ts timestamp_ntz, seq bigint, prediction int")
        named = stream.withColumn("risk", F.when(F.col("prediction") == 1, "Riesgo").when(F.col("prediction") == 0, "Sano"))
        changes = class_changes(named, "event_id", "risk", "seq", "ts", RISK, retention="3650 days")
        _run(changes, idempotent_batch_writer(sink, split=lambda b: (added_up(b), None)), spark, "stream_live_kpis", checkpoint, "update", STATE_STORE_CONF)
    written = read_sink(spark, sink)
    return live_kpis(written, RISK).join(live_risk(written), "total")


def q_stream_paced(spark: SparkSession, d: str) -> DataFrame:
    """The events in order at a steady pace (here the whole table in six
    seconds), stopped halfway and started again: every row once, in order,
    and no faster than asked."""
    ev = S.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    replay = stage_paced(ev, ["ts", "event_id"])
    rate, progress, sink, checkpoint = replay.total / 6, scratch_path(spark, "paced"), scratch_path(spark, "sink"), scratch_path(spark, "stream-ckpt")
    seconds, ends = 0.0, (replay.total // 2, replay.total)
    for until in ends:
        q = write_stream(replay.stream(rate, progress), replay.writer(idempotent_batch_writer(sink), max(50, replay.total // 10)), checkpoint, "stream_paced",
                         trigger={"processingTime": "0.5 seconds"})
        seconds += run_paced(q, replay, until, timeout=300)
    out = decode_json(read_sink(spark, sink), EVENT_SCHEMA, keep=["n"])
    return out.select("n", "event_id", "ts", F.lit(seconds >= 0.9 * replay.total / rate).alias("at_pace"))


STREAM_REGISTRY = {
    "stream_diagnosis": q_stream_diagnosis,
    "stream_live_kpis": q_stream_live_kpis,
    "stream_paced": q_stream_paced,
    "stream_ingest": q_stream_ingest,
    "stream_score_sink": q_stream_score_sink,
    "stream_dedup": q_stream_dedup,
    "stream_window_counts": q_stream_window_counts,
    "stream_quarantine": q_stream_quarantine,
    "stream_restart": q_stream_restart,
}

_DIAGNOSIS = """WITH m AS (SELECT CASE k WHEN 3 THEN 'no json ' || event_id WHEN 10 THEN '[' || event_id || ']' ELSE
    '{"event_id":' || event_id || ',"user_id":' || CASE k WHEN 6 THEN '40.5' WHEN 7 THEN '"40"' WHEN 12 THEN '40.0' ELSE user_id::VARCHAR END
    || CASE k WHEN 12 THEN '' WHEN 8 THEN ',"event_type":5' WHEN 9 THEN ',"event_type":null' ELSE ',"event_type":"' || event_type || '"' END
    || CASE k WHEN 5 THEN '' ELSE ',"value":' || CASE k WHEN 1 THEN '"not a number"' WHEN 2 THEN 'null' WHEN 4 THEN '"1.5"' WHEN 11 THEN '-99999'
                                                 ELSE value::VARCHAR END END || '}' END AS raw
  FROM (SELECT *, event_id % 16 AS k FROM events)),
o AS (SELECT raw, coalesce(json_valid(raw) AND json_type(CASE WHEN json_valid(raw) THEN raw END) = 'OBJECT', false) AS ok FROM m),
f AS (SELECT raw, unnest(['event_id', 'user_id', 'event_type', 'value']) AS field FROM o WHERE ok),
t AS (SELECT raw, field, json_type(raw, '$.' || field) AS kind, json_extract(raw, '$.' || field)::VARCHAR AS value FROM f),
r AS (SELECT raw, field, value, CASE WHEN kind IS NULL THEN 'absent' WHEN kind = 'NULL' THEN 'null'
        WHEN value = '"not a number"' THEN 'not a number'
        WHEN field IN ('event_id', 'user_id') AND kind NOT IN ('BIGINT', 'UBIGINT') THEN 'wrong type'
        WHEN field = 'value' AND kind NOT IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN 'wrong type'
        WHEN field = 'value' AND TRY_CAST(value AS DOUBLE) < -1000 THEN 'out of range' END AS reason FROM t)
SELECT field, reason, CASE WHEN reason IN ('absent', 'null') THEN NULL WHEN reason = 'not a number' THEN 'NaN' ELSE value END AS value, count(*) AS n
FROM r WHERE reason IS NOT NULL GROUP BY ALL
UNION ALL SELECT NULL, 'not an object', raw, count(*) FROM o WHERE NOT ok GROUP BY raw
UNION ALL SELECT NULL, 'valid', NULL, (SELECT count(*) FROM o WHERE ok) - (SELECT count(DISTINCT raw) FROM r WHERE reason IS NOT NULL)"""

STREAM_ORACLE = {
    "stream_diagnosis": _DIAGNOSIS,
    "stream_live_kpis": """WITH p AS (SELECT count(*) AS total, count_if(value > 100) AS r, count_if(value <= 100) AS s FROM events)
SELECT total, CAST(r AS BIGINT) AS n_riesgo, CAST(s AS BIGINT) AS n_sano, round_even(r::DOUBLE / total * 100, 1) AS pct_riesgo,
       round_even(s::DOUBLE / total * 100, 1) AS pct_sano, CAST(r AS BIGINT) AS high, CAST(s AS BIGINT) AS low,
       round_even(r::DOUBLE / total * 100, 2) AS high_pct FROM p""",
    "stream_paced": "SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS n, event_id, ts, true AS at_pace FROM events",
    "stream_ingest": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "stream_dedup": "SELECT event_id, ts FROM events",
    "stream_window_counts": _resample(60),
    "stream_quarantine": """SELECT CASE event_id % 11 WHEN 1 THEN 'value=NaN' WHEN 2 THEN 'value'
            WHEN 3 THEN 'event_id,value' ELSE 'valid' END AS reason, count(*) AS n,
       CAST(sum(CASE WHEN event_id % 11 <> 3 THEN event_id END) AS BIGINT) AS ids
FROM events GROUP BY 1""",
    "stream_restart": """SELECT count(*) AS n, count(DISTINCT event_id) AS events,
       CAST(count_if(event_id % 2 = 1) AS BIGINT) AS read_by_second FROM events""",
    "stream_score_sink": """SELECT o.o_orderkey, o.o_orderstatus AS status_label, true AS as_in_batch
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
}
