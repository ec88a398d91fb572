"""Live totals: any cut into micro-batches, re-sent and corrected records,
restarts, and state that is forgotten with time."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from clasp.operators.stats import kpi_row, risk_summary
from clasp.session import scratch_path
from clasp.sources.specs import StreamSpec
from clasp.streaming.decode import decode_json
from clasp.streaming.live import KNOWN, added_up, class_changes, live_kpis, live_risk, merged
from clasp.streaming.sinks import idempotent_batch_writer, read_sink, run_until_idle, write_stream
from clasp.streaming.sources import json_message, open_stream

CLASSES = ["Riesgo", "Sano"]
SCHEMA = "id bigint, ts timestamp_ntz, seq bigint, risk string"


def records(n=120):
    """Ids with one to three versions, in any order, some sent twice."""
    r, out = random.Random(4), []
    for i in range(n):
        for seq in range(r.randint(1, 3)):
            row = (i, datetime(2026, 1, 1) + timedelta(seconds=i), seq, r.choice(["Riesgo", "Sano", "other", None]))
            out += [row] * r.randint(1, 2)
    r.shuffle(out)
    return out


def final(rows):
    last = {}
    for i, _, seq, risk in rows:
        last[i] = max(last.get(i, (-1, -2)), (seq, CLASSES.index(risk) if risk in CLASSES else -1))
    return [c for _, c in last.values()]


def feed(spark, path, rows, files):
    df = spark.createDataFrame(rows, SCHEMA)
    df.repartition(files).select(json_message(df).alias("value")).write.mode("append").text(path)


def run(spark, path, sink, checkpoint, per_trigger, **kw):
    stream = decode_json(open_stream(spark, StreamSpec(format="text", path=path, max_per_trigger=per_trigger)), SCHEMA)
    changes = class_changes(stream, "id", "risk", "seq", "ts", CLASSES, buckets=8, **kw)
    q = write_stream(changes, idempotent_batch_writer(sink, split=lambda b: (added_up(b), None)), checkpoint, "t_live",
                     trigger={"availableNow": True}, output_mode="update")
    run_until_idle(q)


@pytest.mark.parametrize("files,per_trigger,parts", [(1, None, 1), (6, 1, 1), (4, 2, 3)])
def test_totals_equal_the_batch_form(spark, files, per_trigger, parts):
    rows = records()
    path, sink, ck = (scratch_path(spark, x) for x in ("t-live", "t-live-sink", "t-live-ck"))
    for i in range(parts):  # each part a run of its own on one checkpoint
        feed(spark, path, rows[i::parts], files)
        run(spark, path, sink, ck, per_trigger, retention="3650 days")
    written, classes = read_sink(spark, sink), final(rows)
    batch = spark.createDataFrame([(CLASSES[c] if c >= 0 else None, 1 - c if c >= 0 else None) for c in classes], "risk string, p int")
    assert live_kpis(written, CLASSES).collect() == kpi_row(batch, "risk", CLASSES).collect()
    assert live_risk(written).collect() == risk_summary(batch, "p").drop("model_accuracy").collect()


def test_state_is_forgotten_after_retention(spark):
    """An id comes again long after its retention: late, and left out."""
    path, sink, ck = (scratch_path(spark, x) for x in ("t-live", "t-live-sink", "t-live-ck"))
    day = lambda d: datetime(2026, 1, d)
    for rows in ([(1, day(1), 0, "Sano")], [(2, day(20), 0, "Sano")], [(3, day(21), 0, "Riesgo")], [(1, day(1), 1, "Riesgo")]):
        feed(spark, path, rows, 1)
        run(spark, path, sink, ck, None, retention="2 days")
    assert live_kpis(read_sink(spark, sink), CLASSES).first().asDict() == {"total": 3, "n_riesgo": 1, "n_sano": 2, "pct_riesgo": 33.3, "pct_sano": 66.7}


def test_empty_sink_and_text_ids(spark):
    none = spark.createDataFrame([], "cls int, change bigint")
    assert live_kpis(none, CLASSES).first().asDict() == {"total": 0, "n_riesgo": 0, "n_sano": 0, "pct_riesgo": 0.0, "pct_sano": 0.0}
    assert live_risk(none).first().asDict() == {"total": 0, "high": 0, "low": 0, "high_pct": 0.0}


def test_merge_keeps_the_newest_version():
    rows = lambda *x: np.array(list(x), dtype=KNOWN)
    kept, change = merged(rows((1, 0, 0, 5), (2, 3, 1, 5)), rows((1, 1, 1, 5), (2, 2, 0, 5), (3, 0, -1, 5), (3, 0, 0, 5)), 2)
    assert kept[["id", "version", "cls"]].tolist() == [(1, 1, 1), (2, 3, 1), (3, 0, 0)] and change.tolist() == [0, 1, 0]


def test_runs_on_a_session_with_another_state_store(spark, tmp_path):
    """The query brings the store its state needs, for itself alone."""
    from clasp.plans.stream_queries import q_stream_live_kpis
    key = "spark.sql.streaming.stateStore.providerClass"
    other = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.range(1, 41).select(
        F.col("id").alias("event_id"), (F.lit(datetime(2026, 1, 1)) + F.make_dt_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("ts"),
        F.lit(1).cast("bigint").alias("user_id"), F.lit("click").alias("event_type"), F.lit(None).cast("string").alias("props"),
        F.when(F.col("id") != 40, F.col("id") * 10.0).alias("value")).write.parquet(str(tmp_path / "events.parquet"))
    before = spark.conf.get(key)
    spark.conf.set(key, other)
    try:
        row = q_stream_live_kpis(spark, str(tmp_path)).first()
        assert spark.conf.get(key) == other
    finally:
        spark.conf.set(key, before)
    assert (row.total, row.n_riesgo, row.n_sano, row.high, row.low) == (40, 29, 10, 29, 10)
