"""Replay at a steady pace: rows per second, progress, stop and start."""

import logging

from pyspark.sql import functions as F

from clasp.session import scratch_path
from clasp.streaming.decode import decode_json
from clasp.streaming.paced import PacedReader, run_paced, stage_paced
from clasp.streaming.sinks import idempotent_batch_writer, read_sink, write_stream


def test_offsets_follow_the_clock_and_survive_a_restart(tmp_path, monkeypatch):
    now = [1000.0]
    monkeypatch.setattr("clasp.streaming.paced.time.time", lambda: now[0])
    r = PacedReader(1000, 50, str(tmp_path))
    assert r.initialOffset() == {"sent": 0} and r.latestOffset() == {"sent": 0}
    now[0] += 2.5
    assert r.latestOffset() == {"sent": 125}
    r.partitions({"sent": 0}, {"sent": 125})
    now[0] += 100
    assert r.latestOffset() == {"sent": 1000}
    again = PacedReader(1000, 50, str(tmp_path))  # the run stopped after it had planned 125
    assert [(p.start, p.end) for p in again.partitions({"sent": 0}, {"sent": 125})] == [(0, 125)]
    assert again.latestOffset() == {"sent": 125}
    now[0] += 1
    assert again.latestOffset() == {"sent": 175}


def test_slices_cover_a_batch(tmp_path):
    r = PacedReader(100, 1, str(tmp_path), slice_rows=30)
    parts = r.partitions({"sent": 5}, {"sent": 100})
    rows = [n for p in parts for b in r.read(p) for n in b.column(0).to_pylist()]
    assert len(parts) == 4 and rows == list(range(5, 100))
    assert [list(r.read(p)) for p in r.partitions({"sent": 100}, {"sent": 100})] == [[]]


def test_every_row_once_in_order_at_pace_with_progress(spark, caplog):
    rows = [(i, f"text {i % 7}", None if i % 5 == 0 else i / 3) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, t string, v double").repartition(5)
    replay = stage_paced(df, ["k"])
    assert replay.total == 400 and replay.staged.columns == ["n", "value"]
    sink, ck, progress = (scratch_path(spark, x) for x in ("t-paced", "t-paced-ck", "t-paced-progress"))
    rate, seconds = 25.0, 0.0
    with caplog.at_level(logging.INFO, logger="clasp.streaming.paced"):
        for until in (150, 400):
            q = write_stream(replay.stream(rate, progress), replay.writer(idempotent_batch_writer(sink)), ck, "t_paced",
                             trigger={"processingTime": "0.2 seconds"})
            seconds += run_paced(q, replay, until, timeout=120)
    out = decode_json(read_sink(spark, sink), "k int, t string, v double", keep=["n", "batch_id"]).orderBy("n").collect()
    assert [(x.n, x.k, x.t, x.v) for x in out] == [(i, *r) for i, r in enumerate(rows)]
    assert [x.batch_id for x in out] == sorted(x.batch_id for x in out) and len({x.batch_id for x in out}) > 1
    assert seconds >= 0.9 * 400 / rate
    lines = [r.getMessage() for r in caplog.records if r.name == "clasp.streaming.paced"]
    assert lines == [f"{n} of 400 rows sent" for n in range(50, 401, 50)]


def test_an_empty_table_and_a_finished_replay_end(spark):
    replay = stage_paced(spark.createDataFrame([], "k int"), ["k"])
    q = write_stream(replay.stream(10, scratch_path(spark, "p")), replay.writer(lambda df, i: None), scratch_path(spark, "ck"), "t_none")
    assert run_paced(q, replay, timeout=60) < 60


def test_an_error_in_a_batch_is_raised(spark):
    import pytest
    replay = stage_paced(spark.range(50).withColumn("x", F.lit(1)), ["id"])

    def broken(df, batch_id):
        raise ValueError("sink is down")
    q = write_stream(replay.stream(1000, scratch_path(spark, "p")), replay.writer(broken), scratch_path(spark, "ck"), "t_broken",
                     trigger={"processingTime": "0.2 seconds"})
    with pytest.raises(Exception, match="sink is down"):
        run_paced(q, replay, timeout=60)
