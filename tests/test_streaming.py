"""Stream tests: decoding rules, quarantine, idempotent sink, restart on
the same checkpoint reads nothing twice, batch result = stream result."""

from pyspark.sql import functions as F

from clasp.session import scratch_path
from clasp.sources.specs import StreamSpec
from clasp.streaming.decode import decode_json, split_valid
from clasp.streaming.sinks import idempotent_batch_writer, read_sink, run_until_idle, write_stream
from clasp.streaming.sources import open_stream

SCHEMA = "Age int, Sex string, Oldpeak double"


def test_json_decode_cases(spark):
    vals = ['{"Age":40,"Sex":"M","Oldpeak":0}', '{"Age":40.5,"Sex":"M","Oldpeak":1}',
            '{"Age":"40","Sex":"M","Oldpeak":"1.5"}', '{"Sex":5}', 'not json', '[{"Age":1}]', None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, value string")
    rows = decode_json(df, SCHEMA, keep=["i"]).orderBy("i").collect()
    got = [(r.Age, r.Sex, r.Oldpeak) for r in rows]
    assert got[0] == (40, "M", 0.0)
    assert got[1] == (None, "M", 1.0)
    assert got[2] == (None, "M", None)
    assert got[3] == (None, "5", None)
    assert got[4] == got[5] == got[6] == (None, None, None)


def test_split_valid_reasons(spark):
    df = spark.createDataFrame([(1, "M", None), (None, None, 1.0), (2, "F", 0.5)], SCHEMA)
    good, bad = split_valid(df, ["Age", "Sex", "Oldpeak"], raw_col=None)
    assert good.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["Age,Sex", "Oldpeak"]


def _stage(spark, lines):
    path = scratch_path(spark, "test-stream")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_stream_quarantine_and_restart(spark):
    src = _stage(spark, ['{"Age":40,"Sex":"M","Oldpeak":0}', 'garbage'])
    sink, quar = scratch_path(spark, "t-sink"), scratch_path(spark, "t-q")
    ckpt = scratch_path(spark, "t-ckpt")
    stream = decode_json(open_stream(spark, StreamSpec(path=src)), SCHEMA, keep_raw=True)

    def split(b):
        return split_valid(b, ["Age", "Sex", "Oldpeak"])

    writer = idempotent_batch_writer(sink, split=split, quarantine_path=quar)
    run_until_idle(write_stream(stream, writer, ckpt, "t1", trigger={"availableNow": True}))
    good = read_sink(spark, sink)
    assert [(r.Age, r.Sex, r.Oldpeak) for r in good.collect()] == [(40, "M", 0.0)]
    bad = read_sink(spark, quar).collect()
    assert len(bad) == 1 and bad[0]._raw == "garbage"
    # a restart on the same checkpoint has nothing new to read
    run_until_idle(write_stream(stream, writer, ckpt, "t1", trigger={"availableNow": True}))
    assert read_sink(spark, sink).count() == 1
    assert read_sink(spark, sink).select("batch_id").distinct().count() == 1


def test_retried_batch_overwrites_itself(spark):
    sink = scratch_path(spark, "t-idem")
    w = idempotent_batch_writer(sink)
    b = spark.createDataFrame([(1,), (2,)], "x int")
    w(b, 0)
    w(b, 0)  # the same batch delivered again
    w(spark.createDataFrame([], "x int"), 1)  # empty batch skipped
    got = read_sink(spark, sink)
    assert got.count() == 2 and [r.batch_id for r in got.select("batch_id").distinct().collect()] == [0]


def test_stream_result_equals_batch(spark):
    from tests.conftest import SF_SMALL
    import __spark_entry__ as E
    out = E.queries()["stream_ingest"](spark, SF_SMALL)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(*out.columns)
    assert out.exceptAll(ev).count() == 0 and ev.exceptAll(out).count() == 0
    dd = E.queries()["stream_dedup"](spark, SF_SMALL)
    assert dd.count() == ev.count() == dd.select("event_id").distinct().count()
    assert dd.where(F.col("ts").isNull()).count() == 0


def test_batch_error_surfaces_and_stops_query(spark):
    import pytest
    from pyspark.errors import StreamingQueryException
    src = _stage(spark, ['{"Age":1,"Sex":"M","Oldpeak":0}'])
    stream = decode_json(open_stream(spark, StreamSpec(path=src)), SCHEMA)

    def failing(batch, batch_id):
        raise RuntimeError("sink down")

    q = write_stream(stream, failing, scratch_path(spark, "t-fail"), "t_fail",
                     trigger={"availableNow": True})
    with pytest.raises(StreamingQueryException):
        run_until_idle(q)
    assert not q.isActive


def test_nan_is_quarantined_with_a_reason(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, float("nan"), "b"), (3, None, "c")], "k int, x double, _raw string")
    good, bad = split_valid(df, ["k", "x"])
    assert [r.k for r in good.collect()] == [1]
    assert {(r.k, r.reason, r._raw) for r in bad.collect()} == {(2, "x=NaN", "b"), (3, "x", "c")}


def test_replay_keeps_order_where_times_cannot_be_set(spark, monkeypatch):
    from clasp.session import scratch_path
    from clasp.streaming import sources
    monkeypatch.setattr(sources, "_order_file_times", lambda *a: False)
    df = spark.range(0, 400, numPartitions=4).withColumn("k", F.col("id") * 7919 % 400)
    path = scratch_path(spark, "t-replay")
    sources.stage_replay(df, path, 4, ["k"])
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((s.getModificationTime(), s.getPath().toString()) for s in fs.listStatus(fs_path) if "part-" in s.getPath().getName())
    last = -1
    for _, name in files:
        ks = [r.k for r in spark.read.json(name).collect()]
        if ks:
            assert min(ks) > last
            last = max(ks)


def test_a_store_that_ignores_times_is_noticed(spark, monkeypatch):
    """Times are read back: if they aren't in order, slices are written one
    after another."""
    from clasp.session import scratch_path
    from clasp.streaming import sources
    seen = []
    monkeypatch.setattr(sources, "_write_slices_in_order", lambda *a: seen.append(a))
    real = sources._order_file_times

    def ignored(spark_, path):
        assert real(spark_, path)
        root = spark_._jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(spark_._jsc.hadoopConfiguration())
        names = [s.getPath() for s in fs.listStatus(root)]
        for p in names:
            fs.setTimes(p, 1_000_000, -1)
        times = [fs.getFileStatus(p).getModificationTime() for p in names]
        return all(a < b for a, b in zip(times, times[1:]))
    monkeypatch.setattr(sources, "_order_file_times", ignored)
    sources.stage_replay(spark.range(100), scratch_path(spark, "t-replay"), 3, ["id"])
    assert seen


def test_kafka_writer_gets_a_topic():
    from clasp.sources.sinks import kafka_writer_options
    from clasp.sources.specs import StreamSpec
    assert kafka_writer_options(StreamSpec.kafka("b:1", "t").options) == {"kafka.bootstrap.servers": "b:1", "topic": "t"}


def test_null_fields_are_written(spark):
    from clasp.streaming.sources import json_message
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(json_message(df).alias("v")).first().v == '{"a":1,"b":null}'


def test_a_processing_time_trigger_runs_until_stopped(spark):
    import time
    path, sink = scratch_path(spark, "t-trigger"), scratch_path(spark, "t-sink")
    spark.range(5).selectExpr("concat('{\"k\":', id, '}') as value").write.text(path)
    stream = decode_json(open_stream(spark, StreamSpec(format="text", path=path)), "k int")
    query = write_stream(stream, idempotent_batch_writer(sink), scratch_path(spark, "t-ckpt"), "t_trigger",
                         trigger={"processingTime": "1 second"})
    try:
        for _ in range(60):
            if any(p["numInputRows"] for p in query.recentProgress):
                break
            time.sleep(1)
        assert query.isActive and read_sink(spark, sink).count() == 5
    finally:
        query.stop()
