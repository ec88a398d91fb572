"""Relational operators on literal rows (FIXTURES §3 and §2.13 traps)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clasp.functions.scalars import guess_scalar, round_half_even
from clasp.operators import columns, filters, joins, ordering, stats, timeseries, topk
from clasp.sources import sinks
from clasp.sources.specs import TableSpec


def test_round_half_even_matches_python_on_binary_ties(spark):
    df = spark.createDataFrame([(0.125,), (3.125,), (2.5,)], ["x"])
    got = [r[0] for r in df.select(round_half_even("x", 2)).collect()]
    assert got == [round(0.125, 2), round(3.125, 2), round(2.5, 2)]


def test_accuracy_pct_zero_when_empty(spark):
    df = spark.createDataFrame([], "label int, prediction int")
    row = stats.risk_summary(df, "prediction").first()
    assert (row["total"], row["high"], row["high_pct"], row["model_accuracy"]) == (0, 0, 0.0, 0.0)


def test_null_keys_store_vs_pandas(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), ("a",)], "k string")
    dist = {r["k"]: r["total"] for r in stats.distribution(df, "k").collect()}
    assert dist == {"a": 2, None: 1, "b": 1}
    vc = [(r["k"], r["count"]) for r in stats.value_counts(df, "k").collect()]
    assert vc == [("a", 2), ("b", 1)]


def test_label_stats_null_safe_equality(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (None, None), (None, 0)], "l int, p int")
    rows = stats.label_stats(df, "l", "l", "p").collect()
    assert {r["total"] for r in rows} == {4} and {r["correct"] for r in rows} == {2}
    assert {r["accuracy"] for r in rows} == {50.0}
    pandas_rule = stats.label_stats(df, "l", "l", "p", null_safe=False).first()
    assert pandas_rule["correct"] == 1


def test_kpi_row_absent_class_is_zero(spark):
    df = spark.createDataFrame([("Sano",), ("Sano",), ("Riesgo",)], ["c"])
    r = stats.kpi_row(df, "c", ["Riesgo", "Sano", "Otro"]).first()
    assert (r["total"], r["n_riesgo"], r["n_sano"], r["n_otro"]) == (3, 1, 2, 0)
    assert (r["pct_riesgo"], r["pct_sano"], r["pct_otro"]) == (33.3, 66.7, 0.0)


def test_accuracy_fallback_without_metrics(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (1, 1)], "l int, p int")
    empty = spark.createDataFrame([], "accuracy double, fecha timestamp")
    r = stats.accuracy_or_metrics(df, empty, "l", "p").first()
    assert r["source"] == "computed" and r["accuracy"] == 66.7
    m = spark.createDataFrame([(80.0, datetime(2024, 1, 1)), (90.0, datetime(2024, 2, 1))],
                              "accuracy double, fecha timestamp")
    r = stats.accuracy_or_metrics(df, m, "l", "p").first()
    assert r["source"] == "metrics" and r["accuracy"] == 90.0


def test_week_buckets_anchor_on_first_day(spark):
    df = spark.createDataFrame([(datetime(2025, 11, 1, 1, 57, 32), 1),
                                (datetime(2025, 11, 16, 0, 0, 0), 1),
                                (None, 1)], "ts timestamp_ntz, v int")
    got = [(r[0], r[1]) for r in timeseries.resample_count(df, "ts", "7D", "v").orderBy("bucket_start").collect()]
    assert got == [(datetime(2025, 11, 1), 1), (datetime(2025, 11, 8), 0), (datetime(2025, 11, 15), 1)]


def test_resample_properties(spark):
    from tests.conftest import SF_SMALL
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out = timeseries.resample_count(ev, "ts", "1h", "value")
    rows = out.orderBy("bucket_start").collect()
    assert sum(r["n"] for r in rows) == ev.where(F.col("ts").isNotNull() & F.col("value").isNotNull()).count()
    gaps = {(b["bucket_start"] - a["bucket_start"]).total_seconds() for a, b in zip(rows, rows[1:])}
    assert gaps == {3600.0}


def test_empty_resample(spark):
    df = spark.createDataFrame([], "ts timestamp_ntz, v int")
    assert timeseries.resample_count(df, "ts", "1min", "v").count() == 0


def test_search_regex_case_insensitive_null_safe(spark):
    df = spark.createDataFrame([(1, "Hello World"), (2, None), (3, "nothing")], "id int, t string")
    assert [r.id for r in filters.search(df, "t", "WOR.D").collect()] == [1]
    assert filters.search(df, "t", "").count() == 3
    rows, counts = filters.explore(df, "id", None, "t", "o")
    c = counts.first()
    assert (c["shown"], c["total"]) == (2, 3)


def test_typed_filter_non_int_matches_nothing(spark):
    df = spark.createDataFrame([(1,), (0,)], "p int")
    assert filters.filter_typed_eq(df, "p", "1").count() == 1
    assert filters.filter_typed_eq(df, "p", "abc").count() == 0
    assert filters.filter_typed_eq(df, "p", None).count() == 2


def test_limit_parameter_rules():
    assert topk.parse_limit("abc") == 50 and topk.parse_limit(None) == 50
    assert topk.parse_limit(0) is None and topk.parse_limit("-5") == 5 and topk.parse_limit(7) == 7


def test_latest_orders_with_tiebreak(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2)),
                                (3, datetime(2024, 1, 2)), (4, None)], "id int, ts timestamp")
    assert [r.id for r in topk.latest(df, "ts", "id", 3).collect()] == [2, 3, 1]
    assert topk.latest_one(df, "ts", ["id"]).first().id == 3
    assert topk.latest_one(df.limit(0), "ts").count() == 0


def test_dedup_first_keeps_first_by_order(spark):
    df = spark.createDataFrame([("x", 3, "c"), ("x", 1, "a"), ("y", 2, "b")], "k string, o int, v string")
    got = {r.k: (r.o, r.v) for r in joins.dedup_first(df, ["k"], ["o"]).collect()}
    assert got == {"x": (1, "a"), "y": (2, "b")}


def test_merge_coalesce_prefers_joined_value(spark):
    base = spark.createDataFrame([("t1", None), ("t2", 5), ("t3", 7)], "text string, ref int")
    dim = spark.createDataFrame([("t1", 10), ("t1", 11), ("t3", 30)], "text string, doc int")
    out = {r.text: r.ref for r in joins.merge_coalesce(base, dim, "text", "doc", "ref", ["doc"]).collect()}
    assert out == {"t1": 10, "t2": 5, "t3": 30}


def test_optional_enrichment_missing_dimension(spark, tmp_path):
    base = spark.createDataFrame([("t1", 1)], "text string, ref int")
    out = joins.enrich_left_optional(spark, base, str(tmp_path / "absent"), spark.read.parquet,
                                     "text", "doc", "ref")
    assert out.collect() == base.collect()


def test_ensure_columns_and_select_existing(spark):
    df = spark.createDataFrame([(1, "en")], "id int, lang string")
    out = columns.ensure_columns(df, {"prediction": "desconocido", "lang": "xx"})
    r = columns.select_existing(out, ["id", "lang", "prediction", "missing"]).first()
    assert r.asDict() == {"id": 1, "lang": "en", "prediction": "desconocido"}


def test_type_guess_cases(spark):
    vals = ["40", "40.0", " 5 ", "1_000", "nan", "1e3", "x", "12D", "3f", "1.0F", "0x1p3", "1__0", "_1", "-007", "+8", "-0",
            "12345678901234567890123456789012345678901234567890", ".5", "5.", ".", "-inf", "Infinity", "1_0.0_1e1_0", "", " ", "1e", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "n int, s string")
    for r in df.select("s", guess_scalar("s").alias("g")).orderBy("n").collect():
        want = ("null", None, None) if r.s is None else ("string", None, None)
        for kind, read in (("double", float), ("int", int)):
            try:
                want = (kind, str(read(r.s)) if kind == "int" else None, float(r.s))
            except (TypeError, ValueError):
                pass
        assert (r.g.kind, r.g.i) == want[:2] and r.g.s == r.s, r
        assert r.g.d == want[2] or r.g.d != r.g.d and want[2] != want[2]


def test_stringified_times_keep_their_fraction(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 1, 2, 3, 456789),), (datetime(2024, 1, 1),)], "ts timestamp_ntz")
    assert [r.ts for r in columns.stringify_ts(df).collect()] == ["2024-01-01 01:02:03.456789", "2024-01-01 00:00:00"]


def test_equality_filter_follows_the_schema(spark):
    df = spark.createDataFrame([(1, "1", True), (2, "2", False)], "n int, s string, b boolean")
    count = lambda c, v: filters.filter_eq(df, c, v).count()
    assert [count("n", 1), count("n", "1"), count("n", "x"), count("n", True)] == [1, 0, 0, 0]
    assert [count("s", "1"), count("s", 1), count("b", True), count("b", 1), count("n", None), count("s", "")] == [1, 0, 1, 0, 2, 2]


def test_draws_do_not_depend_on_partitions(spark):
    start, end = datetime(2025, 11, 1), datetime(2026, 2, 1)
    got = [[tuple(r) for r in ordering.with_sorted_random_ts(spark.range(1, 60, numPartitions=n), "id", start, end, ranked=ranked)
            .orderBy("id").collect()] for n, ranked in ((2, False), (5, True))]
    assert got[0] == got[1]


def test_newest_rows_do_not_depend_on_partitions(spark):
    df = spark.range(1000).select("id", F.lit(datetime(2024, 1, 1)).alias("t"))
    got = [[r.id for r in topk.latest(df.repartition(n), "t", None, 5).collect()] for n in (1, 7)]
    assert got[0] == got[1] == [0, 1, 2, 3, 4]
    assert topk.latest_one(df.repartition(7), "t").first().id == 999


def test_typed_messages_lose_no_digits(spark):
    from clasp.jobs.replay import guessed_json, typed_messages
    df = spark.createDataFrame([("1", "1", "12345678901234567890", "1.5"), ("2", "2.5", "7", "12345678901234567890")],
                               "a string, b string, c string, d string")
    out = typed_messages(df)
    assert [t for _, t in out.dtypes] == ["bigint", "double", "decimal(38,0)", "string"]
    assert '"c":12345678901234567890' in guessed_json(df).first().value


def test_csv_bad_cells_become_null(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("Age,Oldpeak,Sex\n40.5,x,M\n,1.0,\n41,2.0,F\n")
    from clasp.sources.tables import read_csv
    df = read_csv(spark, str(p), "Age int, Oldpeak double, Sex string")
    rows = df.collect()
    assert rows[0].Age is None and rows[0].Oldpeak is None and rows[1].Age is None
    assert filters.drop_incomplete(df).count() == 1


def test_row_id_is_consecutive_across_partitions(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"))
    out = ordering.with_row_id(df, ["k"], out="rid")
    rows = out.orderBy("rid").collect()
    assert [r.rid for r in rows] == list(range(1, 5001))
    assert [r.k for r in rows] == sorted(r.k for r in rows)


def test_sorted_random_ts_properties(spark):
    df = spark.range(1, 301, numPartitions=3).withColumnRenamed("id", "rid")
    start, end = datetime(2025, 11, 1), datetime(2026, 2, 1)
    rows = ordering.with_sorted_random_ts(df, "rid", start, end, seed=7).orderBy("rid").collect()
    ts = [r.fecha for r in rows]
    assert len(rows) == 300 and ts == sorted(ts) and start <= ts[0] and ts[-1] <= end
    assert all(t.microsecond == 0 for t in ts)


def test_require_rows_and_truncate(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(sinks.EmptyResultError):
        sinks.require_rows(df.limit(0))
    spec = TableSpec(path=str(tmp_path / "t"))
    sinks.write_table(df, spec)
    sinks.truncate_table(spark.read.parquet(spec.path), spec)
    back = spark.read.parquet(spec.path)
    assert back.count() == 0 and back.columns == ["a"]


def test_write_counted_per_partition(spark, tmp_path):
    df = spark.range(10).withColumn("even", (F.col("id") % 2 == 0).cast("string"))
    got = {r.even: r.rows for r in sinks.write_counted(df, TableSpec(path=str(tmp_path / "o")),
                                                       by="even").collect()}
    assert got == {"true": 5, "false": 5}
    assert sinks.write_counted(df, TableSpec(path=str(tmp_path / "p"))).first().rows == 10


def test_stringify_only_present_timestamp_columns(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1, 2, 3, 4))], "id int, ts timestamp")
    assert columns.stringify_ts(df).first().ts == "2024-01-01 02:03:04"
    from clasp.functions.scalars import format_ts_pystr
    df2 = spark.createDataFrame([(datetime(2024, 1, 1, 2, 3, 4, 500),)], "ts timestamp_ntz")
    assert df2.select(format_ts_pystr("ts")).first()[0] == str(datetime(2024, 1, 1, 2, 3, 4, 500))


def test_search_folds_unicode_case(spark):
    df = spark.createDataFrame([(1, "ÉCOLE"), (2, "école"), (3, "ecole")], "id int, t string")
    assert sorted(r.id for r in filters.search(df, "t", "école").collect()) == [1, 2]


def test_string_keys_render_null_as_python_does(spark):
    df = spark.createDataFrame([(1,), (None,), (1,)], "p int")
    got = {r.p: r.total for r in stats.distribution(df, "p", as_string=True).collect()}
    assert got == {"1": 2, "None": 1}


def test_stats_record_one_row(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), (None, None)], "l string, p string")
    rec = stats.stats_record(stats.label_stats(df, "l", "l", "p"), "l").first()
    assert rec.total == 3 and rec.accuracy == 66.67
    assert dict(rec.distribution) == {"a": 1, "b": 1, "null": 1}


def test_csv_roundtrip_whole_texts(spark, tmp_path):
    from tests.conftest import SF_SMALL
    from clasp.sources.tables import read_csv
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, 'say "hi"\\nnext \\\\ line, "x"')], "doc_id bigint, text string")
    src = docs.unionByName(extra)
    sinks.write_csv(src, str(tmp_path / "d"))
    back = read_csv(spark, str(tmp_path / "d"), "doc_id bigint, text string", multiline=True)
    assert back.count() == src.count()
    assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0
