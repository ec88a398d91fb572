"""Plan properties that matter at scale, read from the executed
(adaptive, final) plans of the registered queries."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def executed_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def q():
    return E.queries()


def test_totals_reuse_the_aggregate_shuffle(spark, q):
    plan = executed_plan(q["label_stats"](spark, SF_SMALL))
    assert "ReusedExchange" in plan


def test_top_terms_limit_before_shuffle(spark, q):
    plan = executed_plan(q["tfidf_top_terms"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_latest_is_take_ordered(spark, q):
    df = q["latest_n"](spark, SF_SMALL)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, q):
    plan = executed_plan(q["filter_label"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(quality), EqualTo(quality,1)" in plan or \
           "EqualTo(quality,1)" in plan
    plan = executed_plan(q["risk_distribution"](spark, SF_SMALL))
    assert "ReadSchema: struct<value:double>" in plan


def test_keep_first_is_a_partial_aggregate(spark, q):
    plan = executed_plan(q["dedup_first"](spark, SF_SMALL))
    assert "partial_min_by" in plan and "Window" not in plan


def test_row_ids_use_no_global_window_over_data(spark, q):
    df = q["row_id"](spark, SF_SMALL)
    plan = executed_plan(df)
    # the only window runs over one row per partition (offsets)
    assert "BroadcastExchange" in plan


def test_time_spine_is_a_range(spark, q):
    plan = executed_plan(q["resample_1min"](spark, SF_SMALL))
    assert "Range (" in plan


def test_spread_only_widens_narrow_scans(spark):
    from clasp.operators.partitioning import num_partitions, spread
    scan = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert num_partitions(spread(scan, 8)) == 8
    wide = spark.range(0, 100, numPartitions=16)
    assert spread(wide, 8) is wide
    grouped = scan.groupBy("lang").count()
    assert spread(grouped, 8) is grouped


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["hash_split", "explore_counts", "metrics_row", "run_counters", "accuracy_fallback",
                                  "holdout_accuracy", "dedup_first", "merge_coalesce", "search_text", "stamp_rows"])
def test_texts_stay_in_their_scan(spark, q, no_broadcast, name):
    """No exchange carries a text: below each one, texts are digests, flags
    or gone."""
    df = q[name](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange " in line and "Reused" not in line:
            below = next(x for x in lines[i + 1:] if "WholeStage" not in x)
            assert not re.search(r"\b(text|texto)#\d+(?!\S* AS)", re.sub(r"\([^()]*\)", "", below.split("[", 1)[-1])) or (
                "AS" in below or "sha2" in below or "functions" in below), (line, below)


def test_term_idf_has_one_data_shuffle(spark, q):
    plan = executed_plan(q["term_idf"](spark, SF_SMALL)).split("== Initial Plan ==")[0]
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert set(keys) <= {"term"} and len(keys) <= 1, plan


def test_one_line_csv_is_split(spark, tmp_path):
    from clasp.operators.partitioning import num_partitions
    from clasp.sources.tables import read_csv
    p = tmp_path / "rows.csv"
    p.write_text("k,v\n" + "".join(f"{i},{'x' * 50}\n" for i in range(40_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        assert num_partitions(read_csv(spark, str(p), "k int, v string")) > 3
        assert num_partitions(read_csv(spark, str(p), "k int, v string", multiline=True)) == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_replay_is_as_wide_as_the_cluster(spark):
    from clasp.streaming.sources import replay_width
    files, per_batch = replay_width(spark.range(10))
    cores = spark.sparkContext.defaultParallelism
    assert per_batch == cores and files >= 4 * cores
