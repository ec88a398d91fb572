"""Appends: ids without gaps that never change, retried and racing appends,
and summaries that read only what is new."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clasp.ml import text
from clasp.operators import running
from clasp.operators.stats import distribution
from clasp.operators.timeseries import resample_count
from clasp.session import scratch_path
from clasp.sources.appends import AppendTable, Running


def frame(spark, rows, schema="k int, t string"):
    return spark.createDataFrame(rows, schema).repartition(3)


def test_ids_survive_appends_and_a_retried_one(spark):
    table = AppendTable(spark, scratch_path(spark, "t-append"))
    with pytest.raises(FileNotFoundError):
        table.read()
    one = table.append(frame(spark, [(i, "a") for i in range(40)]), "monday", ["k"])
    before = {x.k: x.id for x in table.read().collect()}
    assert (one.first, one.last) == (1, 40) and before == {i: i + 1 for i in range(40)}
    none = table.append(frame(spark, []), "empty", ["k"])
    two = table.append(frame(spark, [(i, "b") for i in range(99, 39, -1)]), "tuesday", ["k"])
    assert (none.first, none.last, two.first, two.last) == (41, 40, 41, 100)
    assert table.append(frame(spark, [(7, "again")]), "tuesday", ["k"]) == two  # a retry changes nothing
    after = {x.k: x.id for x in table.read().collect()}
    assert sorted(after.values()) == list(range(1, 101)) and before.items() <= after.items()


def test_a_failed_attempt_leaves_no_ids(spark):
    table = AppendTable(spark, scratch_path(spark, "t-append"))
    table.append(frame(spark, [(1, "a")]), "a", ["k"])
    bad = frame(spark, [(2, "b"), (3, "x")]).withColumn("n", F.expr("if(t = 'x', raise_error('lost'), 1)"))
    with pytest.raises(Exception, match="lost"):
        table.append(bad, "b", ["k"])
    assert table.read().count() == 1
    assert table.append(frame(spark, [(2, "b")]), "b", ["k"]).first == 2


def test_the_later_of_two_writers_numbers_anew(spark, monkeypatch):
    root = scratch_path(spark, "t-append")
    mine, theirs = AppendTable(spark, root), AppendTable(spark, root)
    commit, raced = mine._commit, []

    def late(c):
        if not raced:  # another append commits between our reading and our commit
            raced.append(theirs.append(frame(spark, [(9, "t")] * 5), "theirs", ["k"]))
        return commit(c)
    monkeypatch.setattr(mine, "_commit", late)
    got = mine.append(frame(spark, [(1, "m"), (2, "m")]), "mine", ["k"])
    assert (raced[0].first, raced[0].last, got.first, got.last) == (1, 5, 6, 7)
    assert sorted(x.id for x in mine.read().collect()) == list(range(1, 8))


def slices(n=4):
    r = random.Random(8)
    start = datetime(2026, 3, 1, 22)
    rows = [(r.choice(["x", "y", None]), start + timedelta(minutes=r.randint(0, 4000)) if r.random() > .05 else None, f"w{r.randint(0, 9)} the w{r.randint(0, 9)}")
            for _ in range(200)]
    return [rows[i::n] for i in range(n)]  # times of all slices overlap: every slice brings late rows


def test_summaries_after_each_append_equal_the_full_queries(spark):
    table = AppendTable(spark, scratch_path(spark, "t-append"))
    make = lambda f, *a: f(table, scratch_path(spark, "t-running"), *a)
    counts, buckets, terms = make(running.running_counts, "key"), make(running.running_buckets, "ts", "7min"), make(running.running_terms, "txt")
    for i, rows in enumerate(slices()):
        table.append(frame(spark, rows, "key string, ts timestamp_ntz, txt string"), f"slice {i}", ["ts", "txt"])
        assert counts.update() == [i] and buckets.update() == [i] and terms.update() == [i] and counts.update() == []
        full = table.read()
        key = lambda df: sorted(map(str, df.collect()))
        assert key(counts.result().select("key", "n")) == key(distribution(full, "key").select("key", F.col("total").alias("n")))
        assert key(running.buckets_of(buckets.result(), "7min")) == key(resample_count(full, "ts", "7min"))
        assert key(running.idf_of(terms.result())) == key(text.term_idf(full, "txt"))
        assert key(running.label_order_of(counts.result(), "key")) == key(text.label_index_table(full, "key"))


def test_only_new_files_are_read(spark):
    table, read = AppendTable(spark, scratch_path(spark, "t-append")), []

    def summarise(df):
        read.append({f.rpartition("/")[0] for f in df.inputFiles()})
        return df.select("t", F.lit(1).alias("n"))
    total = Running(table, scratch_path(spark, "t-running"), summarise, ["t"], ["n"])
    commits = []
    for i in range(3):
        commits.append(table.append(frame(spark, [(i, "a"), (i, "b")]), str(i), ["k"]))
        total.update()
    assert [len(x) for x in read] == [1, 1, 1] and all(c.path.rpartition("/")[2] in next(iter(x)) for c, x in zip(commits, read))
    assert {x.t: x.n for x in total.result().collect()} == {"a": 3, "b": 3}
    assert {x.t: x.n for x in total.result(upto=0).collect()} == {"a": 1, "b": 1}


def test_a_killed_update_is_made_again(spark):
    table = AppendTable(spark, scratch_path(spark, "t-append"))
    commit = table.append(frame(spark, [(1, "a")]), "a", ["k"])
    total = running.running_counts(table, scratch_path(spark, "t-running"), "t")
    spark.createDataFrame([("half", 7)], "t string, n long").write.parquet(total._place(commit))
    table._fs.delete(table._path(total._place(commit) + "/_SUCCESS"), False)
    assert total.update() == [0] and [tuple(x) for x in total.result().collect()] == [("a", 1)]


@pytest.mark.parametrize("freq", ["7min", "5h", "36h", "7h", "90s", "3D"])
def test_any_bucket_width_equals_pandas(spark, freq):
    rows = [t for part in slices() for _, t, _ in part if t]
    df = spark.createDataFrame([(t, 1) for t in rows], "ts timestamp_ntz, v int")
    got = {r.bucket_start: r.n for r in resample_count(df, "ts", freq, "v").collect()}
    want = pd.DataFrame({"ts": rows, "v": 1}).set_index("ts").resample(freq)["v"].count()
    assert got == {k.to_pydatetime(): int(v) for k, v in want.items()}
