"""A key holding a third of all rows: results stay whole and exact, the
keep-first aggregate reduces the hot key per task, and a sort-merge join
on it is split by AQE's skew handling (no broadcast, no salting by hand)."""

from pyspark.sql import functions as F

from clasp.operators import joins, stats


def _skewed(spark, n=90_000):
    # one third of the rows share text 'hot'; the rest are unique
    return spark.range(0, n, numPartitions=8).select(
        F.col("id").alias("conv_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id")))
        .alias("text"))


def test_hot_key_merge_is_exact_and_skew_split(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        base = _skewed(spark).withColumn("ref", F.lit(None).cast("bigint")).withColumn(
            "payload", F.concat(*[F.sha2((F.col("conv_id") * 4 + i).cast("string"), 256) for i in range(4)]))
        dim = _skewed(spark).select(F.col("conv_id").alias("doc_id"), "text")
        out = joins.merge_coalesce(base, dim, "text", "doc_id", "ref", order=["doc_id"])
        res = out.groupBy((F.col("text") == "hot").alias("hot")).agg(
            F.count(F.lit(1)).alias("n"), F.min("ref").alias("lo"), F.max("ref").alias("hi"))
        got = {r.hot: (r.n, r.lo, r.hi) for r in res.collect()}
        assert got[True] == (30_000, 0, 0)          # every hot row took the first doc id
        assert got[False][0] == 60_000
        out.write.format("noop").mode("overwrite").save()
        qe = out._jdf.queryExecution()
        qe.toRdd().count()
        assert "skew=true" in qe.executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_counts_and_keep_first(spark):
    df = _skewed(spark)
    dist = {r.text: r.total for r in stats.distribution(df, "text").where("total > 1").collect()}
    assert dist == {"hot": 30_000}
    first = joins.dedup_first(df, ["text"], ["conv_id"])
    assert first.count() == 60_001
    assert first.where("text = 'hot'").first().conv_id == 0
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
