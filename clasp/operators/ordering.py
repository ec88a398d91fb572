"""Global row numbering and sorted random time stamps.

A window ``row_number() over (order by ...)`` with no partition runs in
one task. Instead: range-partition and sort (distributed), record each
row's partition and position, materialise that with a reliable checkpoint
(so recomputation after a lost executor cannot renumber rows), count rows
per partition (one row per partition), turn those counts into offsets and
add them back with a broadcast join whose size is the partition count.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clasp.session import ensure_checkpoint_dir


def with_row_id(df: DataFrame, order: list[str], out: str = "id", start: int = 1) -> DataFrame:
    """Consecutive ids ``start..start+n-1`` in ``order`` (make the
    order total, e.g. end with a unique key)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    placed = (df.orderBy(*[F.col(c).asc() for c in order])
              .withColumn("__rid_pid", F.spark_partition_id())
              .withColumn("__rid_mono", F.monotonically_increasing_id()))
    placed = placed.checkpoint(eager=True)
    # position inside the partition: monotonically_increasing_id puts the
    # partition index in the upper 31 bits and the row position below.
    placed = placed.withColumn("__rid_pos", F.col("__rid_mono") - F.shiftleft(F.col("__rid_pid").cast("bigint"), 33))
    per_part = placed.groupBy("__rid_pid").agg(F.count(F.lit(1)).alias("__rid_cnt"))
    # one row per partition: a window over it is tiny by construction
    offsets = per_part.select(
        "__rid_pid",
        (F.sum("__rid_cnt").over(Window.orderBy("__rid_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__rid_off"))
    offsets = offsets.fillna(0, subset=["__rid_off"])
    out_df = placed.join(F.broadcast(offsets), "__rid_pid")
    return (out_df.withColumn(out, (F.col("__rid_off") + F.col("__rid_pos") + F.lit(start)).cast("bigint"))
            .drop("__rid_pid", "__rid_mono", "__rid_pos", "__rid_off"))


def with_sorted_random_ts(df: DataFrame, id_col: str, start: datetime, end: datetime,
                          seed: int = 42, out: str = "fecha", ranked: bool = False) -> DataFrame:
    """``n`` uniform random times in ``[start, end]`` (whole seconds,
    both ends included), sorted, given to the rows in ``id_col`` order:
    row k gets the k-th smallest. A row's draw is a hash of the seed and its
    id, so it is the same however rows are partitioned. Rank the draws with
    :func:`with_row_id`, rank the ids the same way (unless ``ranked``: they
    are 1..n already), join on rank."""
    span = int((end - start).total_seconds())
    name = F.md5(F.concat(F.lit(f"{seed}:"), F.col("_src").cast("string")))
    draws = df.select(F.col(id_col).alias("_src")).withColumn(
        "_off", F.conv(F.substring(name, 1, 15), 16, 10).cast("bigint") % F.lit(span + 1))
    ranked_draws = with_row_id(draws, ["_off", "_src"], out="_rank").select("_rank", "_off")
    if ranked:
        ranked_rows = df.withColumn("_rank", F.col(id_col))
    else:
        keys = with_row_id(df.select(id_col), [id_col], out="_rank")
        ranked_rows = df.join(keys, id_col)
    base = F.lit(start).cast("timestamp_ntz")
    return (ranked_rows.join(ranked_draws, "_rank")
            .withColumn(out, base + F.make_dt_interval(secs=F.col("_off")))
            .drop("_rank", "_off"))
