"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a uniform 60-bit key from a hash of its id and text.
Within a source, documents in key order are the random order in which the
mix reads it. Equal ranges of the key space are the range partitions: their
token counts are summed per (source, range), a prefix sum over the ranges
finds the one range in which a source's budget ends, and a prefix sum over
the keys of that range finds the key at which it is cut. A document's share
of the mix then follows from its own key and its source's cut, so texts are
never shuffled, and a source that holds a third of all rows is spread over
all ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clasp.llm.common import WORD_PATTERN, cut

KEY_BITS = 60


def sort_key(id_col: str = "doc_id", text_col: str = "text", seed: str = "") -> Column:
    """Uniform key in ``[0, 2**60)``; equal rows share it."""
    name = F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"),
                    F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    return F.conv(F.substring(F.md5(name), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3),
                   max_epochs: int = 3) -> DataFrame:
    """``(source, source_size)`` -> plus ``target`` and ``budget``.

    Sources in code-point order (null last) take ``weights`` in turn and
    share the sum of all sizes. A target stops at ``max_epochs`` times its
    source's size; what it can't take is reshared by weight. In order of
    ``cap / weight`` the level of the first source that isn't above its cap
    is the level of all that follow. One row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    t = (totals.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
         .withColumn("_cap", F.col("source_size").cast("double") * max_epochs)
         .withColumn("_ratio", F.col("_cap") / F.col("_w")))
    order = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = (t.withColumn("_all", F.sum("source_size").over(everything).cast("double"))
         .withColumn("_all_w", F.sum("_w").over(everything))
         .withColumn("_level", (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                     / (F.col("_all_w") - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))))
    level = F.min(F.when(F.col("_ratio") >= F.col("_level"), F.struct("_ratio", "_level"))).over(everything)
    t = t.withColumn("_found", level["_level"])
    target = F.least("_cap", F.col("_w") * F.coalesce(F.col("_found"), F.lit(0.0)))
    return (t.withColumn("target", target)
            .withColumn("budget", F.least(F.floor(target + 0.5), F.col("source_size") * max_epochs))
            .select("source", "source_size", "target", "budget"))


def source_cuts(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3,
                rows_per_range: int = 50_000) -> DataFrame:
    """``(source, size, key)`` -> one row per source: ``source_size``,
    ``target``, whole ``epochs``, the ``cut_key`` of the last partial epoch
    and the words ``cut_share`` that each row with that very key gives."""
    bits = max(0, (sized.count() // rows_per_range).bit_length())
    in_range = sized.withColumn("_range", F.shiftright("key", KEY_BITS - bits))
    per_range = in_range.groupBy("source", "_range").agg(F.sum("size").alias("_words"))
    totals = per_range.groupBy("source").agg(F.sum("_words").alias("source_size"))
    goals = (source_targets(totals, weights, max_epochs)
             .withColumn("epochs", F.when(F.col("source_size") > 0,
                                          F.floor(F.col("budget") / F.col("source_size"))).otherwise(0).cast("long"))
             .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size")))
    goals = cut(goals, "mix-goals")
    up_to = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    ends = (per_range.withColumn("_upto", F.sum("_words").over(up_to))
            .join(goals.select(F.col("source").alias("_s"), "rest"), F.col("source").eqNullSafe(F.col("_s")))
            .where((F.col("_upto") > F.col("rest")) & (F.col("_upto") - F.col("_words") <= F.col("rest")))
            .select(F.col("source").alias("_es"), F.col("_range").alias("_er"), "rest",
                    (F.col("_upto") - F.col("_words")).alias("_before")))
    # rows of one range per source; equal keys are cut together
    last = (in_range.join(ends, F.col("source").eqNullSafe(F.col("_es")) & (F.col("_range") == F.col("_er")))
            .groupBy("source", "key", "rest", "_before")
            .agg(F.sum("size").alias("_words"), F.count(F.lit(1)).alias("_rows")))
    running = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    at = (last.withColumn("_upto", F.col("_before") + F.sum("_words").over(running))
          .where((F.col("_upto") > F.col("rest")) & (F.col("_upto") - F.col("_words") <= F.col("rest")))
          .groupBy("source")
          .agg(F.min(F.struct("key", F.floor((F.col("rest") - F.col("_upto") + F.col("_words"))
                                             / F.col("_rows")).alias("share"))).alias("_cut"))
          .select(F.col("source").alias("_cs"), "_cut"))
    return (goals.join(at, F.col("source").eqNullSafe(F.col("_cs")), "left")
            .select("source", "source_size", "target", "epochs",
                    F.coalesce(F.col("_cut")["key"], F.lit(-1)).alias("cut_key"),
                    F.coalesce(F.col("_cut")["share"], F.lit(0)).cast("long").alias("cut_share")))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"),
        sort_key(id_col, text_col, seed).alias("key"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: str = "",
        rows_per_range: int = 50_000) -> DataFrame:
    """Words that the mix takes from every document.

    Returns ``doc_id, size, source_size, target, taken``, one row per input
    row. ``size`` counts the words of the whole text (null: 0). A null
    source is a source of its own, last in order. ``taken`` is ``epochs *
    size`` plus, before the cut of the last epoch, ``size`` again; the row
    at the cut gives the words that are left, and rows with the same id and
    text share them evenly. Reruns give the same result. Other columns are
    ignored; an empty table gives no rows.
    """
    sized = cut(_sized(docs, id_col, text_col, source_col, seed), "mix-sizes")
    cuts = cut(source_cuts(sized, weights, max_epochs, rows_per_range)
               .withColumnRenamed("source", "_src"), "mix-cuts")
    return (sized.join(cuts, F.col("source").eqNullSafe(F.col("_src")))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("epochs") * F.col("size")
                     + F.when(F.col("key") < F.col("cut_key"), F.col("size"))
                     .when(F.col("key") == F.col("cut_key"), F.least("size", "cut_share"))
                     .otherwise(0)).alias("taken")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", weights: tuple[int, ...] = (1, 2, 3),
                    max_epochs: int = 3, seed: str = "", rows_per_range: int = 50_000) -> DataFrame:
    """The mix as whole documents: each input row, with its own columns,
    once per epoch that takes it. The document at the cut counts as taken
    if the mix takes at least half of its words. Rows without words are in
    every whole epoch of their source, and in the last one if before its cut.
    """
    names = docs.columns
    sized = cut(_sized(docs, id_col, text_col, source_col, seed).drop("doc_id"), "mix-sizes")
    cuts = cut(source_cuts(sized, weights, max_epochs, rows_per_range)
               .select(F.col("source").alias("_mix_src"), "epochs", "cut_key", "cut_share"), "mix-cuts")
    spark = docs.sparkSession
    inner = [f"_mix_{i}" for i in range(len(names))]  # the caller's names can't clash with ours
    held = dict(zip(names, inner))
    size = F.regexp_count(F.col(held[text_col]), F.lit(WORD_PATTERN))
    key = sort_key(held[id_col], held[text_col], seed)
    keyed = docs.toDF(*inner).withColumn("_mix_key", key)
    taken = (keyed.join(cuts.withColumnRenamed("epochs", "_mix_e").withColumnRenamed("cut_key", "_mix_k")
                        .withColumnRenamed("cut_share", "_mix_c"),
                        F.col(held[source_col]).eqNullSafe(F.col("_mix_src"))))
    copies = F.col("_mix_e") + F.when(F.col("_mix_key") < F.col("_mix_k"), 1).when(
        (F.col("_mix_key") == F.col("_mix_k")) & (F.col("_mix_c") > 0)
        & (F.col("_mix_c") * 2 >= F.coalesce(size, F.lit(0))), 1).otherwise(0)
    again = taken.withColumn("_mix_n", copies.cast("int")).where("_mix_n > 0")
    again = again.withColumn("_mix_i", F.explode(F.sequence(F.lit(1), F.col("_mix_n"))))
    assert spark is not None
    return again.select(*[F.col(i).alias(n) for n, i in zip(names, inner)])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1.0::DOUBLE + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w,
             source_size::DOUBLE * 3 AS cap FROM s),
l AS (SELECT *, cap / w AS ratio,
        ((SELECT sum(source_size) FROM s)::DOUBLE
          - coalesce(sum(cap) OVER o, 0)) / ((SELECT sum(w) FROM w) - coalesce(sum(w) OVER o, 0)) AS level
      FROM w WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT source, source_size, least(cap, w * (SELECT arg_min(level, (ratio, level)) FROM l WHERE ratio >= level)) AS target FROM l),
b AS (SELECT *, least(floor(target + 0.5)::BIGINT, source_size * 3) AS budget FROM g),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM b),
p AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.budget - e.epochs * e.source_size AS rest,
        sum(size) OVER (PARTITION BY d.source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
        sum(size) OVER (PARTITION BY d.source, key) AS peers, count(*) OVER (PARTITION BY d.source, key) AS m
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
  (epochs * size + CASE WHEN upto <= rest THEN size WHEN upto - peers >= rest THEN 0
                        ELSE least(size, (rest - (upto - peers)) // m) END)::BIGINT AS taken
FROM p
"""
