"""Connected components of a link table, without collecting any of it.

Alternating large-star and small-star steps: each is one aggregate of the
smallest neighbour and one equi-join back, so a node with very many links
is reduced before the shuffle and its join partition can be split. Every
step's links are written, so a lost executor repeats one step at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clasp.llm.common import cut, discard


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``a, b`` (longs; any order, repeats allowed) -> ``node, root``: the
    smallest node reachable, for every node of a link. No links, no rows."""
    links = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .distinct(), "cc-links")
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .distinct())
        large = cut(large, "cc-large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        following = cut(small, "cc-small")
        reached = _state(following)
        discard(links, large)
        links = following
        if reached == state:
            break
        state = reached
    return (links.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
