"""Replay job: publish a table as JSON messages (Kafka when configured),
or stage it as ordered JSON-line files for a rate-limited file stream."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clasp.functions.scalars import guess_scalar
from clasp.sources.sinks import publish_json
from clasp.sources.specs import StreamSpec, TableSpec
from clasp.streaming.sources import stage_replay


def typed_messages(df: DataFrame) -> DataFrame:
    """P14 per column: a text column whose every value reads as an int
    becomes a bigint (a decimal, if some are longer), else a double when all
    read as numbers of which none would lose digits, else stays text (one
    aggregate decides all columns)."""
    text_cols = [c for c, t in df.dtypes if t == "string"]
    if not text_cols:
        return df
    kinds = df.select(*[guess_scalar(c).alias(c) for c in text_cols])
    agg = kinds.agg(*[
        F.struct(F.count_if(F.col(f"{c}.kind") == "string").alias("s"),
                 F.count_if(F.col(f"{c}.kind") == "double").alias("d"),
                 F.max(F.length(F.ltrim(F.col(f"{c}.i"), F.lit("-")))).alias("digits"),
                 F.count_if(F.col(f"{c}.i").isNotNull() & F.col(f"{c}.i").try_cast("bigint").isNull()).alias("long")
                 ).alias(c)
        for c in text_cols]).first()
    out = {}
    for c in text_cols:
        g, digits = guess_scalar(c), agg[c]["digits"] or 0
        if agg[c]["s"]:
            continue
        if not agg[c]["d"] and digits <= 38:
            out[c] = g["i"].cast("decimal(38,0)" if agg[c]["long"] else "bigint")
        elif agg[c]["d"] and digits <= 15:
            out[c] = g["d"]
    return df.withColumns(out) if out else df


def guessed_message(df: DataFrame) -> Column:
    """K3 + P14 as the producer did it: one JSON object per row where each
    text value is written as an int if it reads as one (all its digits),
    else as a float, else as a JSON string (decided per value, not per
    column); nulls are written."""
    parts = []
    for c, t in df.dtypes:
        name = F.lit(json.dumps(c))
        if t == "string":
            g = guess_scalar(c)
            quoted = F.expr(f"substr(to_json(array(`{c}`)), 2, length(to_json(array(`{c}`))) - 2)")
            val = (F.when(g["kind"] == "null", F.lit("null"))
                   .when(g["kind"] == "int", g["i"])
                   .when(g["kind"] == "double", g["d"].cast("string"))
                   .otherwise(quoted))
        else:
            val = F.coalesce(F.expr(f"substr(to_json(array(`{c}`)), 2, length(to_json(array(`{c}`))) - 2)"),
                             F.lit("null"))
        parts.append(F.concat(name, F.lit(":"), val))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def guessed_json(df: DataFrame) -> DataFrame:
    """The messages of :func:`guessed_message` as one ``value`` column."""
    return df.select(guessed_message(df).alias("value"))


def run(df: DataFrame, target: TableSpec | StreamSpec, files: int | None = None,
        order: list[str] | None = None):
    """Publish ``df`` (text columns as read) as the producer's messages: to
    the target's topic, or as ordered files for a file stream."""
    value = guessed_message(df)
    if isinstance(target, StreamSpec) and target.format == "kafka":
        publish_json(df, TableSpec(format="kafka", options=dict(target.options)), value=value)
        return target
    return stage_replay(df, target.path, files, order or [df.columns[0]], value=value)


def main() -> None:
    from clasp.session import build_session
    spark = build_session("replay")
    try:
        src = spark.read.option("header", True).csv(os.environ.get("CSV_PATH", "data/records.csv"))
        target = (StreamSpec.kafka() if os.environ.get("STREAM_FORMAT", "kafka") == "kafka"
                  else StreamSpec(format="text", path=os.environ.get("STREAM_PATH", "in/records")))
        run(src, target)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
