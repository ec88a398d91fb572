"""Sinks (K1, K3–K8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clasp.sources.specs import TableSpec


class EmptyResultError(RuntimeError):
    pass


def write_table(df: DataFrame, spec: TableSpec, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """K1: batch write (overwrite by default). For ``mongodb`` pass
    ``{"writeConcern.w": "1", "database":..., "collection":...}`` in options."""
    w = df.write.mode(mode).format(spec.format).options(**spec.options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if spec.path:
        w.save(spec.path)
    else:
        w.save()


# Times are written with all six fraction digits (Spark's text formats keep
# three by default), so a CSV or JSON round trip returns the same value.
TIME_FORMATS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: CSV with a header row and no index column; lossless times."""
    from clasp.sources.tables import CSV_OPTIONS
    df.write.mode(mode).option("header", True).options(**TIME_FORMATS, **CSV_OPTIONS).csv(path)


def save_model(model, path: str) -> None:
    """K5: save a fitted pipeline, replacing what is there."""
    model.write().overwrite().save(path)


def truncate_table(df: DataFrame, spec: TableSpec) -> None:
    """K6: empty a table but keep its schema."""
    df.limit(0).write.mode("overwrite").format(spec.format).options(**spec.options).save(spec.path)


def require_rows(df: DataFrame, what: str = "result") -> DataFrame:
    """K7: fail when a result is empty (one cheap ``isEmpty`` probe, not a count)."""
    if df.isEmpty():
        raise EmptyResultError(f"{what} is empty")
    return df


def write_counted(df: DataFrame, spec: TableSpec, by: str | None = None,
                  mode: str = "overwrite") -> DataFrame:
    """K8: write a result and report run counters (rows in total, and per
    value of ``by``) from what was written. With ``by`` the table is
    partitioned on it, so the counts read only parquet footers and
    partition names: no second pass over the computed plan.

    ``DataFrame.observe`` with an ``Observation`` would give the same
    numbers during the write, but on Spark 4.1 it leaves the session in a
    state that cannot be serialised with a fitted forest's training
    summary, which breaks every later forest ``transform`` in the session.
    """
    write_table(df, spec, mode=mode, partition_by=[by] if by else None)
    written = df.sparkSession.read.format(spec.format).options(**spec.options).load(spec.path)
    if not by:
        return written.agg(F.count(F.lit(1)).alias("rows"))
    return written.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))


def kafka_writer_options(options: dict[str, str]) -> dict[str, str]:
    """Options of a Kafka writer from those of a reader: ``topic`` instead of
    ``subscribe``, and no offsets."""
    out = {k: v for k, v in options.items() if k not in ("subscribe", "startingOffsets")}
    if "topic" not in out and "subscribe" in options:
        out["topic"] = options["subscribe"]
    return out


def publish_json(df: DataFrame, spec: TableSpec, key_col: str | None = None, value: Column | None = None) -> None:
    """K3: one JSON message per row (``value``, by default all columns, nulls
    written as ``null``). ``kafka`` takes (key, value) and needs a topic; the
    tested form writes the messages as text lines."""
    from clasp.streaming.sources import json_message
    value = (json_message(df) if value is None else value).alias("value")
    if spec.format == "kafka":
        options = kafka_writer_options(spec.options)
        if "topic" not in options:
            raise ValueError("a Kafka sink needs a topic")
        cols = [value] if key_col is None else [F.col(key_col).cast("string").alias("key"), value]
        df.select(*cols).write.format("kafka").options(**options).save()
    else:
        df.select(value).write.mode("overwrite").text(spec.path)
