"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clasp.session import scratch_path

#: ASCII white space separates words; ``bytes.split()`` uses the same six characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder (``options`` are the
    writer's) and read it back.

    Lineage ends at the written table, so later jobs neither repeat the
    work before it nor depend on shuffle files of executors that may be
    lost. The shuffle files of this one job are freed when it ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*written: DataFrame) -> None:
    """Remove tables made by :func:`cut` that no later plan reads."""
    for df in written:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    return (F.col(name) if name in df.columns else F.lit(None)).cast(kind)


def free_prefix(df: DataFrame, start: str) -> str:
    """``start``, with underscores before it until no column begins so."""
    while any(c.lower().startswith(start.lower()) for c in df.columns):
        start = f"_{start}"
    return start


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """128-bit name of a row's (id, text); equal rows share it."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"),
                          F.md5(F.coalesce(F.col(text_col), F.lit("")))))


def arrow_map(df: DataFrame, func: Callable[[pa.RecordBatch], pa.RecordBatch | None],
              schema: str, step: int = 1000) -> DataFrame:
    """``mapInArrow`` over slices of at most ``step`` rows, so a worker
    holds few long texts at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                out = func(batch.slice(lo, step))
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null becomes empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]
