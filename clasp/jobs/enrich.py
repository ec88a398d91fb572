"""Dataset enrichment job: number the rows 1..n in file order and give
them sorted random timestamps in a date range; write CSV with a header."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clasp.operators.ordering import with_row_id, with_sorted_random_ts
from clasp.sources.sinks import write_csv

# The reference's enrichment window.
START = datetime(2025, 11, 1)
END = datetime(2026, 2, 1)


def file_order(df: DataFrame) -> DataFrame:
    """Columns that sort rows in file order: file, split start, and the
    position inside the split (monotonically increasing per partition)."""
    return df.select("*", F.col("_metadata.file_path").alias("_f"),
                     F.col("_metadata.file_block_start").alias("_b"),
                     F.monotonically_increasing_id().alias("_m"))


def run(df: DataFrame, start: datetime = START, end: datetime = END, seed: int = 42) -> DataFrame:
    cols = [c for c in df.columns]
    numbered = with_row_id(file_order(df), ["_f", "_b", "_m"], out="id")
    stamped = with_sorted_random_ts(numbered.select("id", *cols), "id", start, end, seed=seed, ranked=True)
    return stamped.select("id", *cols, "fecha")


def main() -> None:
    import os

    from clasp.jobs.config import flag
    from clasp.jobs.schemas import TEXT_SCHEMA
    from clasp.session import build_session
    from clasp.sources.tables import read_csv
    spark = build_session("enrich")
    try:
        src = read_csv(spark, os.environ.get("DATA_PATH", "data/labelled_text.csv"), TEXT_SCHEMA,
                       multiline=flag("MULTILINE"))
        write_csv(run(src), os.environ.get("OUT_PATH", "data/enriched_text"))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

