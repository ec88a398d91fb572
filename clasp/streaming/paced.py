"""Replay of a table at a steady pace.

The table is staged once as numbered rows, in order. A streaming source of
its own then lets row numbers out at ``rate`` a second: its newest offset is
where it began plus the seconds passed times the rate, never beyond the
table's end, so a slow sink can't make it hurry the rows but only hand out
larger batches. Each micro-batch reads the rows of its numbers from the
staged table, whose files and row groups are in that order.

The source notes the end of every batch it plans under ``progress`` (a folder
that the next run can read, beside the checkpoint). A run that starts again
goes on from there: Spark first repeats a batch it had begun, then takes new
rows, so nothing is skipped or sent twice.
"""

from __future__ import annotations

import logging
import re
import sys
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from clasp.operators.ordering import with_row_id
from clasp.session import materialise
from clasp.streaming.sources import json_message

# The source runs in Python processes that get this module with it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

log = logging.getLogger(__name__)
SLICE = 1_000_000


class Numbers(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


class PacedReader(DataSourceStreamReader):
    """Row numbers 0 .. ``total`` - 1, ``rate`` a second."""

    def __init__(self, total: int, rate: float, progress: str, slice_rows: int = SLICE):
        self.total, self.rate, self.slice_rows = total, rate, slice_rows
        self.progress = progress.rstrip("/") + "/sent"
        self.began, self.base = None, 0

    def _store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.progress) if "://" in self.progress or self.progress.startswith("file:") else (
            fs.LocalFileSystem(), self.progress)

    def _noted(self) -> int:
        store, path = self._store()
        if store.get_file_info(path).type == fs.FileType.NotFound:
            return 0
        with store.open_input_stream(path) as f:
            return int(f.read().decode() or 0)

    def _note(self, sent: int) -> None:
        store, path = self._store()
        store.create_dir(path.rpartition("/")[0], recursive=True)
        with store.open_output_stream(path + ".new") as f:
            f.write(str(sent).encode())
        store.move(path + ".new", path)

    def initialOffset(self) -> dict:
        return {"sent": 0}

    def latestOffset(self) -> dict:
        if self.began is None:  # after a restart all begun batches have been planned, and so noted, before this
            self.began, self.base = time.time(), self._noted()
        return {"sent": min(self.total, self.base + int((time.time() - self.began) * self.rate))}

    def partitions(self, start: dict, end: dict) -> list[Numbers]:
        lo, hi = start["sent"], end["sent"]
        if hi > self._noted():
            self._note(hi)
        return [Numbers(a, min(hi, a + self.slice_rows)) for a in range(lo, hi, self.slice_rows)] or [Numbers(lo, lo)]

    def read(self, partition: Numbers) -> Iterator[pa.RecordBatch]:
        for lo in range(partition.start, partition.end, 65_536):
            hi = min(partition.end, lo + 65_536)
            yield pa.record_batch([pa.array(range(lo, hi), pa.int64())], ["n"])

    def commit(self, end: dict) -> None:
        pass


class PacedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paced_rows"

    def schema(self) -> str:
        return "n bigint"

    def streamReader(self, schema) -> PacedReader:
        o = self.options
        return PacedReader(int(o["total"]), float(o["rate"]), o["progress"], int(o.get("slicerows", SLICE)))


class PacedReplay:
    """A staged table and the stream of its row numbers."""

    def __init__(self, spark: SparkSession, staged: DataFrame, total: int):
        self.spark, self.staged, self.total = spark, staged, total

    def stream(self, rate: float, progress: str) -> DataFrame:
        """Row numbers, ``rate`` a second; write it with :meth:`writer`."""
        self.spark.dataSource.register(PacedSource)
        return (self.spark.readStream.format("paced_rows").option("total", self.total).option("rate", rate)
                .option("progress", progress).load())

    def rows(self, numbers: DataFrame) -> DataFrame:
        """The staged rows of a micro-batch's numbers; the numbers are a
        range, and so are the files and row groups read for them."""
        lo, hi = numbers.agg(F.min("n"), F.max("n")).first()
        return self.staged.where(F.col("n").between(lo if lo is not None else 0, hi if hi is not None else -1))

    def writer(self, write: Callable[[DataFrame, int], None], every: int = 50) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function that hands each batch's rows (``n``,
        ``value``) to ``write`` and logs a line for each ``every`` rows sent."""
        def run(numbers: DataFrame, batch_id: int) -> None:
            batch = self.rows(numbers)
            write(batch, batch_id)
            lo, hi = numbers.agg(F.min("n"), F.max("n")).first()
            if hi is not None:
                for sent in range(lo // every * every + every, hi + 2, every):
                    log.info("%s of %s rows sent", sent, self.total)
        return run


def stage_paced(df: DataFrame, order: list[str], value: Column | None = None) -> PacedReplay:
    """Number the rows by ``order`` and write them once, as ``n, value``
    (the row's JSON message)."""
    named = df.withColumn("value", json_message(df) if value is None else value)
    numbered = with_row_id(named, order, out="n").select((F.col("n") - 1).alias("n"), "value")
    staged = materialise(numbered.repartitionByRange("n").sortWithinPartitions("n"), "paced")
    return PacedReplay(df.sparkSession, staged, staged.count())


def run_paced(query, replay: PacedReplay, until: int | None = None, timeout: float = 3600.0) -> float:
    """Wait until ``until`` rows (default: all) have been written, then stop;
    the seconds it took. An error of the stream is raised here."""
    until, began = replay.total if until is None else until, time.time()
    try:
        while time.time() - began < timeout:
            if query.exception():
                raise query.exception()
            # a run that finds nothing left reports so without rows
            if until <= 0 or any(_sent(p["sources"][0]["endOffset"]) >= until for p in query.recentProgress):
                return time.time() - began
            time.sleep(0.05)
        raise TimeoutError(f"{until} rows were not sent in {timeout} s")
    finally:
        query.stop()


def _sent(offset) -> int:
    """From an offset as progress reports it."""
    found = re.search(r"sent\D+(\d+)", str(offset))
    return int(found[1]) if found else -1
