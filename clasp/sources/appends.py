"""Tables that grow by appends, ids that survive them (P12), and summaries
kept up to date (A2, A3, A12, A13, M4, M5).

An append writes its rows to a folder of its own and then commits: a small
file, created only if no other has its number, names the folder and the range
of ids. Readers see committed folders alone, so a failed or repeated attempt
leaves nothing behind that counts. An append has a name; repeated under that
name it changes nothing. Two writers at a time: the one that finds its number
taken numbers its rows anew after the other's.

A summary (:class:`Running`) holds one small table of partial sums per
append, made from that append's rows only. Sums of counts don't care in which
append a row came, so late rows need no rewriting: whatever days or keys an
append touches, the sums over all partial tables are those of all rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clasp.operators.ordering import with_row_id


@dataclass(frozen=True)
class Commit:
    number: int
    name: str
    path: str
    first: int  # the append's ids are first .. last; last < first if it had no rows
    last: int


class AppendTable:
    """A table under ``root``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str, id_col: str = "id"):
        self.spark, self.root, self.id_col = spark, root.rstrip("/"), id_col
        self._path = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def commits(self) -> list[Commit]:
        """In order; one small file each."""
        found = self._fs.globStatus(self._path(f"{self.root}/_commits/*.json")) or []
        out = []
        for status in found:
            with_stream = self._fs.open(status.getPath())
            try:
                text = bytes(with_stream.readAllBytes()).decode()
            finally:
                with_stream.close()
            if text.endswith("}"):  # else its writer has not ended yet
                out.append(Commit(**json.loads(text)))
        return sorted(out, key=lambda c: c.number)

    def _commit(self, commit: Commit) -> bool:
        """False if another append has the number."""
        path = self._path(f"{self.root}/_commits/{commit.number:012d}.json")
        try:
            stream = self._fs.create(path, False)
        except Exception as error:  # noqa: BLE001 - the store's own kind of refusal
            if self._fs.exists(path):
                return False
            raise error
        try:
            stream.write(bytearray(json.dumps(commit.__dict__).encode()))
        finally:
            stream.close()
        return True

    def append(self, df: DataFrame, name: str, order: list[str]) -> Commit:
        """Rows in ``order`` get the ids after the last committed one, without
        gaps. The ids of earlier rows never change."""
        while True:
            done = self.commits()
            for c in done:
                if c.name == name:
                    return c
            number, first = (done[-1].number + 1, done[-1].last + 1) if done else (0, 1)
            path = f"{self.root}/data/{number:012d}-{uuid.uuid4().hex}"
            with_row_id(df, order, out=self.id_col, start=first).write.parquet(path)
            rows = self.spark.read.parquet(path).count()
            commit = Commit(number, name, path, first, first + rows - 1)
            if self._commit(commit):
                return commit

    def read(self, commits: list[Commit] | None = None) -> DataFrame:
        """Rows of the given appends, by default of all."""
        paths = [c.path for c in (self.commits() if commits is None else commits)]
        if not paths:
            raise FileNotFoundError(f"nothing was appended to {self.root}")
        return self.spark.read.parquet(*paths)


class Running:
    """Sums over an append table, one partial table per append.

    ``summarise`` turns rows into ``keys`` and ``sums``; its result for
    several appends must be what adding up their own results gives (counts,
    sums, but no distinct counts)."""

    def __init__(self, table: AppendTable, root: str, summarise: Callable[[DataFrame], DataFrame], keys: list[str], sums: list[str]):
        self.table, self.root, self.summarise, self.keys, self.sums = table, root.rstrip("/"), summarise, keys, sums

    def _place(self, c: Commit) -> str:
        return f"{self.root}/part-{c.number:012d}"

    def _made(self, c: Commit) -> bool:
        return self.table._fs.exists(self.table._path(self._place(c) + "/_SUCCESS"))

    def update(self) -> list[int]:
        """Summarise the appends that have no partial table yet; their
        numbers. Only their rows are read."""
        new = [c for c in self.table.commits() if not self._made(c)]
        for c in new:
            part = self.summarise(self.table.read([c])).groupBy(*self.keys).agg(*[F.sum(s).alias(s) for s in self.sums])
            part.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(self._place(c))
        return [c.number for c in new]

    def result(self, upto: int | None = None) -> DataFrame:
        """The sums over all summarised appends (up to a number)."""
        parts = [self._place(c) for c in self.table.commits() if self._made(c) and (upto is None or c.number <= upto)]
        if not parts:
            raise FileNotFoundError(f"nothing was summarised under {self.root}")
        return self.table.spark.read.parquet(*parts).groupBy(*self.keys).agg(*[F.sum(s).alias(s) for s in self.sums])
