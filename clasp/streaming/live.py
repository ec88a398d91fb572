"""Live KPI and risk totals over a stream (X4 with A9 and A11).

Records carry an id, a class and a version. The totals count each id once,
with the class of its newest version: a re-sent record changes nothing, and
one that comes again with another class moves from the old class to the new.

Ids are dealt by hash to buckets; a bucket's state is one packed array of
(id, version, class, event time), so a micro-batch reads and writes one value
per bucket it touches, whatever the number of records. What comes out is what
changed: ``(class, change)``, added up per micro-batch and written once
(``streaming.sinks``). Totals are the sums of these few rows, the same for
any cut into micro-batches and after a restart, which goes on from the
checkpointed state.

State is bounded by event time: a timer of each bucket forgets ids older than
``retention`` behind the watermark. Records that late are dropped, as in any
watermarked aggregate.

The state needs the RocksDB store: where the session's is another, start the
query with ``conf=session.STATE_STORE_CONF``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clasp.operators.stats import safe_ratio_pct
from clasp.streaming.ops import event_time

# Python workers get this module with the processor, not from their own disk.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 64
#: class -1 stands for a null class
KNOWN = np.dtype([("id", "<i8"), ("version", "<i8"), ("cls", "<i4"), ("ts", "<i8")])


def merged(known: np.ndarray, new: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """The newest version of each id (of equal versions the greater class),
    and the change of each class's count (the last for null)."""
    both = np.concatenate([known, new])
    order = np.lexsort((both["cls"], both["version"], both["id"]))
    both = both[order]
    last = np.append(both["id"][1:] != both["id"][:-1], True) if len(both) else np.zeros(0, dtype=bool)
    kept = both[last]
    change = np.bincount(kept["cls"] % (classes + 1), minlength=classes + 1) - np.bincount(known["cls"] % (classes + 1), minlength=classes + 1)
    return kept, change


class ClassTotals(StatefulProcessor):
    """One bucket of ids; emits the changes of the class counts."""

    def __init__(self, classes: int, retention_ms: int):
        self.classes, self.retention_ms = classes, retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "rows binary")

    def _read(self) -> np.ndarray:
        return np.frombuffer(self.known.get()[0], dtype=KNOWN) if self.known.exists() else np.zeros(0, dtype=KNOWN)

    def _write(self, rows: np.ndarray) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        if not len(rows):
            self.known.clear()
            return
        self.known.update((rows.tobytes(),))
        self.handle.registerTimer(int(rows["ts"].min()) + self.retention_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self._read()
        parts = []
        for part in rows:
            new = np.zeros(len(part), dtype=KNOWN)
            for c in KNOWN.names:
                new[c] = part[c].to_numpy()
            parts.append(new)
        kept, change = merged(known, np.concatenate(parts) if parts else known[:0], self.classes)
        self._write(kept)
        at = np.flatnonzero(change)
        yield pd.DataFrame({"cls": np.where(at == self.classes, -1, at).astype(np.int32), "change": change[at].astype(np.int64)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self._read()
        self._write(known[known["ts"] + self.retention_ms > timerValues.getCurrentWatermarkInMs()])
        yield pd.DataFrame({"cls": np.zeros(0, dtype=np.int32), "change": np.zeros(0, dtype=np.int64)})

    def close(self) -> None:
        pass


def class_changes(stream: DataFrame, id_col: str, cls: str, version: str, ts: str, classes: list, retention: str = "7 days",
                  buckets: int = BUCKETS) -> DataFrame:
    """``cls`` (position in ``classes``, -1 for null or any other) and
    ``change``, for ``update`` mode. An id is a bigint, or stands for itself
    by its 64-bit hash; rows without an id or a time are left out."""
    kind = dict(stream.dtypes)[id_col]
    key = F.col(id_col).cast("bigint") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(id_col)
    place: Column = F.coalesce(F.array_position(F.array(*map(F.lit, classes)), F.col(cls)), F.lit(0)).cast("int") - 1
    rows = event_time(stream.where(F.col(id_col).isNotNull() & F.col(ts).isNotNull()), ts).withWatermark(ts, retention).select(
        F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"), key.alias("id"),
        F.coalesce(F.col(version).cast("bigint"), F.lit(0)).alias("version"), place.alias("cls"),
        F.unix_millis(F.col(ts)).alias("ts"), F.col(ts).alias("_event_time"))
    seconds = stream.sparkSession.sql(f"SELECT CAST(unix_seconds(timestamp '1970-01-01' + interval {retention}) AS BIGINT)").first()[0]
    return rows.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=ClassTotals(len(classes), int(seconds) * 1000), outputStructType="cls int, change bigint",
        outputMode="Update", timeMode="EventTime")


def added_up(changes: DataFrame) -> DataFrame:
    """A micro-batch's changes, or all of a sink's: one row per class."""
    return changes.groupBy("cls").agg(F.sum("change").alias("change"))


def live_kpis(written: DataFrame, classes: list, digits: int = 1) -> DataFrame:
    """A9 from the written changes: ``total``, and count and share of each class."""
    counts = [F.coalesce(F.sum(F.when(F.col("cls") == i, F.col("change"))), F.lit(0)).alias(f"n_{str(c).lower()}") for i, c in enumerate(classes)]
    row = written.agg(F.coalesce(F.sum("change"), F.lit(0)).alias("total"), *counts)
    return row.select("*", *[safe_ratio_pct(f"n_{str(c).lower()}", "total", digits).alias(f"pct_{str(c).lower()}") for c in classes])


def live_risk(written: DataFrame, high: int = 0, low: int = 1) -> DataFrame:
    """A11 from the written changes: ``total, high, low, high_pct``; ``high``
    and ``low`` are positions in ``classes``."""
    count = lambda i: F.coalesce(F.sum(F.when(F.col("cls") == i, F.col("change"))), F.lit(0))
    row = written.agg(F.coalesce(F.sum("change"), F.lit(0)).alias("total"), count(high).alias("high"), count(low).alias("low"))
    return row.select("*", safe_ratio_pct("high", "total", 2).alias("high_pct"))
