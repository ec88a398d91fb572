"""Where a table or a stream lives: format + options + path.

The reference kept its results in a document store and read its stream from
a message broker. Here both are configuration: ``format="mongodb"`` or
``format="kafka"`` work when the connector jar is on the classpath; the
tested forms are parquet tables and text-file streams.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    path: str | None = None
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    drop: tuple[str, ...] = ("_id",)

    @classmethod
    def from_env(cls, prefix: str, default_path: str, default_format: str = "parquet") -> "TableSpec":
        return cls(path=os.environ.get(f"{prefix}_PATH", default_path),
                   format=os.environ.get(f"{prefix}_FORMAT", default_format))


@dataclass(frozen=True)
class StreamSpec:
    """A stream source. ``kafka`` reads ``value`` bytes; ``text`` reads a
    folder of JSON lines and exposes the same ``value`` column."""

    format: str = "text"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    max_per_trigger: int | None = None

    @classmethod
    def kafka(cls, brokers: str | None = None, topic: str | None = None,
              starting: str = "earliest", max_per_trigger: int | None = None) -> "StreamSpec":
        brokers = brokers or os.environ.get("KAFKA_BOOTSTRAP_SERVERS", "kafka:9092")
        topic = topic or os.environ.get("KAFKA_TOPIC", "records")
        return cls(format="kafka", options={
            "kafka.bootstrap.servers": brokers, "subscribe": topic,
            "startingOffsets": starting}, max_per_trigger=max_per_trigger)
