"""Job configuration: every setting has an environment variable and a
default (the reference read paths, brokers and topics the same way)."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from clasp.sources.specs import StreamSpec, TableSpec


def env(name: str, default: str) -> str:
    return os.environ.get(name, default)


def flag(name: str, default: str = "false") -> bool:
    return env(name, default).strip().lower() in ("1", "true", "yes")


# Fixed values of the job settings: the environment names and defaults that
# the reference's users have, and the forests' trees, depth and seed.
@dataclass
class TextJobConfig:
    data_path: str = field(default_factory=lambda: env("DATA_PATH", "data/labelled_text.csv"))
    data_format: str = field(default_factory=lambda: env("DATA_FORMAT", "csv"))
    # texts with line breaks inside quotes: such CSV files are read whole, one task each
    multiline: bool = field(default_factory=lambda: flag("MULTILINE"))
    model_path: str = field(default_factory=lambda: env("MODEL_PATH", "models/text_model"))
    results: TableSpec = field(default_factory=lambda: TableSpec.from_env("RESULTS", "out/text_results"))
    metrics: TableSpec = field(default_factory=lambda: TableSpec.from_env("METRICS", "out/text_metrics"))
    train_pct: int = 70
    num_trees: int = 100
    max_depth: int = 10
    seed: int = 42


@dataclass
class TabularJobConfig:
    data_path: str = field(default_factory=lambda: env("DATA_PATH", "data/records.csv"))
    data_format: str = field(default_factory=lambda: env("DATA_FORMAT", "csv"))
    model_path: str = field(default_factory=lambda: env("MODEL_PATH", "models/tabular_model"))
    metrics: TableSpec = field(default_factory=lambda: TableSpec.from_env("METRICS", "out/tabular_metrics"))
    # The record's columns.
    categorical: tuple = ("Sex", "ChestPainType", "RestingECG", "ExerciseAngina", "ST_Slope")
    numeric: tuple = ("Age", "RestingBP", "Cholesterol", "FastingBS", "MaxHR", "Oldpeak")
    label: str = "HeartDisease"
    key: str | None = None
    train_pct: int = 80
    num_trees: int = 100
    max_depth: int = 10
    seed: int = 42


@dataclass
class StreamJobConfig:
    model_path: str = field(default_factory=lambda: env("MODEL_PATH", "models/tabular_model"))
    source: StreamSpec = field(default_factory=lambda: (
        StreamSpec.kafka() if env("STREAM_FORMAT", "kafka") == "kafka"
        else StreamSpec(format="text", path=env("STREAM_PATH", "in/records"))))
    sink_path: str = field(default_factory=lambda: env("SINK_PATH", "out/predictions"))
    quarantine_path: str = field(default_factory=lambda: env("QUARANTINE_PATH", "out/quarantine"))
    checkpoint: str = field(default_factory=lambda: env("CHECKPOINT_PATH", "checkpoints/stream_score"))
    trigger: str = field(default_factory=lambda: env("TRIGGER", "10 seconds"))
    label: str = "HeartDisease"
    label_alias: str = "heart_disease_label"
    label_type: str = "int"
