"""The read side of the two pipelines as one API: every listing, count
and chart series the reference served over HTTP or drew on its dashboard,
as DataFrame-returning methods over the stored tables (no server, no
pulling a whole collection into one process).

``TextResults`` wraps the scored-text table (``texto, etiqueta,
prediction, fecha_proceso, accuracy_test``) and optionally its metrics
table; ``RecordPredictions`` wraps the scored-record table (features,
``heart_disease_label``, ``prediction``, ``fecha_proceso``) and the
training metrics table (``accuracy, train_size, test_size, fecha``).
Column names are parameters with the reference's names as defaults.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clasp.operators import columns, filters, joins, stats, timeseries, topk
from clasp.plans.names import MISSING_PREDICTION, RISK_NAMES

# Class names shown by the reference's dashboard and APIs.
TEXT_CLASSES = ["positivo", "negativo", "neutral"]


@dataclass
class TextResults:
    df: DataFrame
    metrics: DataFrame | None = None
    text: str = "texto"
    label: str = "etiqueta"
    pred: str = "prediction"
    ts: str = "fecha_proceso"
    key: str | None = None

    def prepared(self) -> DataFrame:
        """Missing prediction -> ``desconocido``; missing or bad time ->
        null (the dashboard's defaults)."""
        out = columns.ensure_columns(self.df, {
            self.pred: MISSING_PREDICTION, self.ts: F.lit(None).cast("timestamp_ntz")})
        return columns.parse_timestamps(out, [self.ts]) if dict(out.dtypes)[self.ts] == "string" else out

    # -- service endpoints -------------------------------------------------
    def listing(self, label=None, n: int = 50) -> DataFrame:
        """Latest ``n`` results, optionally of one label; times as text."""
        df = self.prepared()
        rows = topk.listing(df, self.label, label, self.ts, self.key, n)
        return columns.stringify_ts(rows, [self.ts])

    def stats(self) -> DataFrame:
        """Total, distribution by label, accuracy (null equals null)."""
        return stats.label_stats(self.prepared(), self.label, self.label, self.pred)

    # -- dashboard ----------------------------------------------------------
    def kpis(self, classes: list | None = None) -> DataFrame:
        return stats.kpi_row(self.prepared(), self.pred, classes or TEXT_CLASSES)

    def distribution(self) -> DataFrame:
        return stats.share(self.prepared(), self.pred)

    def label_vs_prediction(self) -> DataFrame:
        return stats.confusion(self.prepared(), self.label, self.pred)

    def accuracy(self) -> DataFrame:
        """Stored test accuracy when a metrics row exists, else computed."""
        return stats.accuracy_or_metrics(self.prepared(), self.metrics, self.label, self.pred)

    def timeline(self, enriched: DataFrame | None = None, enriched_ts: str = "fecha",
                 enriched_order: str = "id", freq: str = "7D") -> DataFrame:
        """Weekly volume; with the enriched file, each text takes the time of
        its first occurrence there (keep-first, left join, prefer)."""
        df = self.prepared()
        if enriched is not None:
            df = joins.merge_coalesce(df, enriched, self.text, enriched_ts, self.ts,
                                      order=[enriched_order])
        return timeseries.resample_count(df, self.ts, freq, self.pred)

    def explore(self, prediction=None, pattern: str | None = None) -> tuple[DataFrame, DataFrame]:
        rows, counts = filters.explore(self.prepared(), self.pred, prediction, self.text, pattern)
        keep = columns.select_existing(rows, [self.text, self.label, self.pred, self.ts])
        return keep, counts


@dataclass
class RecordPredictions:
    df: DataFrame
    metrics: DataFrame | None = None
    label: str = "heart_disease_label"
    pred: str = "prediction"
    ts: str = "fecha_proceso"
    category: str = "ChestPainType"
    key: str | None = None

    # -- service endpoints -------------------------------------------------
    def latest(self, limit=50) -> DataFrame:
        return columns.stringify_ts(topk.latest(self.df, self.ts, self.key, limit), [self.ts])

    def by_risk(self, risk=None, limit: int = 100) -> DataFrame:
        rows = topk.latest_by_value(self.df, self.pred, risk, self.ts, self.key, limit)
        return columns.stringify_ts(rows, [self.ts])

    def stats(self) -> DataFrame:
        return stats.label_stats(self.df, self.pred, self.label, self.pred, key_as_string=True)

    def risk_summary(self) -> DataFrame:
        return stats.risk_summary(self.df, self.pred, self.metrics, "accuracy", "fecha")

    # -- dashboard ----------------------------------------------------------
    def named(self) -> DataFrame:
        return columns.map_values(self.df, self.pred, RISK_NAMES, out="prediction_label")

    def kpis(self) -> DataFrame:
        return stats.kpi_row(self.named(), "prediction_label", ["Riesgo", "Sano"])

    def distribution(self) -> DataFrame:
        return stats.share(self.named(), "prediction_label")

    def risk_by_category(self) -> DataFrame | None:
        """None when the category column is absent (the view is skipped)."""
        if not columns.has_columns(self.df, [self.category]):
            return None
        return stats.cross_count(self.named(), self.category, "prediction_label")

    def model_accuracy(self) -> DataFrame:
        """Latest training metrics row (none when there is none)."""
        if self.metrics is None:
            return self.df.sparkSession.createDataFrame([], "accuracy double")
        return topk.latest_one(self.metrics, "fecha").select("accuracy")

    def timeline(self, freq: str = "1min") -> DataFrame | None:
        if not columns.has_columns(self.df, [self.ts]):
            return None
        return timeseries.resample_count(self.df, self.ts, freq, self.pred)
