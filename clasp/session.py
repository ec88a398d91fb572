"""Session construction and shared-storage helpers.

Nothing here hard-codes a master: the deploy decides where jobs run. Tests
and the bench build a ``local[N]`` session through :func:`build_session`.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Streaming state (replay de-dup keys, open windows, live totals) kept in
# RocksDB on local disk with changelog checkpoints, not on the executor heap.
# ``transformWithState`` runs on no other store: its queries are started with
# these settings (``streaming.sinks.write_stream``), whatever the session's are.
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Settings every job wants regardless of scale. Shuffle partition count is
# left to the caller / cluster defaults; AQE coalesces small shuffles and
# splits skewed join partitions at run time.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    **STATE_STORE_CONF,
}


def build_session(app: str = "clasp", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (it is the only place lineage cuts and
    staging tables may go). Only a local-mode session without the setting
    gets a private temporary folder, so tests can run.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="clasp-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return "/".join([checkpoint_root(spark), "clasp", *parts, uuid.uuid4().hex])


def materialise(df, label: str):
    """Write ``df`` under the shared folder and read it back: a cut in the
    lineage whose size Spark knows, and which outlives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    checkpoint_root(spark)
