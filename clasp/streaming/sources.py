"""Stream sources and replay staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clasp.operators.partitioning import has_shuffle, num_partitions
from clasp.sources.specs import StreamSpec

# Times go out with all six fraction digits (Spark's JSON default keeps
# three) so a replayed record decodes to the same value.
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "ignoreNullFields": "false"}


def json_message(df: DataFrame) -> Column:
    """A row as one JSON object; null fields are written."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS)


def replay_width(df: DataFrame) -> tuple[int, int]:
    """Files of a replay and files per micro-batch: a micro-batch has a file
    for every core, and there are as many files as the scan has partitions,
    or four micro-batches of them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = cores if has_shuffle(df) else num_partitions(df)
    return max(4 * cores, parts), cores


def open_stream(spark: SparkSession, spec: StreamSpec) -> DataFrame:
    """S3: a stream with one ``value`` column (bytes from Kafka, text from
    files). ``max_per_trigger`` bounds each micro-batch (offsets or files)."""
    reader = spark.readStream.format(spec.format).options(**spec.options)
    if spec.max_per_trigger:
        key = "maxOffsetsPerTrigger" if spec.format == "kafka" else "maxFilesPerTrigger"
        reader = reader.option(key, spec.max_per_trigger)
    df = reader.load(spec.path) if spec.path else reader.load()
    return df.select("value")


def stage_replay(df: DataFrame, path: str, files: int | None, order: list[str],
                 value: Column | None = None) -> StreamSpec:
    """Stage a table as ``files`` JSON-line files that a file stream
    (``maxFilesPerTrigger``) replays at a bounded rate, the way the
    reference's producer fed its topic (Kafka: use ``publish_json``).

    One range-partitioned write (a single pass; file ``part-0000k`` holds
    the k-th slice of ``order``). The file source takes files
    oldest-modified first, so the files' modification times are then set
    in slice order (metadata only). Event time therefore never goes
    backwards between micro-batches and a watermark drops nothing. Stores
    that cannot set times (the times are read back) get the slices written
    one job after another. Without ``files`` there are :func:`replay_width`
    of them, and a micro-batch takes one per core."""
    value = (json_message(df) if value is None else value).alias("value")
    per_trigger = None
    if files is None:
        files, per_trigger = replay_width(df)
    (df.repartitionByRange(files, *[F.col(c) for c in order])
       .sortWithinPartitions(*order).select(value)
       .write.mode("overwrite").text(path))
    if not _order_file_times(df.sparkSession, path):
        _write_slices_in_order(df, path, files, order, value)
    return StreamSpec(format="text", path=path, max_per_trigger=per_trigger)


def _order_file_times(spark: SparkSession, path: str) -> bool:
    sc = spark.sparkContext
    jvm = sc._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    names = sorted(st.getPath().getName() for st in fs.listStatus(root)
                   if st.getPath().getName().startswith("part-"))
    base = int(jvm.java.lang.System.currentTimeMillis()) - 1000 * (len(names) + 1)
    try:
        for i, name in enumerate(names):
            fs.setTimes(jvm.org.apache.hadoop.fs.Path(root, name), base + 1000 * i, -1)
    except Exception:  # noqa: BLE001 - store without settable times
        return False
    # a store may ignore the call without a word
    times = [fs.getFileStatus(jvm.org.apache.hadoop.fs.Path(root, name)).getModificationTime() for name in names]
    return all(a < b for a, b in zip(times, times[1:]))


def _write_slices_in_order(df: DataFrame, path: str, files: int, order: list[str], value) -> None:
    key = order[0]
    num = F.col(key)
    if dict(df.dtypes)[key].startswith("timestamp"):
        num = F.unix_micros(F.col(key).cast("timestamp"))
    keyed = df.withColumn("_slice_key", num.cast("double"))
    bounds = keyed.approxQuantile("_slice_key", [i / files for i in range(1, files)], 0.001)
    edges = [None, *bounds, None]
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = F.lit(True) if lo is None else (F.col("_slice_key") > F.lit(lo))
        if hi is not None:
            cond = cond & (F.col("_slice_key") <= F.lit(hi))
        if i == 0:
            cond = cond | F.col("_slice_key").isNull()
        part = keyed.where(cond).repartition(1).sortWithinPartitions(*order).select(value)
        part.write.mode("overwrite" if i == 0 else "append").text(path)
