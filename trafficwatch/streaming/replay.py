"""Replay fixture data through the streaming jobs (file sources, availableNow).

Used by the registered ``stream_*`` queries and the tests: the input is
derived from the driver tables by Spark, written as time-ordered files into
the shared checkpoint folder, then consumed by the real streaming queries in
several micro-batches.  The returned frames are batch reads of what the sinks
wrote.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficwatch.config import AlertConfig, DetectionConfig, StreamConfig
from trafficwatch.operators.store import read_alerts
from trafficwatch.session import scratch_path
from trafficwatch.sources.record_log import log_sink, log_source
from trafficwatch.streaming.alerting import AlertFolder, run_alerting
from trafficwatch.streaming.detection import apply_stream_confs, run_detection

ALERT_IDENTITY = ("window_start", "window_size", "attack_type", "src_ip", "signal_reason")
FILES_PER_CHUNK = 4
#: Alert records that a micro-batch of a replay holds at most, about; and the files they are read from, each a task.
RECORDS_PER_CHUNK = 1_000_000
ALERT_FILES_PER_CHUNK = 16

# Progress totals of the last replay: input rows and trigger time per query.
LAST_RUN: dict[str, dict[str, float]] = {}


def _record(name: str, query) -> None:
    progress = query.recentProgress or []
    rows = sum(p.get("numInputRows", 0) for p in progress)
    ms = sum(p.get("durationMs", {}).get("triggerExecution", 0) for p in progress)
    LAST_RUN[name] = {
        "batches": len(progress),
        "input_rows": rows,
        "trigger_sec": round(ms / 1000.0, 3),
        "rows_per_sec": round(rows / (ms / 1000.0), 1) if ms else 0.0,
    }


def write_in_time_order(df: DataFrame, time_col: str, path: str, files: int) -> None:
    """One pass: ``files`` parquet files of consecutive time ranges.

    The file source takes files by modification time, so the driver stamps
    the files (a metadata call each) in the order of their ranges.
    """
    df.repartitionByRange(files, time_col).write.parquet(path)
    spark = df.sparkSession
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("part-"))
    for k, name in enumerate(names):
        fs.setTimes(root.suffix(f"/{name}"), 1_700_000_000_000 + 1000 * k, -1)


@contextmanager
def stream_partitions(spark: SparkSession, most: int = 400):
    """State partitions of a replay: one a core, so that a batch is one wave of tasks; a live job sets its own."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(min(most, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def latest_emission(stored: DataFrame, identity=ALERT_IDENTITY) -> DataFrame:
    """Last emitted row per alert identity (greatest batch_id), as a grouped max."""
    rest = [c for c in stored.columns if c not in identity and c != "batch_id"]
    packed = F.struct(F.col("batch_id"), *[F.col(f"`{c}`") for c in rest])
    agg = stored.groupBy(*identity).agg(F.max(packed).alias("_r"))
    return agg.select(*identity, *[F.col(f"_r.`{c}`").alias(c) for c in ["batch_id"] + rest])


def replay_detection(
    spark: SparkSession,
    requests: DataFrame,
    config: DetectionConfig = DetectionConfig(fast_rules=True, heavy_url_rule=True, exact_distinct=True),
    chunks: int = 5,
) -> DataFrame:
    """Raw request rows -> wire files -> streaming detection -> latest alert per identity."""
    base = scratch_path(spark, "replay")
    fields = [F.col(c) for c in requests.columns]
    wire_rows = requests.select(F.col("timestamp").alias("_t"), F.to_json(F.struct(*fields)).alias("value"))
    write_in_time_order(wire_rows, "_t", f"{base}/in", chunks * FILES_PER_CHUNK)
    apply_stream_confs(spark, StreamConfig())
    wire = spark.readStream.option("maxFilesPerTrigger", str(FILES_PER_CHUNK)).schema("_t long, value string").parquet(f"{base}/in").select("value")
    q = run_detection(wire, f"{base}/cp", config, store_path=f"{base}/store", stats=False, available_now=True)
    q.awaitTermination()
    _record("detection", q)
    return latest_emission(read_alerts(spark, f"{base}/store").drop("alert_key", "@timestamp", "alert_date"))


def replay_alerting(spark: SparkSession, messages: DataFrame, config: AlertConfig = AlertConfig(), chunks: int = 3, digests: bool = True) -> AlertFolder:
    """Alert records (key, value, arrival) -> files -> the streaming alert job, on the records' own clock; returns its folder.

    ``chunks`` micro-batches, or more where they would hold over
    ``RECORDS_PER_CHUNK`` records.  What is still open at the end is flushed,
    as when a job is shut down.
    """
    base = scratch_path(spark, "replay")
    chunks = max(chunks, -(-messages.count() // RECORDS_PER_CHUNK))
    write_in_time_order(messages.select("key", "value", "arrival"), "arrival", f"{base}/in", chunks * ALERT_FILES_PER_CHUNK)
    wire = spark.readStream.option("maxFilesPerTrigger", str(ALERT_FILES_PER_CHUNK)).schema("key string, value string, arrival timestamp").parquet(f"{base}/in")
    with stream_partitions(spark):
        job = run_alerting(wire, f"{base}/cp", f"{base}/out", config, available_now=True, digests=digests, clock="arrival")
    _record("alerting", job.claims)
    if digests:
        job.drain()
    return job.folder


def replay_log(spark: SparkSession, messages: DataFrame, chunks: int = 3, max_records: int = 100_000) -> DataFrame:
    """Records (key, value, arrival) -> files -> stream into a record log -> bounded stream out of it; what that one wrote."""
    base = scratch_path(spark, "replay")
    write_in_time_order(messages.select("key", "value", "arrival"), "arrival", f"{base}/in", chunks)
    wire = spark.readStream.option("maxFilesPerTrigger", "1").schema("key string, value string, arrival timestamp").parquet(f"{base}/in")
    into = log_sink(wire, f"{base}/log", f"{base}/cp-in").trigger(availableNow=True).start()
    into.awaitTermination()
    _record("log sink", into)
    out = log_source(spark, f"{base}/log", f"{base}/cp-out", max_records).writeStream.option("checkpointLocation", f"{base}/cp-out")
    out = out.format("parquet").option("path", f"{base}/out").trigger(processingTime="0 seconds").start()
    try:
        out.processAllAvailable()
    finally:
        out.stop()
    _record("log source", out)
    return spark.read.schema("key string, value string").parquet(f"{base}/out")
