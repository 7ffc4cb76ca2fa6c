"""Structured Streaming alert handling: decode -> gate -> TTL dedupe -> digests -> sinks.

Two queries, each with its state in Spark's state store:

* claims: every record with its outcome (invalid, skipped_severity, duplicate,
  accepted) to ``messages``, partitioned by outcome.  Per dedupe key the last
  claim is kept, with a TTL.  Outcome counts are observed metrics of the plan.
* digests: reads the accepted part of ``messages`` (the file sink's log, so
  only committed files), sums it by source in each task, and groups it into
  first-arrival digests that close by a later arrival or by a processing-time
  timer, also when nothing arrives any more.

A record that arrives late counts at the time its key has reached: as a
duplicate inside a claim's TTL, and in the digest that is open.  Nothing is
dropped.  A key's records of one micro-batch, and a digest's distinct sources
of one micro-batch, are held by one task: the trigger's record cap bounds them.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from trafficwatch.config import AlertConfig, StreamConfig
from trafficwatch.functions.alerts import message_key, min_rank, severity_rank_of
from trafficwatch.operators.alerting import decode_alert_messages
from trafficwatch.operators.digest import DIGEST_KEY, digest_key, digest_rows, single_digests
from trafficwatch.session import ship_package
from trafficwatch.streaming.processors import CLAIMED, PASSED, Claims, Digests

log = logging.getLogger(__name__)

OUTCOMES = ("invalid", "skipped_severity", "duplicate", "accepted")
#: Groups that rows without a claim are spread over.
_PASSED_GROUPS = 64
_IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
_DIGEST_SCHEMA = ", ".join(f"{c} string" for c in DIGEST_KEY) + (
    ", opened_at timestamp, window_end_min timestamp, window_end_max timestamp, ips array<string>, ip_count long, request_count_sum double, rps_sum double, alerts long"
)
_SENT = "k string, opened_us long, we_min long, we_max long, ips array<string>, ip_count long, rc string, rp string, n long"
_PARTIAL = "k string, ip string, us long, n long, rc decimal(38,12), rp decimal(38,12), we_min long, we_max long"


@dataclass(frozen=True)
class AlertFolder:
    """Where the job keeps its sinks."""

    path: str

    @property
    def messages(self) -> str:
        return f"{self.path}/messages"

    @property
    def digests(self) -> str:
        return f"{self.path}/digests"

    @property
    def flushed(self) -> str:
        return f"{self.path}/flushed"


def _filesystem(spark: SparkSession, path: str):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def _message_schema(spark: SparkSession, wire_schema: str) -> str:
    rows = decode_alert_messages(spark.createDataFrame([], wire_schema))
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", dedupe_key string"


_WIRE = "key string, value string, arrival timestamp"


def _keyed(records: DataFrame) -> DataFrame:
    """Records -> decoded fields and dedupe_key."""
    return decode_alert_messages(records).withColumn("dedupe_key", F.when(F.col("valid"), message_key(F.col("key"))))


def judged_messages(wire: DataFrame, config: AlertConfig) -> DataFrame:
    """Streaming records (key, value, arrival) -> decoded fields, dedupe_key, disposition."""
    spark = wire.sparkSession
    ship_package(spark)
    rows = _keyed(wire.select("key", "value", "arrival"))
    gated = F.col("valid") & (severity_rank_of(F.col("severity")) >= F.lit(min_rank(config.min_severity)))
    outcome = F.when(~F.col("valid"), "invalid").when(~F.coalesce(gated, F.lit(False)), "skipped_severity")
    spread = F.concat(F.lit(PASSED), F.pmod(F.xxhash64("value", "arrival"), F.lit(_PASSED_GROUPS)).cast("string"))
    # records go through the Python workers as sent, and are decoded again behind them
    sent = rows.select(
        F.when(outcome.isNull(), F.concat(F.lit(CLAIMED), F.col("dedupe_key"))).otherwise(spread).alias("_group"),
        "key", "value", F.unix_micros("arrival").alias("arrival_us"), F.coalesce("signal_reason", F.lit("")).alias("_tie"), outcome.alias("_outcome"),
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in sent.schema.fields[1:-2]]
    judged = sent.groupBy("_group").transformWithState(
        Claims(config.dedupe_ttl_seconds, config.dedupe_ttl_seconds + config.keep_late_seconds), ", ".join([*fields, "disposition string"]), "append", "processingTime"
    )
    decoded = _keyed(judged.select("key", "value", F.timestamp_micros("arrival_us").alias("arrival"), "disposition"))
    return decoded.select(*rows.columns, "disposition")


def _partial_sums(batches):
    """Rows (k, ip, us, rc, rp, we) summed by digest key, source and arrival inside a task, ahead of the shuffle."""
    for batch in batches:
        table = pa.Table.from_batches([batch]).append_column("n", pa.array([1] * batch.num_rows, pa.int64()))
        sums = table.group_by(["k", "ip", "us"]).aggregate([("n", "sum"), ("rc", "sum"), ("rp", "sum"), ("we", "min"), ("we", "max")])
        kind = pa.decimal128(38, 12)
        columns = [sums["k"], sums["ip"], sums["us"], sums["n_sum"], sums["rc_sum"].cast(kind), sums["rp_sum"].cast(kind), sums["we_min"], sums["we_max"]]
        yield from pa.table(columns, names=["k", "ip", "us", "n", "rc", "rp", "we_min", "we_max"]).to_batches()


def digest_stream(accepted: DataFrame, config: AlertConfig, timers: bool, flushed: int = -1) -> DataFrame:
    """Streaming accepted alerts -> digests, each when it closes."""
    rows = digest_rows(accepted, F.col("arrival"))
    if config.batch_window_seconds <= 0:
        return single_digests(rows)
    decimal = "decimal(38,12)"
    rows = rows.select(digest_key().alias("k"), "ip", F.unix_micros("arrival").alias("us"), F.col("rc").cast(decimal).alias("rc"), F.col("rp").cast(decimal).alias("rp"), F.unix_micros("window_end_ts").alias("we"))
    parts = rows.mapInArrow(_partial_sums, _PARTIAL)
    sent = parts.groupBy("k").transformWithState(Digests(config.batch_window_seconds, config.batch_max_ips, timers, flushed), _SENT, "append", "processingTime")
    return _as_digests(sent)


def _as_digests(sent: DataFrame) -> DataFrame:
    fields = F.split("k", "\u0001")
    number = "decimal(38,12)"
    return sent.select(
        *[fields[i].alias(c) for i, c in enumerate(DIGEST_KEY)],
        F.timestamp_micros("opened_us").alias("opened_at"),
        F.timestamp_micros("we_min").alias("window_end_min"),
        F.timestamp_micros("we_max").alias("window_end_max"),
        "ips",
        "ip_count",
        F.col("rc").cast(number).cast("double").alias("request_count_sum"),
        F.col("rp").cast(number).cast("double").alias("rps_sum"),
        F.col("n").alias("alerts"),
    )


class OutcomeLog(StreamingQueryListener):
    """Sums the observed outcome counts of the claims query; logs them every ``interval_seconds`` (0 or less: each batch)."""

    def __init__(self, interval_seconds: float):
        import time

        self.interval, self.clock, self.since, self.sums = interval_seconds, time.monotonic, time.monotonic(), {}

    def add(self, counts: dict[str, int]) -> None:
        for name, n in counts.items():
            self.sums[name] = self.sums.get(name, 0) + n
        if self.sums and self.clock() - self.since >= self.interval:
            log.info("alert outcomes: consumed %d, %s", sum(self.sums.values()), self.sums)
            self.since, self.sums = self.clock(), {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get("outcomes")
        if seen is not None:
            self.add({name: n for name, n in seen.asDict().items() if n})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class AlertJob:
    """The running queries; ``digests`` is None where none are asked for."""

    def __init__(self, spark: SparkSession, folder: AlertFolder, checkpoint: str, config: AlertConfig, claims: StreamingQuery, digests: StreamingQuery | None, stats: OutcomeLog):
        self.spark, self.folder, self.checkpoint, self.config = spark, folder, checkpoint, config
        self.claims, self.digests, self.stats = claims, digests, stats

    def awaitTermination(self, timeout: float | None = None) -> None:
        """Until a query ends (an error in one stops the other), or for ``timeout`` seconds."""
        try:
            if timeout is None:
                self.spark.streams.awaitAnyTermination()
            else:
                self.claims.awaitTermination(timeout)
        finally:
            if timeout is None:
                self.stop()

    def stop(self) -> None:
        for query in (self.claims, self.digests):
            if query is not None:
                query.stop()
        self.spark.streams.removeListener(self.stats)

    def drain(self) -> DataFrame:
        """Stop, and send the digests that are still open."""
        self.stop()
        return flush(self.spark, self.folder, self.checkpoint)


def _last_flush(spark: SparkSession, folder: AlertFolder) -> int:
    """The batch that the newest flush stands behind; -1 without one."""
    fs, root = _filesystem(spark, folder.flushed)
    if not fs.exists(root):
        return -1
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return max((int(n.split("=", 1)[1]) for n in names if n.startswith("upto=")), default=-1)


def _committed(spark: SparkSession, checkpoint: str) -> int:
    """The last committed batch of the digest query; -1 without one."""
    fs, root = _filesystem(spark, f"{checkpoint}/digests/commits")
    if not fs.exists(root):
        return -1
    return max((int(s.getPath().getName()) for s in fs.listStatus(root) if s.getPath().getName().isdigit()), default=-1)


def open_digests(spark: SparkSession, checkpoint: str, flushed: int = -1) -> DataFrame:
    """The digests that have not closed yet, read from the query's state store."""
    if _committed(spark, checkpoint) < 0:
        return spark.createDataFrame([], _DIGEST_SCHEMA)
    state = spark.read.format("statestore").option("stateVarName", "digest").load(f"{checkpoint}/digests")
    held = state.filter(F.col("value.batch") > flushed).select("key.k", "value.*")
    first = F.transform(F.sort_array("first"), lambda f: f["ip"])
    return _as_digests(held.select("k", "opened_us", "we_min", "we_max", first.alias("ips"), "ip_count", "rc", "rp", "n"))


def flush(spark: SparkSession, folder: AlertFolder, checkpoint: str) -> DataFrame:
    """Send the open digests of a stopped job; a job that starts again begins new ones.

    Flushing twice without a batch between changes nothing.
    """
    last = _committed(spark, checkpoint)
    found = open_digests(spark, checkpoint, _last_flush(spark, folder))
    if last > _last_flush(spark, folder):
        target = f"{folder.flushed}/upto={last}"
        found.write.mode("overwrite").parquet(target)
        return spark.read.schema(_DIGEST_SCHEMA).parquet(target)
    return found


def run_alerting(
    wire: DataFrame,
    checkpoint: str,
    out: str,
    config: AlertConfig = AlertConfig(),
    trigger: str = "2 seconds",
    available_now: bool = False,
    digests: bool = True,
    clock: str = "processing",
    stream: StreamConfig = StreamConfig(),
) -> AlertJob:
    """Start the queries over alert records (key, value, arrival).

    ``clock``: ``processing`` closes digests by timers too; ``arrival`` only by
    the arrivals of their key, for replays of recorded traffic.  With
    ``available_now`` both have ended on return.
    """
    from trafficwatch.streaming.detection import apply_stream_confs

    if clock not in ("processing", "arrival"):
        raise ValueError(f"unknown clock {clock!r}")
    spark, folder = wire.sparkSession, AlertFolder(out)
    apply_stream_confs(spark, stream)
    for path in (folder.messages, folder.digests):
        fs, root = _filesystem(spark, path)
        fs.mkdirs(root)
    stats = OutcomeLog(config.stats_interval_seconds)
    spark.streams.addListener(stats)

    def start(rows: DataFrame, name: str, path: str, partition: list[str]) -> StreamingQuery:
        writer = rows.writeStream.format("parquet").outputMode("append").partitionBy(*partition).option("checkpointLocation", f"{checkpoint}/{name}")
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
        # timers ask for batches without data for ever: a run that ends takes none
        idle = spark.conf.get(_IDLE_BATCHES)
        spark.conf.set(_IDLE_BATCHES, "false" if available_now else idle)
        try:
            query = writer.start(path)
        finally:
            spark.conf.set(_IDLE_BATCHES, idle)
        if available_now:
            query.awaitTermination()
        return query

    counts = [F.count_if(F.col("disposition") == name).alias(name) for name in OUTCOMES]
    claims = start(judged_messages(wire, config).observe("outcomes", *counts), "claims", folder.messages, ["disposition"])
    second = None
    if digests:
        schema = _message_schema(spark, _WIRE) + ", disposition string"
        accepted = spark.readStream.schema(schema).parquet(folder.messages).filter(F.col("disposition") == "accepted")
        second = start(digest_stream(accepted, config, clock == "processing", _last_flush(spark, folder)), "digests", folder.digests, [])
    job = AlertJob(spark, folder, checkpoint, config, claims, second, stats)
    if available_now:
        spark.streams.removeListener(stats)
    return job


def messages(spark: SparkSession, folder: AlertFolder) -> DataFrame:
    """Every record with its outcome."""
    return spark.read.schema(_message_schema(spark, _WIRE) + ", disposition string").parquet(folder.messages)


def outcome_counts(spark: SparkSession, folder: AlertFolder) -> DataFrame:
    """Messages by outcome over all batches."""
    return messages(spark, folder).groupBy("disposition").agg(F.count(F.lit(1)).alias("message_count"))


def accepted_alerts(spark: SparkSession, folder: AlertFolder) -> DataFrame:
    """Accepted alerts of all batches."""
    return messages(spark, folder).filter(F.col("disposition") == "accepted")


def sent_digests(spark: SparkSession, folder: AlertFolder) -> DataFrame:
    """Digests sent when they closed, and those sent by a flush."""
    found = spark.read.schema(_DIGEST_SCHEMA).parquet(folder.digests)
    if _last_flush(spark, folder) < 0:
        return found
    return found.unionByName(spark.read.schema(_DIGEST_SCHEMA).parquet(folder.flushed + "/upto=*"))
