"""Dated alert store: upsert-by-key view over parquet written once per batch, retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficwatch.schema import ALERT_COLUMNS


def to_stored(alerts: DataFrame, key: Column, ingest_time: Column, batch_id: Column) -> DataFrame:
    """Alerts -> stored rows: + alert_key, @timestamp (ingest time), alert_date (UTC), batch_id."""
    return alerts.select(
        *[F.col(c) for c in ALERT_COLUMNS],
        key.alias("alert_key"),
        ingest_time.alias("@timestamp"),
        F.to_date(ingest_time).alias("alert_date"),
        batch_id.cast("long").alias("batch_id"),
    )


def write_alerts(stored: DataFrame, path: str) -> None:
    """Write one micro-batch to the store, partitioned by date and batch.

    Writing a batch again replaces its partitions: with ingest times that a
    replay repeats (the batch's own ``current_timestamp()``), the store is the
    same after it.
    """
    writer = stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("alert_date", "batch_id").parquet(path)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; a filter on ``alert_date`` prunes whole folders."""
    rows = spark.read.parquet(path)
    return rows.withColumns({"batch_id": F.col("batch_id").cast("long"), "alert_date": F.col("alert_date").cast("date")})


def latest_alerts(stored: DataFrame) -> DataFrame:
    """Upsert view: the newest row per (alert_date, alert_key).

    Newest = greatest (@timestamp, batch_id, signal_reason, ...) as one struct,
    so ties resolve deterministically.  A grouped max: partial aggregation
    absorbs keys that are re-emitted very often.
    """
    order = ["@timestamp", "batch_id", "signal_reason"]
    rest = [c for c in stored.columns if c not in order + ["alert_date", "alert_key"]]
    packed = F.struct(*[F.col(f"`{c}`").alias(c) for c in order + rest])
    agg = stored.groupBy("alert_date", "alert_key").agg(F.max(packed).alias("_row"))
    return agg.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in stored.columns if c not in ("alert_date", "alert_key")],
        "alert_key",
        "alert_date",
    ).select(*[F.col(f"`{c}`") for c in stored.columns])


def compact_store(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Compaction job: write only the latest row per (alert_date, alert_key) to ``target``.

    Every micro-batch adds a folder; compaction rewrites them into the upsert
    view, partitioned by date, so later reads skip superseded rows.  Writing to
    a separate target keeps the source readable until the caller swaps the paths.
    """
    latest_alerts(read_alerts(spark, path)).write.mode("overwrite").partitionBy("alert_date").parquet(target)
    return read_alerts(spark, target)


def retention_cutoff(now: Column, keep_days: int = 1) -> Column:
    return F.date_sub(F.to_date(now), keep_days)


def retained(stored: DataFrame, now: Column | None = None, keep_days: int = 1) -> DataFrame:
    """Rows whose date partition survives retention (partition filter on alert_date)."""
    if now is None:
        now = F.current_timestamp()
    return stored.filter(F.col("alert_date") >= retention_cutoff(now, keep_days))


def apply_retention(spark: SparkSession, path: str, now: dt.datetime | None = None, keep_days: int = 1) -> list[str]:
    """Delete whole date partitions older than the cutoff; returns the removed dates."""
    now = now or dt.datetime.now(dt.timezone.utc)
    cutoff = (now.date() - dt.timedelta(days=keep_days)).isoformat()
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(hconf)
    removed = []
    if not fs.exists(root):
        return removed
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("alert_date="):
            day = name.split("=", 1)[1]
            if day < cutoff:
                fs.delete(status.getPath(), True)
                removed.append(day)
    return sorted(removed)
