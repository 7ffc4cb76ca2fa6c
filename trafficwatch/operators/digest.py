"""First-arrival alert digests (grouped notifications)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficwatch.functions.alerts import UNKNOWN
from trafficwatch.operators.ttl import assign_first_arrival

DIGEST_KEY = ("attack_type", "severity", "window_size", "signal_reason")


def digest_rows(alerts: DataFrame, arrival: Column) -> DataFrame:
    """Accepted alerts (wire fields) -> digest key, ip, arrival, window end and the summed numbers.

    Missing texts are 'unknown', missing numbers 0, and a window end that is no time is left out.
    """
    return alerts.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(c) for c in DIGEST_KEY],
        F.coalesce(F.col("src_ip").cast("string"), F.lit(UNKNOWN)).alias("ip"),
        arrival.alias("arrival"),
        F.try_to_timestamp(F.col("window_end")).alias("window_end_ts"),
        F.coalesce(F.col("request_count").cast("double"), F.lit(0.0)).alias("rc"),
        F.coalesce(F.col("rps").cast("double"), F.lit(0.0)).alias("rp"),
    )


def digest_key() -> Column:
    return F.concat_ws("\u0001", *[F.col(c) for c in DIGEST_KEY])


def per_source(grouped: DataFrame) -> DataFrame:
    """Rows of ``digest_rows`` with ``opened_at`` -> partial sums per (digest, source).

    They add up: partial sums of several batches can be summed again.
    """
    return grouped.groupBy(*DIGEST_KEY, "opened_at", "ip").agg(
        F.min("arrival").alias("first_seen"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("rc").cast("decimal(38,12)")).alias("rc_sum"),
        F.sum(F.col("rp").cast("decimal(38,12)")).alias("rp_sum"),
        F.min("window_end_ts").alias("we_min"),
        F.max("window_end_ts").alias("we_max"),
    )


def single_digests(rows: DataFrame) -> DataFrame:
    """Every alert of ``digest_rows`` as a digest of its own."""
    return rows.select(
        *DIGEST_KEY,
        F.col("arrival").alias("opened_at"),
        F.col("window_end_ts").alias("window_end_min"),
        F.col("window_end_ts").alias("window_end_max"),
        F.array("ip").alias("ips"),
        F.lit(1).cast("long").alias("ip_count"),
        F.col("rc").alias("request_count_sum"),
        F.col("rp").alias("rps_sum"),
        F.lit(1).cast("long").alias("alerts"),
    )


def digests_of(per_ip: DataFrame, max_ips: int) -> DataFrame:
    """Partial sums of ``per_source`` (one row per digest and source) -> digests.

    Every step is a grouped aggregate or a group-limited ranking, so a digest
    with very many sources is never gathered into one list beyond ``max_ips``.
    Sums are exact decimal sums with one final rounding, so they do not
    depend on partitioning or summation order.
    """
    gkeys = [*DIGEST_KEY, "opened_at"]
    measures = per_ip.groupBy(*gkeys).agg(
        F.min("we_min").alias("window_end_min"),
        F.max("we_max").alias("window_end_max"),
        F.count(F.lit(1)).alias("ip_count"),
        F.sum("rc_sum").cast("double").alias("request_count_sum"),
        F.sum("rp_sum").cast("double").alias("rps_sum"),
        F.sum("n").alias("alerts"),
    )
    rank = F.row_number().over(Window.partitionBy(*gkeys).orderBy("first_seen", "ip"))
    listed = (
        per_ip.select(*gkeys, "ip", "first_seen")
        .withColumn("rn", rank)
        .filter(F.col("rn") <= max_ips)
        .groupBy(*gkeys)
        .agg(F.sort_array(F.collect_list(F.struct("rn", "ip"))).alias("_ips"))
        .select(*gkeys, F.transform("_ips", lambda x: x["ip"]).alias("ips"))
    )
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"l.{c}")) for c in gkeys]
    return measures.alias("m").join(listed.alias("l"), same).select(
        *[F.col(f"m.{c}") for c in gkeys],
        "window_end_min",
        "window_end_max",
        "ips",
        "ip_count",
        "request_count_sum",
        "rps_sum",
        "alerts",
    )


def digest(alerts: DataFrame, arrival: Column, window_seconds: float = 10, max_ips: int = 50) -> DataFrame:
    """Accepted alerts (wire fields) -> one row per (digest key, first-arrival window).

    Columns: digest key, opened_at, window_end_min/max, ips (first ``max_ips``
    distinct sources by first arrival, then address), ip_count,
    request_count_sum, rps_sum, alerts.  With ``window_seconds`` of 0 or less
    every alert is a digest of its own; alerts without an arrival time share
    the digest of their key that has no opening time.
    """
    rows = digest_rows(alerts, arrival)
    if window_seconds <= 0:
        return single_digests(rows)
    grouped = assign_first_arrival(rows, digest_key(), F.col("arrival"), window_seconds)
    return digests_of(per_source(grouped), max_ips)
