"""Dashboard-style reports over stored alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

US = 1_000_000


def time_range(df: DataFrame, now: Column, span_seconds: int = 300, time_col: str = "@timestamp", date_col: str = "alert_date") -> DataFrame:
    """Rows with ``now - span <= time <= now``.

    The same range on ``date_col``, where there is one, prunes the store's
    folders (it passes below a grouping by date, which the time itself can't).
    """
    t, low = F.col(f"`{time_col}`"), now - F.make_dt_interval(secs=F.lit(span_seconds))
    if date_col in df.columns:
        df = df.filter(F.col(date_col).between(F.to_date(low), F.to_date(now)))
    return df.filter((t >= low) & (t <= now))


def bucketed(
    df: DataFrame,
    value: Column,
    how: str,
    lo: Column,
    hi: Column,
    bucket_seconds: int = 5,
    time_col: str = "@timestamp",
    name: str = "value",
) -> DataFrame:
    """Date histogram of ``value`` (``how`` = sum | avg | count) with empty buckets kept.

    Buckets are ``bucket_seconds`` wide, epoch aligned, covering [lo, hi].
    Empty buckets: sums and counts 0, averages null.  Averages are exact
    decimal sums divided once, so they do not depend on summation order.
    """
    step = bucket_seconds * US
    t_us = F.unix_micros(F.col(f"`{time_col}`"))
    b = (t_us - F.pmod(t_us, F.lit(step))).alias("b")
    average = F.sum(F.col("v").cast("decimal(38,12)")).cast("double") / F.nullif(F.count("v"), F.lit(0))
    measure = {"sum": F.sum("v"), "avg": average, "count": F.count("v")}[how]
    agg = df.select(b, value.alias("v")).groupBy("b").agg(measure.alias(name))
    lo_us, hi_us = F.unix_micros(lo), F.unix_micros(hi)
    first, last = lo_us - F.pmod(lo_us, F.lit(step)), hi_us - F.pmod(hi_us, F.lit(step))
    # The series is output-sized (span / bucket), generated from one bounds row.
    series = df.sparkSession.range(1).select(F.explode(F.sequence(first, last, F.lit(step))).alias("b"))
    out = series.join(agg, on="b", how="left")
    filled = F.col(name) if how == "avg" else F.coalesce(F.col(name), F.lit(0))
    return out.select(F.timestamp_micros("b").alias("bucket_start"), filled.alias(name))


def top_terms(df: DataFrame, field: str, size: int = 5) -> DataFrame:
    """Terms aggregation: the ``size`` most frequent values, count desc then value."""
    return (
        df.groupBy(field)
        .agg(F.count(F.lit(1)).alias("alert_count"))
        .orderBy(F.desc("alert_count"), F.asc(field))
        .limit(size)
    )


def recent(df: DataFrame, n: int = 50, time_col: str = "@timestamp", tie: str = "alert_key") -> DataFrame:
    """Newest ``n`` rows (time desc, then ``tie`` asc)."""
    return df.orderBy(F.desc(f"`{time_col}`"), F.asc(tie)).limit(n)


def alert_stats(alerts: DataFrame) -> DataFrame:
    """Alert count per attack type, most frequent first."""
    return alerts.groupBy("attack_type").agg(F.count(F.lit(1)).alias("alert_count")).orderBy(
        F.desc("alert_count"), F.asc("attack_type")
    )
