"""Alert handling: decode, severity gate, dedupe key, TTL dedupe, dispositions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficwatch.config import AlertConfig
from trafficwatch.functions.alerts import (
    WIRE_ALERT_SCHEMA,
    alert_field,
    message_key,
    min_rank,
    parse_alert,
    severity_rank_of,
)
from trafficwatch.operators.ttl import dedupe_ttl

WIRE_FIELDS = tuple(f.name for f in WIRE_ALERT_SCHEMA.fields)
DISPOSITIONS = ("invalid", "skipped_severity", "duplicate", "accepted")


def decode_alert_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Wire records -> ``valid`` flag plus the alert fields (text times kept as sent).

    A record is valid when its value is a JSON object; anything else (bad
    UTF-8/JSON, null) is invalid and carries null fields.
    """
    parsed = messages.withColumn("_a", parse_alert(F.col(value_col).cast("string")))
    fields = [alert_field(F.col("_a"), f).alias(f) for f in WIRE_FIELDS]
    return parsed.select("*", F.col("_a").isNotNull().alias("valid"), *fields).drop("_a")


def typed_alert_columns() -> list[Column]:
    """Wire text times -> TIMESTAMP columns (ISO-8601 with zone); other text gives null."""
    times = ("window_start", "window_end", "detected_at")
    return [(F.try_to_timestamp(f) if f in times else F.col(f)).alias(f) for f in WIRE_FIELDS]


def severity_gate(df: DataFrame, min_severity: str = "critical") -> DataFrame:
    """Keep alerts whose severity (case-insensitive) ranks at or above ``min_severity``."""
    return df.filter(severity_rank_of(F.col("severity")) >= F.lit(min_rank(min_severity)))


def with_dispositions(
    messages: DataFrame,
    time: Column,
    tie: Column,
    config: AlertConfig = AlertConfig(),
    key_col: str = "key",
) -> DataFrame:
    """Decoded messages -> ``dedupe_key`` and ``disposition`` per message.

    invalid -> skipped_severity -> duplicate (TTL first claim per key, in
    ``time`` then ``tie`` order) -> accepted.
    """
    gated = F.col("valid") & (severity_rank_of(F.col("severity")) >= F.lit(min_rank(config.min_severity)))
    df = messages.withColumn("dedupe_key", F.when(F.col("valid"), message_key(F.col(key_col))))
    out = dedupe_ttl(df, F.col("dedupe_key"), time, config.dedupe_ttl_seconds, tie, where=gated)
    disp = (
        F.when(~F.col("valid"), "invalid")
        .when(F.col("is_duplicate").isNull(), "skipped_severity")
        .when(F.col("is_duplicate"), "duplicate")
        .otherwise("accepted")
    )
    return out.withColumn("disposition", disp).drop("is_duplicate")


def disposition_counts(df: DataFrame) -> DataFrame:
    """Messages by outcome."""
    return df.groupBy("disposition").agg(F.count(F.lit(1)).alias("message_count"))
