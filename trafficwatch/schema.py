"""Declared schemas: request events in, alerts out (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# Request event as it arrives on the wire (JSON object per record).
REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), True),  # epoch milliseconds
        T.StructField("src_ip", T.StringType(), True),
        T.StructField("dst_ip", T.StringType(), True),
        T.StructField("protocol", T.StringType(), True),
        T.StructField("method", T.StringType(), True),
        T.StructField("user_agent", T.StringType(), True),
        T.StructField("request_url", T.StringType(), True),
        T.StructField("status_code", T.IntegerType(), True),
        T.StructField("response_size", T.IntegerType(), True),
    ]
)

# Normalised request columns, in output order.
NORMALIZED_COLUMNS = (
    "timestamp",
    "src_ip",
    "protocol",
    "method",
    "user_agent",
    "request_url",
    "request_path",
    "url_type",
    "status_code",
    "response_size",
    "status_category",
)

# Alert: the public output contract of detection, in output order.
ALERT_SCHEMA = T.StructType(
    [
        T.StructField("src_ip", T.StringType(), True),
        T.StructField("window_start", T.TimestampType(), True),
        T.StructField("window_end", T.TimestampType(), True),
        T.StructField("window_size", T.StringType(), True),
        T.StructField("attack_type", T.StringType(), True),
        T.StructField("severity", T.StringType(), True),
        T.StructField("severity_rank", T.IntegerType(), True),
        T.StructField("request_count", T.LongType(), True),
        T.StructField("rps", T.DoubleType(), True),
        T.StructField("unique_path_count", T.LongType(), True),
        T.StructField("error_ratio", T.DoubleType(), True),
        T.StructField("signal_reason", T.StringType(), True),
        T.StructField("detected_at", T.TimestampType(), True),
    ]
)
ALERT_COLUMNS = tuple(f.name for f in ALERT_SCHEMA.fields)
RULE_OUTPUT_COLUMNS = ALERT_COLUMNS[:-1]  # everything but detected_at

# Stored alert = alert + ingest time + its UTC date (the partition column).
STORED_EXTRA_COLUMNS = ("alert_key", "@timestamp", "alert_date", "batch_id")
