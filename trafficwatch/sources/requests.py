"""Request sources: wire decoding plus Kafka / file stream readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficwatch.config import StreamConfig
from trafficwatch.schema import REQUEST_SCHEMA


def decode_requests(wire: DataFrame, value_col: str = "value") -> DataFrame:
    """``value`` (bytes or JSON text) -> REQUEST_SCHEMA columns.

    PERMISSIVE: a malformed record becomes an all-null row (it is not dropped
    here; event-time windows drop rows whose time is null).  Fields outside the
    schema (e.g. ``payload_size``) are ignored.
    """
    text = F.col(value_col).cast("string")
    return wire.select(F.from_json(text, REQUEST_SCHEMA).alias("data")).select("data.*")


def encode_requests(requests: DataFrame) -> DataFrame:
    """Request rows -> wire form: key = src_ip, value = JSON object."""
    return requests.select(
        F.col("src_ip").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in requests.columns])).alias("value"),
    )


def kafka_options(bootstrap: str, topic: str, cfg: StreamConfig = StreamConfig()) -> dict[str, str]:
    """Reader options: one subscribed topic, start offsets, data-loss policy, rate cap."""
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": cfg.starting_offsets,
        "failOnDataLoss": str(cfg.fail_on_data_loss).lower(),
    }
    if cfg.max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(cfg.max_offsets_per_trigger)
    return options


def kafka_source(spark: SparkSession, bootstrap: str, topic: str, cfg: StreamConfig = StreamConfig()) -> DataFrame:
    """Streaming (key, value) strings from a Kafka topic (needs the Kafka connector jar)."""
    return (
        spark.readStream.format("kafka")
        .options(**kafka_options(bootstrap, topic, cfg))
        .load()
        .select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    )


def file_source(spark: SparkSession, path: str, fmt: str = "json", cfg: StreamConfig = StreamConfig()) -> DataFrame:
    """Streaming ``value`` column from files of wire records.

    ``fmt="json"``: one JSON object per line (the raw line is ``value``);
    ``fmt="parquet"``: files with a ``value`` string column.
    """
    reader = spark.readStream
    if cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(cfg.max_files_per_trigger))
    if fmt == "json":
        return reader.text(path).select(F.col("value"))
    return reader.schema("key string, value string").parquet(path).select("value")
