"""Command line: run the streaming and store jobs.

    python -m trafficwatch detect --source file:/in --checkpoint /cp/detect --store /alerts
    python -m trafficwatch detect --kafka broker:9092 --topic network-traffic \\
        --alerts-topic ddos-alerts --checkpoint '/cp/detect-*'
    python -m trafficwatch detect --source log:/requests --checkpoint /cp/detect --alerts-log /alert-log
    python -m trafficwatch alerts --source log:/alert-log --checkpoint /cp/alerts --out /handled
    python -m trafficwatch alerts --source file:/alert-records --checkpoint /cp/alerts --out /handled
    python -m trafficwatch compact --store /alerts --target /alerts-compact
    python -m trafficwatch retain --store /alerts --keep-days 1
"""

from __future__ import annotations

import argparse
import logging

from trafficwatch.config import AlertConfig, DetectionConfig, StreamConfig
from trafficwatch.session import STREAM_CONF, cluster_session


def _stream_cfg(a) -> StreamConfig:
    return StreamConfig(
        trigger=a.trigger,
        max_offsets_per_trigger=a.max_offsets or None,
        max_files_per_trigger=a.max_files,
        shuffle_partitions=a.shuffle_partitions,
        starting_offsets=a.starting_offsets,
    )


def until_stopped(job, ended: bool) -> None:
    """Wait for the alert job; on SIGTERM, SIGINT or its end the open digests are sent."""
    import signal

    def stop(*_):
        raise KeyboardInterrupt

    before = signal.signal(signal.SIGTERM, stop)
    try:
        if not ended:
            job.awaitTermination()
    except KeyboardInterrupt:
        logging.info("stopping")
    finally:
        signal.signal(signal.SIGTERM, before)
        if job.digests is not None:
            logging.info("open digests sent: %d", job.drain().count())
        else:
            job.stop()


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="trafficwatch")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("detect", "alerts"):
        s = sub.add_parser(name)
        s.add_argument("--source", help="file:<dir> of JSON-line records (detect) / parquet key,value,arrival (alerts); log:<dir> of a record log")
        s.add_argument("--kafka", help="bootstrap servers")
        s.add_argument("--topic", default="network-traffic" if name == "detect" else "ddos-alerts")
        s.add_argument("--checkpoint", required=True, help="path; '*' is replaced by a run id")
        s.add_argument("--run-id")
        s.add_argument("--trigger", default="2 seconds")
        s.add_argument("--max-offsets", type=int, default=1000, help="records per trigger; 0: no cap")
        s.add_argument("--max-files", type=int)
        s.add_argument("--shuffle-partitions", type=int, help="default: the session's")
        s.add_argument("--starting-offsets", default="latest")
        s.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    d = sub.choices["detect"]
    d.add_argument("--store", help="date-partitioned parquet alert store")
    d.add_argument("--alerts-topic", help="Kafka topic for alert records")
    d.add_argument("--alerts-log", help="folder of a record log for alert records")
    d.add_argument("--watermark", default="45 seconds")
    d.add_argument("--fast-rules", action="store_true")
    d.add_argument("--no-heavy-url", action="store_true")
    d.add_argument("--exact", action="store_true", help="exact distinct counts instead of HyperLogLog")
    d.add_argument("--no-stats", action="store_true")
    al = sub.choices["alerts"]
    al.add_argument("--out", required=True, help="folder of handled messages and digests")
    al.add_argument("--min-severity", default="critical")
    al.add_argument("--ttl", type=int, default=300)
    al.add_argument("--window", type=float, default=10, help="seconds of a digest; 0: every alert alone")
    al.add_argument("--max-ips", type=int, default=50)
    al.add_argument("--no-digests", action="store_true")
    al.add_argument("--clock", choices=["processing", "arrival"], default="processing", help="arrival: digests close by arrivals alone, for replays")
    compact = sub.add_parser("compact", help="write the latest row of each alert to another folder")
    compact.add_argument("--store", required=True)
    compact.add_argument("--target", required=True)
    retain = sub.add_parser("retain", help="delete the days that are over")
    retain.add_argument("--store", required=True)
    retain.add_argument("--keep-days", type=int, default=1)
    a = p.parse_args(argv)

    logging.basicConfig(level=logging.INFO)
    spark = cluster_session("trafficwatch-" + a.cmd, STREAM_CONF if a.cmd in ("detect", "alerts") else None)
    if a.cmd in ("compact", "retain"):
        from trafficwatch.operators.store import apply_retention, compact_store

        if a.cmd == "compact":
            compact_store(spark, a.store, a.target)
        else:
            logging.info("removed days: %s", apply_retention(spark, a.store, keep_days=a.keep_days))
        return
    from trafficwatch.sources.record_log import log_source
    from trafficwatch.sources.requests import file_source, kafka_source
    from trafficwatch.streaming.detection import apply_stream_confs, resolve_checkpoint, run_detection

    cfg = _stream_cfg(a)
    apply_stream_confs(spark, cfg)
    checkpoint = resolve_checkpoint(a.checkpoint, a.run_id)
    log = None
    if a.source and a.source.startswith("log:"):
        log = log_source(spark, a.source.removeprefix("log:"), checkpoint, cfg.max_offsets_per_trigger, cfg.starting_offsets)
    if a.cmd == "detect":
        wire = log if log is not None else kafka_source(spark, a.kafka, a.topic, cfg) if a.kafka else file_source(spark, a.source.removeprefix("file:"), "json", cfg)
        det = DetectionConfig(a.watermark, a.fast_rules, not a.no_heavy_url, a.exact)
        kafka = {"bootstrap": a.kafka, "topic": a.alerts_topic} if a.kafka and a.alerts_topic else None
        q = run_detection(
            wire, checkpoint, det, cfg, store_path=a.store, kafka=kafka, stats=not a.no_stats, available_now=a.available_now, log_path=a.alerts_log
        )
    else:
        from pyspark.sql import functions as F

        from trafficwatch.streaming.alerting import run_alerting

        if a.kafka:
            wire = kafka_source(spark, a.kafka, a.topic, cfg).withColumn("arrival", F.current_timestamp())
        elif log is not None:
            wire = log.withColumn("arrival", F.current_timestamp())
        else:
            wire = spark.readStream.schema("key string, value string, arrival timestamp").parquet(a.source.removeprefix("file:"))
        acfg = AlertConfig(min_severity=a.min_severity, dedupe_ttl_seconds=a.ttl, batch_window_seconds=a.window, batch_max_ips=a.max_ips)
        job = run_alerting(wire, checkpoint, a.out, acfg, trigger=cfg.trigger, available_now=a.available_now, digests=not a.no_digests, clock=a.clock, stream=cfg)
        until_stopped(job, a.available_now)
        return
    q.awaitTermination()


if __name__ == "__main__":
    main()
