"""Named queries over the driver tables: each is (spark, sf_dir) -> DataFrame.

Timestamps leave as TIMESTAMP_NTZ holding UTC wall-clock time, so the result
reads the same in every engine and session time zone.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficwatch.config import AlertConfig
from trafficwatch.functions.alerts import alert_json, alert_key, format_alert, format_digest, message_key
from trafficwatch.operators.alerting import (
    decode_alert_messages,
    disposition_counts,
    severity_gate,
    typed_alert_columns,
    with_dispositions,
)
from trafficwatch.operators.detect import detect_rules
from trafficwatch.operators.digest import digest
from trafficwatch.operators.report import alert_stats, bucketed, recent, time_range, top_terms
from trafficwatch.operators.store import latest_alerts, read_alerts, retained, to_stored, write_alerts
from trafficwatch.operators.ttl import ttl_claims
from trafficwatch.operators.normalize import normalize
from trafficwatch.operators.rules import (
    FAST_WINDOW,
    MAIN_WINDOW,
    PATH_WINDOW,
    all_rules,
    rule_by_name,
)
from trafficwatch.operators.windows import path_windows_exact, source_windows_exact
from trafficwatch.schema import RULE_OUTPUT_COLUMNS
from trafficwatch.session import materialize, pin_utc, scratch_path
from trafficwatch.sources.fixtures import alert_messages, read_table, traffic

Query = Callable[[SparkSession, str], DataFrame]


def as_ntz(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append(c.cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else c)
    return df.select(*cols)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return normalize(traffic(spark, sf_dir))


def q_normalize_requests(spark, sf_dir):
    return as_ntz(requests(spark, sf_dir))


def q_url_type_counts(spark, sf_dir):
    return requests(spark, sf_dir).groupBy("url_type").agg(
        F.count(F.lit(1)).alias("request_count"),
        F.count_distinct("src_ip").alias("source_count"),
    )


def q_status_category_counts(spark, sf_dir):
    return requests(spark, sf_dir).groupBy("status_category").agg(
        F.count(F.lit(1)).alias("request_count"),
        F.sum("response_size").cast("long").alias("response_bytes"),
    )


def q_source_windows_5s(spark, sf_dir):
    return as_ntz(source_windows_exact(requests(spark, sf_dir), MAIN_WINDOW))


def q_source_windows_2s(spark, sf_dir):
    return as_ntz(source_windows_exact(requests(spark, sf_dir), FAST_WINDOW))


def q_path_windows_60s(spark, sf_dir):
    return as_ntz(path_windows_exact(requests(spark, sf_dir), PATH_WINDOW))


def _detect_one(rule_name: str) -> Query:
    def q(spark, sf_dir):
        alerts = detect_rules(requests(spark, sf_dir), [rule_by_name(rule_name)], exact=True)
        return as_ntz(alerts.select(*RULE_OUTPUT_COLUMNS))

    q.__name__ = f"q_detect_{rule_name}"
    return q


def alerts(spark: SparkSession, sf_dir: str, plan: str = "auto") -> DataFrame:
    """Every rule (fast and heavy-URL on), exact distinct, detected_at = window_end."""
    a = detect_rules(requests(spark, sf_dir), all_rules(fast=True, heavy_url=True), exact=True, plan=plan)
    return a.withColumn("detected_at", F.col("window_end"))


def q_detect_all(spark, sf_dir):
    return as_ntz(alerts(spark, sf_dir))


def q_detect_all_sketch(spark, sf_dir):
    """All rules on measures whose distinct counts come from merged sketches.

    Without ``unique_path_count``, an estimate (1.6 % standard error beyond some
    hundred members); the thresholds on it are far below that.
    """
    return as_ntz(alerts(spark, sf_dir, plan="sketch").drop("unique_path_count"))


RULE_QUERIES = (
    "http_flood",
    "botnet",
    "search_flood",
    "scanning",
    "slowloris",
    "fast_http_flood",
    "fast_scanning",
    "heavy_url",
)


# ---------------------------------------------------------------------------
# Alert handling, store and reports (inputs derived from detect_all).
# ---------------------------------------------------------------------------
ALERTS = AlertConfig()
DEDUPE_FIXTURE_TTL_SECONDS = 6 * 3600


def messages(spark, sf_dir):
    """Decoded alert records: the alert topic as a table, stored."""
    return materialize(decode_alert_messages(alert_messages(alerts(spark, sf_dir))), "messages")


def dispositions(spark, sf_dir):
    tie = F.coalesce(F.col("signal_reason"), F.lit(""))
    return with_dispositions(messages(spark, sf_dir), F.col("arrival"), tie, ALERTS)


def accepted(spark, sf_dir):
    return dispositions(spark, sf_dir).filter(F.col("disposition") == "accepted")


def stored(spark, sf_dir):
    """Every valid record as stored: + alert_key, @timestamp (arrival), alert_date, batch_id."""
    decoded = decode_alert_messages(alert_messages(alerts(spark, sf_dir))).filter("valid")
    typed = decoded.select(*typed_alert_columns(), "key", "arrival", "emission")
    return to_stored(typed, F.col("key"), F.col("arrival"), F.col("emission"))


def store(spark, sf_dir):
    """The stored records, and copies of them two days older, written to and read from a dated store."""
    rows, path = materialize(stored(spark, sf_dir), "records"), scratch_path(spark, "store")
    older = rows.withColumn("@timestamp", F.col("`@timestamp`") - F.make_dt_interval(days=F.lit(2)))
    older = older.withColumn("alert_date", F.to_date("`@timestamp`"))
    write_alerts(rows.unionByName(older), path)
    return read_alerts(spark, path)


def _now(df):
    """The newest ingest time, as a value: a report's time is known before it is planned, so that it can prune."""
    return F.lit(df.agg(F.max("`@timestamp`")).first()[0]).cast("timestamp")


def dashboard(spark, sf_dir):
    """(latest stored alerts within the last 5 minutes before the newest one, that time)."""
    rows = store(spark, sf_dir)
    now = _now(rows)
    return time_range(latest_alerts(rows), now, 300), now


def q_alert_keys(spark, sf_dir):
    """Stream key of each alert, and the fallback key rebuilt from its JSON record."""
    a = alerts(spark, sf_dir)
    wire = a.select(alert_key().alias("alert_key"), F.lit("").alias("key"), alert_json().alias("value"))
    dec = decode_alert_messages(wire)
    return dec.select("alert_key", message_key(F.col("key")).alias("fallback_key"), "signal_reason")


def q_alert_json(spark, sf_dir):
    return alert_messages(alerts(spark, sf_dir)).filter(F.col("emission") == 2).select("key", "value")


def q_severity_gated(spark, sf_dir):
    return as_ntz(severity_gate(alerts(spark, sf_dir), ALERTS.min_severity))


def q_dispositions(spark, sf_dir):
    return disposition_counts(dispositions(spark, sf_dir))


def q_dedupe_ttl(spark, sf_dir):
    pin_utc(spark)
    ev = read_table(spark, sf_dir, "events")
    key = F.concat_ws("|", F.col("user_id").cast("string"), F.col("event_type"))
    claims = ttl_claims(ev, key, F.col("ts"), DEDUPE_FIXTURE_TTL_SECONDS).filter("claimed")
    return claims.select("k", F.timestamp_micros("t_us").cast("timestamp_ntz").alias("t"))


def _digests(spark, sf_dir):
    return digest(accepted(spark, sf_dir), F.col("arrival"), ALERTS.batch_window_seconds, ALERTS.batch_max_ips)


def q_alert_digest(spark, sf_dir):
    return as_ntz(_digests(spark, sf_dir))


def q_digest_text(spark, sf_dir):
    d = _digests(spark, sf_dir)
    return as_ntz(d.select("attack_type", "signal_reason", "opened_at", format_digest().alias("text")))


def q_alert_text(spark, sf_dir):
    return accepted(spark, sf_dir).select("dedupe_key", format_alert().alias("text"))


def q_latest_alerts(spark, sf_dir):
    """The upsert view of every stored record: the newest row per date and key, of all dates."""
    return as_ntz(latest_alerts(stored(spark, sf_dir)))


def q_retained_alerts(spark, sf_dir):
    st = materialize(stored(spark, sf_dir), "records")
    even = F.col("request_count") % 2 == 0
    shifted_ts = F.when(even, F.col("`@timestamp`") - F.make_dt_interval(days=F.lit(2))).otherwise(F.col("`@timestamp`"))
    st = st.withColumn("@timestamp", shifted_ts).withColumn("alert_date", F.to_date(F.col("`@timestamp`")))
    return as_ntz(retained(st, _now(st)))


def _bucket_query(metric: str, how: str, name: str):
    def q(spark, sf_dir):
        rows, now = dashboard(spark, sf_dir)
        lo = now - F.make_dt_interval(secs=F.lit(300))
        return as_ntz(bucketed(rows, F.col(metric), how, lo, now, 5, name=name))

    q.__name__ = f"q_bucket_{name}"
    return q


def q_top_attack_types(spark, sf_dir):
    return top_terms(dashboard(spark, sf_dir)[0], "attack_type", 5)


def q_top_severities(spark, sf_dir):
    return top_terms(dashboard(spark, sf_dir)[0], "severity", 5)


def q_recent_alerts(spark, sf_dir):
    return as_ntz(recent(dashboard(spark, sf_dir)[0], 50))


def q_alert_stats(spark, sf_dir):
    return alert_stats(alerts(spark, sf_dir))


# ---------------------------------------------------------------------------
# Streaming replays (file source, availableNow, several micro-batches).
# ---------------------------------------------------------------------------


def q_stream_detect_all(spark, sf_dir):
    from trafficwatch.schema import RULE_OUTPUT_COLUMNS as cols
    from trafficwatch.streaming.replay import replay_detection

    pin_utc(spark)
    latest_rows = replay_detection(spark, traffic(spark, sf_dir))
    return as_ntz(latest_rows.select(*cols).withColumn("detected_at", F.col("window_end")))


def _alert_stream(spark, sf_dir, digests: bool):
    from trafficwatch.streaming.replay import replay_alerting

    pin_utc(spark)
    records = materialize(alert_messages(alerts(spark, sf_dir)), "records")
    return replay_alerting(spark, records, ALERTS, digests=digests)


def q_stream_dedupe(spark, sf_dir):
    from trafficwatch.streaming.alerting import accepted_alerts

    out = accepted_alerts(spark, _alert_stream(spark, sf_dir, digests=False))
    return as_ntz(out.select("dedupe_key", "arrival", "attack_type", "signal_reason", "request_count"))


def q_stream_outcomes(spark, sf_dir):
    from trafficwatch.streaming.alerting import outcome_counts

    return outcome_counts(spark, _alert_stream(spark, sf_dir, digests=False))


def q_stream_digest(spark, sf_dir):
    """Digests sent by the stream when they closed, or flushed at its end."""
    from trafficwatch.streaming.alerting import sent_digests

    return as_ntz(sent_digests(spark, _alert_stream(spark, sf_dir, digests=True)))


def q_alert_log(spark, sf_dir):
    """Alert records written by a stream into a record log, read back by a bounded stream, decoded; the valid ones as sent."""
    from trafficwatch.streaming.replay import replay_log

    pin_utc(spark)
    sent = materialize(alert_messages(alerts(spark, sf_dir)).filter("emission != 1"), "records")
    return decode_alert_messages(replay_log(spark, sent)).filter("valid").select("key", "value")


def registry() -> dict[str, Query]:
    out: dict[str, Query] = {
        "normalize_requests": q_normalize_requests,
        "url_type_counts": q_url_type_counts,
        "status_category_counts": q_status_category_counts,
        "source_windows_5s": q_source_windows_5s,
        "source_windows_2s": q_source_windows_2s,
        "path_windows_60s": q_path_windows_60s,
    }
    for r in RULE_QUERIES:
        out[f"detect_{r}"] = _detect_one(r)
    out["detect_all"] = q_detect_all
    out["detect_all_sketch"] = q_detect_all_sketch
    out.update(
        {
            "alert_keys": q_alert_keys,
            "alert_json": q_alert_json,
            "severity_gated": q_severity_gated,
            "dispositions": q_dispositions,
            "dedupe_ttl": q_dedupe_ttl,
            "alert_digest": q_alert_digest,
            "digest_text": q_digest_text,
            "alert_text": q_alert_text,
            "latest_alerts": q_latest_alerts,
            "retained_alerts": q_retained_alerts,
            "bucket_requests": _bucket_query("request_count", "sum", "request_count_sum"),
            "bucket_rps": _bucket_query("rps", "avg", "rps_avg"),
            "bucket_error_ratio": _bucket_query("error_ratio", "avg", "error_ratio_avg"),
            "bucket_unique_paths": _bucket_query("unique_path_count", "avg", "unique_path_count_avg"),
            "top_attack_types": q_top_attack_types,
            "top_severities": q_top_severities,
            "recent_alerts": q_recent_alerts,
            "alert_stats": q_alert_stats,
            "stream_detect_all": q_stream_detect_all,
            "stream_dedupe": q_stream_dedupe,
            "stream_outcomes": q_stream_outcomes,
            "stream_digest": q_stream_digest,
            "alert_log": q_alert_log,
        }
    )
    return out
