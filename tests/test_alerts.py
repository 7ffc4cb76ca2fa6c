import datetime as dt

from pyspark.sql import functions as F

from trafficwatch.functions.alerts import alert_key, format_digest, message_key
from trafficwatch.operators.alerting import decode_alert_messages, severity_gate
from trafficwatch.operators.digest import digest
from trafficwatch.operators.store import apply_retention, latest_alerts


def test_alert_key_skips_nulls(spark):
    df = spark.createDataFrame(
        [(None, "distributed_heavy_url", dt.datetime(2024, 1, 1, 0, 1), "60s"), ("1.2.3.4", "botnet", dt.datetime(2024, 1, 1, 0, 0, 5), "5s")],
        "src_ip string, attack_type string, window_end timestamp, window_size string",
    )
    keys = [r[0] for r in df.select(alert_key()).collect()]
    assert keys == ["distributed_heavy_url|2024-01-01 00:01:00|60s", "1.2.3.4|botnet|2024-01-01 00:00:05|5s"]


def test_severity_gate(spark):
    df = spark.createDataFrame([("critical",), ("WARNING",), (None,), ("info",)], "severity string")
    assert [r[0] for r in severity_gate(df, "critical").collect()] == ["critical"]
    assert [r[0] for r in severity_gate(df, "warning").collect()] == ["critical", "WARNING"]
    assert [r[0] for r in severity_gate(df, "bogus").collect()] == ["critical"]


def test_decode_invalid_and_fallback_key(spark):
    wire = spark.createDataFrame(
        [("", '{"attack_type": "botnet", "window_end": "2024-01-01T00:00:05.000Z", "window_size": "5s"}'),
         ("k1", "{not json"), ("k2", None), ("k3", "[1,2]")],
        "key string, value string",
    )
    out = decode_alert_messages(wire).select("valid", message_key(F.col("key")).alias("k")).collect()
    assert [r["valid"] for r in out] == [True, False, False, False]
    assert out[0]["k"] == "unknown|botnet|2024-01-01T00:00:05.000Z|5s"


def test_digest_cap_and_text(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [
        (f"10.0.0.{i:03d}", "botnet", "critical", "5s", "r", "2024-01-01T00:00:05.000Z", 40, 8.0, t + dt.timedelta(seconds=i % 3))
        for i in range(51)
    ]
    rows.append(("10.0.0.999", "botnet", "critical", "5s", "r", "2024-01-01T00:00:06.000Z", 40, 8.0, t + dt.timedelta(seconds=10)))
    df = spark.createDataFrame(
        rows,
        "src_ip string, attack_type string, severity string, window_size string, signal_reason string, "
        "window_end string, request_count long, rps double, arrival timestamp",
    )
    d = digest(df, F.col("arrival"), 10, 50).orderBy("opened_at").collect()
    assert len(d) == 2
    first = d[0]
    assert first["ip_count"] == 51 and len(first["ips"]) == 50 and first["alerts"] == 51
    assert first["ips"][:2] == ["10.0.0.000", "10.0.0.003"]  # by first arrival, then address
    text = digest(df, F.col("arrival"), 10, 50).orderBy("opened_at").select(format_digest()).first()[0]
    lines = text.split("\n")
    assert lines[1].endswith(", ...(+1 more)")
    assert lines[4] == "Window: 5s ending 2024-01-01T00:00:05.000Z"
    assert lines[5] == "Requests: 2040 | RPS: 408.00"


def test_latest_and_retention(spark, scratch):
    ts = dt.datetime(2024, 1, 1, 12)
    rows = [
        ("k", ts, 0, 10, "r"),
        ("k", ts + dt.timedelta(seconds=1), 1, 20, "r"),
        ("old", ts - dt.timedelta(days=2), 0, 5, "r"),
    ]
    df = spark.createDataFrame(rows, "alert_key string, `@timestamp` timestamp, batch_id long, request_count long, signal_reason string")
    df = df.withColumn("alert_date", F.to_date("`@timestamp`"))
    latest = {r["alert_key"]: r["request_count"] for r in latest_alerts(df).collect()}
    assert latest == {"k": 20, "old": 5}
    df.write.partitionBy("alert_date").parquet(scratch + "/store")
    removed = apply_retention(spark, scratch + "/store", now=dt.datetime(2024, 1, 1, 23, tzinfo=dt.timezone.utc))
    assert removed == ["2023-12-30"]
    assert spark.read.parquet(scratch + "/store").count() == 2


def test_compact_store(spark, scratch):
    from trafficwatch.operators.store import compact_store

    ts = dt.datetime(2024, 1, 1, 12)
    rows = [("k", ts, 0, 10, "r"), ("k", ts + dt.timedelta(seconds=1), 1, 20, "r"), ("j", ts, 0, 7, "r")]
    df = spark.createDataFrame(rows, "alert_key string, `@timestamp` timestamp, batch_id long, request_count long, signal_reason string")
    df.withColumn("alert_date", F.to_date("`@timestamp`")).write.partitionBy("alert_date").parquet(scratch + "/store")
    out = compact_store(spark, scratch + "/store", scratch + "/compact")
    assert sorted((r["alert_key"], r["request_count"]) for r in out.collect()) == [("j", 7), ("k", 20)]


def test_bad_fields_do_not_stop_the_job(spark):
    """Malformed times, quoted numbers, repeated names and out-of-range event times."""
    from trafficwatch.operators.alerting import typed_alert_columns
    from trafficwatch.operators.normalize import normalize
    from trafficwatch.schema import REQUEST_SCHEMA

    wire = spark.createDataFrame(
        [("k", '{"attack_type":"a","attack_type":"b","request_count":"40","rps":" 2.5 ","window_end":"yesterday"}'),
         ("k", '{"request_count":41.0,"rps":"x","severity_rank":"2"}'), ("k", "{}"), ("k", '"text"'), ("k", " ")],
        "key string, value string",
    )
    out = decode_alert_messages(wire)
    assert [(r.valid, r.attack_type, r.request_count, r.rps, r.severity_rank) for r in out.collect()] == [
        (True, "b", 40, 2.5, None), (True, None, 41, None, 2), (True, None, None, None, None), (False,) + (None,) * 4, (False,) + (None,) * 4,
    ]
    assert out.select(*typed_alert_columns()).first()["window_end"] is None
    d = digest(out.filter("valid").withColumn("arrival", F.timestamp_seconds(F.lit(5))), F.col("arrival")).collect()
    assert sum(r.request_count_sum for r in d) == 81 and all(r.window_end_max is None for r in d)
    far = spark.createDataFrame([(2**63 - 1,) + (None,) * 8, (-(2**62),) + (None,) * 8, (1000,) + (None,) * 8], REQUEST_SCHEMA)
    assert [r.timestamp is None for r in normalize(far).collect()] == [True, True, False]


def test_digest_window_zero_and_null_arrivals(spark):
    rows = [("1", "botnet", 5), ("1", "botnet", 5), ("2", "botnet", None)]
    df = spark.createDataFrame(rows, "src_ip string, attack_type string, s long").select(
        "src_ip", "attack_type", F.timestamp_seconds("s").alias("arrival"),
        *[F.lit(None).cast("string").alias(c) for c in ("severity", "window_size", "signal_reason", "window_end", "request_count", "rps")],
    )
    assert digest(df, F.col("arrival"), 0).count() == 3
    got = digest(df, F.col("arrival"), 10).collect()
    assert sorted((r.opened_at is None, r.alerts) for r in got) == [(False, 2), (True, 1)]


def test_no_machine_local_folder_on_a_cluster():
    import pytest

    from trafficwatch.session import checkpoint_dir

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {"spark.checkpoint.dir": None}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
    Session.conf = {"spark.checkpoint.dir": "hdfs://shared/x"}
    assert checkpoint_dir(Session()) == "hdfs://shared/x"
