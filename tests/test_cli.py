"""The command line runs the streaming detection job end to end."""

from pyspark.sql import functions as F

from conftest import SF_SMALL

from trafficwatch.__main__ import main
from trafficwatch.session import CLUSTER_CONF
from trafficwatch.sources.fixtures import traffic

RESTORE = list(CLUSTER_CONF) + ["spark.sql.shuffle.partitions"]


def test_cli_detect_available_now(spark, scratch):
    saved = {k: spark.conf.get(k, None) for k in RESTORE}
    try:
        tr = traffic(spark, SF_SMALL)
        tr.select(F.to_json(F.struct(*tr.columns)).alias("value")).coalesce(1).write.text(f"{scratch}/in")
        main([
            "detect", "--source", f"file:{scratch}/in", "--checkpoint", f"{scratch}/cp-*", "--run-id", "t1",
            "--store", f"{scratch}/store", "--exact", "--fast-rules", "--available-now", "--no-stats",
            "--shuffle-partitions", "4",
        ])
        stored = spark.read.parquet(f"{scratch}/store")
        assert stored.count() == 47  # FIXTURES: every rule at sf0.001
        assert {"alert_key", "@timestamp", "alert_date", "batch_id"} <= set(stored.columns)
        import os

        assert os.path.isdir(f"{scratch}/cp-t1")
        main(["compact", "--store", f"{scratch}/store", "--target", f"{scratch}/compact"])
        assert 0 < spark.read.parquet(f"{scratch}/compact").count() <= 47
        main(["retain", "--store", f"{scratch}/store", "--keep-days", "2"])
        assert spark.read.parquet(f"{scratch}/store").count() == 47  # all of today
        main(["retain", "--store", f"{scratch}/store", "--keep-days", "-1"])
        assert not [x for x in os.listdir(f"{scratch}/store") if x.startswith("alert_date=")]
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_cli_alerts_flushes_at_the_end(spark, scratch):
    """The alert job ends with what is open sent; another start sends it once only."""
    from test_stream import END, alert_batches, alert_value

    saved = {k: spark.conf.get(k, None) for k in RESTORE}
    args = ["alerts", "--source", f"file:{scratch}/in", "--checkpoint", f"{scratch}/cp", "--out", f"{scratch}/out", "--available-now", "--shuffle-partitions", "2", "--max-ips", "1"]
    try:
        alert_batches(spark, f"{scratch}/in", [[("a", alert_value("1", END), 100.0), ("b", alert_value("2", END), 101.0), ("a", alert_value("1", END), 102.0)]])
        for _ in range(2):
            main(args)
            from trafficwatch.streaming.alerting import AlertFolder, sent_digests

            assert [(r.alerts, r.ips, r.ip_count) for r in sent_digests(spark, AlertFolder(f"{scratch}/out")).collect()] == [(2, ["1"], 2)]
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
