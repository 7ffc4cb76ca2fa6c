"""The record log: sink, bounded stream source, batch reader, replays and restarts."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from trafficwatch.config import DetectionConfig
from trafficwatch.functions.alerts import alert_json, alert_key
from trafficwatch.operators.store import read_alerts
from trafficwatch.plans import queries as Q
from trafficwatch.sources import record_log as L
from trafficwatch.sources.fixtures import traffic
from trafficwatch.streaming.detection import run_detection


def records(spark, low, high, parts=3):
    return spark.range(low, high, 1, parts).select(F.col("id").cast("string").alias("key"), F.concat(F.lit("v"), "id").alias("value"))


def drain(source, checkpoint, out):
    """(rows per trigger) of a query over the source until nothing is left."""
    sizes = []

    def sink(batch, _):
        sizes.append(batch.count())
        batch.write.mode("append").parquet(out)

    q = source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return sizes


def test_triggers_are_bounded_in_records_and_restarts_go_on(spark, scratch):
    log, cp, out = f"{scratch}/log", f"{scratch}/cp", f"{scratch}/out"
    L.write_log_batch(records(spark, 0, 25), log, 0)
    L.write_log_batch(records(spark, 0, 0), log, 1)
    L.write_log_batch(records(spark, 25, 32), log, 2)
    assert drain(L.log_source(spark, log, cp, 10), cp, out) == [10, 10, 10, 2]
    assert drain(L.log_source(spark, log, cp, 10), cp, out) == []
    L.write_log_batch(records(spark, 32, 47), log, 3)
    assert drain(L.log_source(spark, log, cp, 10), cp, out) == [10, 5]
    got = sorted(int(r.key) for r in spark.read.parquet(out).collect())
    assert got == list(range(47))
    assert drain(L.log_source(spark, log, f"{cp}2", None), f"{cp}2", f"{out}2") == [47]
    # "latest" skips what is there; the first start of a query runs one batch, empty here
    assert drain(L.log_source(spark, log, f"{cp}3", 10, start="latest"), f"{cp}3", f"{out}3") == [0]
    L.write_log_batch(records(spark, 47, 50), log, 4)
    assert drain(L.log_source(spark, log, f"{cp}3", 10, start="latest"), f"{cp}3", f"{out}3") == [3]


def test_a_failed_batch_is_planned_again(spark, scratch):
    """A trigger that fails after it was planned is run again after the restart, with the same records."""
    log, cp = f"{scratch}/log", f"{scratch}/cp"
    L.write_log_batch(records(spark, 0, 25), log, 0)

    def broken(batch, k):
        if k == 1:
            raise ValueError("lost")

    q = L.log_source(spark, log, cp, 10).writeStream.foreachBatch(broken).option("checkpointLocation", cp).start()
    with pytest.raises(Exception, match="lost"):
        q.processAllAvailable()
    q.stop()
    assert drain(L.log_source(spark, log, cp, 10), cp, f"{scratch}/out") == [10, 5]
    assert sorted(int(r.key) for r in spark.read.parquet(f"{scratch}/out").collect()) == list(range(10, 25))


def test_a_batch_written_twice_counts_once(spark, scratch):
    log = f"{scratch}/log"
    for _ in range(2):
        L.write_log_batch(records(spark, 0, 9), log, 0)
    rows = L.read_log(spark, log)
    assert rows.count() == 9 and rows.columns == ["key", "value"]
    named = {f for f, _ in L._get(L._manifest(log, 0))["files"]}
    assert {f"records/{f}" for f in os.listdir(f"{log}/records")} == named  # the second attempt's files are gone


def test_a_failed_write_leaves_no_batch(spark, scratch):
    log = f"{scratch}/log"
    bad = records(spark, 0, 9).withColumn("value", F.when(F.col("key") == "8", F.raise_error(F.lit("bad"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="bad"):
        L.write_log_batch(bad, log, 0)
    assert L._batches(log) == [] and L.read_log(spark, log).collect() == []


def test_nulls_extra_columns_and_an_empty_log(spark, scratch):
    log = f"{scratch}/log"
    assert L.read_log(spark, log).collect() == []
    rows = spark.createDataFrame([(None, "x", 1), ("k", None, 2), ("k", None, 2), ("", "é" * 100_000, 3)], "key string, value string, batch int")
    L.write_log_batch(rows, log, 4)
    got = sorted((str(r.key), len(r.value or "")) for r in L.read_log(spark, log).collect())
    assert got == [("", 100_000), ("None", 1), ("k", 0), ("k", 0)]
    assert drain(L.log_source(spark, log, f"{scratch}/cp", 3), f"{scratch}/cp", f"{scratch}/out") == [3, 1]  # begins at batch 4


def test_part_of_a_file_with_several_row_groups(spark, scratch):
    log = f"{scratch}/log"
    n = 2 * L.GROUP_ROWS + 5
    L.write_log_batch(records(spark, 0, n, 1), log, 0)
    (file, rows), = L._get(L._manifest(log, 0))["files"]
    assert rows == n and pq.ParquetFile(f"{log}/{file}").num_row_groups >= 2
    part = [b.column(0).to_pylist() for b in L._read_slice(log, L.Slice(file, L.GROUP_ROWS + 3, L.GROUP_ROWS))]
    assert sum(part, []) == [str(k) for k in range(L.GROUP_ROWS + 3, 2 * L.GROUP_ROWS + 3)]


def test_detection_from_a_log_to_a_log(spark, scratch):
    """Requests are admitted by records; the alert log holds what the store holds."""
    tr = traffic(spark, SF_SMALL)
    wire = tr.select(F.col("src_ip").alias("key"), F.to_json(F.struct(*tr.columns)).alias("value"))
    L.write_log_batch(wire.coalesce(1), f"{scratch}/requests", 0)
    cp = f"{scratch}/cp"
    source = L.log_source(spark, f"{scratch}/requests", cp, 400)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        q = run_detection(source, cp, DetectionConfig(fast_rules=True, exact_distinct=True), store_path=f"{scratch}/store", stats=False, log_path=f"{scratch}/alerts")
        try:
            q.processAllAvailable()
            admitted = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
        finally:
            q.stop()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(admitted) == tr.count() and max(admitted) <= 400 and len(admitted) > 1
    stored = read_alerts(spark, f"{scratch}/store").select(alert_key().alias("key"), alert_json().alias("value"))
    sent = L.read_log(spark, f"{scratch}/alerts")
    assert sorted(map(tuple, sent.collect())) == sorted(map(tuple, stored.collect()))
    assert sent.select("key").distinct().count() == Q.q_alert_json(spark, SF_SMALL).select("key").distinct().count()
