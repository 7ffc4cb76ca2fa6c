"""Streaming: late rows, restart from checkpoint, stream == batch."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from trafficwatch.config import AlertConfig, DetectionConfig, StreamConfig
from trafficwatch.operators.detect import detect_rules
from trafficwatch.operators.normalize import normalize
from trafficwatch.operators.rules import main_rules
from trafficwatch.schema import REQUEST_SCHEMA
from trafficwatch.streaming.detection import apply_stream_confs, run_detection

T0 = 1704067200000


def burst(second, n=150, ip="10.9.9.9"):
    return [(T0 + second * 1000, ip, "d", "HTTP/1.1", "GET", "ua", "/home", 200, 500)] * n


def write_batch(spark, rows, path, i):
    df = spark.createDataFrame(rows, REQUEST_SCHEMA)
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).coalesce(1).write.text(f"{path}/b{i:03d}")
    time.sleep(0.05)


def run_once(spark, src, base, read=True, heavy_url=False):
    cfg = StreamConfig(max_files_per_trigger=1, shuffle_partitions=4)
    apply_stream_confs(spark, cfg)
    wire = spark.readStream.option("maxFilesPerTrigger", "1").text(f"{src}/*")
    det = DetectionConfig(fast_rules=False, heavy_url_rule=heavy_url, exact_distinct=True)
    q = run_detection(wire, f"{base}/cp", det, cfg, store_path=f"{base}/store", stats=False, available_now=True)
    q.awaitTermination()
    if not read:
        return None
    return spark.read.parquet(f"{base}/store")


@pytest.mark.parametrize("heavy_url", [False, True])
def test_late_rows_are_dropped(spark, scratch, heavy_url):
    """The 60 s family changes nothing for the 5 s rules."""
    src = os.path.join(scratch, "in")
    # Spark judges lateness against the previous batch's watermark, so the
    # late burst comes two batches after the event that moved the watermark.
    write_batch(spark, burst(100), src, 0)
    write_batch(spark, burst(101, 5, "10.9.9.8"), src, 1)
    write_batch(spark, burst(10), src, 2)  # 90 s older than the max seen: behind the 45 s watermark
    write_batch(spark, burst(52, ip="10.9.9.7"), src, 3)  # the windows that end up to 56 are over
    out = run_once(spark, src, scratch, heavy_url=heavy_url)
    late = sorted(r["window_end"].timestamp() - T0 / 1000 for r in out.filter("attack_type = 'http_flood' and src_ip = '10.9.9.7'").collect())
    assert late == [57.0]  # the watermark stands at 101 - 45 = 56
    out = out.filter("src_ip <> '10.9.9.7'")
    ends = sorted({r["window_end"] for r in out.filter("attack_type = 'http_flood'").collect()})
    assert len(ends) == 5 and min(e.timestamp() for e in ends) > (T0 / 1000) + 100
    # the same rows in batch raise both bursts
    batch = detect_rules(
        normalize(spark.createDataFrame(burst(100) + burst(10), REQUEST_SCHEMA)), main_rules(), exact=True
    )
    assert batch.filter("attack_type = 'http_flood'").count() == 10


def test_restart_from_checkpoint(spark, scratch):
    src = os.path.join(scratch, "in")
    write_batch(spark, burst(20, 100), src, 0)
    run_once(spark, src, scratch, read=False)
    assert not os.path.exists(os.path.join(scratch, "store"))  # 100 < 150 so far: nothing emitted
    write_batch(spark, burst(20, 60), src, 1)  # same second: 160 in total
    out = run_once(spark, src, scratch)  # restarts on the same checkpoint
    flood = out.filter("attack_type = 'http_flood'").collect()
    assert len(flood) == 5 and {r["request_count"] for r in flood} == {160}


def alert_value(ip, end, attack="botnet", severity="critical", count="40"):
    return json.dumps({"src_ip": ip, "attack_type": attack, "severity": severity, "window_size": "5s", "signal_reason": "r", "window_end": end, "request_count": count, "rps": 8.0})


def alert_batches(spark, path, groups):
    """Each group of (key, value, seconds) is one file, in order."""
    for k, rows in enumerate(groups):
        df = spark.createDataFrame(rows, "key string, value string, s double").select("key", "value", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")).alias("arrival"))
        df.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)


WIRE = "key string, value string, arrival timestamp"


def run_alerts(spark, scratch, groups, config, clock="arrival"):
    """Each group is a run of its own on the same checkpoint, so state is restored between them."""
    from trafficwatch.streaming.alerting import run_alerting
    from trafficwatch.streaming.replay import stream_partitions

    for group in groups:
        alert_batches(spark, f"{scratch}/in", [group])
        with stream_partitions(spark, 2):
            job = run_alerting(spark.readStream.schema(WIRE).parquet(f"{scratch}/in"), f"{scratch}/cp", f"{scratch}/out", config, available_now=True, clock=clock)
    return job


END = "2024-01-01T00:00:05.000Z"


def test_alert_stream_keeps_late_and_repeated_records_right(spark, scratch):
    from trafficwatch.streaming.alerting import accepted_alerts, flush, open_digests, outcome_counts, sent_digests

    groups = [
        [("a", alert_value("1", END), 100.0), ("a", alert_value("1", END), 100.0), ("b", alert_value("2", "soon"), 101.0), ("x", "{broken", 101.0)],
        # late by 31 s: another digest key's first alert, and a repeat of a claimed key
        [("c", alert_value("3", END, "scanning"), 70.0), ("a", alert_value("1", END), 71.0), ("w", alert_value("9", END, severity="warning"), 104.0)],
        [("d", alert_value("4", END), 95.0), ("a", alert_value("1", END), 500.0)],
        [("n", alert_value("5", END, "flood"), None), ("a", alert_value("1", END), None)],
    ]
    job = run_alerts(spark, scratch, groups, AlertConfig())
    folder = job.folder
    counts = {r[0]: r[1] for r in outcome_counts(spark, folder).collect()}
    assert counts == {"accepted": 7, "duplicate": 2, "invalid": 1, "skipped_severity": 1}
    assert sorted(r.dedupe_key for r in accepted_alerts(spark, folder).collect()) == ["a", "a", "a", "b", "c", "d", "n"]
    still = open_digests(spark, job.checkpoint).collect()
    assert sorted(r.attack_type for r in still) == ["botnet", "scanning"]
    assert job.drain().count() == 2
    found = sent_digests(spark, folder).collect()
    # nothing is lost: the late alert of the open digest joins it, the late key has a digest of its own
    got = sorted((r.attack_type, r.opened_at.timestamp() if r.opened_at else 0, r.alerts, r.ip_count, tuple(r.ips)) for r in found)
    sent = [("botnet", 0, 1, 1, ("1",)), ("botnet", 100.0, 3, 3, ("4", "1", "2")), ("botnet", 500.0, 1, 1, ("1",)), ("flood", 0, 1, 1, ("5",)), ("scanning", 70.0, 1, 1, ("3",))]
    assert got == sent
    # a second flush sends nothing anew; a job that starts again begins a new digest, and sends only that
    flush(spark, folder, job.checkpoint)
    assert sent_digests(spark, folder).count() == 5
    job = run_alerts(spark, scratch, [[("e", alert_value("6", END), 502.0)]], AlertConfig())
    job.drain()
    got = sorted((r.attack_type, r.opened_at.timestamp() if r.opened_at else 0, r.alerts, r.ip_count, tuple(r.ips)) for r in sent_digests(spark, folder).collect())
    assert got == sorted([*sent, ("botnet", 502.0, 1, 1, ("6",))])


def test_digest_closes_on_an_idle_stream(spark, scratch):
    from trafficwatch.streaming.alerting import run_alerting, sent_digests
    from trafficwatch.streaming.replay import stream_partitions

    alert_batches(spark, f"{scratch}/in", [[("a", alert_value("1", END), 100.0), ("b", alert_value("2", END), 100.0)]])
    with stream_partitions(spark, 2):
        job = run_alerting(spark.readStream.schema(WIRE).parquet(f"{scratch}/in"), f"{scratch}/cp", f"{scratch}/out", AlertConfig(batch_window_seconds=2), trigger="500 milliseconds")
    try:
        for _ in range(240):  # nothing more arrives: only a timer can close it
            found = sent_digests(spark, job.folder).collect()
            if found:
                break
            time.sleep(0.5)
        assert [(r.alerts, r.ips) for r in found] == [(2, ["1", "2"])]
    finally:
        job.stop()
    assert job.drain().collect() == []


def test_state_holds_one_claim_a_key_and_outlives_a_restart(spark, scratch):
    """The claims' store: a row a key, however many records; batches write changed keys only."""
    first = [(f"k{i}", alert_value(str(i), END), 100.0 + j) for i in range(20) for j in range(3)]
    job = run_alerts(spark, scratch, [first, [("k1", alert_value("1", END), 104.0), ("new", alert_value("77", END), 105.0)]], AlertConfig())
    held = spark.read.format("statestore").option("stateVarName", "claim").load(f"{scratch}/cp/claims")
    rows = held.select("key._group", "value.*").collect()
    assert len(rows) == 21 and {r[0] for r in rows} == {f"kk{i}" for i in range(20)} | {"knew"}
    progress = job.claims.lastProgress.stateOperators[0]
    assert progress.numRowsTotal == 21 and progress.numRowsUpdated == 1  # only the new key
    assert os.path.isdir(f"{scratch}/cp/claims/state")


def test_many_sources_in_a_digest(spark, scratch):
    from trafficwatch.streaming.alerting import sent_digests

    rows = [(f"k{i}", alert_value(f"10.0.{i // 256}.{i % 256}", END), 100.0 + (i % 3)) for i in range(700)]
    job = run_alerts(spark, scratch, [rows[:400], rows[300:]], AlertConfig())
    job.drain()
    (one,) = sent_digests(spark, job.folder).collect()
    assert (one.alerts, one.ip_count, one.request_count_sum) == (700, 700, 28000.0)
    assert one.ips == [v for _, v in sorted((100 + i % 3, f"10.0.{i // 256}.{i % 256}") for i in range(700))][:50]


def test_digests_that_open_and_close_in_a_batch_leave_the_store_alone(spark, scratch):
    """Only the digest that stays open is written: its sums and the parts of its sources."""
    from trafficwatch.streaming.alerting import sent_digests

    rows = [(f"k{i}", alert_value(f"10.0.0.{i}", END), 100.0 + i) for i in range(200)]  # 20 digests of 10 seconds
    job = run_alerts(spark, scratch, [rows[:195]], AlertConfig())
    (state,) = job.digests.lastProgress.stateOperators
    assert state.numRowsUpdated <= 1 + 5  # 196 where every second writes its sources
    # the open one goes on from the store, with a source that it has and one that it has not
    again = [("again", alert_value("10.0.0.190", END), 290.5), *rows[195:]]
    job = run_alerts(spark, scratch, [again], AlertConfig())
    job.drain()
    got = sorted((r.opened_at.timestamp(), r.alerts, r.ip_count, tuple(r.ips)) for r in sent_digests(spark, job.folder).collect())
    want = [(100.0 + 10 * d, 10, 10, tuple(f"10.0.0.{10 * d + i}" for i in range(10))) for d in range(20)]
    want[19] = (290.0, 11, 10, want[19][3])
    assert got == want


def test_replay_of_alerts_uses_every_core_and_bounds_its_batches(spark, monkeypatch):
    """Files and state partitions by the cores, micro-batches by the records."""
    from trafficwatch.streaming import replay
    from trafficwatch.streaming.alerting import outcome_counts, sent_digests

    rows = [(f"k{i}", alert_value(str(i % 7), END), 100.0 + i / 10) for i in range(400)]
    sent = spark.createDataFrame(rows, "key string, value string, s double").select("key", "value", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")).alias("arrival"))
    jobs, real = [], replay.run_alerting

    def run(*a, **b):
        jobs.append(real(*a, **b))
        return jobs[-1]

    monkeypatch.setattr(replay, "run_alerting", run)
    monkeypatch.setattr(replay, "RECORDS_PER_CHUNK", 80, raising=False)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    folder = replay.replay_alerting(spark, sent, AlertConfig())
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    progress = [p for p in jobs[0].claims.recentProgress if p.numInputRows]
    assert len(progress) >= 5 and sum(p.numInputRows for p in progress) == 400
    assert max(p.numInputRows for p in progress) < 200
    assert progress[0].stateOperators[0].numShufflePartitions == spark.sparkContext.defaultParallelism
    assert {r[0]: r[1] for r in outcome_counts(spark, folder).collect()} == {"accepted": 400}
    assert sorted((r.opened_at.timestamp(), r.alerts, r.ip_count) for r in sent_digests(spark, folder).collect()) == [(100.0 + 10 * d, 100, 7) for d in range(4)]


def test_digests_off_send_every_alert_alone(spark, scratch):
    from trafficwatch.streaming.alerting import sent_digests

    groups = [[(k, alert_value(k, END), 1.0) for k in "abc"]]
    job = run_alerts(spark, scratch, groups, AlertConfig(batch_window_seconds=0))
    assert sorted(r.ips[0] for r in sent_digests(spark, job.folder).collect()) == ["a", "b", "c"]


def test_replayed_batch_leaves_the_store_as_it_is(spark, scratch):
    from trafficwatch.operators.store import latest_alerts, read_alerts
    from trafficwatch.plans import queries as Q
    from trafficwatch.streaming.detection import make_sink

    batch = Q.alerts(spark, "/root/testdata/sf0.001")
    sink = make_sink(store_path=f"{scratch}/store")
    sink(batch, 3)
    before = sorted(map(str, read_alerts(spark, f"{scratch}/store").collect()))
    sink(batch, 3)
    again = read_alerts(spark, f"{scratch}/store")
    assert sorted(map(str, again.collect())) == before
    assert latest_alerts(again).count() == len(before)


def test_expanded_windows_equal_the_grain_plan(spark):
    from trafficwatch.operators.rules import all_rules
    from trafficwatch.plans import queries as Q

    reqs = Q.requests(spark, "/root/testdata/sf0.001")
    one, two = (sorted(map(str, detect_rules(reqs, all_rules(), exact=True, plan=p).collect())) for p in ("grain", "expanded"))
    assert one == two and len(one) == 47


def test_outcome_log_sums_over_its_interval(caplog):
    from trafficwatch.streaming.alerting import OutcomeLog

    stats = OutcomeLog(10)
    stats.clock = lambda: stats.since + 5
    stats.add({"accepted": 2})
    assert not caplog.records and stats.sums == {"accepted": 2}
    stats.clock = lambda: 10_000_000.0
    with caplog.at_level("INFO"):
        stats.add({"accepted": 1, "invalid": 4})
    assert "consumed 7" in caplog.text and stats.sums == {}
