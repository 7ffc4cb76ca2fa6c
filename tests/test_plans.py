"""Physical plan shape: scans, shuffles and state operators stay as designed."""

import re

import pytest
from conftest import SF_SMALL

from trafficwatch.config import DetectionConfig
from trafficwatch.operators.detect import detect, detect_rules
from trafficwatch.operators.rules import main_rules
from trafficwatch.plans import queries as Q


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(pattern: str, text: str) -> int:
    return len(re.findall(pattern, text))


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are once the side tables outgrow a broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n in names:
        spark.conf.unset(n)


def test_default_batch_plan_is_one_scan(spark, no_broadcast):
    """Two shuffles of rows; with the path rule a third one of sums per window and part."""
    for config, shuffles in ((DetectionConfig(), 3), (DetectionConfig(heavy_url_rule=False), 2), (DetectionConfig(fast_rules=True), 3)):
        text = plan_text(detect(Q.requests(spark, SF_SMALL), config))
        assert count(r"FileScan parquet", text) == 1
        assert count(r"Exchange hashpartitioning", text) == shuffles
        assert "Join" not in text and "Expand" not in text and "Union" not in text


def test_a_hot_path_is_spread(spark):
    """One path with a third of all requests in one minute: no task of the dealt panes has twice the median."""
    from pyspark.sql import functions as F

    from trafficwatch.operators import windows as W

    rows = spark.range(60_000).selectExpr(
        "CAST(CAST(id % 20011 AS STRING) AS STRING) AS src_ip",
        "timestamp_millis(1704067200000 + id % 60000) AS timestamp",
        "IF(id % 3 = 0, '/hot', concat('/p', id % 5000)) AS request_path",
        "'GET' AS method", "'2xx' AS status_category", "200 AS status_code", "500 AS response_size",
    )
    spec = W.WindowSpec("60s", 60, 60, "request_path")
    dealt, _ = W._blocked(W.pane_counts(rows, 60), [W._Family(spec, W._PATH, 1, 1)])
    sizes = sorted(r[1] for r in dealt.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]
    hot = W.path_windows_exact(rows, spec).filter("request_path = '/hot'").collect()
    assert [(r.path_request_count, r.unique_src_ip) for r in hot] == [(20_000, rows.filter("request_path = '/hot'").select("src_ip").distinct().count())]


def test_main_rules_share_one_aggregate(spark):
    df = detect_rules(Q.requests(spark, SF_SMALL), main_rules(), exact=False, plan="windowed")
    text = plan_text(df)
    assert count(r"FileScan parquet", text) == 1
    assert count(r"Exchange hashpartitioning", text) == 1


def test_scan_reads_only_needed_columns(spark):
    df = Q.q_detect_all(spark, SF_SMALL)
    text = plan_text(df)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all(set(s.split(",")) <= {"event_id:bigint", "user_id:bigint", "event_type:string"} for s in schemas)


def test_stream_reads_once_and_holds_one_state(spark, scratch):
    """All rules of all window families share one stateful aggregate and one read of the source."""
    from pyspark.sql import functions as F

    from trafficwatch.streaming.detection import run_detection

    tr = Q.traffic(spark, SF_SMALL)
    tr.select(F.to_json(F.struct(*tr.columns)).alias("value")).write.parquet(f"{scratch}/in")
    wire = spark.readStream.schema("value string").parquet(f"{scratch}/in")
    q = run_detection(wire, f"{scratch}/cp", DetectionConfig(fast_rules=True, heavy_url_rule=True),
                      store_path=f"{scratch}/store", stats=True, available_now=True)
    q.awaitTermination()
    text = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    assert count(r"StateStoreSave", text) == 1
    assert count(r"StateStoreRestore", text) == 1
    assert sum(p["numInputRows"] for p in q.recentProgress) == tr.count()


def test_reports_prune_the_store_by_date(spark):
    rows = Q.store(spark, SF_SMALL)
    assert rows.select("alert_date").distinct().count() == 2
    pruned = Q.time_range(Q.latest_alerts(rows), Q._now(rows), 300)
    text = plan_text(pruned)
    filters = re.findall(r"PartitionFilters: \[([^\n]*?)\], PushedFilters", text)
    assert any("alert_date" in f for f in filters)
    assert pruned.count() > 0
