"""Rule boundaries: one below / at every threshold and ratio, on both plans."""

import pytest
from pyspark.sql import functions as F

from trafficwatch.operators.detect import detect_rules
from trafficwatch.operators.normalize import normalize
from trafficwatch.operators.rules import all_rules
from trafficwatch.schema import REQUEST_SCHEMA

T0 = 1704067200000  # 2024-01-01T00:00:00Z


def req(ip, url, status=200, size=500, method="GET", ms=T0 + 2000):
    return (ms, ip, "10.0.0.1", "HTTP/1.1", method, "ua", url, status, size)


def run(spark, rows, plan, attack, window="5s"):
    df = normalize(spark.createDataFrame(rows, REQUEST_SCHEMA))
    out = detect_rules(df, all_rules(), exact=True, plan=plan)
    return out.filter((F.col("attack_type") == attack) & (F.col("window_size") == window)).collect()


PLANS = ["grain", "windowed"]


@pytest.mark.parametrize("plan", PLANS)
def test_http_flood(spark, plan):
    assert len(run(spark, [req("a", "/home")] * 149, plan, "http_flood")) == 0
    hits = run(spark, [req("a", "/home")] * 150, plan, "http_flood")
    assert len(hits) == 5  # every 5 s window holding that second
    assert {h["request_count"] for h in hits} == {150} and {h["rps"] for h in hits} == {30.0}
    assert {h["severity"] for h in hits} == {"critical"} and {h["severity_rank"] for h in hits} == {2}


@pytest.mark.parametrize("plan", PLANS)
def test_botnet_needs_three_paths(spark, plan):
    three = [req("b", p) for p in ("/home", "/cart", "/blog/x")] * 14  # 42 requests, 3 paths
    two = [req("b", p) for p in ("/home", "/cart")] * 21
    assert len(run(spark, three, plan, "botnet")) == 5
    assert len(run(spark, two, plan, "botnet")) == 0
    assert len(run(spark, three[:39], plan, "botnet")) == 0


@pytest.mark.parametrize("plan", PLANS)
def test_search_flood(spark, plan):
    assert len(run(spark, [req("s", "/search?q=1")] * 119, plan, "search_flood")) == 0
    assert len(run(spark, [req("s", "/api/v1/report/export")] * 120, plan, "search_flood")) == 5


@pytest.mark.parametrize("plan", PLANS)
def test_scanning_error_ratio(spark, plan):
    at = [req("x", "/.env", 404)] * 20 + [req("x", "/wp-admin", 200)] * 20
    below = [req("x", "/.env", 404)] * 19 + [req("x", "/wp-admin", 200)] * 21
    hits = run(spark, at, plan, "scanning")
    assert len(hits) == 5 and {h["error_ratio"] for h in hits} == {0.5}
    assert len(run(spark, below, plan, "scanning")) == 0


def slow(timeouts=9, tiny=18, methods=("GET",), paths=("/",), n=30):
    rows = []
    for i in range(n):
        rows.append(
            req(
                "z",
                paths[i % len(paths)],
                408 if i < timeouts else 200,
                16 if i < tiny else 129,
                methods[i % len(methods)],
            )
        )
    return rows


@pytest.mark.parametrize("plan", PLANS)
def test_slowloris_bounds(spark, plan):
    assert len(run(spark, slow(), plan, "slowloris")) == 5
    assert len(run(spark, slow(timeouts=8), plan, "slowloris")) == 0
    assert len(run(spark, slow(tiny=17), plan, "slowloris")) == 0
    assert len(run(spark, slow(methods=("GET", "POST")), plan, "slowloris")) == 5
    assert len(run(spark, slow(methods=("GET", "POST", "HEAD")), plan, "slowloris")) == 0
    assert len(run(spark, slow(paths=("/", "/a", "/b")), plan, "slowloris")) == 5
    assert len(run(spark, slow(paths=("/", "/a", "/b", "/c")), plan, "slowloris")) == 0
    assert len(run(spark, slow(n=29, timeouts=9, tiny=18), plan, "slowloris")) == 0


@pytest.mark.parametrize("plan", PLANS)
def test_fast_rules(spark, plan):
    assert len(run(spark, [req("f", "/home")] * 100, plan, "http_flood", "2s")) == 2
    assert len(run(spark, [req("f", "/home")] * 99, plan, "http_flood", "2s")) == 0
    hits = run(spark, [req("f", "/.env", 404)] * 28, plan, "scanning", "2s")
    assert len(hits) == 2 and {h["severity"] for h in hits} == {"warning"} and {h["severity_rank"] for h in hits} == {1}


@pytest.mark.parametrize("plan", PLANS)
def test_heavy_url(spark, plan):
    def burst(n, ips):
        return [req(f"10.9.0.{i % ips}", "/products?page=1", ms=T0 + (i % 50) * 1000) for i in range(n)]

    hits = run(spark, burst(1440, 20), plan, "distributed_heavy_url", "60s")
    assert len(hits) == 1
    h = hits[0]
    assert h["src_ip"] is None and h["unique_path_count"] == 20 and h["severity_rank"] == 2
    assert h["signal_reason"] == "distributed_spike_on_path:/products"
    assert len(run(spark, burst(1440, 19), plan, "distributed_heavy_url", "60s")) == 0
    assert len(run(spark, burst(1439, 20), plan, "distributed_heavy_url", "60s")) == 0


@pytest.mark.parametrize("plan", PLANS)
def test_window_edge_and_null_time(spark, plan):
    rows = [req("e", "/home", ms=T0 + 5000)] * 150 + [(None, "e", None, None, "GET", None, "/home", 200, 1)] * 10
    hits = run(spark, rows, plan, "http_flood")
    starts = sorted(int(h["window_start"].timestamp()) - T0 // 1000 for h in hits)
    assert starts == [1, 2, 3, 4, 5]
    assert {h["request_count"] for h in hits} == {150}


def test_prefilter_pigeonhole_edge(spark):
    """Evenly spread traffic at exactly the bound (6/s for 5 s = 30) still fires with the prefilter."""
    def spread(per_second, seconds=5):
        rows = []
        for s in range(seconds):
            for i in range(per_second):
                rows.append(req("p", "/", 408, 16, "GET", ms=T0 + 10_000 + s * 1000 + i))
        return rows

    for per_second, fires in ((6, True), (5, False)):
        df = normalize(spark.createDataFrame(spread(per_second), REQUEST_SCHEMA))
        with_pf = detect_rules(df, all_rules(), exact=True, plan="grain", prefilter=True)
        without = detect_rules(df, all_rules(), exact=True, plan="grain", prefilter=False)
        a = sorted(tuple(r) for r in with_pf.collect())
        b = sorted(tuple(r) for r in without.collect())
        assert a == b
        slow = [r for r in a if r[4] == "slowloris"]
        assert bool(slow) == fires
        if fires:
            assert len(slow) == 1 and slow[0][7] == 30  # only the window covering all 5 seconds


@pytest.mark.parametrize("plan", PLANS)
def test_null_source_is_its_own_group(spark, plan):
    hits = run(spark, [req(None, "/home")] * 150, plan, "http_flood")
    assert len(hits) == 5 and {h["src_ip"] for h in hits} == {None}
