"""Windows from sketches: equal to the exact plan on few members, close to it on many."""

import re

from conftest import SF_SMALL
from test_plans import count, plan_text

from trafficwatch.operators import windows as W
from trafficwatch.operators.detect import detect_rules
from trafficwatch.operators.rules import FAST_WINDOW, MAIN_WINDOW, PATH_WINDOW, all_rules
from trafficwatch.operators.sketches import pane_sketches, sketch_measures
from trafficwatch.plans import queries as Q
from trafficwatch.schema import RULE_OUTPUT_COLUMNS

SPECS = [MAIN_WINDOW, FAST_WINDOW, PATH_WINDOW]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def many_sources(spark, sources: int):
    return spark.range(sources * 2).selectExpr(
        f"CAST(id % {sources} AS STRING) AS src_ip",
        "timestamp_millis(1704067200000 + id % 60000) AS timestamp",
        "'/hot' AS request_path", "'GET' AS method", "'5xx' AS status_category", "503 AS status_code", "CAST(NULL AS INT) AS response_size",
    )


def test_all_measures_equal_the_exact_plan(spark):
    requests = Q.requests(spark, SF_SMALL)
    for labels in (None, {"5s"}, set()):
        exact, sketch = (f(requests, SPECS, labels) for f in (W.grain_measures, sketch_measures))
        assert sketch.columns == exact.columns
        assert rows_of(sketch) == rows_of(exact)


def test_rules_equal_the_exact_plan(spark):
    requests = Q.requests(spark, SF_SMALL)
    exact, sketch = (detect_rules(requests, all_rules(), plan=p).select(*RULE_OUTPUT_COLUMNS) for p in ("grain", "sketch"))
    assert rows_of(sketch) == rows_of(exact)
    assert exact.count() > 0


def test_nulls_and_an_empty_table(spark):
    rows = spark.createDataFrame(
        [(None, 0, "/a", "GET"), ("1", 0, None, None), ("1", None, "/a", "GET"), ("1", 1, "", "PUT"), (None, 1, None, None)],
        "src_ip string, s int, request_path string, method string",
    ).selectExpr("*", "timestamp_seconds(s) AS timestamp", "CAST(NULL AS STRING) AS status_category", "CAST(NULL AS INT) AS status_code", "CAST(NULL AS INT) AS response_size")
    assert rows_of(sketch_measures(rows, SPECS)) == rows_of(W.grain_measures(rows, SPECS))
    assert sketch_measures(rows.filter("false"), SPECS).collect() == []


def test_error_on_many_members(spark):
    """Three standard errors of 2^12 buckets (1.04 / 64) on counts far beyond what a sketch holds exactly."""
    for sources in (3_000, 50_000, 200_000):
        (row,) = sketch_measures(many_sources(spark, sources), [PATH_WINDOW]).collect()
        assert row.path_request_count == row.path_error_count == 2 * sources
        assert abs(row.unique_src_ip / sources - 1) < 3 * 1.04 / 64


def test_a_hot_path_is_one_row_per_pane(spark):
    """However many members a pane has, one bounded row of it is left."""
    panes = pane_sketches(many_sources(spark, 100_000), 60, {False: False})
    (row,) = panes.selectExpr("octet_length(unique_path_count_all) AS bytes", "request_count_all AS n").collect()
    assert row.n == 200_000 and row.bytes < 6_000


def test_plan_is_one_scan_without_joins(spark):
    text = plan_text(detect_rules(Q.requests(spark, SF_SMALL), all_rules(), plan="sketch"))
    assert count(r"FileScan parquet", text) == 1
    assert count(r"Exchange hashpartitioning", text) == 3
    assert not re.search(r"Join|Expand|Union", text)
