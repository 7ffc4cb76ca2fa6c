"""Every registered query against its DuckDB statement (order-insensitive)."""

import duckdb
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

from conftest import SF_SMALL
from oracle_check import compare, duck

import __spark_entry__ as entry_mod
from trafficwatch.plans import oracle, queries

QUERIES = queries.registry()
ORACLE = oracle.registry()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert ok, f"{name}: {msg}"


def test_latest_alerts_of_traffic_that_crosses_midnight(spark, scratch):
    events = pq.read_table(f"{SF_SMALL}/events.parquet")
    events = events.filter(pc.less(events["event_id"], 960))
    midnight = 24 * 3600 * 200  # at 5 ms per event
    days = [events.set_column(0, "event_id", pc.add(events["event_id"], midnight + shift)) for shift in (-960, 0)]
    pq.write_table(pa.concat_tables(days), f"{scratch}/events.parquet")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{scratch}/events.parquet')")
    got = QUERIES["latest_alerts"](spark, scratch)
    assert got.select("alert_date").distinct().count() == 2
    ok, msg = compare(got, con, ORACLE["latest_alerts"])
    assert ok, msg


def test_entry(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 47  # FIXTURES: all rules at sf0.001
    assert df.columns[:3] == ["src_ip", "window_start", "window_end"]


def test_alert_json_roundtrip(spark):
    rows = QUERIES["alert_json"](spark, SF_SMALL).collect()
    assert len(rows) == 47
    path_alerts = [r for r in rows if r["key"].startswith("distributed_heavy_url")]
    assert all('"src_ip"' not in r["value"] for r in path_alerts)
    assert all('.000Z"' in r["value"] for r in rows)
