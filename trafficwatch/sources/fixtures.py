"""Request traffic derived from the driver's ``events`` table.

``events`` spans 30 days, far too sparse for 2-60 s windows, so event time is
rebuilt from ``event_id`` at one request per 5 ms; blocks of 160 events cycle
through six traffic phases (normal, flood, botnet, search flood, scanning,
slowloris).  The same projection is written in DuckDB SQL in
``trafficwatch.plans.oracle.TRAFFIC_SQL``; both engines give identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The fixture projection (one SQL expression per request field).
_PHASE = "CAST(floor(event_id / 160) AS BIGINT) % 6"

TRAFFIC_EXPRS = (
    "CAST(1704067200000 + event_id * 5 AS BIGINT) AS `timestamp`",
    """CASE phase WHEN 1 THEN '10.0.1.1' WHEN 2 THEN '10.0.2.' || (user_id % 3) WHEN 3 THEN '10.0.3.1'
         WHEN 4 THEN '10.0.4.' || (user_id % 2) WHEN 5 THEN '10.0.5.' || (user_id % 3)
         ELSE '10.1.0.' || user_id END AS src_ip""",
    "'10.0.0.1' AS dst_ip",
    "'HTTP/1.1' AS protocol",
    "CASE WHEN phase IN (4, 5) THEN 'GET' WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method",
    """CASE phase WHEN 4 THEN 'Nmap-Scanner/7.9' WHEN 5 THEN 'Slowloris-Lib/1.1'
         ELSE 'Mozilla/5.0' END AS user_agent""",
    """CASE phase WHEN 1 THEN '/api/v1/login?nonce=' || event_id
         WHEN 2 THEN CASE WHEN user_id % 3 = 2 THEN '/cart'
           ELSE CASE event_id % 5 WHEN 0 THEN '/home?session_id=' || user_id
             WHEN 1 THEN '/products/' || (1000 + user_id) || '?ref=home'
             WHEN 2 THEN '/cart' WHEN 3 THEN '/blog/p' || (user_id % 9) || '?utm_medium=cpc'
             ELSE '/api/v1/users/' || user_id || '/profile' END END
         WHEN 3 THEN CASE event_id % 3 WHEN 0 THEN '/search?q=x' WHEN 1 THEN '/api/v1/search?limit=50'
           ELSE '/api/v1/report/export?format=csv' END
         WHEN 4 THEN CASE event_id % 4 WHEN 0 THEN '/.env' WHEN 1 THEN '/wp-admin'
           WHEN 2 THEN '/admin/config.php' ELSE '/etc/passwd' END
         WHEN 5 THEN CASE event_id % 3 WHEN 0 THEN '/' WHEN 1 THEN '/api/v1/login' ELSE '/api/v1/search' END
         ELSE '/products?page=' || (event_id % 5) END AS request_url""",
    """CAST(CASE phase WHEN 3 THEN CASE WHEN event_id % 10 < 6 THEN 503 ELSE 200 END
         WHEN 4 THEN CASE WHEN user_id % 2 = 0 AND event_id % 10 < 8 THEN 404 ELSE 200 END
         WHEN 5 THEN CASE WHEN event_id % 10 < 9 THEN 408 ELSE 200 END
         ELSE CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 302 ELSE 200 END END
       AS INT) AS status_code""",
    """CAST(CASE WHEN phase = 5 AND user_id % 3 < 2 THEN 16 + event_id % 80
         ELSE 129 + event_id % 900 END AS INT) AS response_size""",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def traffic_from_events(events: DataFrame) -> DataFrame:
    """Raw request events (REQUEST_SCHEMA columns) projected from ``events``."""
    return events.selectExpr("*", f"{_PHASE} AS phase").selectExpr(*TRAFFIC_EXPRS)


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic_from_events(read_table(spark, sf_dir, "events"))


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Wire records of detected alerts, as an update-mode stream would carry them.

    Every alert yields three records: emission 0 at window_end is a damaged
    copy of the first emission (cut to 40 characters, so not JSON);
    emission 1 one second later carries half the final request count;
    emission 2 one second after that is the final row.
    Columns: key, value, arrival, emission.
    """
    from pyspark.sql import functions as F

    from trafficwatch.functions.alerts import alert_json, alert_key

    em = alerts.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("emission"))
    em = em.withColumn(
        "request_count",
        F.when(F.col("emission") < 2, F.expr("request_count div 2")).otherwise(F.col("request_count")),
    ).withColumn("detected_at", F.timestamp_micros(F.unix_micros("window_end") + F.col("emission") * 1_000_000))
    value = alert_json()
    return em.select(
        alert_key().alias("key"),
        F.when(F.col("emission") == 0, F.substring(value, 1, 40)).otherwise(value).alias("value"),
        F.col("detected_at").alias("arrival"),
        "emission",
    )
