"""Normalisation of decoded request events (one projection, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trafficwatch.functions.classify import request_path_sql, status_category_sql, url_type_sql

_MAX_MILLIS = 2**63 // 1000 - 1  # a TIMESTAMP holds microseconds in 64 bits
_PATH = request_path_sql("request_url")


def normalize(raw: DataFrame) -> DataFrame:
    """Decoded requests -> the 11 normalised columns (dst_ip is dropped).

    Event time is epoch milliseconds turned into a TIMESTAMP exactly
    (``timestamp_millis``); rows whose time is null, or beyond the range of a
    TIMESTAMP (then null), keep flowing and are only dropped by the event-time
    windows downstream.
    """
    code = "CAST(status_code AS INT)"
    return raw.selectExpr(
        f"IF(CAST(`timestamp` AS BIGINT) BETWEEN -{_MAX_MILLIS}L AND {_MAX_MILLIS}L, timestamp_millis(CAST(`timestamp` AS BIGINT)), NULL) AS `timestamp`",
        "src_ip",
        "protocol",
        "method",
        "user_agent",
        "request_url",
        f"{_PATH} AS request_path",
        f"{url_type_sql(_PATH)} AS url_type",
        f"{code} AS status_code",
        "CAST(response_size AS INT) AS response_size",
        f"{status_category_sql(code)} AS status_category",
    )
