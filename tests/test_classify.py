from pyspark.sql import functions as F

from trafficwatch.functions.classify import request_path_sql, status_category_sql, url_type_sql
from trafficwatch.operators.normalize import normalize
from trafficwatch.schema import NORMALIZED_COLUMNS, REQUEST_SCHEMA
from trafficwatch.sources.requests import decode_requests

URLS = [
    ("/search", "search_url"), ("/api/v1/search?limit=5", "search_url"), ("/api/v1/search/", "other_url"),
    ("/", "site_page_url"), ("/home?x=1", "site_page_url"), ("/about", "site_page_url"), ("/contact", "site_page_url"),
    ("/cart", "cart_page_url"), ("/products/1", "product_detail_url"), ("/products", "product_list_url"),
    ("/productsX", "other_url"), ("/blog", "blog_list_url"), ("/blog/p1", "blog_detail_url"),
    ("/api/v1/login", "api_login_url"), ("/api/v1/loginX", "api_login_url"), ("/api/v1/cart/items/3", "api_cart_url"),
    ("/api/v1/users/7/profile", "api_user_profile_url"), ("/api/v1/report/export?f=csv", "api_report_export_url"),
    ("/api/v1/report/export/x", "other_url"), ("/.env", "scan_url"), ("/wp-admin", "scan_url"),
    ("/admin/config.php", "scan_url"), ("/etc/passwd", "scan_url"), ("?a=1", "other_url"), (None, "other_url"),
]


def test_url_types(spark):
    df = spark.createDataFrame([(u,) for u, _ in URLS], "u string")
    got = [r["t"] for r in df.select(F.expr(url_type_sql(request_path_sql("u"))).alias("t")).collect()]
    assert got == [t for _, t in URLS]


def test_request_path_edges(spark):
    df = spark.createDataFrame([("?a=1",), (None,), ("/a?b?c",)], "u string")
    assert [r[0] for r in df.select(F.expr(request_path_sql("u"))).collect()] == ["", None, "/a"]


def test_status_bounds(spark):
    codes = [199, 200, 299, 300, 399, 400, 499, 500, 599, 600, None]
    want = ["other", "2xx", "2xx", "other", "other", "4xx", "4xx", "5xx", "5xx", "other", "other"]
    df = spark.createDataFrame([(c,) for c in codes], "c int")
    assert [r[0] for r in df.select(F.expr(status_category_sql("c"))).collect()] == want


def test_decode_and_normalize(spark):
    wire = spark.createDataFrame(
        [
            ('{"timestamp": 1704067205000, "src_ip": "a", "request_url": "/x?q", "status_code": 404, "payload_size": 9}',),
            ("not json",),
            (None,),
            ('{"timestamp": "x", "src_ip": "b"}',),
            ('{"status_code": "500"}',),
        ],
        "value string",
    )
    rows = normalize(decode_requests(wire)).collect()
    assert tuple(rows[0].asDict()) == NORMALIZED_COLUMNS
    assert rows[0]["request_path"] == "/x" and rows[0]["status_category"] == "4xx"
    assert rows[0]["timestamp"].isoformat().startswith("2024-01-01T00:00:05")
    assert all(v is None for k, v in rows[1].asDict().items() if k not in ("url_type", "status_category"))
    assert rows[3]["timestamp"] is None and rows[3]["src_ip"] == "b"
    assert rows[4]["status_code"] is None
    assert len(REQUEST_SCHEMA.fields) == 9


def test_kafka_options():
    from trafficwatch.config import StreamConfig
    from trafficwatch.sources.requests import kafka_options

    opts = kafka_options("broker:9092", "network-traffic", StreamConfig(max_offsets_per_trigger=3000))
    assert opts == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "network-traffic",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "3000",
    }
