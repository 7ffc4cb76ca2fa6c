"""Row-level classification of HTTP requests, as Spark SQL text.

Everything here is a built-in Catalyst expression, so it stays inside
whole-stage codegen and works identically on batch and streaming frames.  As
text, a whole select list costs one call into the JVM; ``F.expr`` makes a
Column of it.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# URL classes, checked in this order, first match wins.
# Each entry is (kind, patterns, url_type); kind "exact" compares the whole
# path, kind "prefix" uses startswith.
# ---------------------------------------------------------------------------
URL_TYPE_RULES = (
    ("exact", ("/search", "/api/v1/search"), "search_url"),
    ("exact", ("/", "/home", "/about", "/contact"), "site_page_url"),
    ("exact", ("/cart",), "cart_page_url"),
    ("prefix", ("/products/",), "product_detail_url"),
    ("exact", ("/products",), "product_list_url"),
    ("exact", ("/blog",), "blog_list_url"),
    ("prefix", ("/blog/",), "blog_detail_url"),
    ("prefix", ("/api/v1/login",), "api_login_url"),
    ("prefix", ("/api/v1/cart/items",), "api_cart_url"),
    ("prefix", ("/api/v1/users/",), "api_user_profile_url"),
    ("exact", ("/api/v1/report/export",), "api_report_export_url"),
    ("exact", ("/.env", "/wp-admin", "/admin/config.php", "/etc/passwd"), "scan_url"),
)
OTHER_URL = "other_url"

# Traffic classes over url_type (they overlap on purpose).
SCAN_TYPES = ("scan_url",)
SEARCH_TYPES = ("search_url",)
SEARCH_FOCUS_TYPES = ("search_url", "api_report_export_url", "api_login_url")
TRAFFIC_CLASSES = ("all", "non_scan", "non_scan_non_search", "search_focus", "scan_only")

# Status codes that look like time-outs, and the tiny-response bound.
TIMEOUT_LIKE_CODES = (408, 429, 503, 504)
TINY_RESPONSE_MAX_BYTES = 128
ERROR_CATEGORIES = ("4xx", "5xx")


def sql_str(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def request_path_sql(url: str) -> str:
    """Text before the first '?'; null stays null, '?a=1' gives ''."""
    return rf"split({url}, '\\?')[0]"


def url_type_sql(path: str) -> str:
    """Ordered CASE over URL_TYPE_RULES; a null path falls through to other_url."""
    branches = []
    for kind, patterns, label in URL_TYPE_RULES:
        if kind == "exact":
            cond = f"{path} IN ({', '.join(sql_str(p) for p in patterns)})"
        else:
            cond = " OR ".join(f"startswith({path}, {sql_str(p)})" for p in patterns)
        branches.append(f"WHEN {cond} THEN {sql_str(label)}")
    return f"CASE {' '.join(branches)} ELSE {sql_str(OTHER_URL)} END"


def status_category_sql(code: str) -> str:
    return (
        f"CASE WHEN {code} BETWEEN 200 AND 299 THEN '2xx' WHEN {code} BETWEEN 400 AND 499 THEN '4xx' "
        f"WHEN {code} BETWEEN 500 AND 599 THEN '5xx' ELSE 'other' END"
    )


def _in_list(col: str, values) -> str:
    return f"{col} IN ({', '.join(sql_str(v) for v in values)})"


def in_class_sql(traffic_class: str, utype: str) -> str:
    """Membership of a url_type in one of TRAFFIC_CLASSES (never null)."""
    if traffic_class == "all":
        return "true"
    if traffic_class == "scan_only":
        return _in_list(utype, SCAN_TYPES)
    if traffic_class == "non_scan":
        return f"NOT {_in_list(utype, SCAN_TYPES)}"
    if traffic_class == "non_scan_non_search":
        return f"NOT {_in_list(utype, SCAN_TYPES + SEARCH_TYPES)}"
    if traffic_class == "search_focus":
        return _in_list(utype, SEARCH_FOCUS_TYPES)
    raise ValueError(f"unknown traffic class {traffic_class!r}")


def is_error_sql(category: str) -> str:
    return f"coalesce({_in_list(category, ERROR_CATEGORIES)}, false)"


def is_timeout_like_sql(code: str) -> str:
    return f"coalesce({code} IN ({', '.join(str(c) for c in TIMEOUT_LIKE_CODES)}), false)"


def is_tiny_response_sql(size: str) -> str:
    """response_size <= 128; a null size is not tiny."""
    return f"coalesce({size} <= {TINY_RESPONSE_MAX_BYTES}, false)"


def safe_ratio_sql(num: str, den: str) -> str:
    """num / den when den > 0 else 0.0 (ANSI-safe: no division by zero)."""
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE 0.0D END"
