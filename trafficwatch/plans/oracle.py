"""Independent DuckDB statements of every registered query.

They are written directly in SQL (not generated from the Spark code) so the
correctness check compares two separate formulations.  The driver registers
the parquet tables as views; ``traffic`` is rebuilt here as a CTE.
"""

from __future__ import annotations

TRAFFIC_SQL = """
traffic AS (
SELECT CAST(1704067200000 + event_id*5 AS BIGINT) AS "timestamp",
 CASE phase WHEN 1 THEN '10.0.1.1' WHEN 2 THEN '10.0.2.'||(user_id%3) WHEN 3 THEN '10.0.3.1'
   WHEN 4 THEN '10.0.4.'||(user_id%2) WHEN 5 THEN '10.0.5.'||(user_id%3) ELSE '10.1.0.'||user_id END AS src_ip,
 '10.0.0.1' AS dst_ip, 'HTTP/1.1' AS protocol,
 CASE WHEN phase IN (4,5) THEN 'GET' WHEN event_type='purchase' THEN 'POST' ELSE 'GET' END AS method,
 CASE phase WHEN 4 THEN 'Nmap-Scanner/7.9' WHEN 5 THEN 'Slowloris-Lib/1.1' ELSE 'Mozilla/5.0' END AS user_agent,
 CASE phase WHEN 1 THEN '/api/v1/login?nonce='||event_id
   WHEN 2 THEN CASE WHEN user_id%3=2 THEN '/cart'
     ELSE CASE event_id%5 WHEN 0 THEN '/home?session_id='||user_id WHEN 1 THEN '/products/'||(1000+user_id)||'?ref=home'
       WHEN 2 THEN '/cart' WHEN 3 THEN '/blog/p'||(user_id%9)||'?utm_medium=cpc' ELSE '/api/v1/users/'||user_id||'/profile' END END
   WHEN 3 THEN CASE event_id%3 WHEN 0 THEN '/search?q=x' WHEN 1 THEN '/api/v1/search?limit=50' ELSE '/api/v1/report/export?format=csv' END
   WHEN 4 THEN CASE event_id%4 WHEN 0 THEN '/.env' WHEN 1 THEN '/wp-admin' WHEN 2 THEN '/admin/config.php' ELSE '/etc/passwd' END
   WHEN 5 THEN CASE event_id%3 WHEN 0 THEN '/' WHEN 1 THEN '/api/v1/login' ELSE '/api/v1/search' END
   ELSE '/products?page='||(event_id%5) END AS request_url,
 CAST(CASE phase WHEN 3 THEN CASE WHEN event_id%10<6 THEN 503 ELSE 200 END
   WHEN 4 THEN CASE WHEN user_id%2=0 AND event_id%10<8 THEN 404 ELSE 200 END
   WHEN 5 THEN CASE WHEN event_id%10<9 THEN 408 ELSE 200 END
   ELSE CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 302 ELSE 200 END END AS INTEGER) AS status_code,
 CAST(CASE WHEN phase=5 AND user_id%3<2 THEN 16+event_id%80 ELSE 129+event_id%900 END AS INTEGER) AS response_size
FROM (SELECT *, CAST(floor(event_id/160) AS BIGINT) % 6 AS phase FROM events))"""

NORM_SQL = """
req0 AS (
SELECT "timestamp" AS ms, src_ip, protocol, method, user_agent, request_url,
       string_split(request_url, '?')[1] AS request_path, status_code, response_size
FROM traffic),
req AS (
SELECT ms, epoch_ms(ms) AS ts, src_ip, protocol, method, user_agent, request_url, request_path,
 CASE WHEN request_path IN ('/search','/api/v1/search') THEN 'search_url'
  WHEN request_path IN ('/','/home','/about','/contact') THEN 'site_page_url'
  WHEN request_path = '/cart' THEN 'cart_page_url'
  WHEN starts_with(request_path, '/products/') THEN 'product_detail_url'
  WHEN request_path = '/products' THEN 'product_list_url'
  WHEN request_path = '/blog' THEN 'blog_list_url'
  WHEN starts_with(request_path, '/blog/') THEN 'blog_detail_url'
  WHEN starts_with(request_path, '/api/v1/login') THEN 'api_login_url'
  WHEN starts_with(request_path, '/api/v1/cart/items') THEN 'api_cart_url'
  WHEN starts_with(request_path, '/api/v1/users/') THEN 'api_user_profile_url'
  WHEN request_path = '/api/v1/report/export' THEN 'api_report_export_url'
  WHEN request_path IN ('/.env','/wp-admin','/admin/config.php','/etc/passwd') THEN 'scan_url'
  ELSE 'other_url' END AS url_type,
 status_code, response_size,
 CASE WHEN status_code BETWEEN 200 AND 299 THEN '2xx' WHEN status_code BETWEEN 400 AND 499 THEN '4xx'
  WHEN status_code BETWEEN 500 AND 599 THEN '5xx' ELSE 'other' END AS status_category
FROM req0),
flags AS (
SELECT *, url_type = 'scan_url' AS c_scan, url_type <> 'scan_url' AS c_ns,
  url_type NOT IN ('scan_url','search_url') AS c_nsns,
  url_type IN ('search_url','api_report_export_url','api_login_url') AS c_sf,
  status_category IN ('4xx','5xx') AS err
FROM req WHERE ms IS NOT NULL)"""


def _src_agg(name: str, back: int) -> str:
    return f"""
{name} AS (
SELECT ws, src_ip,
 count(*) AS request_count_all,
 count(*) FILTER (WHERE c_ns) AS request_count_non_scan,
 count(*) FILTER (WHERE c_nsns) AS request_count_non_scan_non_search,
 count(*) FILTER (WHERE c_sf) AS request_count_search_focus,
 count(*) FILTER (WHERE c_scan) AS request_count_scan_only,
 count(DISTINCT request_path) AS unique_path_count_all,
 count(DISTINCT request_path) FILTER (WHERE c_ns) AS unique_path_count_non_scan,
 count(DISTINCT request_path) FILTER (WHERE c_nsns) AS unique_path_count_non_scan_non_search,
 count(DISTINCT request_path) FILTER (WHERE c_sf) AS unique_path_count_search_focus,
 count(DISTINCT request_path) FILTER (WHERE c_scan) AS unique_path_count_scan_only,
 count(DISTINCT method) AS method_variety,
 count(*) FILTER (WHERE err) AS error_count_all,
 count(*) FILTER (WHERE err AND c_ns) AS error_count_non_scan,
 count(*) FILTER (WHERE err AND c_nsns) AS error_count_non_scan_non_search,
 count(*) FILTER (WHERE err AND c_sf) AS error_count_search_focus,
 count(*) FILTER (WHERE err AND c_scan) AS error_count_scan_only,
 count(*) FILTER (WHERE status_code IN (408,429,503,504)) AS timeout_like_count_all,
 count(*) FILTER (WHERE response_size <= 128) AS tiny_response_count_all
FROM (SELECT *, unnest(generate_series(ms // 1000 - {back}, ms // 1000)) AS ws FROM flags)
GROUP BY ws, src_ip)"""


PATH_AGG = """
a60 AS (
SELECT ws, request_path, count(*) AS path_request_count, count(DISTINCT src_ip) AS unique_src_ip,
       count(*) FILTER (WHERE err) AS path_error_count
FROM (SELECT *, ms // 60000 * 60 AS ws FROM flags)
GROUP BY ws, request_path)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _ratio(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / {den} ELSE 0.0 END"


def _alert_select(src: str, agg: str, size: int, attack: str, severity: str, rank: int,
                  cls: str, threshold: str, reason: str, extra: str = "") -> str:
    cnt, uniq, err = f"request_count_{cls}", f"unique_path_count_{cls}", f"error_count_{cls}"
    where = f"{cnt} >= {threshold}" + (f" AND {extra}" if extra else "")
    return f"""SELECT {src} AS src_ip, make_timestamp(ws * 1000000) AS window_start,
 make_timestamp((ws + {size}) * 1000000) AS window_end, '{size}s' AS window_size,
 '{attack}' AS attack_type, '{severity}' AS severity, CAST({rank} AS INTEGER) AS severity_rank,
 CAST({cnt} AS BIGINT) AS request_count, CAST({cnt} AS DOUBLE) / {size} AS rps,
 CAST({uniq} AS BIGINT) AS unique_path_count, {_ratio(err, cnt)} AS error_ratio,
 {reason} AS signal_reason
FROM {agg} WHERE {where}"""


RULE_SQL = {
    "http_flood": _alert_select("src_ip", "a5", 5, "http_flood", "critical", 2, "non_scan", "150",
                                "'high_rps_general_http'"),
    "botnet": _alert_select("src_ip", "a5", 5, "botnet", "critical", 2, "non_scan_non_search", "40",
                            "'distributed_low_and_steady_rps'", "unique_path_count_non_scan_non_search >= 3"),
    "search_flood": _alert_select("src_ip", "a5", 5, "search_flood", "critical", 2, "search_focus", "120",
                                  "'heavy_db_or_login_endpoints'"),
    "scanning": _alert_select("src_ip", "a5", 5, "scanning", "critical", 2, "scan_only", "40",
                              "'suspicious_scan_endpoints'",
                              _ratio("error_count_scan_only", "request_count_scan_only") + " >= 0.5"),
    "slowloris": _alert_select("src_ip", "a5", 5, "slowloris", "critical", 2, "all", "30",
                               "'slow_connection_behavior'",
                               " AND ".join([
                                   _ratio("timeout_like_count_all", "request_count_all") + " >= 0.30",
                                   _ratio("tiny_response_count_all", "request_count_all") + " >= 0.60",
                                   "method_variety <= 2", "unique_path_count_all <= 3"])),
    "fast_http_flood": _alert_select("src_ip", "a2", 2, "http_flood", "warning", 1, "non_scan", "100",
                                     "'high_rps_general_http'"),
    "fast_scanning": _alert_select("src_ip", "a2", 2, "scanning", "warning", 1, "scan_only", "28",
                                   "'suspicious_scan_endpoints'",
                                   _ratio("error_count_scan_only", "request_count_scan_only") + " >= 0.5"),
    "heavy_url": """SELECT CAST(NULL AS VARCHAR) AS src_ip, make_timestamp(ws * 1000000) AS window_start,
 make_timestamp((ws + 60) * 1000000) AS window_end, '60s' AS window_size,
 'distributed_heavy_url' AS attack_type, 'warning' AS severity, CAST(2 AS INTEGER) AS severity_rank,
 CAST(path_request_count AS BIGINT) AS request_count, CAST(path_request_count AS DOUBLE) / 60 AS rps,
 CAST(unique_src_ip AS BIGINT) AS unique_path_count,
 """ + _ratio("path_error_count", "path_request_count") + """ AS error_ratio,
 'distributed_spike_on_path:' || request_path AS signal_reason
FROM a60 WHERE path_request_count >= 1440.0 AND unique_src_ip >= 20""",
}

RULE_AGG = {"fast_http_flood": "a2", "fast_scanning": "a2", "heavy_url": "a60"}


def detect_rule_sql(rule: str) -> str:
    agg = RULE_AGG.get(rule, "a5")
    cte = {"a5": _src_agg("a5", 4), "a2": _src_agg("a2", 1), "a60": PATH_AGG}[agg]
    return with_ctes(TRAFFIC_SQL, NORM_SQL, cte) + RULE_SQL[rule]


ALERTS_CTE = (
    _src_agg("a5", 4)
    + ","
    + _src_agg("a2", 1)
    + ","
    + PATH_AGG
    + ",\nalerts AS (\n"
    + "\nUNION ALL\n".join(RULE_SQL.values())
    + ")"
)


def detect_all_sql() -> str:
    return with_ctes(TRAFFIC_SQL, NORM_SQL, ALERTS_CTE) + "SELECT *, window_end AS detected_at FROM alerts"


def normalize_sql() -> str:
    return with_ctes(TRAFFIC_SQL, NORM_SQL) + """SELECT ts AS "timestamp", src_ip, protocol, method, user_agent,
 request_url, request_path, url_type, status_code, response_size, status_category FROM req"""


def url_type_counts_sql() -> str:
    return with_ctes(TRAFFIC_SQL, NORM_SQL) + """SELECT url_type, count(*) AS request_count,
 count(DISTINCT src_ip) AS source_count FROM req GROUP BY url_type"""


def status_category_counts_sql() -> str:
    return with_ctes(TRAFFIC_SQL, NORM_SQL) + """SELECT status_category, count(*) AS request_count,
 CAST(sum(response_size) AS BIGINT) AS response_bytes FROM req GROUP BY status_category"""


def source_windows_sql(size: int) -> str:
    back = size - 1
    return with_ctes(TRAFFIC_SQL, NORM_SQL, _src_agg("a", back)) + f"""SELECT make_timestamp(ws * 1000000) AS window_start,
 make_timestamp((ws + {size}) * 1000000) AS window_end, '{size}s' AS window_size, src_ip,
 request_count_all, request_count_non_scan, request_count_non_scan_non_search, request_count_search_focus,
 request_count_scan_only, unique_path_count_all, unique_path_count_non_scan, unique_path_count_non_scan_non_search,
 unique_path_count_search_focus, unique_path_count_scan_only, method_variety, error_count_all, error_count_non_scan,
 error_count_non_scan_non_search, error_count_search_focus, error_count_scan_only, timeout_like_count_all,
 tiny_response_count_all FROM a"""


def path_windows_sql() -> str:
    return with_ctes(TRAFFIC_SQL, NORM_SQL, PATH_AGG) + """SELECT make_timestamp(ws * 1000000) AS window_start,
 make_timestamp((ws + 60) * 1000000) AS window_end, '60s' AS window_size, request_path,
 CAST(path_request_count AS BIGINT) AS path_request_count, CAST(unique_src_ip AS BIGINT) AS unique_src_ip,
 CAST(path_error_count AS BIGINT) AS path_error_count,
 """ + _ratio("path_error_count", "path_request_count") + " AS path_error_ratio FROM a60"


def registry() -> dict[str, str]:
    out = {
        "normalize_requests": normalize_sql(),
        "url_type_counts": url_type_counts_sql(),
        "status_category_counts": status_category_counts_sql(),
        "source_windows_5s": source_windows_sql(5),
        "source_windows_2s": source_windows_sql(2),
        "path_windows_60s": path_windows_sql(),
    }
    for r in RULE_SQL:
        out[f"detect_{r}"] = detect_rule_sql(r)
    out["detect_all"] = detect_all_sql()
    out["detect_all_sketch"] = f"SELECT * EXCLUDE (unique_path_count) FROM ({detect_all_sql()})"
    out.update(alert_registry())
    return out


# ---------------------------------------------------------------------------
# Alert handling, store and reports.
# ---------------------------------------------------------------------------
KEY_TS = "strftime({c}, '%Y-%m-%d %H:%M:%S')"
ISO_TS = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%gZ')"

MSGS_CTE = """
msgs AS (
SELECT a.* REPLACE (CASE WHEN e.emission < 2 THEN a.request_count // 2 ELSE a.request_count END AS request_count),
 e.emission, (e.emission = 0) AS corrupt,
 a.window_end + to_seconds(e.emission) AS arrival,
 concat_ws('|', a.src_ip, a.attack_type, strftime(a.window_end, '%Y-%m-%d %H:%M:%S'), a.window_size) AS msg_key
FROM alerts a, (SELECT unnest([0, 1, 2]) AS emission) e),
gated AS (SELECT * FROM msgs WHERE NOT corrupt AND lower(severity) = 'critical'),
gpairs AS (SELECT msg_key AS k, arrival AS t, min(coalesce(signal_reason, '')) AS first FROM gated GROUP BY 1, 2),
dclaims(k, t) AS (
  SELECT k, min(t) FROM gpairs GROUP BY k
  UNION ALL
  SELECT k2, t2 FROM (SELECT c.k AS k2, min(p.t) AS t2 FROM dclaims c JOIN gpairs p
                      ON p.k = c.k AND p.t >= c.t + INTERVAL 300 SECOND GROUP BY c.k)),
won AS (SELECT p.k, p.t, p.first FROM gpairs p JOIN dclaims c USING (k, t)),
disp AS (
SELECT m.*, CASE WHEN corrupt THEN 'invalid' WHEN lower(severity) <> 'critical' THEN 'skipped_severity'
  WHEN w.k IS NOT NULL THEN 'accepted' ELSE 'duplicate' END AS disposition
FROM msgs m LEFT JOIN won w ON NOT m.corrupt AND lower(m.severity) = 'critical'
  AND w.k = m.msg_key AND w.t = m.arrival AND w.first = coalesce(m.signal_reason, '')),
acc AS (SELECT * FROM disp WHERE disposition = 'accepted'),
stored AS (
SELECT * EXCLUDE (emission, corrupt, arrival, msg_key) REPLACE (arrival AS detected_at),
 msg_key AS alert_key, arrival AS "@timestamp", CAST(arrival AS DATE) AS alert_date, CAST(emission AS BIGINT) AS batch_id
FROM msgs WHERE NOT corrupt),
latest AS (
SELECT * FROM stored
QUALIFY row_number() OVER (PARTITION BY alert_date, alert_key
  ORDER BY "@timestamp" DESC, batch_id DESC, signal_reason DESC NULLS LAST, severity_rank DESC, request_count DESC) = 1),
dash AS (SELECT * FROM latest WHERE "@timestamp" >= (SELECT max("@timestamp") FROM latest) - INTERVAL 300 SECOND
  AND "@timestamp" <= (SELECT max("@timestamp") FROM latest))"""

DIGEST_CTE = """
dk AS (
SELECT coalesce(attack_type, 'unknown') AS attack_type, coalesce(severity, 'unknown') AS severity,
 coalesce(window_size, 'unknown') AS window_size, coalesce(signal_reason, 'unknown') AS signal_reason,
 coalesce(src_ip, 'unknown') AS ip, arrival, window_end, CAST(request_count AS DOUBLE) AS rc, rps
FROM acc),
dk2 AS (SELECT *, concat_ws(chr(1), attack_type, severity, window_size, signal_reason) AS k FROM dk),
dpairs AS (SELECT DISTINCT k, arrival AS t FROM dk2),
opens(k, t) AS (
  SELECT k, min(t) FROM dpairs GROUP BY k
  UNION ALL
  SELECT k2, t2 FROM (SELECT c.k AS k2, min(p.t) AS t2 FROM opens c JOIN dpairs p
                      ON p.k = c.k AND p.t >= c.t + INTERVAL 10 SECOND GROUP BY c.k)),
assigned AS (SELECT d.*, (SELECT max(o.t) FROM opens o WHERE o.k = d.k AND o.t <= d.arrival) AS opened_at FROM dk2 d),
firsts AS (SELECT attack_type, severity, window_size, signal_reason, opened_at, ip, min(arrival) AS first_seen
  FROM assigned GROUP BY ALL),
iplists AS (SELECT attack_type, severity, window_size, signal_reason, opened_at,
  list(ip ORDER BY first_seen, ip)[1:50] AS ips FROM firsts GROUP BY ALL),
digests AS (
SELECT a.attack_type, a.severity, a.window_size, a.signal_reason, a.opened_at,
 min(window_end) AS window_end_min, max(window_end) AS window_end_max, any_value(l.ips) AS ips,
 count(DISTINCT ip) AS ip_count, CAST(sum(CAST(rc AS DECIMAL(38,12))) AS DOUBLE) AS request_count_sum,
 CAST(sum(CAST(rps AS DECIMAL(38,12))) AS DOUBLE) AS rps_sum, count(*) AS alerts
FROM assigned a JOIN iplists l USING (attack_type, severity, window_size, signal_reason, opened_at)
GROUP BY a.attack_type, a.severity, a.window_size, a.signal_reason, a.opened_at)"""


def _alerts_with(*extra: str) -> str:
    return "WITH RECURSIVE " + ",".join((TRAFFIC_SQL, NORM_SQL, ALERTS_CTE.replace(
        "\nalerts AS (\n", "\nalerts0 AS (\n"), "\nalerts AS (SELECT *, window_end AS detected_at FROM alerts0)") + extra) + "\n"


def alert_keys_sql() -> str:
    return _alerts_with() + """SELECT concat_ws('|', src_ip, attack_type, strftime(window_end, '%Y-%m-%d %H:%M:%S'), window_size) AS alert_key,
 concat_ws('|', coalesce(src_ip, 'unknown'), attack_type, strftime(window_end, '%Y-%m-%dT%H:%M:%S.%gZ'), window_size) AS fallback_key,
 signal_reason FROM alerts"""


def severity_gated_sql() -> str:
    return _alerts_with() + "SELECT * FROM alerts WHERE lower(severity) = 'critical'"


def dispositions_sql() -> str:
    return _alerts_with(MSGS_CTE) + "SELECT disposition, count(*) AS message_count FROM disp GROUP BY disposition"


def dedupe_ttl_sql() -> str:
    return """WITH RECURSIVE e AS (SELECT CAST(user_id AS VARCHAR) || '|' || event_type AS k, ts FROM events),
c(k, t) AS (
  SELECT k, min(ts) FROM e GROUP BY k
  UNION ALL
  SELECT k2, t2 FROM (SELECT c.k AS k2, min(e.ts) AS t2
                      FROM c JOIN e ON e.k = c.k AND e.ts >= c.t + INTERVAL 6 HOUR
                      GROUP BY c.k))
SELECT k, t FROM c"""


def alert_digest_sql() -> str:
    return _alerts_with(MSGS_CTE, DIGEST_CTE) + "SELECT * FROM digests"


def digest_text_sql() -> str:
    return _alerts_with(MSGS_CTE, DIGEST_CTE) + """SELECT attack_type, signal_reason, opened_at,
 'DDoS Alert' || chr(10) || 'IP: ' || (array_to_string(ips, ', ') ||
   CASE WHEN ip_count > len(ips) THEN ', ...(+' || CAST(ip_count - len(ips) AS VARCHAR) || ' more)' ELSE '' END)
 || chr(10) || 'Attack: ' || attack_type || chr(10) || 'Severity: ' || severity || chr(10)
 || 'Window: ' || window_size || ' ending ' || strftime(window_end_max, '%Y-%m-%dT%H:%M:%S.%gZ') || chr(10)
 || 'Requests: ' || printf('%.0f', request_count_sum) || ' | RPS: ' || printf('%.2f', rps_sum) || chr(10)
 || 'Reason: ' || signal_reason AS text
FROM digests"""


def alert_text_sql() -> str:
    return _alerts_with(MSGS_CTE) + """SELECT msg_key AS dedupe_key,
 'DDoS Alert' || chr(10) || 'IP: ' || coalesce(src_ip, 'unknown') || chr(10) || 'Attack: ' || attack_type || chr(10)
 || 'Severity: ' || severity || chr(10) || 'Window: ' || window_size || ' ending '
 || strftime(window_end, '%Y-%m-%dT%H:%M:%S.%gZ') || chr(10)
 || 'Requests: ' || CAST(request_count AS VARCHAR) || ' | RPS: ' || CAST(rps AS VARCHAR) || chr(10)
 || 'Reason: ' || signal_reason AS text
FROM acc"""


def latest_alerts_sql() -> str:
    return _alerts_with(MSGS_CTE) + "SELECT * FROM latest"


def retained_alerts_sql() -> str:
    return _alerts_with(MSGS_CTE, """
shifted AS (SELECT * REPLACE (CASE WHEN request_count % 2 = 0 THEN "@timestamp" - INTERVAL 2 DAY ELSE "@timestamp" END AS "@timestamp") FROM stored),
shifted2 AS (SELECT * REPLACE (CAST("@timestamp" AS DATE) AS alert_date) FROM shifted)""") + """SELECT * FROM shifted2
WHERE alert_date >= CAST((SELECT max("@timestamp") FROM shifted2) AS DATE) - 1"""


def bucket_sql(metric: str, how: str, name: str) -> str:
    agg = (f"sum({metric})" if how == "sum" else
           f"CAST(sum(CAST({metric} AS DECIMAL(38,12))) AS DOUBLE) / count({metric})")
    fill = f"coalesce(CAST(v AS BIGINT), 0)" if how == "sum" else "v"
    return _alerts_with(MSGS_CTE, f"""
bounds AS (SELECT epoch_us(max("@timestamp")) AS hi FROM latest),
series AS (SELECT unnest(generate_series((hi - 300000000) - ((hi - 300000000) % 5000000), hi - hi % 5000000, 5000000)) AS b FROM bounds),
vals AS (SELECT epoch_us("@timestamp") - epoch_us("@timestamp") % 5000000 AS b, {agg} AS v FROM dash GROUP BY 1)""") + f"""SELECT make_timestamp(s.b) AS bucket_start, {fill} AS {name}
FROM series s LEFT JOIN vals v USING (b)"""


def top_terms_sql(field: str) -> str:
    return _alerts_with(MSGS_CTE) + f"""SELECT {field}, count(*) AS alert_count FROM dash GROUP BY {field}
ORDER BY alert_count DESC, {field} ASC LIMIT 5"""


def recent_alerts_sql() -> str:
    return _alerts_with(MSGS_CTE) + """SELECT * FROM dash ORDER BY "@timestamp" DESC, alert_key ASC LIMIT 50"""


def alert_stats_sql() -> str:
    return _alerts_with() + "SELECT attack_type, count(*) AS alert_count FROM alerts GROUP BY attack_type"


def alert_json_sql() -> str:
    """The JSON text Spark's ``to_json`` writes: fields in schema order, nulls
    omitted, times as ISO-8601 UTC with milliseconds."""
    def s(c):
        return f"'\"{c}\":' || to_json({c})"

    def n(c):
        return f"'\"{c}\":' || CAST({c} AS VARCHAR)"

    def ts(c):
        return f"'\"{c}\":\"' || strftime({c}, '%Y-%m-%dT%H:%M:%S.%gZ') || '\"'"

    parts = [
        f"CASE WHEN src_ip IS NULL THEN NULL ELSE {s('src_ip')} END",
        ts("window_start"), ts("window_end"), s("window_size"), s("attack_type"), s("severity"),
        n("severity_rank"), n("request_count"), n("rps"), n("unique_path_count"), n("error_ratio"),
        s("signal_reason"), "'\"detected_at\":\"' || strftime(window_end + INTERVAL 2 SECOND, '%Y-%m-%dT%H:%M:%S.%gZ') || '\"'",
    ]
    body = "concat_ws(',', " + ", ".join(parts) + ")"
    return _alerts_with() + f"""SELECT concat_ws('|', src_ip, attack_type, strftime(window_end, '%Y-%m-%d %H:%M:%S'), window_size) AS key,
 '{{' || {body} || '}}' AS value FROM alerts"""


def alert_registry() -> dict[str, str]:
    return {
        "alert_keys": alert_keys_sql(),
        "alert_json": alert_json_sql(),
        "alert_log": alert_json_sql(),
        "severity_gated": severity_gated_sql(),
        "dispositions": dispositions_sql(),
        "dedupe_ttl": dedupe_ttl_sql(),
        "alert_digest": alert_digest_sql(),
        "digest_text": digest_text_sql(),
        "alert_text": alert_text_sql(),
        "latest_alerts": latest_alerts_sql(),
        "retained_alerts": retained_alerts_sql(),
        "bucket_requests": bucket_sql("request_count", "sum", "request_count_sum"),
        "bucket_rps": bucket_sql("rps", "avg", "rps_avg"),
        "bucket_error_ratio": bucket_sql("error_ratio", "avg", "error_ratio_avg"),
        "bucket_unique_paths": bucket_sql("unique_path_count", "avg", "unique_path_count_avg"),
        "top_attack_types": top_terms_sql("attack_type"),
        "top_severities": top_terms_sql("severity"),
        "recent_alerts": recent_alerts_sql(),
        "alert_stats": alert_stats_sql(),
        "stream_detect_all": detect_all_sql(),
        "stream_outcomes": dispositions_sql(),
        "stream_digest": alert_digest_sql(),
        "stream_dedupe": _alerts_with(MSGS_CTE) + """SELECT msg_key AS dedupe_key, arrival, attack_type, signal_reason,
 request_count FROM acc""",
    }
