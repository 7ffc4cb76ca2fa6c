"""Property test: both detection plans equal a brute-force evaluation of the rules."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trafficwatch.operators.detect import detect_rules
from trafficwatch.operators.normalize import normalize
from trafficwatch.operators.rules import all_rules
from trafficwatch.schema import REQUEST_SCHEMA

T0 = 1704067200000
PATHS = ["/home", "/cart", "/search", "/.env", "/etc/passwd", "/api/v1/login", "/products/1", "/blog/x", None]


def brute(rows):
    """Reference evaluation straight from the rule table's definition."""
    def utype(p):
        if p in ("/search", "/api/v1/search"):
            return "search_url"
        if p in ("/.env", "/wp-admin", "/admin/config.php", "/etc/passwd"):
            return "scan_url"
        if p is not None and p.startswith("/api/v1/login"):
            return "api_login_url"
        if p == "/api/v1/report/export":
            return "api_report_export_url"
        return "other"

    classes = {
        "all": lambda u: True,
        "non_scan": lambda u: u != "scan_url",
        "non_scan_non_search": lambda u: u not in ("scan_url", "search_url"),
        "search_focus": lambda u: u in ("search_url", "api_report_export_url", "api_login_url"),
        "scan_only": lambda u: u == "scan_url",
    }
    out = set()
    for size, label in ((5, "5s"), (2, "2s")):
        groups = defaultdict(list)
        for r in rows:
            sec = r[0] // 1000
            for start in range(sec - size + 1, sec + 1):
                groups[(start, r[1])].append(r)
        for (start, ip), rs in groups.items():
            m = {}
            for c, f in classes.items():
                sel = [r for r in rs if f(utype(r[6]))]
                m[c] = (len(sel), len({r[6] for r in sel if r[6] is not None}),
                        sum(1 for r in sel if r[7] is not None and 400 <= r[7] <= 599))
            n = len(rs)
            def ratio(a, b):
                return a / b if b > 0 else 0.0
            fired = []
            if label == "5s":
                fired += [("http_flood", "non_scan")] if m["non_scan"][0] >= 150 else []
                fired += [("botnet", "non_scan_non_search")] if m["non_scan_non_search"][0] >= 40 and m["non_scan_non_search"][1] >= 3 else []
                fired += [("search_flood", "search_focus")] if m["search_focus"][0] >= 120 else []
                fired += [("scanning", "scan_only")] if m["scan_only"][0] >= 40 and ratio(m["scan_only"][2], m["scan_only"][0]) >= 0.5 else []
                timeouts = sum(1 for r in rs if r[7] in (408, 429, 503, 504))
                tiny = sum(1 for r in rs if r[8] is not None and r[8] <= 128)
                methods = len({r[4] for r in rs if r[4] is not None})
                if n >= 30 and ratio(timeouts, n) >= 0.3 and ratio(tiny, n) >= 0.6 and methods <= 2 and m["all"][1] <= 3:
                    fired.append(("slowloris", "all"))
            else:
                fired += [("http_flood", "non_scan")] if m["non_scan"][0] >= 100 else []
                fired += [("scanning", "scan_only")] if m["scan_only"][0] >= 28 and ratio(m["scan_only"][2], m["scan_only"][0]) >= 0.5 else []
            for attack, c in fired:
                out.add((ip, start, label, attack, m[c][0], m[c][1]))
    return out


row = st.tuples(
    st.integers(0, 3999),  # ms offset within 4 s, so windows overlap heavily
    st.sampled_from(["a", "b", None]),
    st.sampled_from(PATHS),
    st.sampled_from([200, 404, 408, 500, 503]),
    st.sampled_from([16, 100, 128, 129, 900]),
    st.sampled_from(["GET", "POST", "HEAD"]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.too_slow, HealthCheck.function_scoped_fixture])
@given(base=st.lists(row, min_size=1, max_size=40), repeat=st.integers(1, 8))
def test_plans_equal_brute_force(spark, base, repeat):
    rows = [(T0 + ms, ip, "d", "HTTP/1.1", m, "ua", p, code, size) for ms, ip, p, code, size, m in base] * repeat
    want = brute(rows)
    df = normalize(spark.createDataFrame(rows, REQUEST_SCHEMA))
    rules = [r for r in all_rules() if r.window.label != "60s"]
    for plan in ("grain", "windowed"):
        got = {
            (r["src_ip"], int(r["window_start"].timestamp()), r["window_size"], r["attack_type"], r["request_count"], r["unique_path_count"])
            for r in detect_rules(df, rules, exact=True, plan=plan).collect()
        }
        assert got == want, plan
