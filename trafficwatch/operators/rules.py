"""Detection rules as data, and their application to window measures.

All rules of one measures frame are applied in a single projection: every
rule yields ``IF(condition, alert_struct, NULL)``; the array of those is
exploded and its null entries dropped (plain ``explode``, so the step stays
inside whole-stage codegen).  The aggregate under the rules is therefore computed (and, in
streaming, held in state) once, however many rules read it.
"""

from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import DataFrame

from trafficwatch.functions.classify import safe_ratio_sql, sql_str
from trafficwatch.operators.windows import WindowSpec

# ---------------------------------------------------------------------------
# Window families, thresholds, severities and reasons.
# ---------------------------------------------------------------------------
MAIN_WINDOW = WindowSpec("5s", 5, 1, "src_ip")
FAST_WINDOW = WindowSpec("2s", 2, 1, "src_ip")
PATH_WINDOW = WindowSpec("60s", 60, 60, "request_path")

MAIN_THRESHOLDS = {
    "http_flood": 150,
    "botnet": 40,
    "search_flood": 120,
    "scanning": 40,
    "slowloris": 30,
    "distributed_heavy_url": 120,  # per 5 s, scaled to the 60 s path window
}
FAST_THRESHOLDS = {"http_flood": 100, "scanning": 28}
HEAVY_URL_MIN_SOURCES = 20
PATH_REASON_PREFIX = "distributed_spike_on_path:"


@dataclass(frozen=True)
class Rule:
    attack_type: str
    window: WindowSpec
    count_col: str  # request count the threshold applies to (also request_count)
    unique_col: str  # reported as unique_path_count
    error_col: str  # numerator of error_ratio
    threshold: float
    severity: str
    severity_rank: int
    signal_reason: str | None  # None: PATH_REASON_PREFIX + request_path
    extra_sql: str | None = None  # post-filter over the measures (Spark SQL)
    needs_methods: bool = False  # the post-filter reads method_variety


def _ratio(num: str, den: str) -> str:
    return safe_ratio_sql(num, den)


def _class_rule(attack, window, cls, threshold, severity, rank, reason, extra=None, needs_methods=False) -> Rule:
    return Rule(
        attack,
        window,
        f"request_count_{cls}",
        f"unique_path_count_{cls}",
        f"error_count_{cls}",
        threshold,
        severity,
        rank,
        reason,
        extra,
        needs_methods,
    )


def main_rules() -> list[Rule]:
    w = MAIN_WINDOW
    t = MAIN_THRESHOLDS
    return [
        _class_rule("http_flood", w, "non_scan", t["http_flood"], "critical", 2, "high_rps_general_http"),
        _class_rule(
            "botnet", w, "non_scan_non_search", t["botnet"], "critical", 2, "distributed_low_and_steady_rps",
            "unique_path_count_non_scan_non_search >= 3",
        ),
        _class_rule("search_flood", w, "search_focus", t["search_flood"], "critical", 2, "heavy_db_or_login_endpoints"),
        _class_rule(
            "scanning", w, "scan_only", t["scanning"], "critical", 2, "suspicious_scan_endpoints",
            f"{_ratio('error_count_scan_only', 'request_count_scan_only')} >= 0.5D",
        ),
        _class_rule(
            "slowloris", w, "all", t["slowloris"], "critical", 2, "slow_connection_behavior",
            f"{_ratio('timeout_like_count_all', 'request_count_all')} >= 0.30D"
            f" AND {_ratio('tiny_response_count_all', 'request_count_all')} >= 0.60D"
            " AND method_variety <= 2 AND unique_path_count_all <= 3",
            needs_methods=True,
        ),
    ]


def fast_rules() -> list[Rule]:
    w = FAST_WINDOW
    t = FAST_THRESHOLDS
    return [
        _class_rule("http_flood", w, "non_scan", t["http_flood"], "warning", 1, "high_rps_general_http"),
        _class_rule(
            "scanning", w, "scan_only", t["scanning"], "warning", 1, "suspicious_scan_endpoints",
            f"{_ratio('error_count_scan_only', 'request_count_scan_only')} >= 0.5D",
        ),
    ]


def heavy_url_rule() -> Rule:
    w = PATH_WINDOW
    threshold = float(MAIN_THRESHOLDS["distributed_heavy_url"] * (w.seconds / MAIN_WINDOW.seconds))
    return Rule(
        "distributed_heavy_url",
        w,
        "path_request_count",
        "unique_src_ip",
        "path_error_count",
        threshold,
        "warning",
        2,
        None,
        f"unique_src_ip >= {HEAVY_URL_MIN_SOURCES}",
    )


def all_rules(fast: bool = True, heavy_url: bool = True) -> list[Rule]:
    rules = main_rules()
    if fast:
        rules += fast_rules()
    if heavy_url:
        rules.append(heavy_url_rule())
    return rules


def rule_by_name(name: str) -> Rule:
    """'http_flood', 'fast_http_flood', 'heavy_url', ..."""
    table = {r.attack_type: r for r in main_rules()}
    table.update({f"fast_{r.attack_type}": r for r in fast_rules()})
    table["heavy_url"] = heavy_url_rule()
    table["distributed_heavy_url"] = table["heavy_url"]
    return table[name]


def _alert_struct_sql(rule: Rule) -> str:
    count = rule.count_col
    src = "src_ip" if rule.window.key == "src_ip" else "CAST(NULL AS STRING)"
    if rule.signal_reason is not None:
        reason = sql_str(rule.signal_reason)
    else:
        reason = f"concat({sql_str(PATH_REASON_PREFIX)}, request_path)"
    return (
        "named_struct("
        f"'src_ip', {src}, 'window_start', window_start, 'window_end', window_end, "
        f"'window_size', {sql_str(rule.window.label)}, 'attack_type', {sql_str(rule.attack_type)}, "
        f"'severity', {sql_str(rule.severity)}, 'severity_rank', CAST({rule.severity_rank} AS INT), "
        f"'request_count', CAST({count} AS BIGINT), "
        f"'rps', CAST({count} AS DOUBLE) / {float(rule.window.seconds)}D, "
        f"'unique_path_count', CAST({rule.unique_col} AS BIGINT), "
        f"'error_ratio', {safe_ratio_sql(rule.error_col, count)}, "
        f"'signal_reason', {reason})"
    )


def rule_condition_sql(rule: Rule, check_window: bool) -> str:
    t = rule.threshold
    literal = f"{int(t)}L" if float(t).is_integer() else f"{float(t)}D"
    cond = f"{rule.count_col} >= {literal}"
    if rule.extra_sql is not None:
        cond = f"{cond} AND ({rule.extra_sql})"
    if check_window:
        cond = f"window_size = {sql_str(rule.window.label)} AND {cond}"
    return f"coalesce({cond}, false)"


def apply_rules(measures: DataFrame, rules: list[Rule], check_window: bool = True) -> DataFrame:
    """Measures frame -> alert rows (RULE_OUTPUT_COLUMNS); one row per (window, key, firing rule)."""
    if not rules:
        raise ValueError("no rules to apply")
    conds = [rule_condition_sql(r, check_window) for r in rules]
    entries = [f"IF({c}, {_alert_struct_sql(r)}, NULL)" for c, r in zip(conds, rules)]
    # A cheap pre-filter (any rule fires) keeps non-alerting windows out of the generator.
    return (
        measures.filter(" OR ".join(f"({c})" for c in conds))
        .selectExpr(f"explode(array({', '.join(entries)})) AS a")
        .filter("a IS NOT NULL")
        .selectExpr("a.*")
    )
