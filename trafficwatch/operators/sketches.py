"""Window measures from panes that carry distinct sketches (batch).

``grain_measures`` counts distinct members exactly and for that deals out one
row per (key, pane, member).  Here a pane holds a HyperLogLog sketch instead of
its members, so what is dealt out is one row per (key, pane) however many
members it has: a path asked for by a hundred million sources is a few
kilobytes per pane and task.  Sketches of panes merge to those of windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficwatch.functions.classify import TRAFFIC_CLASSES, in_class_sql, sql_str, url_type_sql
from trafficwatch.operators.windows import (
    PATH_MEASURES,
    SOURCE_MEASURES,
    US,
    WindowSpec,
    pane_counts,
    pane_families,
    pane_seconds,
)

#: log2 of a sketch's buckets: about 1.6 % standard error, 4 KB at most.
LOG_BUCKETS = 12

_SUMS = [f"{kind}_count_{c}" for kind in ("request", "error") for c in TRAFFIC_CLASSES] + ["timeout_like_count_all", "tiny_response_count_all"]
_UNIQUE = [f"unique_path_count_{c}" for c in TRAFFIC_CLASSES]


def _hashed(col: str) -> str:
    """What a sketch is fed: it would leave out an empty text, and a null's hash is not null."""
    return f"IF({col} IS NULL, NULL, xxhash64({col}))"


def pane_sketches(df: DataFrame, seconds: int, kinds: dict[bool, bool], log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """One row per (per_source, gkey, pane): sums and sketches, partial in each task before the shuffle.

    ``kinds``: per-source or per-path rows wanted -> with methods.  A path's
    members are its sources and all its sums those of the class "all".
    """
    entries = [
        f"named_struct('per_source', {str(source).lower()}, 'gkey', {'src_ip' if source else 'request_path'}, "
        f"'member', {_hashed('request_path' if source else 'src_ip')}, 'verb', {_hashed('method') if methods else 'CAST(NULL AS BIGINT)'})"
        for source, methods in kinds.items()
    ]
    rows = pane_counts(df, seconds).selectExpr("*", f"{url_type_sql('request_path')} AS utype", f"explode(array({', '.join(entries)})) AS g")
    rows = rows.selectExpr("pane", "utype", "n", "n_err", "n_timeout", "n_tiny", "g.*")
    aggs = []
    for c in TRAFFIC_CLASSES:
        inside = "true" if c == "all" else f"per_source AND {in_class_sql(c, 'utype')}"
        aggs += [
            f"sum(IF({inside}, n, 0)) AS request_count_{c}",
            f"sum(IF({inside}, n_err, 0)) AS error_count_{c}",
            f"hll_sketch_agg(IF({inside}, member, NULL), {log_buckets}) AS unique_path_count_{c}",
        ]
    aggs += ["sum(n_timeout) AS timeout_like_count_all", "sum(n_tiny) AS tiny_response_count_all", f"hll_sketch_agg(verb, {log_buckets}) AS method_variety"]
    return rows.groupBy("per_source", "gkey", "pane").agg(*[F.expr(x) for x in aggs])


def sketch_measures(df: DataFrame, specs: list[WindowSpec], method_labels: set[str] | None = None, log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """Measures of every window family in ``specs``, distinct counts estimated; columns as ``grain_measures``.

    One scan and three shuffles: panes, panes per key with sketches, windows.
    Each has partial sums, and raw rows are neither joined nor expanded to
    windows.  Counts other than the distinct ones are exact, and so are, but
    for hash collisions, distinct counts of up to some hundred members.
    """
    if method_labels is None:
        method_labels = {s.label for s in specs}
    seconds = pane_seconds(specs)
    families = pane_families(specs, seconds)
    kinds = {f.spec.key == "src_ip": False for f in families}
    if True in kinds:
        kinds[True] = any(f.spec.label in method_labels for f in families if f.spec.key == "src_ip")
    entries = []
    for f in families:
        mine = "per_source" if f.spec.key == "src_ip" else "NOT per_source"
        for start, holds in f.starts("pane"):
            one = f"named_struct('window_size', {sql_str(f.spec.label)}, 'ws', {start}, 'length', {f.spec.seconds * US}L)"
            entries.append(f"IF({mine} AND {holds}, {one}, NULL)")
    rows = pane_sketches(df, seconds, kinds, log_buckets).selectExpr("*", f"explode(array({', '.join(entries)})) AS w").filter("w IS NOT NULL")
    sums = [f"sum({c}) AS {c}" for c in _SUMS]
    merged = [f"hll_sketch_estimate(hll_union_agg({c})) AS {c}" for c in [*_UNIQUE, "method_variety"]]
    windows = rows.groupBy("per_source", "gkey", "w.window_size", "w.ws", "w.length").agg(*[F.expr(x) for x in sums + merged])
    methods = f"window_size IN ({', '.join(sql_str(x) for x in sorted(method_labels))})" if method_labels else "false"
    of_path = {"path_request_count": "request_count_all", "unique_src_ip": "unique_path_count_all", "path_error_count": "error_count_all"}
    return windows.selectExpr(
        "window_size",
        f"timestamp_micros(ws * {seconds * US}L) AS window_start",
        f"timestamp_micros(ws * {seconds * US}L + length) AS window_end",
        "IF(per_source, gkey, NULL) AS src_ip",
        "IF(per_source, NULL, gkey) AS request_path",
        *[f"IF(per_source{f' AND {methods}' if m == 'method_variety' else ''}, {m}, NULL) AS {m}" for m in SOURCE_MEASURES],
        *[f"IF(per_source, NULL, {of_path[m]}) AS {m}" for m in PATH_MEASURES],
    )
