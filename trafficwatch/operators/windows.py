"""Event-time window aggregates over normalised requests.

Two physical shapes compute the same measures:

* ``source_windows`` / ``path_windows``: one ``groupBy(window(...), key)`` per
  window size.  Works on batch *and* streaming frames (watermark + state), with
  HyperLogLog distinct counts (default, like the reference) or exact sets.

* ``grain_measures`` (batch): all window sizes from **one scan and two
  shuffles**.  Requests are summed to panes (source, second, path, method)
  with map-side partial sums; windows, exact distinct counts and the test
  whether a window can reach a threshold all come from the pane rows, dealt
  out by key and block of time.  Raw rows are never joined or expanded, and a
  hot source (one IP holding a large share of all rows) is first reduced and
  then spread over its blocks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficwatch.functions.classify import (
    TRAFFIC_CLASSES,
    in_class_sql,
    is_error_sql,
    is_timeout_like_sql,
    is_tiny_response_sql,
    safe_ratio_sql,
    sql_str,
    url_type_sql,
)

US = 1_000_000


@dataclass(frozen=True)
class WindowSpec:
    """An event-time window family: ``seconds`` long, starting every ``slide``."""

    label: str  # also the alert's window_size, e.g. "5s"
    seconds: int
    slide: int
    key: str  # "src_ip" (per-source measures) or "request_path" (per-path measures)


SOURCE_MEASURES = (
    [f"request_count_{c}" for c in TRAFFIC_CLASSES]
    + [f"unique_path_count_{c}" for c in TRAFFIC_CLASSES]
    + ["method_variety"]
    + [f"error_count_{c}" for c in TRAFFIC_CLASSES]
    + ["timeout_like_count_all", "tiny_response_count_all"]
)
PATH_MEASURES = ["path_request_count", "unique_src_ip", "path_error_count"]


def _distinct(col: Column, exact: bool) -> Column:
    return F.size(F.collect_set(col)).cast("long") if exact else F.approx_count_distinct(col)


def _count_if(cond: str) -> Column:
    return F.expr(f"CAST(sum(IF({cond}, 1, 0)) AS BIGINT)")


def source_window_aggs(exact: bool = False) -> list[Column]:
    """The 18 per-source measures as aggregate expressions over normalised rows."""
    error = is_error_sql("status_category")
    counts, uniques, errors = [], [], []
    for c in TRAFFIC_CLASSES:
        member = in_class_sql(c, "url_type")
        counts.append(_count_if(member).alias(f"request_count_{c}"))
        uniques.append(_distinct(F.expr(f"IF({member}, request_path, NULL)"), exact).alias(f"unique_path_count_{c}"))
        errors.append(_count_if(f"{member} AND {error}").alias(f"error_count_{c}"))
    return [
        *counts,
        *uniques,
        _distinct(F.col("method"), exact).alias("method_variety"),
        *errors,
        _count_if(is_timeout_like_sql("status_code")).alias("timeout_like_count_all"),
        _count_if(is_tiny_response_sql("response_size")).alias("tiny_response_count_all"),
    ]


def path_window_aggs(exact: bool = False) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("path_request_count"),
        _distinct(F.col("src_ip"), exact).alias("unique_src_ip"),
        _count_if(is_error_sql("status_category")).alias("path_error_count"),
    ]


def _window(spec: WindowSpec) -> Column:
    return F.window("timestamp", f"{spec.seconds} seconds", f"{spec.slide} seconds")


def source_windows(df: DataFrame, spec: WindowSpec, exact: bool = False) -> DataFrame:
    """A1: per (window, src_ip) measures.  Batch or streaming."""
    agg = df.groupBy(_window(spec).alias("window"), F.col("src_ip")).agg(*source_window_aggs(exact))
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.lit(spec.label).alias("window_size"),
        "src_ip",
        *SOURCE_MEASURES,
    )


def path_windows(df: DataFrame, spec: WindowSpec, exact: bool = False) -> DataFrame:
    """A2: per (window, request_path) measures.  Batch or streaming."""
    agg = df.groupBy(_window(spec).alias("window"), F.col("request_path")).agg(*path_window_aggs(exact))
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.lit(spec.label).alias("window_size"),
        "request_path",
        *PATH_MEASURES,
        F.expr(safe_ratio_sql("path_error_count", "path_request_count")).alias("path_error_ratio"),
    )


def expanded_windows(df: DataFrame, specs: list[WindowSpec], exact: bool = False, method_labels: set[str] | None = None, lateness: str | None = None) -> DataFrame:
    """Measures of every family in one aggregation; batch or streaming (one read, one state).

    Each request becomes one row per window that holds it.  On a stream the
    watermark is that of the requests themselves (newest time minus
    ``lateness``), and the event time of a window's rows is its end: a window of
    any family closes when the watermark passes its end, so one family's length
    changes nothing for another.  Output as ``grain_measures``.
    """
    if method_labels is None:
        method_labels = {s.label for s in specs}
    entries = []
    for spec in specs:
        source = spec.key == "src_ip"
        method = "method" if source and spec.label in method_labels else "CAST(NULL AS STRING)"
        for start, holds in _Family(spec, "", spec.seconds * US, spec.slide * US).starts(_TS_US):
            one = (
                f"named_struct('window_size', {sql_str(spec.label)}, 'window_start', timestamp_micros({start}), "
                f"'window_end', timestamp_micros({start} + {spec.seconds * US}L), 'per_source', {str(source).lower()}, "
                f"'gkey', {spec.key}, 'member', {'request_path' if source else 'src_ip'}, 'method', {method})"
            )
            entries.append(f"IF({holds}, {one}, NULL)")
    flags = ["url_type", "status_category", "status_code", "response_size"]
    late = df.isStreaming and lateness is not None
    if late:
        df = df.withWatermark("timestamp", lateness)
    rows = df.filter("`timestamp` IS NOT NULL").selectExpr(*flags, f"explode(array({', '.join(entries)})) AS w").filter("w IS NOT NULL")
    rows = rows.selectExpr(*flags, "w.*").withColumn("request_path", F.col("member"))
    if late:
        # the window's end is compared with the watermark of the requests
        delay = next(f.metadata for f in df.schema.fields if f.name == "timestamp")
        rows = rows.withColumn("window_end", F.col("window_end").alias("window_end", metadata=delay))
    agg = rows.groupBy("window_end", "window_start", "window_size", "per_source", "gkey").agg(*source_window_aggs(exact))
    return agg.selectExpr(
        "window_size",
        "window_start",
        "window_end",
        "IF(per_source, gkey, NULL) AS src_ip",
        "IF(NOT per_source, gkey, NULL) AS request_path",
        *[f"IF(per_source, {m}, NULL) AS {m}" for m in SOURCE_MEASURES],
        "IF(NOT per_source, request_count_all, NULL) AS path_request_count",
        "IF(NOT per_source, unique_path_count_all, NULL) AS unique_src_ip",
        "IF(NOT per_source, error_count_all, NULL) AS path_error_count",
    )


# ---------------------------------------------------------------------------
# Batch: panes first, windows from the panes, exact distinct counts without sets.
# ---------------------------------------------------------------------------

_TS_US = "unix_micros(`timestamp`)"
_SOURCE, _PATH = "s", "p"
#: Panes of one source whose windows are built together in one task.
BLOCK_PANES = 32
#: Parts, by source, that the rows of one path and block are dealt out in.
PATH_PARTS = 64


def pane_seconds(specs: list[WindowSpec]) -> int:
    """The longest pane of which every window and slide is a multiple."""
    return math.gcd(*(x for s in specs for x in (s.seconds, s.slide)))


def pane_counts(df: DataFrame, seconds: int) -> DataFrame:
    """The requests summed to (src_ip, pane, request_path, method): the only pass over raw rows."""
    us = seconds * US
    rows = df.filter("`timestamp` IS NOT NULL").selectExpr(
        "src_ip",
        f"({_TS_US} - pmod({_TS_US}, {us}L)) div {us}L AS pane",
        "request_path",
        "method",
        f"CAST({is_error_sql('status_category')} AS INT) AS e",
        f"CAST({is_timeout_like_sql('status_code')} AS INT) AS t",
        f"CAST({is_tiny_response_sql('response_size')} AS INT) AS y",
    )
    return rows.groupBy("src_ip", "pane", "request_path", "method").agg(
        F.expr("count(1) AS n"),
        F.expr("CAST(sum(e) AS BIGINT) AS n_err"),
        F.expr("CAST(sum(t) AS BIGINT) AS n_timeout"),
        F.expr("CAST(sum(y) AS BIGINT) AS n_tiny"),
    )


@dataclass(frozen=True)
class _Family:
    """A window family in panes."""

    spec: WindowSpec
    kind: str
    size: int
    slide: int

    def starts(self, pane: str) -> list[tuple[str, str]]:
        """(start, condition) of every window that can hold ``pane``."""
        base = f"({pane} - pmod({pane}, {self.slide}L))"
        out = []
        for k in range(math.ceil(self.size / self.slide)):
            start = f"({base} - {k * self.slide}L)"
            out.append((start, "true" if self.size % self.slide == 0 else f"{start} + {self.size}L > {pane}"))
        return out

    def earliest(self, pane: str) -> str:
        """Start of the first window that holds ``pane``."""
        low = f"({pane} - {self.size - 1}L)"
        return f"({low} + pmod(-{low}, {self.slide}L))"


def pane_families(specs: list[WindowSpec], seconds: int) -> list[_Family]:
    """The families in panes of ``seconds``."""
    return [_Family(s, _SOURCE if s.key == "src_ip" else _PATH, s.seconds // seconds, s.slide // seconds) for s in specs]


def _blocked(panes: DataFrame, families: list[_Family]) -> tuple[DataFrame, dict[str, int]]:
    """Pane rows dealt out by (kind, key, block of panes).

    A window belongs to the block of its start, so a pane also goes to the
    block before its own if a window that starts there reaches it: everything
    a window needs meets in one place, and one key spreads over its blocks.
    """
    entries, blocks = [], {}
    part = f"CAST(pmod(xxhash64(src_ip), {PATH_PARTS}) AS INT)"
    for kind, key, member, part in ((_SOURCE, "src_ip", "request_path", "0"), (_PATH, "request_path", "src_ip", part)):
        own = [f for f in families if f.kind == kind]
        if not own:
            continue
        step = math.lcm(*(f.slide for f in own))
        blocks[kind] = size = -(-max(BLOCK_PANES, *(f.size for f in own)) // step) * step
        block = f"(pane - pmod(pane, {size}L)) div {size}L"

        def entry(at: str, kind=kind, key=key, member=member, part=part) -> str:
            return f"named_struct('kind', '{kind}', 'gkey', {key}, 'block', {at}, 'part', {part}, 'member', {member})"

        reached = " OR ".join(f"{f.earliest('pane')} < {block} * {size}L" for f in own)
        entries += [entry(block), f"IF({reached}, {entry(f'{block} - 1L')}, NULL)"]
    rows = panes.selectExpr("*", f"explode(array({', '.join(entries)})) AS g").filter("g IS NOT NULL")
    columns = ["pane", "method", "n", "n_err", "n_timeout", "n_tiny"]
    return rows.selectExpr("g.kind", "g.gkey", "g.block", "g.part", "g.member", *columns).repartition("kind", "gkey", "block", "part"), blocks


def _near_enough(rows: DataFrame, families: list[_Family], min_count: dict[str, float]) -> tuple[DataFrame, dict[str, str]]:
    """Drop the pane rows of sources that no window reaching its family's threshold can hold.

    All panes of a window lie within its length of each other, so a pane row
    can only matter if the requests of its source that near to it reach the
    threshold.  A path's rows lie in several parts, so they all stay.  Returns
    the rows and a condition for each source family.
    """
    near = {}
    own = [f for f in families if f.kind == _SOURCE]
    for k, f in enumerate(own):
        if f.spec.label in min_count:
            reach = Window.partitionBy("kind", "gkey", "block", "part").orderBy("pane").rangeBetween(1 - f.size, f.size - 1)
            rows = rows.withColumn(f"_near{k}", F.sum("n").over(reach))
            near[f.spec.label] = f"_near{k} >= {math.ceil(min_count[f.spec.label])}L"
    if own and len(near) == len(own):
        rows = rows.filter(f"kind = '{_PATH}' OR " + " OR ".join(near.values()))
    return rows, near


def grain_measures(
    df: DataFrame,
    specs: list[WindowSpec],
    method_labels: set[str] | None = None,
    min_count: dict[str, float] | None = None,
) -> DataFrame:
    """Measures of every window family in ``specs`` from one pass over ``df``.

    Output: window_size, window_start, window_end, src_ip, request_path plus
    SOURCE_MEASURES (per-source families) and PATH_MEASURES (per-path
    families); columns of the other family are null.  Distinct counts are
    exact: rows are first summed to one per (window, member).  With
    ``min_count`` (lowest useful request count by family) windows below it may
    be left out.  ``method_variety`` is only computed for the families in
    ``method_labels`` (default: all; null elsewhere).

    Two shuffles: partial sums of the panes, and the panes by (key, block) and,
    for paths, part; every later step is clustered by the latter.  With a path
    family a third one adds up the parts: one row per window and part, already
    summed.
    """
    if method_labels is None:
        method_labels = {s.label for s in specs}
    seconds = pane_seconds(specs)
    families = pane_families(specs, seconds)
    rows, blocks = _blocked(pane_counts(df, seconds), families)
    rows, near = _near_enough(rows, families, min_count or {})

    entries = []
    for f in families:
        for start, holds in f.starts("pane"):
            block = f"({start} - pmod({start}, {blocks[f.kind]}L)) div {blocks[f.kind]}L = block"
            cond = " AND ".join(x for x in (f"kind = '{f.kind}'", block, holds, near.get(f.spec.label)) if x)
            subs = ["1"] + (["2"] if f.kind == _SOURCE and f.spec.label in method_labels else [])
            for sub in subs:
                one = f"named_struct('window_size', {sql_str(f.spec.label)}, 'ws', {start}, 'sub', {sub})"
                entries.append(f"IF({cond}, {one}, NULL)")
    rows = rows.selectExpr("*", f"explode(array({', '.join(entries)})) AS w").filter("w IS NOT NULL")
    rows = rows.selectExpr("kind", "gkey", "block", "part", "w.window_size", "w.ws", "w.sub", "IF(w.sub = 1, member, method) AS member", "n", "n_err", "n_timeout", "n_tiny")
    keys = ["kind", "gkey", "block", "part", "window_size", "ws"]
    sums = [F.expr(f"sum({c}) AS {c}") for c in ("n", "n_err", "n_timeout", "n_tiny")]
    members = rows.groupBy(*keys, "sub", "member").agg(*sums)
    members = members.selectExpr("*", f"IF(sub = 1 AND kind = '{_SOURCE}', {url_type_sql('member')}, NULL) AS utype")

    is_path, is_method = f"kind = '{_SOURCE}' AND sub = 1", "sub = 2"

    def total(cond: str, col: str) -> str:
        return f"CAST(coalesce(sum(IF({cond}, {col}, NULL)), 0) AS BIGINT)"

    def count(cond: str) -> str:
        return f"count(IF({cond} AND member IS NOT NULL, 1, NULL))"

    aggs = []
    for c in TRAFFIC_CLASSES:
        inside = f"{is_path} AND {in_class_sql(c, 'utype')}"
        aggs += [
            f"{total(inside, 'n')} AS request_count_{c}",
            f"{count(inside)} AS unique_path_count_{c}",
            f"{total(inside, 'n_err')} AS error_count_{c}",
        ]
    aggs += [
        f"{count(is_method)} AS method_variety",
        f"{total(is_path, 'n_timeout')} AS timeout_like_count_all",
        f"{total(is_path, 'n_tiny')} AS tiny_response_count_all",
        f"{total(f"kind = '{_PATH}'", 'n')} AS path_request_count",
        f"{count(f"kind = '{_PATH}'")} AS unique_src_ip",
        f"{total(f"kind = '{_PATH}'", 'n_err')} AS path_error_count",
    ]
    windows = members.groupBy(*keys).agg(*[F.expr(x) for x in aggs])
    if any(f.kind == _PATH for f in families):
        measures = [*SOURCE_MEASURES, *PATH_MEASURES]
        windows = windows.groupBy("kind", "gkey", "window_size", "ws").agg(*[F.expr(f"CAST(sum({m}) AS BIGINT) AS {m}") for m in measures])

    us = seconds * US
    length = "CASE " + " ".join(f"WHEN window_size = {sql_str(f.spec.label)} THEN {f.spec.seconds * US}L" for f in families) + " END"
    methods = f"window_size IN ({', '.join(sql_str(x) for x in sorted(method_labels))})" if method_labels else "false"
    of_source, of_path = f"kind = '{_SOURCE}'", f"kind = '{_PATH}'"
    out = [
        "window_size",
        f"timestamp_micros(ws * {us}L) AS window_start",
        f"timestamp_micros(ws * {us}L + {length}) AS window_end",
        f"IF({of_source}, gkey, NULL) AS src_ip",
        f"IF({of_path}, gkey, NULL) AS request_path",
    ]
    for m in SOURCE_MEASURES:
        cond = f"{of_source} AND {methods}" if m == "method_variety" else of_source
        out.append(f"IF({cond}, {m}, NULL) AS {m}")
    out += [f"IF({of_path}, {m}, NULL) AS {m}" for m in PATH_MEASURES]
    return windows.selectExpr(*out)


def source_windows_exact(df: DataFrame, spec: WindowSpec) -> DataFrame:
    """A1 in batch via the grain plan (exact distinct counts)."""
    m = grain_measures(df, [spec])
    return m.select("window_start", "window_end", "window_size", "src_ip", *SOURCE_MEASURES)


def path_windows_exact(df: DataFrame, spec: WindowSpec) -> DataFrame:
    """A2 in batch via the grain plan (exact distinct counts)."""
    m = grain_measures(df, [spec])
    return m.select(
        "window_start",
        "window_end",
        "window_size",
        "request_path",
        *PATH_MEASURES,
        F.expr(safe_ratio_sql("path_error_count", "path_request_count")).alias("path_error_ratio"),
    )

