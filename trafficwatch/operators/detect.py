"""Detection: normalised requests -> typed alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficwatch.config import DetectionConfig
from trafficwatch.operators.rules import Rule, all_rules, apply_rules
from trafficwatch.operators.sketches import sketch_measures
from trafficwatch.operators.windows import (
    WindowSpec,
    expanded_windows,
    grain_measures,
    path_windows,
    source_windows,
)
from trafficwatch.schema import RULE_OUTPUT_COLUMNS


def _specs(rules: list[Rule]) -> list[WindowSpec]:
    seen: dict[str, WindowSpec] = {}
    for r in rules:
        seen.setdefault(r.window.label, r.window)
    return list(seen.values())


def detect_rules(
    df: DataFrame,
    rules: list[Rule],
    exact: bool = False,
    plan: str = "auto",
    watermark: str | None = "45 seconds",
    prefilter: bool = True,
) -> DataFrame:
    """Apply ``rules`` to normalised requests; returns RULE_OUTPUT_COLUMNS.

    plan="grain" (batch, exact counts): one scan, panes, then all windows.
    plan="sketch" (batch): panes that carry distinct sketches; no member rows
    are dealt out, for keys with very many members.
    plan="expanded" (streams): one aggregation over the windows of all
    families, so the source is read once and one state is held.
    plan="windowed": one ``groupBy(window(...))`` per window family, rules
    inlined on each, union across families.
    plan="union": the windowed aggregates with one filter+select branch per
    rule, unioned (the textbook shape; kept as a benchmark comparator - each
    branch re-plans its aggregate).
    plan="auto": expanded for streams, else grain: in batch the exact counts of
    the panes also cost less than HyperLogLog counts of expanded rows, so
    ``exact`` only matters on streams and for the plans below.

    ``prefilter`` (grain plan): build windows only from pane rows near enough
    requests to reach the family's lowest threshold (exact, see
    ``windows._near_enough``).
    """
    if plan == "auto":
        plan = "expanded" if df.isStreaming else "grain"
    specs = _specs(rules)
    if plan in ("grain", "sketch") and df.isStreaming:
        raise ValueError(f"the {plan} plan chains aggregations; use plan='expanded' on streams")
    if plan == "sketch":
        return apply_rules(sketch_measures(df, specs, {r.window.label for r in rules if r.needs_methods}), rules).select(*RULE_OUTPUT_COLUMNS)
    if plan == "grain":
        lowest: dict[str, float] = {}
        for r in rules if prefilter else []:
            lowest[r.window.label] = min(lowest.get(r.window.label, r.threshold), r.threshold)
        measures = grain_measures(df, specs, {r.window.label for r in rules if r.needs_methods}, lowest)
        return apply_rules(measures, rules).select(*RULE_OUTPUT_COLUMNS)
    if plan == "expanded":
        measures = expanded_windows(df, specs, exact, {r.window.label for r in rules if r.needs_methods}, watermark)
        return apply_rules(measures, rules).select(*RULE_OUTPUT_COLUMNS)
    if watermark and df.isStreaming:
        df = df.withWatermark("timestamp", watermark)
    found = None
    for spec in specs:
        family = [r for r in rules if r.window.label == spec.label]
        measures = source_windows(df, spec, exact) if spec.key == "src_ip" else path_windows(df, spec, exact)
        for group in [[r] for r in family] if plan == "union" else [family]:
            alerts = apply_rules(measures, group, check_window=False)
            found = alerts if found is None else found.unionByName(alerts)
    return found.select(*RULE_OUTPUT_COLUMNS)


def detect(
    df: DataFrame,
    config: DetectionConfig = DetectionConfig(),
    detected_at: Column | None = None,
    plan: str = "auto",
) -> DataFrame:
    """All enabled rules; adds ``detected_at`` (processing time unless given)."""
    rules = all_rules(fast=config.fast_rules, heavy_url=config.heavy_url_rule)
    alerts = detect_rules(df, rules, exact=config.exact_distinct, plan=plan, watermark=config.watermark_delay)
    stamp = detected_at if detected_at is not None else F.current_timestamp()
    return alerts.withColumn("detected_at", stamp)
