"""User-visible parameters of detection and alert handling, with defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class DetectionConfig:
    watermark_delay: str = "45 seconds"
    fast_rules: bool = False  # 2 s / 1 s rules
    heavy_url_rule: bool = True  # 60 s per-path rule
    exact_distinct: bool = False  # approx_count_distinct like the reference; True = exact


@dataclass(frozen=True)
class AlertConfig:
    min_severity: str = "critical"
    dedupe_ttl_seconds: int = 300
    batch_window_seconds: int = 10  # <= 0: every alert is sent alone
    batch_max_ips: int = 50
    stats_interval_seconds: int = 30  # outcome counts are logged that often
    keep_late_seconds: int = 600  # a claim is kept that long after its TTL, for late records


@dataclass(frozen=True)
class StreamConfig:
    trigger: str = "2 seconds"
    max_offsets_per_trigger: int | None = 1000  # None: no cap
    max_files_per_trigger: int | None = None
    fail_on_data_loss: bool = False
    starting_offsets: str = "latest"
    shuffle_partitions: int | None = None  # None: the session's; fixed by a query's first checkpoint
    state_store: str = "rocksdb"
    min_batches_to_retain: int = 50
    maintenance_interval: str = "30s"
    multiple_watermark_policy: str = "min"
