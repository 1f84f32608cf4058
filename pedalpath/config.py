"""Every tunable of the engine, in one frozen object."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

HOUR_MS = 3_600_000

SHED_POLICIES = ("none", "drop_oldest", "drop_k", "shrink_window")


def parse_int_set(text: str) -> tuple[int, ...]:
    """The integers in a comma-separated text; anything else in it does not count."""
    return tuple(sorted({int(t) for t in text.replace(" ", "").split(",") if re.fullmatch(r"[+-]?\d+", t)}))


def normal_policy(name: str | None) -> str:
    """Policy names ignore case and blanks; an unknown name sheds nothing."""
    name = (name or "none").strip().lower()
    return name if name in SHED_POLICIES else "none"


@dataclass(frozen=True)
class PathConfig:
    # pattern
    window_ms: int = HOUR_MS
    hot: tuple[int, ...] = (7, 8, 9)
    hot_mode: str = "last_digit"
    min_a: int = 1
    max_chain: int | None = None
    # sharding and ingest
    n_shards: int = 10
    files_per_trigger: int = 1
    # matches
    dedupe_ttl_ms: int = 24 * HOUR_MS
    detail_sample: int = 50
    # load shedding
    shed_policy: str = "none"
    shed_keep_last_n: int = 1
    shed_drop_k: int = 3
    shed_window_ms: int = HOUR_MS // 2
    # overload switch
    pending_threshold: int = 3
    responsiveness: int = 3
    status_cap: int = 3
    # metrics
    slow_threshold_ms: int = 2
    latency_bucket_s: int = 5
    latency_retention_ms: int = HOUR_MS
    series_span_s: int = 3600
    # streaming
    watermark: str | None = "24 hours"
    # scale: a key with more rows than this is processed in ordered pieces
    max_group_rows: int = 1_000_000
    max_pieces: int = 20_000

    def __post_init__(self) -> None:
        hot = self.hot
        if isinstance(hot, str):
            hot = parse_int_set(hot)
        elif isinstance(hot, Iterable):
            hot = tuple(sorted(set(hot)))
        object.__setattr__(self, "hot", hot)
        if self.hot_mode not in ("last_digit", "literal"):
            raise ValueError(f"unknown hot_mode {self.hot_mode!r}")
        if self.hot_mode == "last_digit" and any(h < 0 or h > 9 for h in hot):
            raise ValueError("a last digit lies in 0..9; use hot_mode='literal' for station ids")
        if self.max_chain is not None and self.max_chain < 1:
            raise ValueError("max_chain must be at least 1")
        lower_bounds = {
            "window_ms": 0, "n_shards": 1, "min_a": 0, "dedupe_ttl_ms": 0, "shed_keep_last_n": 0,
            "shed_drop_k": 0, "shed_window_ms": 0, "slow_threshold_ms": 0, "detail_sample": 0,
            "latency_bucket_s": 1, "series_span_s": 1, "status_cap": 1, "max_group_rows": 1, "max_pieces": 1,
            "files_per_trigger": 1,
        }
        for name, low in lower_bounds.items():
            object.__setattr__(self, name, max(getattr(self, name), low))
        object.__setattr__(self, "shed_policy", normal_policy(self.shed_policy))


DEFAULT = PathConfig()
