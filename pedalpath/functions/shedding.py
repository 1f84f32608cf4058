"""Load-shedding policies on chain arrays."""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, functions as F

from ..config import DEFAULT, PathConfig, normal_policy


def shed(chain: Column | str, last_ts_ms: Column | str, policy: str, cfg: PathConfig = DEFAULT) -> Column:
    """The chain left after one call of ``policy``; unknown names change nothing."""
    chain = F.col(chain) if isinstance(chain, str) else chain
    last = F.col(last_ts_ms) if isinstance(last_ts_ms, str) else last_ts_ms
    policy = normal_policy(policy)
    if policy == "drop_oldest":
        return _newest(chain, max(cfg.shed_keep_last_n, 1))
    if policy == "drop_k":
        return F.slice(chain, cfg.shed_drop_k + 1, F.greatest(F.size(chain), F.lit(0)))
    if policy == "shrink_window":
        if cfg.shed_window_ms == 0:
            return _newest(chain, 1)
        return F.filter(chain, lambda t: t["started_at_ms"] >= last - F.lit(cfg.shed_window_ms))
    return chain


def _newest(chain: Column, n: int) -> Column:
    return F.slice(chain, F.greatest(F.size(chain) - F.lit(n - 1), F.lit(1)), n)


def shed_trips(chain: deque, last_ts_ms: int, cfg: PathConfig) -> None:
    """The same, in place, on a deque of (start, end, started, ended) for the stateful matcher."""
    keep = len(chain)
    if cfg.shed_policy == "drop_oldest":
        keep = max(cfg.shed_keep_last_n, 1)
    elif cfg.shed_policy == "drop_k":
        keep = len(chain) - cfg.shed_drop_k
    elif cfg.shed_policy == "shrink_window":
        keep = 1 if cfg.shed_window_ms == 0 else sum(t[2] >= last_ts_ms - cfg.shed_window_ms for t in chain)
    while chain and len(chain) > keep:
        chain.popleft()
