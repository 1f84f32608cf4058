"""The hot-station and window tests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..config import DEFAULT, PathConfig


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ends_hot(station: Column | str, digits: tuple[int, ...] = DEFAULT.hot) -> Column:
    """Last decimal digit of a whole number; floored modulo, so -3 counts as 7."""
    return F.pmod(_col(station), F.lit(10).cast("bigint")).isin(*digits)


def ends_hot_text(station: Column | str, digits: tuple[int, ...] = DEFAULT.hot) -> Column:
    """The same for text ids: whole numbers by value, other text by its last character."""
    from .scalar import parse_int
    number = parse_int(station)
    tail = F.substring(_col(station), -1, 1).isin(*[str(d) for d in digits])
    return F.coalesce(ends_hot(number, digits), tail)


def is_hot_id(station: Column | str, ids: tuple[int, ...]) -> Column:
    return _col(station).isin(*ids)


def hot_end(cfg: PathConfig, station: Column | str = "end_station_id") -> Column:
    return ends_hot(station, cfg.hot) if cfg.hot_mode == "last_digit" else is_hot_id(station, cfg.hot)


def within(first_ms: Column | str, last_ms: Column | str, window_ms: int) -> Column:
    """Both ends count: a span of exactly the window passes."""
    return (_col(last_ms) - _col(first_ms)) <= F.lit(window_ms)
