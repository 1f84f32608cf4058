"""Window computations over one key in a total order, safe for a key of any size.

A key with at most ``max_group_rows`` rows is one window group: one hash shuffle, no more.
Larger keys are few by definition. Their rows are range-partitioned on (key, order) so that one
key spreads over many tasks; every task computes its piece alone, and what a piece needs from the
pieces before it (the last row, a running total) travels in a table with one row per piece.
The choice of pieces changes where rows are computed and never what is computed.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import DEFAULT, PathConfig
from ..session import written

PIECE = "_piece"
TIE = "_tie"


@dataclass(frozen=True)
class HotKeys:
    """Keys above the size limit and how many rows they hold together; the table is None when there are no such keys."""

    table: DataFrame | None = None
    rows: int = 0


@dataclass(frozen=True)
class Ordered:
    df: DataFrame
    key: tuple[str, ...]
    order: tuple[str, ...]
    pieces: bool = False
    limit: PathConfig = DEFAULT

    @property
    def group(self) -> list[str]:
        return [*self.key, PIECE] if self.pieces else list(self.key)

    def window(self):
        return Window.partitionBy(*self.group).orderBy(*self.order)

    def with_columns(self, columns: dict[str, Column]) -> "Ordered":
        return replace(self, df=self.df.withColumns(columns))

    def rows(self) -> DataFrame:
        return self.df.drop(PIECE, TIE)


def find_hot_keys(df: DataFrame, key: str, limit: PathConfig = DEFAULT) -> HotKeys:
    """One narrow scan: only the key column is read, and counts are combined before the shuffle."""
    counts = df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > limit.max_group_rows)
    found = counts.agg(F.count("*").alias("keys"), F.sum("_n").alias("rows")).first()
    return HotKeys(written(counts.select(key), "hot-keys"), found["rows"]) if found["keys"] else HotKeys()


def by_key(df: DataFrame, key: str, order: list[str], hot: HotKeys, compute: Callable[[Ordered], DataFrame],
           limit: PathConfig = DEFAULT) -> DataFrame:
    """Run ``compute`` over whole keys, and over pieces for the keys in ``hot``."""
    if hot.table is None:
        return compute(Ordered(df, (key,), tuple(order), limit=limit))
    # The key table is written, so the planner knows its size and broadcasts it only when small.
    usual = compute(Ordered(df.join(hot.table, key, "left_anti"), (key,), tuple(order), limit=limit))
    large = compute(in_pieces(df.join(hot.table, key, "left_semi"), (key,), tuple(order), hot.rows, limit))
    return usual.unionByName(large)


def in_pieces(df: DataFrame, key: tuple[str, ...], order: tuple[str, ...], rows: int,
              limit: PathConfig = DEFAULT) -> Ordered:
    """Rows spread over range partitions of (key, order); a piece is one key's part of a partition.

    Rows that tie in the whole order are told apart by a running number, fixed here once, so that even
    copies of a single row spread over pieces.
    """
    n = min(limit.max_pieces, max(2, math.ceil(2 * rows / limit.max_group_rows)))
    placed = (df.drop(PIECE, TIE).withColumn(TIE, F.monotonically_increasing_id())
              .repartitionByRange(n, *key, *order, TIE)
              .withColumn(PIECE, F.spark_partition_id().cast("bigint")))
    return Ordered(written(placed, "pieces"), key, (*order, TIE), True, limit)


def _carry(o: Ordered, totals: dict[str, Column], carried: dict[str, Callable]) -> Ordered:
    """Join per-piece totals, folded over the key's other pieces, onto the piece's rows."""
    per_piece = o.df.groupBy(*o.group).agg(*[c.alias(n) for n, c in totals.items()])
    across = Window.partitionBy(*o.key).orderBy(PIECE)
    table = per_piece.select(*o.group, *[fold(across).alias(n) for n, fold in carried.items()])
    return replace(o, df=o.df.join(table, o.group, "left"))


def neighbour(o: Ordered, name: str, columns: list[str], step: int = -1) -> Ordered:
    """Struct ``name`` of ``columns`` from the row before (-1) or after (+1); null at the key's edge."""
    shift = F.lag if step < 0 else F.lead
    record = F.struct(*columns)
    local = shift(record).over(o.window())
    if not o.pieces:
        return o.with_columns({name: local})
    edge = F.max_by if step < 0 else F.min_by
    o = _carry(o, {"_edge": edge(record, F.struct(*o.order))},
               {"_carried": lambda w: shift("_edge").over(w)})
    o = o.with_columns({name: F.coalesce(local, F.col("_carried"))})
    return replace(o, df=o.df.drop("_carried"))


# kind -> (aggregate over rows, how a carried total and a local value combine)
_KINDS = {
    "sum": (F.sum, lambda carried, local: F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0))),
    "max": (F.max, lambda carried, local: F.greatest(carried, local)),
    "last": (lambda c: F.last(c, ignorenulls=True), lambda carried, local: F.coalesce(local, carried)),
}


def running(o: Ordered, exclusive: bool = False, **wanted: tuple[str, Column]) -> Ordered:
    """Running ``sum``, ``max`` or ``last`` non-null value from the key's first row to this row.

    ``exclusive`` leaves the row itself out.
    """
    frame = o.window().rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)
    local = {name: _KINDS[kind][0](expr).over(frame) for name, (kind, expr) in wanted.items()}
    if not o.pieces:
        if exclusive:
            local = {n: F.coalesce(c, F.lit(0)) if wanted[n][0] == "sum" else c for n, c in local.items()}
        return o.with_columns(local)
    position = F.struct(*o.order)
    totals, carried = {}, {}
    for name, (kind, expr) in wanted.items():
        held = f"_of_{name}"
        # A piece's last non-null value must follow the order, which a plain aggregate does not.
        totals[held] = F.max_by(expr, F.when(expr.isNotNull(), position)) if kind == "last" \
            else _KINDS[kind][0](expr)
        carried[held] = (lambda w, held=held, kind=kind:
                         _KINDS[kind][0](F.col(held)).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    o = _carry(o, totals, carried)
    o = o.with_columns({name: _KINDS[kind][1](F.col(f"_of_{name}"), local[name])
                        for name, (kind, _) in wanted.items()})
    return replace(o, df=o.df.drop(*totals))
