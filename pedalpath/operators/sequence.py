"""Per-bike sequence operators: order, continuity, runs, late-trip drop, chain summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import DEFAULT, PathConfig
from ..session import written
from .ordered import HotKeys, Ordered, by_key, find_hot_keys, in_pieces, neighbour, running

BIKE = "bike_id"
# Trips that tie in all of these are alike in every respect the pattern looks at.
TIME_ORDER = ["started_at_ms", "ended_at_ms", "trip_seq", "start_station_id", "end_station_id"]
ARRIVAL_ORDER = ["trip_seq", "started_at_ms", "ended_at_ms", "start_station_id", "end_station_id"]
# After every reading of the clock: sorts behind each row of the same time.
LAST = (1 << 63) - 1
# Length of the short tail kept beside the finished parts while a block is folded.
_FOLD_TAIL = 512


def _hot(trips: DataFrame, hot: HotKeys | None, cfg: PathConfig) -> HotKeys:
    return find_hot_keys(trips, BIKE, cfg) if hot is None else hot


def with_sequence(o: Ordered) -> Ordered:
    """Adds ``pos`` (1..n per bike), ``prev_end``, ``is_break``, ``run_no`` and ``run_first``."""
    o = neighbour(o, "_prev", ["end_station_id"])
    prev_end = F.col("_prev.end_station_id")
    o = o.with_columns({
        "prev_end": prev_end,
        "is_break": F.coalesce(prev_end != F.col("start_station_id"), F.lit(True)),
    })
    o = running(o, pos=("sum", F.lit(1).cast("bigint")),
                run_no=("sum", F.col("is_break").cast("bigint")))
    head = F.struct("pos", F.col("started_at_ms").alias("ts"), F.col("start_station_id").alias("station"))
    o = running(o, run_first=("last", F.when(F.col("is_break"), head)))
    return Ordered(o.df.drop("_prev"), o.key, o.order, o.pieces, o.limit)


def sequence_trips(trips: DataFrame, cfg: PathConfig = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """Trips with their place in the bike's order and in its unbroken runs."""
    hot = _hot(trips, hot, cfg)
    return by_key(trips, BIKE, TIME_ORDER, hot, lambda o: with_sequence(o).rows(), cfg) \
        .withColumn("run_start_pos", F.col("run_first.pos")).drop("run_first")


def chain_summary(trips: DataFrame, cfg: PathConfig = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """One row per unbroken run: first station and time, last station and time, length.

    A plain aggregate over (bike, run): partial results are combined before any shuffle.
    """
    place = F.col("pos")
    return sequence_trips(trips, cfg, hot).groupBy(BIKE, "run_no").agg(
        F.min_by("start_station_id", place).alias("first_start_station"),
        F.min_by("started_at_ms", place).alias("first_ts_ms"),
        F.max_by("end_station_id", place).alias("last_end_station"),
        F.max_by("ended_at_ms", place).alias("last_ts_ms"),
        F.count("*").alias("length"),
    )


def keep_newest(chain: Column | str, n: int) -> Column:
    """The newest ``n`` entries of a chain array."""
    chain = F.col(chain) if isinstance(chain, str) else chain
    return F.slice(chain, F.greatest(F.size(chain) - F.lit(n - 1), F.lit(1)), n)


def prune_chain(chain: Column | str, ended_ms: Column | str, window_ms: int) -> Column:
    """The entries of a chain array still in the window of a trip that ends at ``ended_ms``."""
    ended = F.col(ended_ms) if isinstance(ended_ms, str) else ended_ms
    return F.filter(chain, lambda t: t["started_at_ms"] >= ended - F.lit(window_ms))


def chain_entry() -> Column:
    return F.struct("start_station_id", "end_station_id", "started_at_ms", "ended_at_ms")


def _with_last(o: Ordered) -> DataFrame:
    """Trips in sequence with ``last``: what the bike's final trip says."""
    o = with_sequence(o)
    last = F.struct("pos", "run_no", F.col("ended_at_ms").alias("ended"), F.col("end_station_id").alias("station"))
    if not o.pieces:
        return o.df.withColumn("last", F.max(last).over(Window.partitionBy(*o.key)))
    return o.rows().join(o.df.groupBy(*o.key).agg(F.max(last).alias("last")), list(o.key))


def open_chains(trips: DataFrame, cfg: PathConfig = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """The chain every bike holds after its last trip: the tail of its last run within the window.

    Only tail trips are collected, so an array is bounded by what fits one window.
    """
    hot = _hot(trips, hot, cfg)

    def tail(o: Ordered) -> DataFrame:
        recent = F.col("started_at_ms") >= F.col("last.ended") - F.lit(cfg.window_ms)
        return _with_last(o).where((F.col("run_no") == F.col("last.run_no"))
                                   & (recent | (F.col("pos") == F.col("last.pos")))) \
            .select(BIKE, "pos", "last", chain_entry().alias("trip"))

    chain = F.transform(F.sort_array(F.collect_list(F.struct("pos", "trip"))), lambda x: x["trip"])
    chains = by_key(trips, BIKE, TIME_ORDER, hot, tail, cfg).groupBy(BIKE).agg(
        F.first("last.ended").alias("last_ts_ms"), F.first("last.station").alias("last_end"), chain.alias("chain"))
    return chains if cfg.max_chain is None else chains.withColumn("chain", keep_newest("chain", cfg.max_chain))


# --- late trips -------------------------------------------------------------------------------

def _blocks(o: Ordered) -> Ordered:
    """Cut the order where a trip starts at or after every earlier end.

    Such a trip is kept whatever came before, so each block is decided alone. Adds ``_block`` and
    ``_alone`` (the block has one trip).
    """
    o = running(o, exclusive=True, _busy_until=("max", F.col("ended_at_ms")))
    cut = F.coalesce(F.col("started_at_ms") >= F.col("_busy_until"), F.lit(True))
    o = running(o.with_columns({"_cut": cut}), _block=("sum", F.col("_cut").cast("bigint")))
    o = neighbour(o, "_next", ["_cut"], +1)
    o = o.with_columns({"_alone": F.col("_cut") & F.coalesce(F.col("_next._cut"), F.lit(True))})
    return Ordered(o.df.drop("_busy_until", "_next"), o.key, o.order, o.pieces, o.limit)


def _fold_block(block: Column) -> Column:
    """Greedy keep over one block's trips, in order.

    Kept trips gather in a short tail that moves to the finished parts when full: appending copies
    the array it extends, and this keeps the copies short for a long block.
    """
    start = F.struct(F.lit(-LAST).alias("until"), F.slice(block, 1, 0).alias("tail"),
                     F.slice(F.array(block), 1, 0).alias("full"))

    def step(acc, trip):
        roomy = F.size(acc["tail"]) < _FOLD_TAIL
        taken = F.struct(
            trip["ended_at_ms"].alias("until"),
            F.when(roomy, F.array_append(acc["tail"], trip)).otherwise(F.array(trip)).alias("tail"),
            F.when(roomy, acc["full"]).otherwise(F.array_append(acc["full"], acc["tail"])).alias("full"))
        return F.when(trip["started_at_ms"] >= acc["until"], taken).otherwise(acc)

    return F.aggregate(block, start, step, lambda acc: F.flatten(F.array_append(acc["full"], acc["tail"])))


def _keep_whole(o: Ordered) -> DataFrame:
    """Blocks of a bike that fits one task: single trips pass, longer blocks are folded in the JVM."""
    columns = o.df.columns
    cut = _blocks(o).df
    rest = [c for c in columns if c not in (*o.key, *o.order)]
    folded = (cut.where(~F.col("_alone"))
              .groupBy(*o.key, "_block")
              .agg(F.sort_array(F.collect_list(F.struct(*o.order, *rest))).alias("_trips"))
              .select(*o.key, F.explode(_fold_block(F.col("_trips"))).alias("_t"))
              .select(*o.key, "_t.*"))
    return cut.where("_alone").select(*columns).unionByName(folded.select(*columns))


def _keep_pieces(o: Ordered) -> DataFrame:
    """Blocks of a bike too large for one task, by pointer doubling.

    Each trip points to the first later trip of its block that starts at or after its end. The kept
    trips are those reached from the block's first trip, so doubling the pointers finds them in
    log2(longest block) rounds of joins on (bike, position), a key no two rows share.
    """
    columns = o.rows().columns
    placed = running(_blocks(o), pos=("sum", F.lit(1).cast("bigint")))
    placed = written(placed.rows(), "blocks")
    inside = placed.where(~F.col("_alone"))
    node = F.struct("pos", "_block", F.col("_cut").alias("head"))
    # Looking back from the latest time, the last trip seen at a trip's end is its successor.
    here = F.struct((-F.col("started_at_ms")).alias("_t"), (-F.col("pos")).alias("_p"),
                    node.alias("trip"), F.lit(None).cast("struct<pos:bigint,_block:bigint>").alias("ask"))
    ask = F.struct((-F.col("ended_at_ms")).alias("_t"), F.lit(LAST).alias("_p"),
                   F.lit(None).cast("struct<pos:bigint,_block:bigint,head:boolean>").alias("trip"),
                   F.struct("pos", "_block").alias("ask"))
    looked = inside.where(F.col("ended_at_ms") > F.col("started_at_ms"))
    asked = inside.select(BIKE, here.alias("s")).unionByName(looked.select(BIKE, ask.alias("s"))) \
        .select(BIKE, "s.*")
    swept = running(in_pieces(asked, (BIKE,), ("_t", "_p"), 2 * _rows(placed), o.limit),
                    found=("last", F.col("trip"))).rows()
    ends_later = swept.where(F.col("ask").isNotNull() & (F.col("found._block") == F.col("ask._block"))) \
        .select(BIKE, F.col("ask.pos").alias("pos"), F.col("found.pos").alias("to"))
    # A trip of no length is followed by the next trip of its block, which starts no earlier.
    instant = inside.where(F.col("ended_at_ms") == F.col("started_at_ms")) \
        .select(BIKE, "pos", (F.col("pos") + 1).alias("to"))
    instant = instant.join(inside.where(~F.col("_cut")).select(BIKE, F.col("pos").alias("to")),
                           [BIKE, "to"], "left_semi").select(BIKE, "pos", "to")
    jump = written(ends_later.unionByName(instant), "jump")
    reached = inside.where("_cut").select(BIKE, "pos")
    while not jump.isEmpty():
        hop = jump.join(reached, [BIKE, "pos"], "left_semi").select(BIKE, F.col("to").alias("pos"))
        reached = written(reached.unionByName(hop), "reached")
        second = jump.select(BIKE, F.col("pos").alias("to"), F.col("to").alias("beyond"))
        jump = written(jump.join(second, [BIKE, "to"]).select(BIKE, "pos", F.col("beyond").alias("to")), "jump")
    kept = inside.join(reached, [BIKE, "pos"], "left_semi")
    return placed.where("_alone").select(*columns).unionByName(kept.select(*columns))


def _rows(table: DataFrame) -> int:
    return table.count()


def drop_late(trips: DataFrame, order: str = "time", cfg: PathConfig = DEFAULT,
              hot: HotKeys | None = None) -> DataFrame:
    """Keep a trip iff it starts at or after the end of the last *kept* trip of its bike.

    ``order='arrival'`` walks the trips by ``trip_seq``. There a trip that starts before any earlier
    arrival is never kept: had that arrival been kept, its end would be later still, and had it been
    dropped, some kept trip ends after its start. So a running maximum removes those trips, and what
    is left arrives in start order.
    """
    trips = trips.where(F.col("ended_at_ms") >= F.col("started_at_ms"))
    hot = _hot(trips, hot, cfg)
    walk = TIME_ORDER
    if order == "arrival":
        columns = trips.columns
        trips = by_key(
            trips, BIKE, ARRIVAL_ORDER, hot,
            lambda o: running(o, exclusive=True, _latest=("max", F.col("started_at_ms"))).rows()
            .where(F.coalesce(F.col("started_at_ms") >= F.col("_latest"), F.lit(True))).select(*columns), cfg)
        walk = ["started_at_ms", *[c for c in ARRIVAL_ORDER if c != "started_at_ms"]]
    elif order != "time":
        raise ValueError(f"unknown order {order!r}")
    return by_key(trips, BIKE, walk, hot, lambda o: _keep_pieces(o) if o.pieces else _keep_whole(o), cfg)
