"""Hot paths in batch: chains of trips that end at a hot station within the window.

``longest`` gives one match per final trip, with the longest chain in the window; ``all`` gives one
match per (chain start, final trip). The longest chain of a trip starts at the later of two trips:
the first of its run and the first that starts inside its window. Both are running values over a
sorted order, so the work is linear in the trips however many chains there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..config import DEFAULT, PathConfig
from ..functions.predicates import hot_end
from ..operators.ordered import HotKeys, Ordered, by_key, find_hot_keys, in_pieces, neighbour, running
from ..operators.sequence import BIKE, LAST, TIME_ORDER, drop_late, with_sequence
from ..session import written
from ..sources.trips import wire_reject_reason

MATCH_COLUMNS = ["bike_id", "a1_start", "ai_end", "b_end", "first_ts_ms", "b_ended_ms", "length_a",
                 "ingest_ts_ms"]
_TRIP = ["bike_id", "start_station_id", "end_station_id", "started_at_ms", "ended_at_ms", "ingest_ts_ms",
         "trip_seq"]
_PLACE = "struct<pos:bigint,ts:bigint,station:bigint>"
_NO_B = ("struct<pos:bigint,run_first:" + _PLACE + ",start_station_id:bigint,end_station_id:bigint,"
         "ended_at_ms:bigint,ingest_ts_ms:bigint>")


def _place():
    return F.struct("pos", F.col("started_at_ms").alias("ts"), F.col("start_station_id").alias("station"))


def _final_trip(cfg: PathConfig):
    """A trip that can end a path: hot, not longer than the window, and with a trip before it."""
    test = hot_end(cfg) & ((F.col("ended_at_ms") - F.col("started_at_ms")) <= F.lit(cfg.window_ms))
    return test if cfg.min_a == 0 else test & ~F.col("is_break")


def _swept(o: Ordered, cfg: PathConfig) -> DataFrame:
    """One row per trip and one more per final trip, which carries ``b`` and the ``lower`` trip.

    A final trip asks for the first trip at or after (its end - window). Walking back in time, that
    is the last trip seen, hence one running value and no pairs of trips.
    """
    placed = with_sequence(o).df
    b = F.struct("pos", "run_first", "start_station_id", "end_station_id", "ended_at_ms", "ingest_ts_ms")
    here = F.struct((-F.col("started_at_ms")).alias("_t"), (-F.col("pos")).alias("_p"),
                    _place().alias("a"), F.lit(None).cast(_NO_B).alias("b"))
    ask = F.struct((F.lit(cfg.window_ms) - F.col("ended_at_ms")).alias("_t"), F.lit(LAST).alias("_p"),
                   F.lit(None).cast(_PLACE).alias("a"), b.alias("b"))
    rows = placed.select(
        BIKE, F.explode(F.when(_final_trip(cfg), F.array(here, ask)).otherwise(F.array(here))).alias("s")
    ).select(BIKE, "s.*")
    sweep = Ordered(rows, (BIKE,), ("_t", "_p"), limit=o.limit)
    if o.pieces:
        sweep = in_pieces(rows, (BIKE,), ("_t", "_p"), 2 * o.df.count(), o.limit)
    swept = running(sweep, seen=("last", F.col("a"))).df
    first = F.when(F.col("seen.pos") >= F.col("b.run_first.pos"), F.col("seen")).otherwise(F.col("b.run_first"))
    length = F.col("b.pos") - F.col("lower.pos")
    if cfg.max_chain is not None:
        length = F.least(length, F.lit(cfg.max_chain).cast("bigint"))
    return (swept.withColumn("lower", F.when(F.col("b").isNotNull(), first))
            .withColumn("length_a", length).select(BIKE, "b", "lower", "length_a"))


def _found(swept: DataFrame, cfg: PathConfig) -> DataFrame:
    return swept.where(F.col("length_a") >= cfg.min_a)


def _as_match(rows: DataFrame) -> DataFrame:
    """From (bike, b, a, length_a) to the match record, with the two positions for ordering."""
    return rows.select(
        BIKE,
        F.col("a.station").alias("a1_start"),
        F.when(F.col("length_a") > 0, F.col("b.start_station_id")).otherwise(F.col("b.end_station_id"))
        .alias("ai_end"),
        F.col("b.end_station_id").alias("b_end"),
        F.col("a.ts").alias("first_ts_ms"),
        F.col("b.ended_at_ms").alias("b_ended_ms"),
        F.col("length_a").cast("int").alias("length_a"),
        F.col("b.ingest_ts_ms").alias("ingest_ts_ms"),
        F.col("a.pos").alias("a_pos"),
        F.col("b.pos").alias("b_pos"),
    )


def _look_up_start(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """Attach the chain's first trip by its position; (bike, position) is unique, so nothing skews."""
    starts = placed.select(BIKE, F.col("pos").alias("a_pos"), _place().alias("a"))
    return rows.join(starts, [BIKE, "a_pos"]).drop("a_pos")


def _longest(o: Ordered, cfg: PathConfig) -> DataFrame:
    found = _found(_swept(o, cfg), cfg)
    if cfg.max_chain is None:
        return _as_match(found.withColumn("a", F.col("lower")))
    found = found.withColumn("a_pos", F.col("b.pos") - F.col("length_a")).drop("lower")
    return _as_match(_look_up_start(found, with_sequence(o).df))


def _all(o: Ordered, cfg: PathConfig) -> DataFrame:
    """Every chain start between the lower trip and the final trip, looked up by position.

    What is listed is the result: a pair is a row from the start, and no trip gathers its chains.
    """
    found = _found(_swept(o, cfg), cfg).drop("lower")
    pairs = found.withColumn("length_a", F.explode(F.sequence(F.lit(cfg.min_a).cast("bigint"), "length_a"))) \
        .withColumn("a_pos", F.col("b.pos") - F.col("length_a"))
    return _as_match(_look_up_start(pairs, with_sequence(o).df))


def _usable(trips: DataFrame) -> DataFrame:
    """The columns the pattern needs; trips that lack one or end before they start are for the reject table."""
    return trips.select(*_TRIP).where((F.col("ended_at_ms") >= F.col("started_at_ms")) & wire_reject_reason().isNull())


def _prepared(trips: DataFrame, mode: str, overlap: str | None, order: str, cfg: PathConfig,
              hot: HotKeys | None) -> tuple[DataFrame, HotKeys]:
    if mode not in ("longest", "all"):
        raise ValueError(f"unknown mode {mode!r}")
    overlap = overlap or ("drop" if mode == "longest" else "keep")
    if overlap not in ("drop", "keep"):
        raise ValueError(f"unknown overlap {overlap!r}")
    if order == "arrival" and overlap == "keep":
        raise ValueError("arrival order needs overlap='drop': without the drop the trips are not in time order")
    if order not in ("time", "arrival"):
        raise ValueError(f"unknown order {order!r}")
    trips = _usable(trips)
    hot = find_hot_keys(trips, BIKE, cfg) if hot is None else hot
    if overlap == "drop":
        trips = drop_late(trips, order, cfg, hot)
    return trips, hot


def placed_hot_paths(trips: DataFrame, mode: str = "longest", overlap: str | None = None, order: str = "time",
                     cfg: PathConfig = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """Match records with ``a_pos`` and ``b_pos``, the places of the two end trips in the bike's order."""
    trips, hot = _prepared(trips, mode, overlap, order, cfg, hot)
    found = _longest if mode == "longest" else _all
    return by_key(trips, BIKE, TIME_ORDER, hot, lambda o: found(o, cfg), cfg)


def hot_paths(trips: DataFrame, mode: str = "longest", overlap: str | None = None, order: str = "time",
              cfg: PathConfig = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """Match records. ``longest`` drops late trips by default, ``all`` keeps overlaps."""
    return placed_hot_paths(trips, mode, overlap, order, cfg, hot).select(*MATCH_COLUMNS)


def first_pairs(spans: DataFrame, n: int, per_bike: bool, hot: HotKeys, cfg: PathConfig = DEFAULT) -> DataFrame:
    """(bike, a_pos, b, length_a): the first ``n`` pairs of each bike, or of all bikes, by (bike, a_pos, b_pos).

    ``spans`` has a row per final trip: its chains start at the positions ``lo`` to ``hi``. How many spans cover a position
    is a running sum over their ends, so the number of pairs before any position is known without a pair; up to the
    position at which ``n`` is reached, and there for as many final trips as are wanting, pairs are listed. So exactly
    the pairs of the result are.
    """
    pairs = F.col("hi") - F.col("lo") + 1
    if per_bike:
        quota = spans.select(BIKE).distinct().withColumn("quota", F.lit(n).cast("bigint"))
    else:
        # a bike in the table has a pair at least, so the first n bikes are enough
        some = spans.groupBy(BIKE).agg(F.sum(pairs).alias("pairs")).orderBy(BIKE).limit(n)
        before = F.sum("pairs").over(Window.orderBy(BIKE).rowsBetween(Window.unboundedPreceding, -1))
        quota = some.select(BIKE, (F.lit(n) - F.coalesce(before, F.lit(0))).alias("quota")).where("quota > 0")
        quota = written(quota, "quota")
        spans = spans.join(quota.select(BIKE), BIKE, "left_semi")
    one = F.lit(1).cast("bigint")
    ends = spans.select(BIKE, F.inline(F.array(F.struct(F.col("lo").alias("pos"), one.alias("more")),
                                               F.struct((F.col("hi") + 1).alias("pos"), (-one).alias("more")))))
    ends = ends.groupBy(BIKE, "pos").agg(F.sum("more").alias("more")).join(quota, BIKE)

    def covered(o: Ordered) -> DataFrame:
        o = running(neighbour(o, "_next", ["pos"], +1), n=("sum", F.col("more")))
        o = o.with_columns({"width": F.coalesce(F.col("_next.pos"), F.col("pos")) - F.col("pos")})
        return running(o, exclusive=True, before=("sum", F.col("n") * F.col("width"))).rows()

    reach = by_key(ends, BIKE, ["pos"], hot, covered, cfg).where((F.col("n") > 0) & (F.col("before") < F.col("quota")))
    rest = F.col("quota") - F.col("before")
    last = F.col("pos") + F.least("width", F.ceil(rest / F.col("n"))) - 1
    edge = reach.groupBy(BIKE).agg(F.max(F.struct(last.alias("last"), (rest - (last - F.col("pos")) * F.col("n")).alias("need"))).alias("e")) \
        .select(BIKE, "e.last", "e.need")
    near = spans.join(edge, BIKE).where(F.col("lo") <= F.col("last"))
    whole = near.where(F.col("lo") < F.col("last")).withColumn(
        "a_pos", F.explode(F.sequence("lo", F.least(F.col("hi"), F.col("last") - 1))))
    turn = F.row_number().over(Window.partitionBy(BIKE).orderBy("b.pos"))
    # the limit by a constant lets every task cut its rows before the shuffle
    part = near.where(F.col("hi") >= F.col("last")).withColumn("turn", turn).where(F.col("turn") <= n) \
        .where(F.col("turn") <= F.col("need")).withColumn("a_pos", F.col("last")).drop("turn")
    return whole.unionByName(part).select(BIKE, "a_pos", "b", (F.col("b.pos") - F.col("a_pos")).alias("length_a"))


def first_details(trips: DataFrame, n: int, per_bike: bool = False, overlap: str | None = None,
                  cfg: PathConfig = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """The first ``n`` details of ``all``, over all bikes (L3) or of each (W11), by (bike, chain start, final trip)."""
    trips, hot = _prepared(trips, "all", overlap, "time", cfg, hot)
    spans = by_key(trips, BIKE, TIME_ORDER, hot, lambda o: _found(_swept(o, cfg), cfg), cfg).select(
        BIKE, "b", (F.col("b.pos") - F.col("length_a")).alias("lo"), (F.col("b.pos") - F.lit(cfg.min_a)).alias("hi"))
    pairs = first_pairs(written(spans, "spans"), n, per_bike, hot, cfg)
    placed = by_key(trips, BIKE, TIME_ORDER, hot, lambda o: with_sequence(o).rows(), cfg)
    return as_details(_as_match(_look_up_start(pairs, placed)))


def match_counts(trips: DataFrame, mode: str = "all", overlap: str | None = None, order: str = "time",
                 cfg: PathConfig = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """Matches per bike, zeros included, without listing a single match (A1).

    A final trip with a longest chain of k has one match per chain length from ``min_a`` to k.
    """
    trips, hot = _prepared(trips, mode, overlap, order, cfg, hot)
    per_trip = F.lit(1) if mode == "longest" else F.col("length_a") - F.lit(cfg.min_a - 1)
    counted = F.when(F.col("length_a") >= cfg.min_a, per_trip).otherwise(0).cast("bigint")
    swept = by_key(trips, BIKE, TIME_ORDER, hot, lambda o: _swept(o, cfg), cfg)
    return swept.groupBy(F.col(BIKE).alias("bike")).agg(F.sum(counted).alias("matches"))


def match_details(trips: DataFrame, mode: str = "all", overlap: str | None = None,
                  cfg: PathConfig = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """Matches in the audit layout, where the length counts the final trip too."""
    return as_details(placed_hot_paths(trips, mode, overlap, "time", cfg, hot))


def as_details(matches: DataFrame) -> DataFrame:
    return matches.select(
        F.col(BIKE).alias("bike"),
        F.timestamp_millis("first_ts_ms").alias("a1_start_time"),
        F.col("ai_end").alias("a_last_end_station"),
        F.col("b_end").alias("b_end_station"),
        F.timestamp_millis("b_ended_ms").alias("b_stop_time"),
        (F.col("length_a") + 1).cast("int").alias("chain_len"),
        "a_pos", "b_pos",
    )


def early_variant(trips: DataFrame, cfg: PathConfig = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """The superseded rule: a single trip by last digit, longer chains by literal station id."""
    from dataclasses import replace
    alone = _usable(trips).where(hot_end(replace(cfg, hot_mode="last_digit")) & (
        (F.col("ended_at_ms") - F.col("started_at_ms")) <= F.lit(cfg.window_ms))).select(
        BIKE, F.col("start_station_id").alias("a1_start"), F.col("end_station_id").alias("ai_end"),
        F.col("end_station_id").alias("b_end"), F.col("started_at_ms").alias("first_ts_ms"),
        F.col("ended_at_ms").alias("b_ended_ms"), F.lit(0).alias("length_a"), "ingest_ts_ms")
    chains = hot_paths(trips, "all", "keep", cfg=replace(cfg, hot_mode="literal"), hot=hot)
    return alone.unionByName(chains)
