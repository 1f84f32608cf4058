"""Backlog, the overload switch and the flag in force at a trip's time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DEFAULT, HOUR_MS, PathConfig
from .ordered import HotKeys, Ordered, by_key, find_hot_keys, neighbour, running

# Entries folded in one array.
_FOLD = 512


def backlog(trips: DataFrame, processed: DataFrame, n_shards: int = DEFAULT.n_shards) -> DataFrame:
    """Trips not yet processed, per shard, shards without any included."""
    spark = trips.sparkSession
    shards = spark.range(n_shards).select(F.col("id").cast("int").alias("shard"))
    waiting = trips.join(processed.select("trip_seq"), "trip_seq", "left_anti") \
        .groupBy("shard").agg(F.count("*").alias("_n"))
    return shards.join(waiting, "shard", "left").select("shard", F.coalesce("_n", F.lit(0)).alias("pending"))


def _moved(status: Column, up: Column, cap: int) -> Column:
    return F.when(up, F.least(status + 1, F.lit(cap))).otherwise(F.greatest(status - 1, F.lit(0)))


def _states(items: Column, start: Column, step) -> Column:
    """The state before the first item and after every item."""
    return F.aggregate(items, F.array(start), lambda acc, x: F.array_append(acc, step(F.element_at(acc, -1), x)))


def overload_switch(polls: DataFrame, cfg: PathConfig = DEFAULT, hot: HotKeys | None = None, fold: int = _FOLD) -> DataFrame:
    """Status 0..cap per shard and poll, +1 over the threshold and -1 otherwise, and the flag.

    A clamped walk is not a plain running sum, but over a stretch of polls it is a small table from
    start status to end status. Polls fold to such tables 512 at a time, and tables fold the same way, level upon level
    until a shard has one; the start statuses flow back down. No array outgrows 512 entries, however long a shard's polls go on.
    """
    cap = cfg.status_cap
    hot = find_hot_keys(polls, "shard", cfg) if hot is None else hot
    placed = by_key(polls.select("shard", "ts", "pending"), "shard", ["ts"], hot,
                    lambda o: running(o, pos=("sum", F.lit(1).cast("bigint"))).rows(), cfg)
    part = F.floor((F.col("pos") - 1) / fold)
    grouped = placed.withColumn("part", part).groupBy("shard", "part").agg(
        F.sort_array(F.collect_list(F.struct("pos", "ts", "pending",
                                             (F.col("pending") > cfg.pending_threshold).alias("up")))).alias("polls"))
    starts = F.sequence(F.lit(0), F.lit(cap))
    leaves = grouped.withColumn("table", F.transform(
        starts, lambda s: F.aggregate("polls", s, lambda st, p: _moved(st, p["up"], cap))))

    def composed(tables: Column) -> Column:
        return F.transform(starts, lambda s: F.aggregate(
            tables, s, lambda st, t: F.element_at(t["table"], st + 1)))

    def opened(df: DataFrame) -> DataFrame:
        """(shard, no, start) of every listed table."""
        before = _states(F.col("tables"), F.col("start"), lambda st, t: F.element_at(t["table"], st + 1))
        return df.select("shard", F.explode(F.arrays_zip(F.col("tables.no").alias("no"), F.slice(before, 1, F.size("tables")).alias("start")))
                         .alias("z")).select("shard", F.col("z.no").alias("no"), F.col("z.start").alias("start"))

    longest = placed.groupBy("shard").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    levels, tables, parts = [], leaves.select("shard", F.col("part").alias("no"), "table"), -(-longest // fold)
    while True:
        level = tables.groupBy("shard", F.floor(F.col("no") / fold).alias("up")).agg(
            F.sort_array(F.collect_list(F.struct("no", "table"))).alias("tables"))
        levels.append(level)
        if parts <= fold:
            break
        tables, parts = level.select("shard", F.col("up").alias("no"), composed(F.col("tables")).alias("table")), -(-parts // fold)
    starts_of = opened(levels[-1].withColumn("start", F.lit(0)))
    for level in reversed(levels[:-1]):
        starts_of = opened(level.join(starts_of.withColumnRenamed("no", "up"), ["shard", "up"]))
    part_starts = starts_of.withColumnRenamed("no", "part")
    walked = leaves.drop("table").join(part_starts, ["shard", "part"]).withColumn(
        "after", F.slice(_states(F.col("polls"), F.col("start"), lambda st, p: _moved(st, p["up"], cap)),
                         2, F.size("polls")))
    return walked.select("shard", F.explode(F.arrays_zip("polls", "after")).alias("z")).select(
        "shard", F.col("z.polls.ts").alias("ts"), F.col("z.polls.pending").alias("pending"),
        F.col("z.after").alias("status"), (F.col("z.after") >= cfg.responsiveness).alias("active"))


def shed_flags(switch: DataFrame) -> DataFrame:
    return switch.select("shard", "ts", "active")


def flag_intervals(flags: DataFrame, cfg: PathConfig = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """Stretches (shard, from_ms, to_ms, active) between changes; the last of a shard has no end."""
    marked = flags.select("shard", F.unix_millis(F.col("ts").cast("timestamp")).alias("from_ms"), "active")
    hot = find_hot_keys(marked, "shard", cfg) if hot is None else hot

    def stretches(o: Ordered) -> DataFrame:
        o = neighbour(o, "_b", ["active"])
        changed = F.coalesce(F.col("_b.active") != F.col("active"), F.lit(True))
        return o.rows().where(changed).select("shard", "from_ms", "active")

    changes = by_key(marked, "shard", ["from_ms"], hot, stretches, cfg)

    def ends(o: Ordered) -> DataFrame:
        o = neighbour(o, "_n", ["from_ms"], +1)
        return o.rows().select("shard", "from_ms", F.col("_n.from_ms").alias("to_ms"), "active")

    return by_key(changes, "shard", ["from_ms"], hot, ends, cfg)


def attach_flag(trips: DataFrame, flags: DataFrame, at: str = "started_at_ms", cfg: PathConfig = DEFAULT,
                bucket_ms: int = HOUR_MS, hot: HotKeys | None = None) -> DataFrame:
    """Trips with the flag in force in their shard at their time, false before the first flag."""
    return attach_intervals(trips, flag_intervals(flags, cfg, hot), at, bucket_ms)


def attach_intervals(trips: DataFrame, stretches: DataFrame, at: str = "started_at_ms",
                     bucket_ms: int = HOUR_MS) -> DataFrame:
    """The same from the output of ``flag_intervals``, which a stream may store and reuse every batch.

    Stretches are listed under every time bucket they touch, so the as-of lookup is an equi-join on
    (shard, bucket); each trip meets at most one stretch. Trips after a shard's last change take its
    final flag. Trips are never gathered per shard. Also works with a stream on the left.
    """
    closed = stretches.where(F.col("to_ms").isNotNull()).select(
        F.col("shard").alias("_shard"), "from_ms", "to_ms", F.col("active").alias("_held"),
        F.explode(F.sequence(F.floor(F.col("from_ms") / bucket_ms),
                             F.floor((F.col("to_ms") - 1) / bucket_ms))).alias("_bucket"))
    final = stretches.where(F.col("to_ms").isNull()).select(
        F.col("shard").alias("_fshard"), F.col("from_ms").alias("_ffrom"), F.col("active").alias("_final"))
    t = F.col(at)
    joined = trips.join(closed, (F.col("shard") == F.col("_shard"))
                        & (F.floor(t / bucket_ms) == F.col("_bucket"))
                        & (t >= F.col("from_ms")) & (t < F.col("to_ms")), "left") \
        .join(final, F.col("shard") == F.col("_fshard"), "left")
    active = F.coalesce(F.col("_held"), F.when(t >= F.col("_ffrom"), F.col("_final")), F.lit(False))
    return joined.select(*[trips[c] for c in trips.columns], active.alias("active"))
