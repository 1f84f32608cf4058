"""Counts, top lists, samples and the comparison of two results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..config import DEFAULT, PathConfig
from ..operators.sequence import BIKE
from ..functions.scalar import shard_of
from ..operators.select import nth_by_group
from ..session import written


def totals(counts: DataFrame) -> DataFrame:
    """Bikes with a match, bikes, matches (A2)."""
    return counts.agg(F.count_if(F.col("matches") > 0).alias("bikes_matched"), F.count("*").alias("bikes"),
                      F.coalesce(F.sum("matches"), F.lit(0)).alias("matches"))


def count_by_bike(matches: DataFrame, bike: str = "bike") -> DataFrame:
    """Matches per bike from a list of matches; bikes without one are absent (A3)."""
    return matches.groupBy(F.col(bike).alias("bike")).agg(F.count("*").alias("matches"))


def top_bikes(counts: DataFrame, k: int, by: str = "matches") -> DataFrame:
    """The k bikes with most matches; equal counts in bike order (L1, L2)."""
    return counts.orderBy(F.desc(by), "bike").limit(k)


def compare_counts(batch: DataFrame, online: DataFrame) -> DataFrame:
    """Both counts per bike, 0 where one side lacks the bike, and the difference."""
    both = batch.select("bike", F.col("matches").alias("batch_matches")).join(
        online.select("bike", F.col("matches").alias("online_matches")), "bike", "full_outer").fillna(
        0, ["batch_matches", "online_matches"])
    return both.withColumn("delta", F.col("batch_matches") - F.col("online_matches"))


def count_correlation(compared: DataFrame) -> DataFrame:
    return compared.agg(F.corr("batch_matches", "online_matches").alias("correlation"))


def sample_details(details: DataFrame, per_bike: int = DEFAULT.detail_sample) -> DataFrame:
    """The first of every bike's listed details by (chain start, final trip) (W11); ``first_details`` lists no others.

    Spark cuts each task's rows to ``per_bike`` a bike before the shuffle, so no bike is gathered whole.
    """
    w = Window.partitionBy("bike").orderBy("a_pos", "b_pos")
    return details.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= per_bike).drop("_rn")


def dedupe_matches(matches: DataFrame) -> DataFrame:
    """The first ingested of the matches that share bike, first start, final end time and station (T4)."""
    keys = [BIKE, "first_ts_ms", "b_ended_ms", "b_end"]
    rest = [c for c in matches.columns if c not in keys]
    ordered = (["ingest_ts_ms"] if "ingest_ts_ms" in rest else []) + [c for c in rest if c != "ingest_ts_ms"]
    return matches.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_m")) \
        .select(*[F.col(c) if c in keys else F.col(f"_m.{c}") for c in matches.columns])


def active_bikes(trips: DataFrame, per_shard: int, cfg: PathConfig = DEFAULT) -> DataFrame:
    """The most recently active bikes of every shard, as many as its state may hold."""
    last = trips.groupBy(BIKE).agg(F.max(F.struct("started_at_ms", "trip_seq")).alias("_last")) \
        .select(BIKE, shard_of(BIKE, cfg.n_shards).alias("shard"), F.col("_last.started_at_ms").alias("last_ms"),
                F.col("_last.trip_seq").alias("last_seq"))
    # the time of the last one that counts is found by counting; a shard then ranks as many bikes as it may hold, and ties
    last = written(last.withColumn("_age", -F.col("last_ms")), "last-trips")
    cut = nth_by_group(last, "shard", "_age", per_shard)
    near = last.join(cut, "shard", "left").where(F.col("cut").isNull() | (F.col("_age") <= F.col("cut"))).drop("_age", "cut")
    w = Window.partitionBy("shard").orderBy(F.desc("last_ms"), F.desc("last_seq"))
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= per_shard)
