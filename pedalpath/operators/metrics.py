"""Latency series: buckets, newest values, slow events, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import DEFAULT, PathConfig
from .ordered import Ordered, by_key, find_hot_keys, neighbour


def latency_series(samples: DataFrame, cfg: PathConfig = DEFAULT) -> DataFrame:
    """One value per (shard, ts), the last written (by ``seq``), over the retention time (K6)."""
    last = samples.groupBy("shard", "ts").agg(F.max_by("latency_ms", "seq").alias("latency_ms"))
    newest = samples.groupBy("shard").agg(F.max("ts").alias("_newest"))
    age = F.timestamp_diff("MICROSECOND", F.col("ts"), F.col("_newest"))
    return last.join(newest, "shard").where(age <= cfg.latency_retention_ms * 1000).drop("_newest")


def latency_buckets(samples: DataFrame, cfg: PathConfig = DEFAULT, fill: bool = True) -> DataFrame:
    """Mean latency per shard and bucket; with ``fill``, empty buckets between a shard's first and
    last sample are there with a null mean (A5)."""
    width = cfg.latency_bucket_s
    at = (F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / width) * width).cast("bigint")
    means = samples.groupBy("shard", at.alias("bucket_s")).agg(
        F.avg("latency_ms").alias("mean_ms"), F.count("*").alias("n"))
    if not fill:
        return means
    span = means.groupBy("shard").agg(F.min("bucket_s").alias("lo"), F.max("bucket_s").alias("hi"))
    # Ranges open in two steps, so that one shard's buckets come from many tasks.
    stride = width * 1000
    grid = span.select("shard", "hi", F.explode(F.sequence("lo", "hi", F.lit(stride).cast("bigint"))).alias("at")) \
        .repartition("shard", "at") \
        .select("shard", F.explode(F.sequence("at", F.least(F.col("hi"), F.col("at") + stride - width),
                                              F.lit(width).cast("bigint"))).alias("bucket_s"))
    return grid.join(means, ["shard", "bucket_s"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def newest_mean(buckets: DataFrame) -> DataFrame:
    """The latest bucket of every shard (A10)."""
    return buckets.where(F.col("n") > 0).groupBy("shard").agg(
        F.max("bucket_s").alias("bucket_s"), F.max_by("mean_ms", "bucket_s").alias("mean_ms"))


def newest_sample(samples: DataFrame) -> DataFrame:
    """Time and value of the latest sample per shard."""
    return samples.groupBy("shard").agg(
        F.max("ts").alias("last_ts"),
        F.max_by("latency_ms", F.struct("ts", "seq")).alias("last_latency_ms"))


def poll_news(polls: DataFrame, cfg: PathConfig = DEFAULT) -> DataFrame:
    """For polls (shard, poll_ts, last_ts): did the newest sample move since the poll before."""
    hot = find_hot_keys(polls, "shard", cfg)

    def compare(o: Ordered) -> DataFrame:
        o = neighbour(o, "_b", ["last_ts"])
        return o.rows().select("shard", "poll_ts", "last_ts",
                               (~F.col("last_ts").eqNullSafe(F.col("_b.last_ts"))).alias("is_new"))

    return by_key(polls, "shard", ["poll_ts"], hot, compare, cfg)


def slow_counts(samples: DataFrame, cfg: PathConfig = DEFAULT) -> DataFrame:
    """Events slower than the threshold, per shard."""
    return samples.groupBy("shard").agg(
        F.count_if(F.col("latency_ms") > cfg.slow_threshold_ms).alias("slow"), F.count("*").alias("events"))


def event_latency(trips: DataFrame, done_ms) -> DataFrame:
    """Per-event latency samples from the ingest stamp to ``done_ms``."""
    return trips.select("shard", F.timestamp_millis(done_ms).alias("ts"),
                        (done_ms - F.col("ingest_ts_ms")).cast("double").alias("latency_ms"),
                        F.col("trip_seq").alias("seq"))
