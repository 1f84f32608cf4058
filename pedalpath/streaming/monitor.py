"""Streaming metrics and the streaming overload switch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import DEFAULT, PathConfig
from ..session import drop_path, fresh_path, ship_package
from .state import StateLog


def latency_stream(samples: DataFrame, cfg: PathConfig = DEFAULT, delay: str = "10 seconds") -> DataFrame:
    """Mean latency per shard and tumbling bucket, once the bucket has closed (T11). ``latency_sink`` has open ones too."""
    return (samples.withWatermark("ts", delay)
            .groupBy(F.window("ts", f"{cfg.latency_bucket_s} seconds"), "shard")
            .agg(F.avg("latency_ms").alias("mean_ms"), F.count("*").alias("n"))
            .select("shard", F.unix_seconds("window.start").alias("bucket_s"), "mean_ms", "n"))


_SUMS = "shard int, bucket_s bigint, total double, n bigint"


def latency_sink(samples: DataFrame, path: str, checkpoint: str, cfg: PathConfig = DEFAULT) -> DataStreamWriter:
    """Mean latency per shard and bucket, the newest ones while they are open (T11); ``read_latency`` reads it.

    Every batch puts the sums of the buckets it touched in the place of the former ones, by shard and bucket. A bucket
    may be added to at any time, so no sample is too late.
    """
    spark = samples.sparkSession
    log = _buckets(spark, path)
    width = cfg.latency_bucket_s

    def step(batch: DataFrame, number: int) -> None:
        place = fresh_path(spark, "latency-batch")
        at = (F.floor(F.unix_seconds("ts") / width) * width).cast("bigint")
        try:
            batch.groupBy("shard", at.alias("bucket_s")).agg(F.sum("latency_ms").alias("total"), F.count("*").alias("n")).write.parquet(place)
            fresh = spark.read.schema(_SUMS).parquet(place)
            both = fresh.unionByName(log.before(number, fresh))
            log.put(number, both.groupBy("shard", "bucket_s").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
        finally:
            drop_path(spark, place)

    return samples.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)


def _buckets(spark: SparkSession, path: str) -> StateLog:
    return StateLog(spark, path, _SUMS, ("shard", "bucket_s"))


def read_latency(spark: SparkSession, path: str) -> DataFrame:
    """shard, bucket_s, mean_ms, n of every bucket that ``latency_sink`` has a sample of, open ones included."""
    rows = _buckets(spark, path).before((1 << 62))
    return rows.select("shard", "bucket_s", (F.col("total") / F.col("n")).alias("mean_ms"), "n")


def _switch(cfg: PathConfig):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status = int(state.get[0]) if state.exists else 0
        polls = pd.concat(list(batches)).sort_values("ts", kind="mergesort")
        after = np.empty(len(polls), dtype="int32")
        for i, pending in enumerate(polls["pending"].tolist()):
            status = min(status + 1, cfg.status_cap) if pending > cfg.pending_threshold else max(status - 1, 0)
            after[i] = status
        state.update((status,))
        yield pd.DataFrame({"shard": polls["shard"].to_numpy(), "ts": polls["ts"].to_numpy(),
                            "pending": polls["pending"].to_numpy(), "status": after,
                            "active": after >= cfg.responsiveness})

    return run


def overload_stream(polls: DataFrame, cfg: PathConfig = DEFAULT) -> DataFrame:
    """The overload switch over a stream of polls: one small counter of state per shard."""
    ship_package(polls.sparkSession)
    return polls.select("shard", "ts", "pending").groupBy("shard").applyInPandasWithState(
        _switch(cfg), "shard int, ts timestamp, pending bigint, status int, active boolean",
        "status int", "append", GroupStateTimeout.NoTimeout)
