"""A store of latency samples by shard and span of time: appended to, compacted, and read for the retention time only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import DEFAULT, PathConfig
from ..operators.metrics import latency_series
from ..session import drop_path, fresh_path

_SAMPLES = "ts timestamp, latency_ms double, seq bigint, shard int, span bigint"


def append_samples(samples: DataFrame, path: str, cfg: PathConfig = DEFAULT) -> None:
    """Samples (shard, ts, latency_ms, seq) into the folders of their shard and span. One file a task and folder."""
    span = F.floor(F.unix_seconds("ts") / cfg.series_span_s).cast("bigint")
    samples.select("ts", "latency_ms", "seq", "shard", span.alias("span")).write.mode("append").partitionBy("shard", "span").parquet(path)


def _spans(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """Spans per shard that have a folder, rising; from the listing, without a look at the samples."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return {}
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/shard=*/span=*")) or []
    out: dict[int, list[int]] = {}
    for status in found:
        shard, span = re.search(r"shard=(-?\d+)/span=(-?\d+)$", status.getPath().toString()).groups()
        out.setdefault(int(shard), []).append(int(span))
    return {s: sorted(h) for s, h in out.items()}


def _retained(spans: dict[int, list[int]], cfg: PathConfig) -> Column:
    """The folders in which a sample may lie within the retention time before its shard's newest."""
    back = -(-cfg.latency_retention_ms // (1000 * cfg.series_span_s))
    wanted = F.lit(False)
    for shard, found in spans.items():
        wanted = wanted | ((F.col("shard") == shard) & (F.col("span") >= found[-1] - back))
    return wanted


def read_samples(spark: SparkSession, path: str, cfg: PathConfig = DEFAULT) -> DataFrame:
    """shard, ts, latency_ms of the retention time before each shard's newest sample; of equal stamps the last written (K6).

    The newest span of a shard is known from the listing, so only the folders that can matter are read.
    """
    spans = _spans(spark, path)
    if not spans:
        return spark.createDataFrame([], "shard int, ts timestamp, latency_ms double")
    kept = spark.read.schema(_SAMPLES).parquet(path).where(_retained(spans, cfg))
    return latency_series(kept.select("shard", "ts", "latency_ms", "seq"), cfg)


def compact_samples(spark: SparkSession, path: str, cfg: PathConfig = DEFAULT) -> None:
    """One row a stamp in the closed spans of the retention time (each shard's newest one is still appended to), a file a
    folder; folders beyond the retention time go."""
    spans = _spans(spark, path)
    back = -(-cfg.latency_retention_ms // (1000 * cfg.series_span_s))
    closed = F.lit(False)
    for shard, found in spans.items():
        closed = closed | ((F.col("shard") == shard) & (F.col("span") >= found[-1] - back) & (F.col("span") < found[-1]))
    rows = spark.read.schema(_SAMPLES).parquet(path).where(closed)
    newest = rows.groupBy("shard", "span", "ts").agg(F.max_by(F.struct("latency_ms", "seq"), "seq").alias("x"))
    place = fresh_path(spark, "series")
    try:
        newest.select("ts", "x.latency_ms", "x.seq", "shard", "span").repartition("shard", "span").write.parquet(place)
        spark.read.schema(_SAMPLES).parquet(place).repartition("shard", "span").write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("shard", "span").parquet(path)
    finally:
        drop_path(spark, place)
    for shard, found in spans.items():
        for span in found:
            if span < found[-1] - back:
                drop_path(spark, f"{path.rstrip('/')}/shard={shard}/span={span}")
