"""File streams. The checkpoint holds the position; the trigger bounds a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import DEFAULT, PathConfig
from ..schemas import BACKLOG, LATENCY, MATCH_TEXT, TRIP, WIRE_TRIP
from .trips import usable_records


def stream_trip_records(spark: SparkSession, path: str, cfg: PathConfig = DEFAULT,
                        form: str = "json") -> DataFrame:
    """Typed trips from a growing folder of wire records (json) or typed rows (parquet)."""
    reader = spark.readStream.option("maxFilesPerTrigger", cfg.files_per_trigger) \
        .option("recursiveFileLookup", True)
    if form == "json":
        trips = usable_records(reader.schema(WIRE_TRIP).json(path))
    else:
        trips = reader.schema(TRIP).parquet(path)
    return trips.withColumn("started_at", F.timestamp_millis("started_at_ms"))


def stream_matches(spark: SparkSession, path: str) -> DataFrame:
    """All matches: the files already there, then each new one. One reader, so none falls between."""
    return typed_matches(spark.readStream.option("recursiveFileLookup", True).schema(MATCH_TEXT).json(path))


def read_matches(spark: SparkSession, path: str) -> DataFrame:
    return typed_matches(spark.read.option("recursiveFileLookup", True).schema(MATCH_TEXT).json(path))


def typed_matches(text: DataFrame) -> DataFrame:
    longs = ("a1_start", "ai_end", "b_end", "first_ts_ms", "b_ended_ms", "ingest_ts_ms", "emit_ts_ms")
    casts = {n: F.col(n).try_cast("bigint") for n in longs}
    return text.withColumns({**casts, "length_a": F.col("length_a").try_cast("int")})


def stream_latency(spark: SparkSession, path: str, cfg: PathConfig = DEFAULT) -> DataFrame:
    return spark.readStream.schema(LATENCY).option("maxFilesPerTrigger", cfg.files_per_trigger).parquet(path)


def stream_backlog(spark: SparkSession, path: str, cfg: PathConfig = DEFAULT) -> DataFrame:
    return spark.readStream.schema(BACKLOG).option("maxFilesPerTrigger", cfg.files_per_trigger).parquet(path)
