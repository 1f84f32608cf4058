"""Batch and streaming writers. Every streaming writer commits through its checkpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.scalar import now_ms
from ..schemas import MATCH, WIRE_TRIP
from ..session import drop_path, fresh_path


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _wire(trips: DataFrame) -> DataFrame:
    names = [f.name for f in WIRE_TRIP]
    return trips.select("shard", *[F.col(n).cast("string").alias(n) for n in names])


def write_trip_records(trips: DataFrame, path: str, form: str = "json", mode: str = "append") -> None:
    """Trips in one folder per shard. No shuffle: each task adds its own file to each folder."""
    out = _wire(trips) if form == "json" else trips
    out.write.mode(mode).partitionBy("shard").format(form).save(path)


def stream_trip_sink(trips: DataFrame, path: str, checkpoint: str, form: str = "json") -> DataStreamWriter:
    out = _wire(trips) if form == "json" else trips
    return (out.writeStream.format(form).partitionBy("shard").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint))


def stamped_matches(matches: DataFrame, emit_ts_ms: int | None = None) -> DataFrame:
    """Matches with the emit time (now, unless given) in the record's column order."""
    stamp = F.lit(emit_ts_ms).cast("bigint") if emit_ts_ms is not None else now_ms()
    return matches.withColumn("emit_ts_ms", stamp).select(*[f.name for f in MATCH])


def match_latency(matches: DataFrame) -> DataFrame:
    return matches.withColumn("latency_ms", F.col("emit_ts_ms") - F.col("ingest_ts_ms"))


def write_matches(matches: DataFrame, path: str, mode: str = "append") -> None:
    """JSON Lines, all values text."""
    as_text(matches).write.mode(mode).json(path)


def stream_match_sink(matches: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return (as_text(matches.select(*[f.name for f in MATCH])).writeStream.format("json").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_months(df: DataFrame, month: Column, path: str) -> None:
    """CSV files in folders ``folder=<n>_Month`` by the number ``month``, in one write; the number is not in the files."""
    df.withColumn("folder", F.concat(month.cast("string"), F.lit("_Month"))).drop("_m") \
        .write.partitionBy("folder").option("header", True).csv(path)


def write_detail_sample(details: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """Written only when there is a row to write; says whether it was. The rows are made once."""
    spark = details.sparkSession
    kept = fresh_path(spark, "detail-sample")
    details.write.parquet(kept)
    try:
        stored = spark.read.schema(details.schema).parquet(kept)
        if stored.isEmpty():
            return False
        write_csv(stored, path, mode)
        return True
    finally:
        drop_path(spark, kept)


def mark_processed(trips: DataFrame, path: str) -> None:
    """Record the trips that are done, by sequence number."""
    trips.select("trip_seq").write.mode("append").parquet(path)


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there, batch by batch, and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
