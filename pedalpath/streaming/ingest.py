"""Raw CSV files as they arrive, to trip records. Every file's columns are found by its own header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..config import DEFAULT, PathConfig
from ..operators.clean import clean_trips
from ..sources.sinks import write_trip_records
from ..sources.trips import read_files
from .state import StateLog, batch_path

# The layout of a stream of files; their content is never asked for.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def csv_ingest_sink(spark: SparkSession, source: str, path: str, state: str, checkpoint: str, cfg: PathConfig = DEFAULT,
                    id_parse: str = "strict", ingest_ts_ms: int | None = None, form: str = "json") -> DataStreamWriter:
    """Usable trips of a growing folder of CSV files, as records by shard, a folder a batch.

    The stream holds file names only, ``cfg.files_per_trigger`` a batch, and a batch reads its files as the batch reader does.
    ``trip_seq`` goes on from batch to batch: within a batch by folder month, path and place in the file. The next free number
    is committed with the batch, so a batch that runs again gives the same numbers.
    """
    files = spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", cfg.files_per_trigger) \
        .option("recursiveFileLookup", True).load(source).select("path")
    log = StateLog(spark, state, "source string, next_seq bigint", ("source",))

    def step(batch: DataFrame, number: int) -> None:
        paths = [r.path for r in batch.collect()]  # as many as a trigger takes
        if not paths:
            return
        known = log.before(number).first()
        raw, after = read_files(spark, paths, known.next_seq if known else 0)
        if raw is not None:
            good = clean_trips(raw.drop("_file"), id_parse, cfg.n_shards, ingest_ts_ms=ingest_ts_ms)
            write_trip_records(good, batch_path(path, number), form, "overwrite")
            log.put(number, spark.range(1).select(F.lit(source).alias("source"), F.lit(after).cast("bigint").alias("next_seq")))

    return files.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
