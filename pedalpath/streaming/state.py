"""Keyed state as stored tables, for micro-batches that run as plain DataFrame jobs.

A batch leaves a small table with the rows of the keys it touched; now and then the newest row of every key goes to one
snapshot. State before a batch is the snapshot and the tables after it, the newest row of a key counting. Tables are named by
batch number and written whole, so a batch that runs again, after a failure or a restart, reads the state it read before and
overwrites what it wrote. No key expires by the clock of other keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

VERSION = "_batch"


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def batch_path(path: str, batch: int) -> str:
    return f"{path.rstrip('/')}/batch-{batch:012d}"


@dataclass(frozen=True)
class StateLog:
    """``keys`` of ``schema`` (DDL text) name the state's rows; ``every`` so many batches a snapshot is taken."""

    spark: SparkSession
    path: str
    schema: str
    keys: tuple[str, ...]
    every: int = 16

    def _numbers(self, kind: str) -> list[int]:
        """Batches with a finished table of this kind, rising."""
        fs, place = _folder(self.spark, f"{self.path}/{kind}")
        if not fs.exists(place):
            return []
        names = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(place)]
        done = [n for n, p in names if n.startswith("batch-") and fs.exists(_folder(self.spark, f"{p}/_SUCCESS")[1])]
        return sorted(int(n.removeprefix("batch-")) for n in done)

    def before(self, batch: int, keys: DataFrame | None = None) -> DataFrame:
        """The newest row of every key, or of those in ``keys``, as it was before the batch."""
        snapshots = [n for n in self._numbers("full") if n < batch]
        last = snapshots[-1] if snapshots else -1
        paths = [batch_path(f"{self.path}/full", last)] if snapshots else []
        paths += [batch_path(f"{self.path}/delta", n) for n in self._numbers("delta") if last < n < batch]
        schema = f"{self.schema}, {VERSION} bigint"
        rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        if keys is not None:
            wanted = keys.select(*[F.col(c).alias(f"_of_{c}") for c in self.keys]).distinct()
            rows = rows.join(wanted, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in self.keys], "left_semi")
        rest = [c for c in rows.columns if c not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), VERSION).alias("_row"))
        return newest.select(*self.keys, *[f"_row.{c}" for c in rest if c != VERSION])

    def put(self, batch: int, rows: DataFrame, live: Column | None = None) -> None:
        """The new rows of the keys that the batch touched. Rows for which ``live`` is not true leave at the next snapshot."""
        rows.select(*StructType.fromDDL(self.schema).names, F.lit(batch).cast("bigint").alias(VERSION)).write.mode("overwrite").parquet(
            batch_path(f"{self.path}/delta", batch))
        done = self._numbers("delta")
        snapshots = self._numbers("full")
        if len([n for n in done if n > (snapshots[-1] if snapshots else -1)]) < self.every:
            return
        whole = self.before(batch + 1)
        whole = whole if live is None else whole.where(live)
        whole.withColumn(VERSION, F.lit(batch).cast("bigint")).write.mode("overwrite").parquet(batch_path(f"{self.path}/full", batch))
        # the batch may run once more: what it reads, the snapshot before and the tables after that, stays
        keep = snapshots[-1] if snapshots else -1
        for kind, numbers in (("delta", done), ("full", snapshots)):
            for n in numbers:
                if n < keep or kind == "delta" and n == keep:
                    fs, place = _folder(self.spark, batch_path(f"{self.path}/{kind}", n))
                    fs.delete(place, True)


__all__ = ["StateLog", "batch_path"]
