"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import fresh_path, ship_package, written

SPACES = " \t\n\x0b\f\r"
#: ``[^\x20\x09-\x0D]+`` as used by most operators here.
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
LOWER = (bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))


def word_count(text: Column) -> Column:
    """Number of white-space separated words, null as empty; stays in the JVM."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE_RUN))).cast("bigint")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[dict]]], schema: str | T.StructType,
                rows: int = 2_000) -> DataFrame:
    """``mapInArrow`` where ``make()`` builds, once a task, a function from a batch to output rows as dicts.

    Rows are gathered into batches of at most ``rows``, so that a long input batch never makes a long output one.
    """
    ship_package(df.sparkSession)
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, held = make(), []
        for batch in batches:
            for row in step(batch):
                held.append(row)
                if len(held) >= rows:
                    yield pa.RecordBatch.from_pylist(held, arrow)
                    held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, arrow)

    return df.mapInArrow(run, kind)


def texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def with_free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores before it, so that no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def drop_written(df_or_spark: DataFrame | SparkSession, *paths: str) -> None:
    """Delete tables that an operator wrote for itself and has finished reading."""
    spark = df_or_spark if isinstance(df_or_spark, SparkSession) else df_or_spark.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Like ``written``, with the path for ``drop_written``."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


class Scratch:
    """Tables an operator stores on its way: each deleted once its last reader has been stored, all of them in the end,
    also after an error."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        drop_written(self.spark, *[path for _, path in self.paths.values()])
        self.paths = {}

    def put(self, df: DataFrame, label: str) -> DataFrame:
        path = fresh_path(self.spark, f"{self.label}-{label}")
        self.paths[path] = (None, path)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        del self.paths[path]
        self.paths[id(table)] = (table, path)
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            drop_written(self.spark, self.paths.pop(id(table))[1])

    def keep(self, table: DataFrame) -> DataFrame:
        """The table stays when the others go."""
        self.paths.pop(id(table))
        return table


# --- a bitmap of fixed size, used to let most rows out of a join before it is shuffled

def bitmap_of(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bits ``hash mod 2**bits`` of the hashes, or-ed on the executors; the result has 2**bits / 8 bytes whatever
    the number of rows. A bit that several hashes share only lets more rows through to the exact join."""
    place = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    # ints, so that the driver gets 8 bytes a word
    bit = F.call_function("shiftleft", F.lit(1), place.bitwiseAND(F.lit(31)).cast("int"))
    words = hashes.select(F.shiftright(place, 5).cast("int").alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("word"))
    found = np.zeros(1 << (bits - 5), dtype=np.uint32)
    table = words.toArrow()
    found[table["at"].to_numpy()] = table["word"].to_numpy().view(np.uint32)
    return found


def in_bitmap(found: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes.astype(np.uint64) & np.uint64(len(found) * 32 - 1)
    return (found[(place >> np.uint64(5)).astype(np.int64)] >> (place & np.uint64(31)).astype(np.uint32)) & 1 > 0


# --- connected components

def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node reachable.

    Alternating large-star and small-star steps: every step joins nothing and keeps at most two rows an edge. A step
    that changes nothing ends the loop. Steps are written to the shared folder. A node with very many neighbours is
    never gathered: the steps need only the smallest neighbour, which is combined before the shuffle.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now = scratch.put(pairs, "components")  # a > b in every row, here and after every step
    before = None
    while True:
        turned = F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
        ends = now.select(F.explode(F.array(F.struct("a", "b"), turned)).alias("e")).select("e.*")
        least = ends.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: every larger neighbour points to the smallest of the neighbourhood; rows met twice go in the next step
        large = now.select(F.col("b").alias("a"), F.col("a").alias("b")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(least.where("a <> m").select("a", F.col("m").alias("b")))
        # two plans, as one would hold the first of them three times
        large = scratch.put(large, "stars")
        # small star: every smaller neighbour, and the node itself, points to the smallest one
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        after = scratch.put(small, "components")
        scratch.drop(large)
        scratch.drop(now)
        digest = after.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("bigint"))).first()
        now = after
        if tuple(digest) == before:
            break
        before = tuple(digest)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


__all__ = ["LOWER", "SPACES", "Scratch", "SPACE_RUN", "bitmap_of", "components", "drop_written", "in_bitmap", "lower_ascii",
           "map_batches", "stored", "texts", "with_free_name", "word_count", "written"]
