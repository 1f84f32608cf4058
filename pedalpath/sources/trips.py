"""Trip sources: CSV files, month folders, wire records."""

from __future__ import annotations

import csv
import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.scalar import decode_text, month_of_folder
from ..schemas import RAW_TRIP, WIRE_TRIP

# Names tried first for the bike column, in order (fixed values).
BIKE_COLUMNS = ("Bike ID", "bike_id", "bikeid", "BikeID", "bike", "Bike", "Bike Number", "Bike Number ID")


def _rank(column: str) -> int | None:
    """How well a header fits the bike column, best first; None if not at all."""
    if column in BIKE_COLUMNS:
        return BIKE_COLUMNS.index(column)
    return len(BIKE_COLUMNS) if "bike" in column.casefold() else None


def find_bike_column(columns: list[str]) -> str:
    """The column whose header fits best; of equals the one further left."""
    fitting = [c for c in columns if _rank(c) is not None]
    if not fitting:
        raise KeyError(f"none of these columns looks like a bike id: {columns}")
    return min(fitting, key=_rank)


# Headers of other years, as letters and digits (fixed values) -> raw name. Those that differ from a raw name only in case and
# signs need no entry.
OTHER_HEADERS = {"startedat": "Start Time", "endedat": "Stop Time", "tripdurationseconds": "Trip Duration"}


def _letters(name: str) -> str:
    return re.sub("[^a-z0-9]", "", name.lower())


def resolved_header(names: list[str]) -> list[str]:
    """Our raw names for a file's header, whatever the case, blanks and signs in it; other columns keep their name.

    Of columns that fit one raw name the exact one takes it, else the one further left; no name occurs twice.
    """
    raw = {_letters(f.name): f.name for f in RAW_TRIP} | OTHER_HEADERS
    taken = {n for n in names if n in RAW_TRIP.names}
    out: list[str] = []
    for name in names:
        ours = raw.get(_letters(name), name)
        ours = name if ours != name and ours in taken else ours
        taken.add(ours)
        while ours.lower() in {o.lower() for o in out}:
            ours += "_"
        out.append(ours)
    return out


def file_starts(files: list[tuple[str, int]], slack: int, first: int = 0) -> tuple[dict[str, int], int]:
    """Per file the number of its first row, and the number behind the last; ``files`` (path, bytes) stand in their order.

    A row's place in its file is where its scan block starts plus its number in the scan task. A row has a byte at least, and
    a task that scans several files scans at most ``slack`` bytes, so a file's rows have room in its bytes and the slack:
    numbers rise with the order without a look at the rows.
    """
    starts = {}
    for path, size in files:
        starts[path] = first
        first += size + slack
    return starts, first


def _listed(spark: SparkSession, paths: str | list[str]) -> list[tuple[str, int]]:
    """(path, bytes) of the files that are not empty, by month number of their folder, then by path. No file is opened."""
    found = spark.read.format("binaryFile").load(paths).select("_metadata.file_path", "_metadata.file_size").collect()

    def order(file):
        folder = unquote(file[0].rsplit("/", 2)[-2])
        month = re.match(r"([+-]?\d+)(_|$)", folder.split("=", 1)[-1])
        return (0, int(month[1]), file[0]) if month else (1, 0, file[0])

    return sorted(((r[0], r[1]) for r in found if r[1]), key=order)


def _local_path(spark: SparkSession, uri: str) -> str:
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def _header(spark: SparkSession, uri: str) -> tuple[str, ...]:
    """The names in the first line of a file: one short read."""
    java, hadoop = spark._jvm.java, spark._jvm.org.apache.hadoop
    conf = spark._jsc.hadoopConfiguration()
    place = hadoop.fs.Path(java.net.URI(uri))
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        reader = java.io.BufferedReader(java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        line = (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        stream.close()
    names = next(csv.reader([line]), [])
    # a column without a name is named by its place, as Spark does
    return tuple(n.strip() or f"_c{i}" for i, n in enumerate(names))


def read_files(spark: SparkSession, paths: str | list[str], first: int = 0) -> tuple[DataFrame | None, int]:
    """All columns of the files as text, by name, with ``_file`` and ``trip_seq``; and the number behind the last row's.

    The driver lists the files and reads their first lines. Files of one header are one scan, and the scans are united by
    name, so files of different years are read together; a column that a file lacks is null there. The bike column of a
    header without ``Bike ID`` is the one that fits best, where headers differ. Every file is scanned once.
    """
    files = _listed(spark, paths)
    if not files:
        return None, first
    conf = spark.conf
    slack = 2 * _bytes(spark, conf.get("spark.sql.files.maxPartitionBytes"))
    wider = conf.get("spark.sql.files.maxPartitionNum", None)
    if wider:
        slack = max(slack, 2 * -(-sum(size for _, size in files) // int(wider)))
    starts, after = file_starts(files, slack, first)
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda f: _header(spark, f[0]), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for (path, _), names in zip(files, headers):
        groups.setdefault(names, []).append(path)
    scans = []
    for names, some in groups.items():
        ours = resolved_header(list(names))
        if len(groups) > 1 and "Bike ID" not in ours and any(_rank(c) is not None for c in ours):
            ours[ours.index(find_bike_column(ours))] = "Bike ID"
        schema = T.StructType([T.StructField(n, T.StringType()) for n in ours])
        scan = spark.read.option("header", True).schema(schema).csv([_local_path(spark, f) for f in some])
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        scan = scan.select("*", F.col("_metadata.file_path").alias("_file"), (F.col("_metadata.file_block_start") + row).alias("_place"))
        scans.append(_numbered(spark, scan, {f: starts[f] for f in some}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans), after


#: a table of files up to this many rows of about 200 bytes is sent to every task; a larger one is joined as Spark sees fit
MOST_SENT = 50_000


def _numbered(spark: SparkSession, scan: DataFrame, starts: dict[str, int]) -> DataFrame:
    if len(starts) == 1:
        start = F.lit(next(iter(starts.values()))).cast("bigint")
        return scan.withColumn("trip_seq", start + F.col("_place")).drop("_place")
    table = spark.createDataFrame(list(starts.items()), "_file string, _start bigint")
    table = F.broadcast(table) if len(starts) <= MOST_SENT else table
    return scan.join(table, "_file").withColumn("trip_seq", F.col("_start") + F.col("_place")).drop("_start", "_place")


def _bytes(spark: SparkSession, text: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def _typed(raw: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType for f in RAW_TRIP}
    return raw.withColumns({c: F.col(f"`{c}`").try_cast(kinds[c]) for c in raw.columns if c in kinds and kinds[c] != T.StringType()})


def _empty(spark: SparkSession) -> DataFrame:
    """What a folder without a row reads as: the raw columns."""
    names = [*RAW_TRIP.names, "_file"]
    schema = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField("trip_seq", T.LongType())])
    return spark.createDataFrame([], schema)


def read_trip_csv(spark: SparkSession, path: str | list[str], fixed_schema: bool = True) -> DataFrame:
    """Raw trips with their arrival order ``trip_seq``; columns are found by their header names, file by file.

    Without the fixed schema every column stays text; nothing is inferred.
    """
    raw = read_files(spark, path)[0]
    raw = (_empty(spark) if raw is None else raw).drop("_file")
    return _typed(raw) if fixed_schema else raw


def read_month_folders(spark: SparkSession, root: str) -> DataFrame:
    """Every file of every ``<n>_<Month>`` folder, with the month number taken from the folder name; months in their order."""
    raw = read_files(spark, f"{root.rstrip('/')}/*/*.csv")[0]
    raw = _empty(spark) if raw is None else raw
    folder = F.regexp_extract("_file", r"/([^/]+)/[^/]+$", 1)
    return _typed(raw.withColumn("month", month_of_folder(folder)).drop("_file"))


def decode_wire(records: DataFrame) -> DataFrame:
    """Text or byte fields to a typed trip. A missing ingest stamp is 0; a bad field becomes null."""
    kinds = dict(records.dtypes)

    def text(name):
        return decode_text(name) if kinds[name] == "binary" else F.col(name)

    def number(name):
        return F.trim(text(name)).try_cast("bigint") if name in kinds else F.lit(None).cast("bigint")

    out = [text("bike_id").alias("bike_id")]
    for name in ("start_station_id", "end_station_id", "started_at_ms", "ended_at_ms"):
        out.append(number(name).alias(name))
    out.append(F.coalesce(number("ingest_ts_ms"), F.lit(0).cast("bigint")).alias("ingest_ts_ms"))
    out.append(number("trip_seq").alias("trip_seq"))
    return records.select(*out)


def wire_reject_reason() -> Column:
    """The first field a decoded record lacks, else null."""
    reason = F.when(F.coalesce("bike_id", F.lit("")) == "", "bike_id")
    for name in ("start_station_id", "end_station_id", "started_at_ms", "ended_at_ms"):
        reason = reason.when(F.col(name).isNull(), name)
    return reason


def usable_records(records: DataFrame) -> DataFrame:
    """Decoded records with all their fields, batch or stream; the others are in ``rejected_records``."""
    return decode_wire(records).where(wire_reject_reason().isNull())


def rejected_records(records: DataFrame) -> DataFrame:
    """Decoded records that lack a field, with ``reject_reason``."""
    return decode_wire(records).withColumn("reject_reason", wire_reject_reason()).where(F.col("reject_reason").isNotNull())


def read_trip_records(spark: SparkSession, path: str) -> DataFrame:
    """Usable trips of those written by ``write_trip_records``, batch form."""
    return usable_records(spark.read.schema(WIRE_TRIP).option("recursiveFileLookup", True).json(path))
