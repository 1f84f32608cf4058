"""From raw text rows to typed trips, and the rows that do not make it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalar import now_ms, parse_int, parse_number, parse_time_ms, shard_of
from ..session import written
from ..sources.trips import find_bike_column
from .select import smallest

# Our name -> raw name (fixed values). The bike column is found by name.
RAW_NAMES = {
    "start_station_id": "Start Station ID",
    "end_station_id": "End Station ID",
    "started_at": "Start Time",
    "ended_at": "Stop Time",
}
REQUIRED = ["bike_id", "start_station_id", "end_station_id", "started_at_ms", "ended_at_ms"]


def project_raw(raw: DataFrame, bike_column: str | None = None, names: dict[str, str] | None = None) -> DataFrame:
    """The five raw columns the pattern needs, as text under our names, plus ``trip_seq``."""
    names = {**RAW_NAMES, **(names or {})}
    bike = bike_column or find_bike_column(raw.columns)
    seq = F.col("trip_seq") if "trip_seq" in raw.columns else F.monotonically_increasing_id()
    return raw.select(F.col(f"`{bike}`").cast("string").alias("bike_id"),
                      *[F.col(f"`{theirs}`").cast("string").alias(ours) for ours, theirs in names.items()],
                      seq.alias("trip_seq"))


def judge_trips(raw: DataFrame, id_parse: str = "strict", bike_column: str | None = None,
                names: dict[str, str] | None = None) -> DataFrame:
    """Typed columns and ``reject_reason``, null for a usable trip."""
    if id_parse not in ("strict", "numeric"):
        raise ValueError(f"unknown id_parse {id_parse!r}")
    station = parse_int if id_parse == "strict" else parse_number
    # inline() holds the parsed values: a test on them would otherwise be pushed down with the whole parsing in it
    typed = project_raw(raw, bike_column, names).select(F.inline(F.array(F.struct(
        "bike_id",
        station("start_station_id").alias("start_station_id"),
        station("end_station_id").alias("end_station_id"),
        parse_time_ms("started_at").alias("started_at_ms"),
        parse_time_ms("ended_at").alias("ended_at_ms"),
        "trip_seq",
    ))))
    return typed.withColumn("reject_reason", reject_reason())


def reject_reason() -> Column:
    """First thing wrong with a typed trip, else null."""
    reason = F.when(F.col("bike_id").isNull() | (F.col("bike_id") == ""), "bike_id")
    for name in REQUIRED[1:]:
        reason = reason.when(F.col(name).isNull(), name)
    return reason.when(F.col("ended_at_ms") < F.col("started_at_ms"), "ends_before_start")


def stamp_and_shard(trips: DataFrame, n_shards: int, ingest_ts_ms: int | None = None) -> DataFrame:
    stamp = F.lit(ingest_ts_ms).cast("bigint") if ingest_ts_ms is not None else now_ms()
    return trips.withColumns({
        "ingest_ts_ms": stamp,
        "shard": shard_of("bike_id", n_shards),
        "started_at": F.timestamp_millis("started_at_ms"),
    })


def clean_trips(raw: DataFrame, id_parse: str = "strict", n_shards: int = 10, max_rows: int | None = None,
                ingest_ts_ms: int | None = None, bike_column: str | None = None) -> DataFrame:
    """Usable trips, stamped and sharded; at most the first ``max_rows`` usable ones (S3)."""
    good = judge_trips(raw, id_parse, bike_column).where(F.col("reject_reason").isNull()).drop("reject_reason")
    if max_rows is not None:
        good = first_rows(good, max_rows)
    return stamp_and_shard(good, n_shards, ingest_ts_ms)


def first_rows(trips: DataFrame, n: int) -> DataFrame:
    """The n trips that arrived first, found by counting arrival numbers; the trips are parsed once."""
    return smallest(written(trips, "usable"), "trip_seq", n)


def rejected_trips(raw: DataFrame, id_parse: str = "strict", bike_column: str | None = None) -> DataFrame:
    return judge_trips(raw, id_parse, bike_column).where(F.col("reject_reason").isNotNull())


def reject_counts(raw: DataFrame, id_parse: str = "strict") -> DataFrame:
    return rejected_trips(raw, id_parse).groupBy("reject_reason").agg(F.count("*").alias("n"))


def typed_bikes(trips: DataFrame, column: str = "bike_id") -> DataFrame:
    """Bike ids as BIGINT when every one of them is a whole number (``7`` or ``7.0``), else left as text (F8).

    One row with one boolean decides, so the result's type is known when the plan is built.
    """
    test = trips.agg(F.bool_and(parse_number(column).isNotNull()).alias("whole")).first()["whole"]
    return trips.withColumn(column, parse_number(column)) if test else trips


def sharded_rows(trips: DataFrame, n: int, cfg=None, hot=None) -> DataFrame:
    """Trips of a bike together in one of ``n`` partitions, each in (bike, start, arrival) order.

    A bike is placed by stretches of ``max_group_rows`` trips of its order, each of them in one task and most bikes having
    one, so no task holds more than its share. Rows of a stretch stand in order; ``placement`` tells whether they do.
    """
    from ..config import DEFAULT
    from .ordered import PIECE, TIE, find_hot_keys, in_pieces
    cfg = cfg or DEFAULT
    inner = ["bike_id", "started_at_ms", "trip_seq"]
    hot = find_hot_keys(trips, "bike_id", cfg) if hot is None else hot
    if hot.table is None:
        return trips.repartition(n, "bike_id").sortWithinPartitions(*inner)
    usual = trips.join(hot.table, "bike_id", "left_anti").withColumn(PIECE, F.lit(-1).cast("bigint"))
    large = in_pieces(trips.join(hot.table, "bike_id", "left_semi"), ("bike_id",),
                      ("started_at_ms", "trip_seq"), hot.rows, cfg).df.drop(TIE)
    return (usual.unionByName(large).repartition(n, "bike_id", PIECE)
            .sortWithinPartitions("bike_id", PIECE, *inner[1:]).drop(PIECE))


def placement(placed: DataFrame) -> DataFrame:
    """Per bike of ``sharded_rows``: trips, and those that stand behind a later one of their bike in the same partition (R2)."""
    where = placed.select("bike_id", "started_at_ms", "trip_seq", F.spark_partition_id().alias("part"),
                          F.monotonically_increasing_id().alias("at"))
    before = F.max(F.struct("started_at_ms", "trip_seq")).over(
        Window.partitionBy("bike_id", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    late = F.coalesce(F.struct("started_at_ms", "trip_seq") < before, F.lit(False))
    return where.withColumn("late", late).groupBy("bike_id").agg(F.count("*").alias("trips"), F.count_if("late").alias("out_of_order"))


def produced_counts(trips: DataFrame) -> DataFrame:
    """Events produced and shards they went to."""
    return trips.agg(F.count("*").alias("events"), F.count_distinct("shard").alias("shards"))


def per_shard_counts(trips: DataFrame) -> DataFrame:
    return trips.groupBy("shard").agg(F.count("*").alias("events"))
