"""A trip table derived from an event table (event_id, ts, user_id, event_type, value, props).

One event is one trip of the user's bike: it starts where the previous one ended, except after an
``error`` event, and lasts ``value`` minutes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import DEFAULT, PathConfig
from ..functions.scalar import ntz_epoch_ms
from ..operators.ordered import HotKeys, Ordered, by_key, find_hot_keys, neighbour


def event_trips(events: DataFrame, overlapping: bool = False, cfg: PathConfig = DEFAULT,
                hot: HotKeys | None = None) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    started = ntz_epoch_ms(F.col("ts").cast("timestamp_ntz"))
    base = events.select(
        F.col("user_id").cast("string").alias("bike_id"),
        "ts", F.col("event_id").alias("trip_seq"),
        k.alias("_k"), (F.col("event_type") == "error").alias("_error"),
        started.alias("started_at_ms"),
        (started + F.floor(F.col("value") * 60000).cast("bigint")).alias("_raw_end"),
    )
    hot = find_hot_keys(base, "bike_id", cfg) if hot is None else hot

    def derive(o: Ordered) -> DataFrame:
        o = neighbour(o, "_before", ["_k"])
        start = F.when(F.col("_error") | F.col("_before").isNull(), 300 + F.col("_k")) \
            .otherwise(100 + F.col("_before._k"))
        end = F.col("_raw_end")
        if not overlapping:
            o = neighbour(o, "_after", ["started_at_ms"], +1)
            end = F.least(end, F.col("_after.started_at_ms"))
        return o.df.select("bike_id", start.cast("bigint").alias("start_station_id"),
                           (100 + F.col("_k")).alias("end_station_id"), "started_at_ms",
                           end.alias("ended_at_ms"), F.col("started_at_ms").alias("ingest_ts_ms"), "trip_seq")

    return by_key(base, "bike_id", ["ts", "trip_seq"], hot, derive, cfg)
