"""One query per operator over the driver's tables. Each runs over the whole of its tables.

The tables hold no trips, so trips are derived from ``events`` (see ``driver_trips``).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import HOUR_MS, PathConfig
from ..functions import predicates, scalar
from ..functions.shedding import shed
from ..operators import clean, metrics, overload, sequence
from ..operators.ordered import HotKeys, find_hot_keys
from ..schemas import WIRE_TRIP
from ..session import fresh_path, written
from ..sources import logs, series, sinks, streams, trips as trip_sources
from ..streaming import ingest, matcher, monitor
from . import hot_paths as hp, reports
from .driver_trips import event_trips

DAY = PathConfig(window_ms=24 * HOUR_MS)
SIX = PathConfig(window_ms=6 * HOUR_MS)
LITERAL = PathConfig(window_ms=24 * HOUR_MS, hot=(107, 117, 128, 139, 150, 161, 172, 183), hot_mode="literal")
BUCKETS = PathConfig(latency_bucket_s=600)
POLL_S = 7200
STAMP = 1_700_000_000_000


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def _trips(spark, sf, overlapping=False) -> tuple[DataFrame, HotKeys]:
    """Trips, and the bikes above the size limit, found once per query."""
    events = _events(spark, sf)
    found = find_hot_keys(events.select(F.col("user_id").cast("string").alias("bike_id")), "bike_id")
    return event_trips(events, overlapping, hot=found), found


def _arrivals(spark, sf) -> tuple[DataFrame, HotKeys]:
    """Overlapping trips that arrive out of start order."""
    trips, hot = _trips(spark, sf, True)
    slot = F.col("trip_seq") + (F.col("trip_seq") * 37) % 11 * 300
    return trips.withColumn("trip_seq", slot * (1 << 20) + F.col("trip_seq") % (1 << 20)), hot


def _samples(spark, sf) -> DataFrame:
    """Latency samples from events: shard of the user, time, value, arrival."""
    return _events(spark, sf).select(
        scalar.shard_of(F.col("user_id").cast("string"), 10).alias("shard"),
        F.timestamp_millis(scalar.ntz_epoch_ms(F.col("ts").cast("timestamp_ntz"))).alias("ts"),
        F.col("value").alias("latency_ms"), F.col("event_id").alias("seq"))


def _ms(c: str):
    return F.unix_millis(c)


# --- hot paths --------------------------------------------------------------------------------

def _paths(mode, cfg=DAY, overlapping=False, overlap=None):
    def run(spark, sf):
        trips, hot = _trips(spark, sf, overlapping)
        return hp.hot_paths(trips, mode, overlap, cfg=cfg, hot=hot)
    return run


def hot_path_longest_arrival(spark, sf):
    trips, hot = _arrivals(spark, sf)
    return hp.hot_paths(trips, "longest", order="arrival", cfg=DAY, hot=hot)


def _counts(spark, sf, mode="all", overlapping=False, cfg=DAY):
    trips, hot = _trips(spark, sf, overlapping)
    return hp.match_counts(trips, mode, cfg=cfg, hot=hot)


def hot_path_totals(spark, sf):
    return reports.totals(_counts(spark, sf))


def top_bikes(spark, sf):
    return reports.top_bikes(_counts(spark, sf), 20)


def _details(spark, sf):
    trips, hot = _trips(spark, sf)
    return hp.match_details(trips, "all", cfg=DAY, hot=hot)


def _detail_columns(df):
    return df.select("bike", _ms("a1_start_time").alias("a1_start_ms"), "a_last_end_station", "b_end_station",
                     _ms("b_stop_time").alias("b_stop_ms"), "chain_len")


def hot_path_details(spark, sf):
    return _detail_columns(_details(spark, sf))


def detail_sample(spark, sf):
    trips, hot = _trips(spark, sf)
    return _detail_columns(hp.first_details(trips, 3, True, cfg=DAY, hot=hot))


def first_details(spark, sf):
    trips, hot = _trips(spark, sf)
    return _detail_columns(hp.first_details(trips, 10, cfg=DAY, hot=hot))


def early_variant(spark, sf):
    """Station ids moved so that those of the literal set occur."""
    trips, hot = _trips(spark, sf)
    moved = trips.withColumns({c: F.col(c) - 100 for c in ("start_station_id", "end_station_id")})
    return hp.early_variant(moved, DAY, hot)


# --- sequences --------------------------------------------------------------------------------

def trip_sequence(spark, sf):
    trips, hot = _trips(spark, sf)
    return sequence.sequence_trips(trips, hot=hot).select("bike_id", "trip_seq", "pos", "prev_end", "is_break",
                                                          "run_no", "run_start_pos")


def chain_summary(spark, sf):
    trips, hot = _trips(spark, sf)
    return sequence.chain_summary(trips, hot=hot)


def late_drop(spark, sf):
    trips, hot = _trips(spark, sf, True)
    return sequence.drop_late(trips, hot=hot).select("bike_id", "trip_seq", "started_at_ms", "ended_at_ms")


def late_drop_arrival(spark, sf):
    trips, hot = _arrivals(spark, sf)
    return sequence.drop_late(trips, "arrival", hot=hot).select("bike_id", "trip_seq", "started_at_ms")


def _chain_text(c):
    parts = F.transform(c, lambda t: F.concat_ws(":", *[t[n].cast("string") for n in (
        "start_station_id", "end_station_id", "started_at_ms", "ended_at_ms")]))
    return F.array_join(parts, ",")


def _open(spark, sf, cfg=DAY):
    trips, hot = _trips(spark, sf)
    return sequence.open_chains(trips, cfg, hot)


def open_chains(spark, sf):
    return _open(spark, sf).select("bike_id", "last_ts_ms", "last_end", F.size("chain").alias("length"),
                                   _chain_text("chain").alias("chain"))


def chain_cap(spark, sf):
    chains = _open(spark, sf, replace(DAY, max_chain=2))
    return chains.select("bike_id", F.size("chain").alias("length"), _chain_text("chain").alias("chain"))


def pruned_chains(spark, sf):
    """Open chains of a day, cut to the last six hours of each."""
    left = sequence.prune_chain("chain", "last_ts_ms", SIX.window_ms)
    return _open(spark, sf).select("bike_id", F.size(left).alias("length"), _chain_text(left).alias("chain"))


def shed_policies(spark, sf):
    cfg = replace(DAY, shed_drop_k=1, shed_keep_last_n=2, shed_window_ms=8 * HOUR_MS)
    chains = _open(spark, sf)
    left = {p: _chain_text(shed("chain", "last_ts_ms", p, cfg))
            for p in ("none", "drop_oldest", "drop_k", "shrink_window", "Unheard_Of")}
    none_kept = replace(cfg, shed_keep_last_n=0, shed_window_ms=0)
    left["drop_oldest_0"] = _chain_text(shed("chain", "last_ts_ms", "Drop_Oldest", none_kept))
    left["shrink_window_0"] = _chain_text(shed("chain", "last_ts_ms", "shrink_window", none_kept))
    return chains.select("bike_id", *[c.alias(n.lower()) for n, c in left.items()])


# --- predicates and scalars -------------------------------------------------------------------

def hot_stations(spark, sf):
    trips, _ = _trips(spark, sf)
    shifted = F.col("end_station_id") - 150
    text = F.concat(F.lit("S"), F.col("end_station_id").cast("string"))
    return trips.select(
        "trip_seq", predicates.ends_hot("end_station_id").alias("hot"),
        predicates.ends_hot(shifted).alias("hot_signed"),
        predicates.ends_hot_text(text).alias("hot_text"),
        predicates.is_hot_id("end_station_id", LITERAL.hot).alias("hot_literal"),
        predicates.within("started_at_ms", "ended_at_ms", 600_000).alias("short"))


def _messy(events: DataFrame) -> DataFrame:
    """Event fields as text with the faults raw files have, a fault per event type."""
    k = F.get_json_object("props", "$.k")
    at = F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
    kind = F.col("event_type")
    stop = F.col("ts").cast("timestamp_ntz") + F.make_dt_interval(secs=F.floor(F.col("value") * 60))
    ended = F.date_format(stop, "yyyy-MM-dd HH:mm:ss")
    return events.select(
        F.when((kind == "error") & (F.length(k) == 1), "").otherwise(F.col("user_id").cast("string")).alias("Bike ID"),
        F.when(kind == "signup", F.concat(k, F.lit(".0"))).when(kind == "view", F.concat(F.lit(" "), k, F.lit(" ")))
        .otherwise(k).alias("Start Station ID"),
        F.when((kind == "click") & (F.length(k) == 1), "x").otherwise(F.concat(F.lit("1"), k)).alias("End Station ID"),
        F.when((kind == "purchase") & (F.length(k) == 1), "no time").when(kind == "view", F.concat(at, F.lit("+01:00")))
        .otherwise(at).alias("Start Time"),
        ended.alias("Stop Time"), F.col("event_id").alias("trip_seq"))


def _raw(spark, sf) -> DataFrame:
    """Raw rows as a stored table, as they come from files."""
    return written(_messy(_events(spark, sf)), "raw")


def clean_strict(spark, sf):
    good = clean.clean_trips(_raw(spark, sf), "strict", ingest_ts_ms=STAMP)
    return good.drop("started_at")


def clean_numeric(spark, sf):
    good = clean.clean_trips(_raw(spark, sf), "numeric", n_shards=8, ingest_ts_ms=STAMP)
    return good.drop("started_at")


def ingest_stamps(spark, sf):
    """Trips stamped with the time of the run: all of them, with one time, between two readings of the clock."""
    before = scalar.now_ms()
    good = clean.clean_trips(_raw(spark, sf), "strict")
    at = F.col("ingest_ts_ms")
    return good.agg(F.count("*").alias("trips"), F.count_if((at >= F.lit(1_600_000_000_000)) & (at <= before)).alias("stamped"),
                    F.count_distinct("ingest_ts_ms").alias("stamps"))


def reject_counts(spark, sf):
    return clean.reject_counts(_raw(spark, sf))


def reject_reasons(spark, sf):
    """Rejects by reason, where every reason occurs: stop times that cannot be read, and some before the start."""
    n = F.col("trip_seq")
    stop = F.when(n % 17 == 0, F.lit("never")).when(n % 19 == 0, F.lit("1/2/1999 3:04 pm")).otherwise(F.col("Stop Time"))
    return clean.reject_counts(_messy(_events(spark, sf)).withColumn("Stop Time", stop))


def row_cap(spark, sf):
    return clean.clean_trips(_raw(spark, sf), "strict", max_rows=500, ingest_ts_ms=STAMP) \
        .select("bike_id", "trip_seq", "started_at_ms", "shard")


def parsed_ids(spark, sf):
    raw = _messy(_events(spark, sf))
    return raw.select("trip_seq", scalar.parse_int("Start Station ID").alias("strict_id"),
                      scalar.parse_number("Start Station ID").alias("numeric_id"),
                      scalar.parse_time_ms("Start Time").alias("start_ms"))


def typed_bikes(spark, sf):
    raw = _messy(_events(spark, sf)).select(F.col("Bike ID").alias("bike_id"), "trip_seq")
    whole = clean.typed_bikes(raw.where("bike_id <> ''")).groupBy("bike_id").agg(F.count("*").alias("trips"))
    mixed = clean.typed_bikes(raw.withColumn("bike_id", F.concat(F.lit("b"), "bike_id")))
    kept = mixed.groupBy("bike_id").agg(F.count("*").alias("trips"))
    return whole.select((F.col("bike_id") + 0).cast("string").alias("bike"), F.lit("whole").alias("kind"), "trips") \
        .unionByName(kept.select(F.col("bike_id").alias("bike"), F.lit("text").alias("kind"), "trips"))


def shard_counts(spark, sf):
    trips, _ = _trips(spark, sf)
    sharded = trips.withColumn("shard", scalar.shard_of("bike_id", 10))
    return clean.per_shard_counts(sharded).withColumns({
        "stream": scalar.shard_label("trips:", "shard"), "series": scalar.series_key("metrics:latency", "shard")})


def bike_shards(spark, sf):
    bikes = _events(spark, sf).select(F.col("user_id").cast("string").alias("bike_id")).distinct()
    return bikes.select("bike_id", scalar.shard_of("bike_id", 10).alias("shard10"),
                        scalar.shard_of("bike_id", 8).alias("shard8"), scalar.shard_of("bike_id", 7).alias("shard7"))


def sharded_rows(spark, sf):
    """Per bike: trips that were placed, those out of their order, and those that got lost on the way."""
    trips, hot = _trips(spark, sf)
    placed = clean.placement(clean.sharded_rows(trips, 10, hot=hot))
    given = trips.groupBy("bike_id").agg(F.count("*").alias("given"))
    return given.join(placed, "bike_id", "left").select(
        "bike_id", F.coalesce("trips", F.lit(0)).alias("trips"), F.coalesce("out_of_order", F.lit(0)).alias("out_of_order"),
        (F.col("given") - F.coalesce("trips", F.lit(0))).alias("lost"))


def produced(spark, sf):
    trips, _ = _trips(spark, sf)
    return clean.produced_counts(trips.withColumn("shard", scalar.shard_of("bike_id", 10)))


def dedupe_keys(spark, sf):
    trips, hot = _trips(spark, sf)
    return hp.hot_paths(trips, "longest", cfg=DAY, hot=hot).select(
        scalar.dedupe_key().alias("key"), "length_a")


def local_times(spark, sf):
    """Winter times, and for odd events the time half a year later, in summer."""
    ms = _ms("ts") + F.pmod("seq", F.lit(2)) * F.lit(181 * 24 * HOUR_MS)
    return _samples(spark, sf).select(
        "seq", scalar.local_time(ms, "UTC").alias("utc"),
        scalar.local_time(ms, "Europe/Helsinki").alias("helsinki"),
        scalar.round2(F.col("latency_ms") / 7).alias("rounded"))


# --- logs, counts, comparison -----------------------------------------------------------------

def _log_lines(matches: DataFrame) -> DataFrame:
    """Two lines a match, one that says all of it and one that lacks the end; both with other words around."""
    says = F.format_string("%s INFO chain closed: bike=%s end=%d\tlenA=%d (%d trips)", F.timestamp_millis("b_ended_ms").cast("string"),
                           "bike_id", "b_end", "length_a", F.col("length_a") + 1)
    lacks = F.format_string("WARN bike=%s end=? lenA=%d", "bike_id", "length_a")
    return matches.select(F.explode(F.array(says, lacks)).alias("value"))


def _logged(spark, sf):
    trips, hot = _trips(spark, sf)
    path = fresh_path(spark, "log")
    _log_lines(hp.hot_paths(trips, "longest", cfg=DAY, hot=hot)).write.text(path)
    return logs.read_match_log(spark, path)


def match_log(spark, sf):
    return _logged(spark, sf)


def log_counts(spark, sf):
    return reports.count_by_bike(_logged(spark, sf))


def _compared(spark, sf):
    batch = _counts(spark, sf).where("matches > 0").withColumn("bike", F.col("bike").cast("bigint"))
    return reports.compare_counts(batch, reports.count_by_bike(_logged(spark, sf)))


def compare_counts(spark, sf):
    return _compared(spark, sf)


def compare_top(spark, sf):
    return reports.top_bikes(_compared(spark, sf), 20, "batch_matches")


def count_correlation(spark, sf):
    return reports.count_correlation(_compared(spark, sf)).select(F.round("correlation", 6).alias("correlation"))


def compare_sides(spark, sf):
    """Counts of which either side lacks bikes: one hour in batch, a day online for every second bike."""
    batch = _counts(spark, sf, cfg=PathConfig()).where("matches > 0").withColumn("bike", F.col("bike").cast("bigint"))
    online = reports.count_by_bike(_logged(spark, sf)).where(F.pmod("bike", F.lit(2)) == 0)
    return reports.compare_counts(batch, online)


def deduped_matches(spark, sf):
    """Every match three times with different ingest stamps; the first ingested stays."""
    trips, hot = _trips(spark, sf)
    found = hp.hot_paths(trips, "longest", cfg=DAY, hot=hot)
    copies = found.withColumn("copy", F.explode(F.array(*[F.lit(i) for i in (5, 0, 9)]))) \
        .withColumn("ingest_ts_ms", F.col("ingest_ts_ms") + F.col("copy"))
    return reports.dedupe_matches(copies)


def active_bikes(spark, sf):
    trips, _ = _trips(spark, sf)
    return reports.active_bikes(trips, 5)


def match_latency(spark, sf):
    trips, hot = _trips(spark, sf)
    stamped = sinks.stamped_matches(hp.hot_paths(trips, "longest", cfg=DAY, hot=hot), STAMP)
    return sinks.match_latency(stamped).select("bike_id", "b_ended_ms", "latency_ms")


# --- metrics ----------------------------------------------------------------------------------

def latency_buckets(spark, sf):
    return metrics.latency_buckets(_samples(spark, sf), BUCKETS).withColumn("mean_ms", F.round("mean_ms", 6))


def newest_mean(spark, sf):
    means = metrics.latency_buckets(_samples(spark, sf), BUCKETS)
    return metrics.newest_mean(means).withColumn("mean_ms", F.round("mean_ms", 6))


def latency_series(spark, sf):
    """Two samples a time stamp, the later written wins; the last day is kept."""
    kept = metrics.latency_series(_twice(spark, sf), RETAINED)
    return kept.select("shard", _ms("ts").alias("ts_ms"), "latency_ms")


RETAINED = PathConfig(latency_retention_ms=24 * HOUR_MS, series_span_s=90 * 86_400)


def _twice(spark, sf) -> DataFrame:
    return _samples(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(0)))) \
        .withColumns({"seq": F.col("seq") * 2 + F.col("copy"), "latency_ms": F.col("latency_ms") + F.col("copy")})


def series_store(spark, sf):
    """The same from the store: appended in two writes, compacted between them, read for the last day only."""
    path = fresh_path(spark, "series")
    twice = _twice(spark, sf)
    for copy in (0, 1):
        series.append_samples(twice.where(F.col("copy") == copy), path, RETAINED)
        series.compact_samples(spark, path, replace(RETAINED, latency_retention_ms=1000 * 24 * HOUR_MS))
    return series.read_samples(spark, path, RETAINED).select("shard", _ms("ts").alias("ts_ms"), "latency_ms")


def newest_sample(spark, sf):
    return metrics.newest_sample(_samples(spark, sf)).select("shard", _ms("last_ts").alias("last_ms"),
                                                             "last_latency_ms")


def slow_events(spark, sf):
    return metrics.slow_counts(_samples(spark, sf))


def poll_news(spark, sf):
    """The newest sample seen at each poll: polls every ten minutes, where there was a sample or not."""
    filled = metrics.latency_buckets(_samples(spark, sf), BUCKETS)
    polls = filled.select("shard", F.timestamp_seconds(F.col("bucket_s") + 600).alias("poll_ts"),
                          F.when(F.col("n") > 0, F.col("bucket_s")).alias("seen"))
    from ..operators.ordered import by_key, running
    hot = find_hot_keys(polls, "shard")
    known = by_key(polls, "shard", ["poll_ts"], hot,
                   lambda o: running(o, last_ts=("last", F.col("seen"))).rows())
    return metrics.poll_news(known).select("shard", F.unix_seconds("poll_ts").alias("poll_s"), "last_ts", "is_new")


def shard_backlog(spark, sf):
    events = _events(spark, sf)
    trips, _ = _trips(spark, sf)
    done = events.where("event_type <> 'view'").select(F.col("event_id").alias("trip_seq"))
    return overload.backlog(trips.withColumn("shard", scalar.shard_of("bike_id", 10)), done, 12)


def _polls(spark, sf) -> DataFrame:
    """Events waiting per shard at polls two hours apart; stored, as several steps read it."""
    at = F.floor(F.unix_seconds("ts") / POLL_S) * POLL_S
    polls = _samples(spark, sf).groupBy("shard", F.timestamp_seconds(at).alias("ts")) \
        .agg(F.count("*").alias("pending"))
    return written(polls, "polls")


def _threshold(polls) -> PathConfig:
    """Overloaded means more than the mean backlog, so that the switch moves at any table size."""
    mean = polls.agg(F.floor(F.avg("pending")).alias("m")).first()["m"]
    return PathConfig(pending_threshold=int(mean))


def overload_switch(spark, sf):
    polls = _polls(spark, sf)
    switched = overload.overload_switch(polls, _threshold(polls))
    return switched.select("shard", F.unix_seconds("ts").alias("poll_s"), "pending", "status", "active")


def _flags(spark, sf) -> tuple[DataFrame, HotKeys]:
    polls = _polls(spark, sf)
    hot = find_hot_keys(polls, "shard")
    return overload.shed_flags(overload.overload_switch(polls, _threshold(polls), hot)), hot


def trip_flags(spark, sf):
    flags, hot = _flags(spark, sf)
    trips, _ = _trips(spark, sf)
    sharded = trips.withColumn("shard", scalar.shard_of("bike_id", 10))
    return overload.attach_flag(sharded, flags, hot=hot).select("trip_seq", "shard", "active")


# --- sources and sinks, there and back --------------------------------------------------------

def _raw_columns(messy: DataFrame) -> DataFrame:
    from ..schemas import RAW_TRIP
    return messy.select(*[F.col(f"`{f.name}`") if f.name in messy.columns else F.lit(None).cast(f.dataType)
                          .alias(f.name) for f in RAW_TRIP])


def csv_round_trip(spark, sf):
    """Raw CSV files out, read back with the fixed schema, cleaned."""
    path = fresh_path(spark, "raw-csv")
    sinks.write_csv(_raw_columns(_messy(_events(spark, sf))), path)
    raw = trip_sources.read_trip_csv(spark, path)
    return clean.clean_trips(raw, "strict", ingest_ts_ms=STAMP).select(
        "bike_id", "start_station_id", "end_station_id", "started_at_ms", "ended_at_ms", "shard")


def renamed_bike_column(spark, sf):
    """Files with another bike header, all columns text: the column is found by name."""
    path = fresh_path(spark, "renamed-csv")
    raw = _messy(_events(spark, sf)).withColumnRenamed("Bike ID", "City bike no").drop("trip_seq")
    sinks.write_csv(raw, path)
    good = clean.clean_trips(trip_sources.read_trip_csv(spark, path, fixed_schema=False), "numeric",
                             ingest_ts_ms=STAMP)
    return good.groupBy("bike_id").agg(F.count("*").alias("trips"))


def month_folders(spark, sf):
    """Raw files in folders named <n>_<name>, n by the length of the station text; every file is read."""
    path = fresh_path(spark, "months")
    raw = _raw_columns(_messy(_events(spark, sf)))
    # one write; a folder's name is given by a column
    sinks.write_months(raw, F.length("Start Station ID"), path)
    return trip_sources.read_month_folders(spark, path).groupBy("month").agg(F.count("*").alias("trips"))


def month_arrival(spark, sf):
    """Trips in twelve month folders, by time; matched in their order of arrival, which is that of the months."""
    trips, _ = _trips(spark, sf)
    at = lambda c: F.date_format(F.timestamp_millis(c), "yyyy-MM-dd HH:mm:ss.SSS")
    span = trips.agg(F.min("started_at_ms").alias("low"), F.max("started_at_ms").alias("high")).first()
    month = 1 + F.floor((F.col("started_at_ms") - span["low"]) * 12 / (span["high"] - span["low"] + 1))
    path = fresh_path(spark, "arrivals")
    # columns in an order of their own: they are found by name
    table = trips.select(
        F.col("bike_id").alias("Bike ID"), at("ended_at_ms").alias("Stop Time"), at("started_at_ms").alias("Start Time"),
        F.col("end_station_id").alias("End Station ID"), F.col("start_station_id").alias("Start Station ID"),
        month.alias("_m"), "started_at_ms", "trip_seq").repartitionByRange(36, "started_at_ms", "trip_seq") \
        .sortWithinPartitions("_m", "started_at_ms", "trip_seq").drop("started_at_ms", "trip_seq")
    sinks.write_months(table, F.col("_m"), path)
    arrived = clean.clean_trips(trip_sources.read_month_folders(spark, path), ingest_ts_ms=0)
    return hp.hot_paths(arrived, "longest", order="arrival", cfg=DAY).drop("ingest_ts_ms")


def time_forms(spark, sf):
    """Times in the forms that files have, by the event number; the last form names a zone that does not exist."""
    at = F.col("ts").cast("timestamp_ntz")
    iso = F.date_format(at, "yyyy-MM-dd HH:mm:ss")
    forms = [F.date_format(at, "M/d/yyyy HH:mm:ss"), F.date_format(at, "yyyy/MM/dd HH:mm:ss"), F.date_format(at, "MMM d yyyy HH:mm:ss"),
             F.date_format(at, "M/d/yyyy H:mm"), F.concat(iso, F.lit(" Etc/GMT+5")), F.concat(iso, F.lit(" GMT+2")),
             F.concat(iso, F.lit("-5")), F.concat(iso, F.lit(" Nowhere/Zone"))]
    text = F.element_at(F.array(*forms), (F.pmod("event_id", F.lit(len(forms))) + 1).cast("int"))
    return _events(spark, sf).select("event_id", scalar.parse_time_ms(text).alias("ms"))


def shuffled_header(spark, sf):
    """Raw files whose columns stand in another order, with one that is not known."""
    path = fresh_path(spark, "shuffled-csv")
    raw = _raw_columns(_messy(_events(spark, sf)))
    sinks.write_csv(raw.select(F.lit("n").alias("Note"), *sorted(raw.columns, reverse=True)), path)
    return clean.clean_trips(trip_sources.read_trip_csv(spark, path), "strict", ingest_ts_ms=STAMP).select(
        "bike_id", "start_station_id", "end_station_id", "started_at_ms", "ended_at_ms", "shard")


def wire_rejects(spark, sf):
    """Records on the wire that lack a field: how many, by the first field that is missing."""
    trips, _ = _trips(spark, sf)
    n = F.col("trip_seq")
    broken = trips.withColumns({
        "bike_id": F.when(n % 13 != 0, F.col("bike_id")).otherwise(""), "start_station_id": F.when(n % 7 != 0, F.col("start_station_id")),
        "end_station_id": F.when(n % 11 != 0, F.col("end_station_id")), "started_at_ms": F.when(n % 5 != 0, F.col("started_at_ms")),
        "ended_at_ms": F.when(n % 3 != 0, F.col("ended_at_ms")), "shard": F.lit(0)})
    path = fresh_path(spark, "broken-wire")
    sinks.write_trip_records(broken, path)
    return trip_sources.rejected_records(spark.read.schema(WIRE_TRIP).json(path)).groupBy("reject_reason").agg(F.count("*").alias("n"))


def wire_round_trip(spark, sf):
    """Trips to sharded JSON records and back; a stamp missing on the wire is 0."""
    trips, _ = _trips(spark, sf)
    path = fresh_path(spark, "wire")
    sharded = trips.withColumns({"shard": scalar.shard_of("bike_id", 10), "ingest_ts_ms": F.when(
        F.col("end_station_id") > 150, F.col("ingest_ts_ms"))})
    sinks.write_trip_records(sharded, path)
    return trip_sources.read_trip_records(spark, path)


def decoded_bytes(spark, sf):
    trips, _ = _trips(spark, sf)
    wire = trips.select(*[F.encode(F.col(c).cast("string"), "UTF-8").alias(c) for c in trips.columns])
    return trip_sources.decode_wire(wire)


def match_lines(spark, sf):
    """Matches as JSON Lines of text values and back."""
    trips, hot = _trips(spark, sf)
    path = fresh_path(spark, "match-lines")
    sinks.write_matches(sinks.stamped_matches(hp.hot_paths(trips, "longest", cfg=DAY, hot=hot), STAMP), path)
    return streams.read_matches(spark, path)


def counts_csv(spark, sf):
    path = fresh_path(spark, "counts-csv")
    sinks.write_csv(_counts(spark, sf), path)
    return spark.read.option("header", True).schema("bike string, matches bigint").csv(path)


def detail_csv(spark, sf):
    path = fresh_path(spark, "detail-csv")
    sample = detail_sample(spark, sf)
    sinks.write_detail_sample(sample, path)
    return spark.read.option("header", True).schema(sample.schema).csv(path)


def processed_marks(spark, sf):
    """Marks written for the trips of three event types, read back for the backlog."""
    events = _events(spark, sf)
    trips, _ = _trips(spark, sf)
    path = fresh_path(spark, "processed")
    sinks.mark_processed(events.where("event_type in ('click', 'error', 'signup')")
                         .withColumnRenamed("event_id", "trip_seq"), path)
    return overload.backlog(trips.withColumn("shard", scalar.shard_of("bike_id", 10)),
                            spark.read.schema("trip_seq bigint").parquet(path), 10)


# --- streaming --------------------------------------------------------------------------------

SLICE_ROWS = 10_000_000
FILE_ROWS = 1_000_000


def _arrive(source: DataFrame, at: str, folder: str, rows: int, least: int = 3) -> int:
    """The rows as a folder of files that arrive in the order of ``at``, in slices of about ``SLICE_ROWS`` rows; files of a slice.

    They are written once. A file stream takes files by their modification time, which is set in the order of ``at``; with
    a slice's files a trigger, every slice is a micro-batch of the same size however large the table is. A file has about
    ``FILE_ROWS`` rows at most, so that a slice is written and read by several tasks.
    """
    slices = max(least, -(-rows // SLICE_ROWS))
    source.repartitionByRange(slices * max(1, -(-rows // (slices * FILE_ROWS))), at).write.parquet(folder)
    spark = source.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted((f.getPath() for f in files.listStatus(place) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    first = files.getFileStatus(place).getModificationTime() - 1000 * len(parts)
    for n, part in enumerate(parts):
        files.setTimes(part, first + 1000 * n, -1)
    # counted as written, so the number of batches does not depend on how many files a write leaves
    return max(1, -(-len(parts) // slices))


def _stream_paths(spark, sf, overlapping, cfg, at="started_at_ms", flagged=None) -> DataFrame:
    trips, _ = _trips(spark, sf, overlapping)
    base = fresh_path(spark, "stream")
    files_each = _arrive(trips.withColumn("_at", F.expr(at)), "_at", f"{base}/trips", _events(spark, sf).count())
    stream = streams.stream_trip_records(spark, f"{base}/trips", replace(cfg, files_per_trigger=files_each), "parquet")
    if flagged is None:
        sinks.run_available(matcher.hot_path_sink(stream, f"{base}/matches", f"{base}/chains", f"{base}/checkpoint", cfg, emit_ts_ms=STAMP))
    else:
        found = matcher.hot_path_stream(flagged(stream), replace(cfg, watermark=None), emit_ts_ms=STAMP)
        sinks.run_available(sinks.stream_match_sink(found, f"{base}/matches", f"{base}/checkpoint"))
    return streams.read_matches(spark, f"{base}/matches").drop("emit_ts_ms")


def stream_hot_paths(spark, sf):
    return _stream_paths(spark, sf, True, DAY)


def stream_late_bike(spark, sf):
    """The trips of every third bike arrive forty days after the others'; no match of theirs is lost to the other bikes' clock."""
    return _stream_paths(spark, sf, True, DAY, f"started_at_ms + IF(CAST(bike_id AS BIGINT) % 3 = 0, {40 * 24 * HOUR_MS}, 0)")


def stream_shed_paths(spark, sf):
    """The matcher with the newest two chain trips kept while the trip's shard is overloaded."""
    flags, hot = _flags(spark, sf)
    stretches = written(overload.flag_intervals(flags, hot=hot), "flag-intervals")

    def flagged(stream):
        return overload.attach_intervals(stream.withColumn("shard", scalar.shard_of("bike_id", 10)), stretches)

    return _stream_paths(spark, sf, False, replace(DAY, shed_policy="drop_oldest", shed_keep_last_n=2), flagged=flagged)


def _emitted(spark, sf) -> DataFrame:
    """Matches with the end of their final trip as the time they are emitted."""
    trips, hot = _trips(spark, sf)
    found = hp.hot_paths(trips, "longest", cfg=DAY, hot=hot)
    return written(sinks.stamped_matches(found).withColumn("emit_ts_ms", F.col("b_ended_ms")), "emitted")


def _stream_dedupe(spark, sf, arrivals) -> DataFrame:
    """Match files, one a batch, through the dedupe stage with its default time to live of a day."""
    base = fresh_path(spark, "dedupe")
    for found in arrivals(_emitted(spark, sf)):
        sinks.write_matches(found, f"{base}/in")
        stream = streams.stream_matches(spark, f"{base}/in")
        sinks.run_available(matcher.dedupe_sink(stream, f"{base}/out", f"{base}/seen", f"{base}/checkpoint", DAY, "emit_ts_ms"))
    return streams.read_matches(spark, f"{base}/out")


def stream_dedupe(spark, sf):
    """Unique matches that come after much later ones, then every match once more an hour on."""
    def arrivals(found):
        middle = found.agg(F.avg("emit_ts_ms")).first()[0]
        late = F.col("emit_ts_ms") < F.lit(middle)
        return [found.where(~late), found.where(late), found.withColumn("emit_ts_ms", F.col("emit_ts_ms") + HOUR_MS)]

    return _stream_dedupe(spark, sf, arrivals).drop("emit_ts_ms")


def stream_dedupe_again(spark, sf):
    """Copies 23 and 25 hours on, twice over: the later ones pass, once, as their keys are no longer barred."""
    def arrivals(found):
        moved = [found.withColumn("emit_ts_ms", F.col("emit_ts_ms") + h * HOUR_MS) for h in (0, 23, 25)]
        both = moved[0].unionByName(moved[1]).unionByName(moved[2])
        return [both.unionByName(moved[2]), both]

    return _stream_dedupe(spark, sf, arrivals)


def stream_latency(spark, sf):
    """All buckets, the newest ones still open at the end of the stream."""
    base = fresh_path(spark, "latency")
    files_each = _arrive(_samples(spark, sf).select("shard", "ts", "latency_ms"), "ts", f"{base}/in", _events(spark, sf).count(), 2)
    cfg = replace(BUCKETS, files_per_trigger=files_each)
    samples = streams.stream_latency(spark, f"{base}/in", cfg)
    sinks.run_available(monitor.latency_sink(samples, f"{base}/out", f"{base}/checkpoint", cfg))
    return monitor.read_latency(spark, f"{base}/out").withColumn("mean_ms", F.round("mean_ms", 6))


def stream_overload(spark, sf):
    base = fresh_path(spark, "overload")
    polls = _polls(spark, sf)
    files_each = _arrive(polls, "ts", f"{base}/in", polls.count(), 2)
    cfg = replace(_threshold(polls), files_per_trigger=files_each)
    flags = monitor.overload_stream(streams.stream_backlog(spark, f"{base}/in", cfg), cfg)
    sinks.run_available(flags.writeStream.format("parquet").outputMode("append")
                        .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint"))
    out = spark.read.schema("shard int, ts timestamp, pending bigint, status int, active boolean") \
        .parquet(f"{base}/out")
    return out.select("shard", F.unix_seconds("ts").alias("poll_s"), "pending", "status", "active")


def stream_ingest(spark, sf):
    """Raw CSV files streamed through cleaning into sharded records, and read back; a batch has columns in reverse."""
    base = fresh_path(spark, "ingest")
    raw = _raw_columns(_messy(_events(spark, sf)))
    for n, columns in enumerate((raw.columns, raw.columns[::-1])):
        part = raw.where(F.pmod(F.xxhash64("Start Time", "Stop Time"), F.lit(2)) == n)
        sinks.write_csv(part.select(*[F.col(f"`{c}`") for c in columns]), f"{base}/raw/{n}")
        sinks.run_available(ingest.csv_ingest_sink(spark, f"{base}/raw", f"{base}/trips", f"{base}/numbers", f"{base}/checkpoint",
                                                   PathConfig(files_per_trigger=10_000), ingest_ts_ms=STAMP))
    return trip_sources.read_trip_records(spark, f"{base}/trips").groupBy("bike_id").agg(
        F.count("*").alias("trips"), F.min("started_at_ms").alias("first_ms"), F.max("ended_at_ms").alias("last_ms"),
        F.count_distinct("trip_seq").alias("numbers"))


def _as_files(part: DataFrame, names: list[str]) -> DataFrame:
    """Trips as the columns of a raw file under ``names``: bike, start and stop time, start and end station."""
    at = lambda c: F.date_format(F.timestamp_millis(c), "yyyy-MM-dd HH:mm:ss.SSS")
    columns = [F.col("bike_id"), at("started_at_ms"), at("ended_at_ms"), F.col("start_station_id"), F.col("end_station_id")]
    return part.select(*[c.alias(n) for c, n in zip(columns, names)])


#: Headers of two years (fixed values).
NEWER = ["Bike ID", "Start Time", "Stop Time", "Start Station ID", "End Station ID"]
OLDER = ["bikeid", "starttime", "stoptime", "start station id", "end station id"]


def _in_parts(trips: DataFrame, parts: int):
    """``parts`` spans of time, each sorted; of the trips' whole table."""
    span = trips.agg(F.min("started_at_ms").alias("low"), F.max("started_at_ms").alias("high")).first()
    part = F.floor((F.col("started_at_ms") - span["low"]) * parts / (span["high"] - span["low"] + 1))
    for n in range(parts):
        yield n, trips.where(part == n).repartitionByRange(2, "started_at_ms", "trip_seq").sortWithinPartitions("started_at_ms", "trip_seq")


def stream_ingest_arrival(spark, sf):
    """Files of two header years and column orders arrive one batch after the other; matched in their order of arrival."""
    trips = written(_trips(spark, sf)[0], "arriving")
    base = fresh_path(spark, "ingest-arrival")
    for n, part in _in_parts(trips, 3):
        table = _as_files(part, (NEWER, OLDER)[n % 2])
        sinks.write_csv(table.select(*[F.col(f"`{c}`") for c in (table.columns if n < 2 else table.columns[::-1])]), f"{base}/raw/{n}")
        sinks.run_available(ingest.csv_ingest_sink(spark, f"{base}/raw", f"{base}/trips", f"{base}/numbers", f"{base}/checkpoint",
                                                   PathConfig(files_per_trigger=10_000), ingest_ts_ms=0))
    arrived = trip_sources.read_trip_records(spark, f"{base}/trips")
    return hp.hot_paths(arrived, "longest", order="arrival", cfg=DAY).drop("ingest_ts_ms")


def mixed_headers(spark, sf):
    """Month folders of two header years, columns in any order, read together and matched in their order."""
    trips = written(_trips(spark, sf)[0], "mixed")
    path = fresh_path(spark, "mixed-headers")
    for n, part in _in_parts(trips, 2):
        sinks.write_csv(_as_files(part, (OLDER, NEWER)[n]).select(*[F.col(f"`{c}`") for c in ((OLDER, NEWER)[n][::-1] if n else OLDER)]),
                        f"{path}/{9 + n}_Month")
    arrived = clean.clean_trips(trip_sources.read_month_folders(spark, path), ingest_ts_ms=0)
    return hp.hot_paths(arrived, "longest", order="arrival", cfg=DAY).drop("ingest_ts_ms")


def time_forms_more(spark, sf):
    """More forms that files have, by the event number: half days, months by name, compact, two-digit years, day first."""
    at = F.col("ts").cast("timestamp_ntz")
    form = lambda f: F.date_format(at, f)
    day_first = F.when(F.dayofmonth(at) > 12, form("d/M/yyyy HH:mm:ss")).otherwise(form("M/d/yyyy HH:mm:ss"))
    forms = [form("M/d/yyyy h:mm:ss a"), form("d MMMM yyyy HH:mm:ss"), form("dd-MMM-yyyy HH:mm:ss"), day_first, form("yyyyMMdd"),
             form("yyyyMMdd'T'HHmmss"), form("yyyyMMddHHmm"), form("MMMM d, yyyy h a"), form("M/d/yy HH:mm:ss"), form("EEE MMM d yyyy HH:mm:ss"),
             F.concat(form("d"), F.lit(" Foo "), form("yyyy HH:mm:ss"))]
    text = F.element_at(F.array(*forms), (F.pmod("event_id", F.lit(len(forms))) + 1).cast("int"))
    return _events(spark, sf).select("event_id", scalar.parse_time_ms(text).alias("ms"))


QUERIES = {
    "hot_path_all": _paths("all"),
    "hot_path_all_1h": _paths("all", PathConfig()),
    "hot_path_all_join": _paths("all", overlap="keep"),
    "hot_path_all_overlapping": _paths("all", SIX, True),
    "hot_path_longest": _paths("longest"),
    "hot_path_longest_overlapping": _paths("longest", DAY, True),
    "hot_path_longest_arrival": hot_path_longest_arrival,
    "hot_path_longest_capped": _paths("longest", replace(DAY, max_chain=2)),
    "hot_path_all_capped": _paths("all", replace(DAY, max_chain=2)),
    "hot_path_literal": _paths("all", LITERAL),
    "hot_path_counts": _counts,
    "hot_path_counts_longest": lambda s, d: _counts(s, d, "longest", True, SIX),
    "hot_path_counts_1h": lambda s, d: _counts(s, d, cfg=PathConfig()),
    "hot_path_totals": hot_path_totals,
    "hot_path_details": hot_path_details,
    "top_bikes": top_bikes,
    "detail_sample": detail_sample,
    "first_details": first_details,
    "early_variant": early_variant,
    "trip_sequence": trip_sequence,
    "chain_summary": chain_summary,
    "open_chains": open_chains,
    "pruned_chains": pruned_chains,
    "chain_cap": chain_cap,
    "late_drop": late_drop,
    "late_drop_arrival": late_drop_arrival,
    "shed_policies": shed_policies,
    "hot_stations": hot_stations,
    "clean_strict": clean_strict,
    "clean_numeric": clean_numeric,
    "reject_counts": reject_counts,
    "ingest_stamps": ingest_stamps,
    "row_cap": row_cap,
    "parsed_ids": parsed_ids,
    "typed_bikes": typed_bikes,
    "shard_counts": shard_counts,
    "bike_shards": bike_shards,
    "sharded_rows": sharded_rows,
    "produced": produced,
    "dedupe_keys": dedupe_keys,
    "local_times": local_times,
    "match_log": match_log,
    "log_counts": log_counts,
    "compare_counts": compare_counts,
    "compare_sides": compare_sides,
    "compare_top": compare_top,
    "count_correlation": count_correlation,
    "deduped_matches": deduped_matches,
    "active_bikes": active_bikes,
    "match_latency": match_latency,
    "latency_buckets": latency_buckets,
    "newest_mean": newest_mean,
    "latency_series": latency_series,
    "series_store": series_store,
    "reject_reasons": reject_reasons,
    "newest_sample": newest_sample,
    "slow_events": slow_events,
    "poll_news": poll_news,
    "shard_backlog": shard_backlog,
    "overload_switch": overload_switch,
    "trip_flags": trip_flags,
    "csv_round_trip": csv_round_trip,
    "renamed_bike_column": renamed_bike_column,
    "month_folders": month_folders,
    "month_arrival": month_arrival,
    "time_forms": time_forms,
    "shuffled_header": shuffled_header,
    "wire_rejects": wire_rejects,
    "wire_round_trip": wire_round_trip,
    "decoded_bytes": decoded_bytes,
    "match_lines": match_lines,
    "counts_csv": counts_csv,
    "detail_csv": detail_csv,
    "processed_marks": processed_marks,
    "stream_hot_paths": stream_hot_paths,
    "stream_late_bike": stream_late_bike,
    "stream_shed_paths": stream_shed_paths,
    "stream_dedupe": stream_dedupe,
    "stream_dedupe_again": stream_dedupe_again,
    "stream_latency": stream_latency,
    "stream_overload": stream_overload,
    "stream_ingest": stream_ingest,
    "stream_ingest_arrival": stream_ingest_arrival,
    "mixed_headers": mixed_headers,
    "time_forms_more": time_forms_more,
}
