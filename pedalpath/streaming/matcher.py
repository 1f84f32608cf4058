"""The online matcher: one chain of recent trips per bike, kept from batch to batch.

``hot_path_sink`` runs a micro-batch as the batch plan over the stored chains and the new trips, all of it DataFrame
operations; ``hot_path_stream`` walks trip by trip in Python, which shedding needs, many bikes to a call. Neither has a clock
over all bikes unless one is asked for: whether a trip is late depends on its own bike only.
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import DEFAULT, PathConfig
from ..functions.scalar import now_ms, shard_of
from ..functions.shedding import shed_trips
from ..operators import sequence
from ..operators.metrics import event_latency
from ..operators.ordered import by_key, find_hot_keys, running
from ..plans import hot_paths as plans
from ..schemas import MATCH
from ..session import drop_path, fresh_path, ship_package
from ..sources.series import append_samples
from ..sources.sinks import as_text, stamped_matches
from ..sources.trips import wire_reject_reason
from .state import StateLog, batch_path

# State of a bucket of bikes: a bike's chain is the next ``sizes`` entries of the four lists of trips.
_STATE = ("bikes array<string>, sizes array<int>, last_ts array<bigint>, last_end array<bigint>, starts array<bigint>, "
          "ends array<bigint>, started array<bigint>, ended array<bigint>")
# A call of a stateful group costs milliseconds however few rows it has, so bikes share groups. State is stored by bucket:
# another number of them needs a new checkpoint.
_BUCKETS = 4096
_STRETCH = 65_536
_FIELDS = ["start_station_id", "end_station_id", "started_at_ms", "ended_at_ms", "trip_seq", "ingest_ts_ms"]


def is_hot(station: int, cfg: PathConfig) -> bool:
    return (station % 10 if cfg.hot_mode == "last_digit" else station) in cfg.hot


def advance(chain: deque | None, last_ts: int, last_end: int, trip: tuple, active: bool, cfg: PathConfig):
    """One trip against a bike's chain: (chain, last_ts, last_end, match or None).

    ``trip`` and the chain's entries are (start, end, started, ended). A match is (first start, last
    chain end, final end, first time, final end time, length). The chain may be changed in place.
    """
    start, end, started, ended = trip
    if chain is None:
        return deque([trip]), ended, end, None
    if active:
        shed_trips(chain, last_ts, cfg)
    if started < last_ts:
        return chain, last_ts, last_end, None
    while chain and chain[0][2] < ended - cfg.window_ms:
        chain.popleft()
    if not chain or start != last_end:
        return deque([trip]), ended, end, None
    match = None
    if len(chain) >= cfg.min_a and is_hot(end, cfg):
        match = (chain[0][0], last_end, end, chain[0][2], ended, len(chain))
    chain.append(trip)
    if cfg.max_chain is not None and len(chain) > cfg.max_chain:
        chain.popleft()
    return chain, ended, end, match


def _open_bucket(state: GroupState) -> dict[str, tuple]:
    """bike -> (chain, last_ts, last_end) from a bucket's state."""
    held, at = {}, 0
    if state.exists:
        bikes, sizes, last_ts, last_end, *trips = state.get
        for bike, size, ts, end in zip(bikes, sizes, last_ts, last_end):
            held[bike] = deque(zip(*[t[at:at + size] for t in trips])), ts, end
            at += size
    return held


def _keep_bucket(state: GroupState, held: dict[str, tuple], cfg: PathConfig) -> None:
    """Store the bucket's bikes, without those whose chain no later trip can reach."""
    if cfg.watermark is not None:
        # An idle chain is out of any later trip's window once the clock passes its last end + window.
        clock = state.getCurrentWatermarkMs()
        held = {bike: h for bike, h in held.items() if h[1] + cfg.window_ms >= clock}
        if not held:
            state.remove()
            return
        state.setTimeoutTimestamp(min(h[1] for h in held.values()) + cfg.window_ms + 1)
    trips = [t for chain, _, _ in held.values() for t in chain]
    state.update((list(held), [len(h[0]) for h in held.values()], [h[1] for h in held.values()], [h[2] for h in held.values()],
                  *[[t[n] for t in trips] for n in range(4)]))


def _bucket_batch(cfg: PathConfig, order: str, emit_ts_ms: int | None):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            _keep_bucket(state, _open_bucket(state), cfg)
            return
        parts = [pdf for pdf in batches if len(pdf)]
        if not parts:
            return
        rows = {f: np.concatenate([p[f].to_numpy() for p in parts]) for f in (*_FIELDS, "active", "stamped")}
        of, bikes = pd.factorize(np.concatenate([p["bike_id"].to_numpy() for p in parts]))
        # Rows of one batch come in no set order.
        keys = (rows["trip_seq"], rows["ended_at_ms"], rows["started_at_ms"]) if order == "time" \
            else (rows["trip_seq"],)
        turn = np.lexsort((*keys, of))
        held = _open_bucket(state)
        found, now = [], None
        # Python objects are made for a stretch of rows at a time; the batch itself stays in arrays.
        for at in range(0, len(turn), _STRETCH):
            some = turn[at:at + _STRETCH]
            columns = [rows[f][some].tolist() for f in (*_FIELDS, "active", "stamped")]
            for bike, start, end, begun, done, _, ingest, shedding, stamped in zip(bikes[of[some]], *columns):
                if bike != now:
                    if now is not None:
                        held[now] = chain, last_ts, last_end
                    now = bike
                    chain, last_ts, last_end = held.get(bike, (None, 0, 0))
                chain, last_ts, last_end, match = advance(chain, last_ts, last_end, (start, end, begun, done),
                                                          bool(shedding), cfg)
                if match:
                    found.append((bike, *match, ingest if stamped else None))
        held[now] = chain, last_ts, last_end
        _keep_bucket(state, held, cfg)
        if found:
            # objects: a missing stamp must not turn the others into floats
            out = pd.DataFrame(found, columns=MATCH.names[:-1], dtype=object)
            out["emit_ts_ms"] = emit_ts_ms if emit_ts_ms is not None else int(time.time() * 1000)
            yield out

    return run


def hot_path_stream(trips: DataFrame, cfg: PathConfig = DEFAULT, order: str = "time",
                    emit_ts_ms: int | None = None) -> DataFrame:
    """Matches, as they are found, from a stream of typed trips with ``started_at``.

    An ``active`` column, when there is one, turns shedding on for a trip's chain (T10). ``cfg.watermark`` bounds
    lateness over all bikes, and state goes when its window has passed it (T2); with None no trip is lost to other
    bikes' clocks, and a bike's last chain stays. Bikes are walked in ``_BUCKETS`` groups by a hash, each of which keeps the
    chains of its bikes; the trigger bounds a group's rows.
    """
    if cfg.min_a < 1:
        raise ValueError("the online matcher needs at least one trip before the final one")
    ship_package(trips.sparkSession)
    if "active" not in trips.columns:
        trips = trips.withColumn("active", F.lit(False))
    # Trips that lack a field or end before they start belong to the reject table, as in batch.
    usable = trips.where((F.col("ended_at_ms") >= F.col("started_at_ms")) & wire_reject_reason().isNull()).withColumn(
        "trip_seq", F.coalesce("trip_seq", F.lit(0).cast("bigint")))
    stamp = F.col("ingest_ts_ms")
    rows = usable.withColumns({"bucket": F.pmod(F.xxhash64("bike_id"), F.lit(_BUCKETS)), "stamped": stamp.isNotNull(),
                               "ingest_ts_ms": F.coalesce(stamp, F.lit(0).cast("bigint"))})
    columns, timeout = ["bucket", "bike_id", "active", "stamped", *_FIELDS], GroupStateTimeout.NoTimeout
    if cfg.watermark is not None:
        rows, timeout = rows.withWatermark("started_at", cfg.watermark), GroupStateTimeout.EventTimeTimeout
        columns.append("started_at")
    return rows.select(*columns).groupBy("bucket").applyInPandasWithState(
        _bucket_batch(cfg, order, emit_ts_ms), MATCH, _STATE, "append", timeout)


_CHAINS = ("bike_id string, last_ts_ms bigint, last_end bigint, "
           "chain array<struct<start_station_id:bigint,end_station_id:bigint,started_at_ms:bigint,ended_at_ms:bigint>>")
# Stored trips sort before any new one of the same time.
_STORED = -(1 << 62)


def match_batch(trips: DataFrame, chains: DataFrame, cfg: PathConfig, order: str, keep) -> tuple[DataFrame, DataFrame]:
    """Matches whose final trip is among ``trips``, and the chains after them, from the chains before.

    The longest chain of a final trip reaches back at most to what its bike's open chain holds. So the chain's trips and the
    new ones together give the batch plan's result, once trips that start before the bike's last end are gone.
    ``keep`` stores a table.
    """
    place = F.struct((F.col("pos") + _STORED).alias("trip_seq"), "t.*", F.col("last_ts_ms").alias("_last"))
    # a stored trip has no ingest stamp: no match of an earlier batch is found again
    stored = chains.select("bike_id", "last_ts_ms", F.posexplode("chain").alias("pos", "t")).select("bike_id", place.alias("x")) \
        .select("bike_id", "x.*").withColumn("ingest_ts_ms", F.lit(None).cast("bigint"))
    both = trips.withColumn("_last", F.lit(None).cast("bigint")).unionByName(stored)
    hot = find_hot_keys(trips, "bike_id", cfg)  # a chain is one row of state, so it is small beside a hot bike
    columns = trips.columns
    # stored trips have the lowest numbers, so what they say stands before every new trip
    timely = by_key(both, "bike_id", ["trip_seq", "started_at_ms", "ended_at_ms"], hot, lambda o: running(
        o, _busy=("max", F.col("_last"))).rows().where(
            F.col("_busy").isNull() | F.col("ingest_ts_ms").isNull() | (F.col("started_at_ms") >= F.col("_busy"))).select(*columns), cfg)
    kept = keep(sequence.drop_late(timely, order, cfg, hot), "kept")
    found = plans.hot_paths(kept, "longest", "keep", cfg=cfg, hot=hot).where(F.col("ingest_ts_ms").isNotNull())
    return found, sequence.open_chains(kept, cfg, hot)


def hot_path_sink(trips: DataFrame, path: str, state: str, checkpoint: str, cfg: PathConfig = DEFAULT, order: str = "time",
                  emit_ts_ms: int | None = None, latency: str | None = None) -> DataStreamWriter:
    """Matches of a stream of typed trips as JSON Lines, a folder a batch, committed by batch number.

    Chains are kept in ``state``, one row a bike, of the length of a window at most. A trip is late only if its own bike has
    been seen beyond it, however far other bikes are ahead. Bikes of any size in a batch are matched in pieces. With
    ``latency``, every trip's time from its ingest stamp to the batch's end goes to that store of samples (P8), at least once.
    """
    if cfg.min_a < 1:
        raise ValueError("the online matcher needs at least one trip before the final one")
    spark = trips.sparkSession
    log = StateLog(spark, state, _CHAINS, ("bike_id",))

    def step(batch: DataFrame, number: int) -> None:
        held = []

        def keep(df: DataFrame, label: str) -> DataFrame:
            held.append(fresh_path(spark, f"match-{label}"))
            df.write.parquet(held[-1])
            return spark.read.schema(df.schema).parquet(held[-1])

        try:
            usable = batch.where((F.col("ended_at_ms") >= F.col("started_at_ms")) & wire_reject_reason().isNull())
            rows = usable.select("bike_id", *_FIELDS).withColumns({
                c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("trip_seq", "ingest_ts_ms")})
            found, chains = match_batch(rows, log.before(number, rows), cfg, order, keep)
            # neither needs the other; both are written whole again if the batch runs again
            with ThreadPoolExecutor(1) as other:
                stored = other.submit(log.put, number, chains)
                as_text(stamped_matches(found, emit_ts_ms)).write.mode("overwrite").json(batch_path(path, number))
                stored.result()
            if latency is not None:
                done = F.lit(emit_ts_ms if emit_ts_ms is not None else int(time.time() * 1000)).cast("bigint")
                sharded = rows.withColumn("shard", shard_of("bike_id", cfg.n_shards))
                append_samples(event_latency(sharded, done), latency, cfg)
        finally:
            for place in held:
                drop_path(spark, place)

    return trips.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)


def dedupe_stream(matches: DataFrame, cfg: PathConfig = DEFAULT) -> DataFrame:
    """Each match once within the time to live, counted in event time, for streams in that order (T4).

    A match behind the watermark is lost, though it may be the first of its key; ``dedupe_sink`` loses none.
    """
    return (matches.withColumn("_at", F.timestamp_millis("b_ended_ms"))
            .withWatermark("_at", f"{cfg.dedupe_ttl_ms} milliseconds")
            .dropDuplicatesWithinWatermark(["bike_id", "first_ts_ms", "b_ended_ms", "b_end"])
            .drop("_at"))


KEY = ("bike_id", "first_ts_ms", "b_ended_ms", "b_end")
_SEEN = "bike_id string, first_ts_ms bigint, b_ended_ms bigint, b_end bigint, until_ms bigint"


def dedupe_batch(matches: DataFrame, seen: DataFrame, at: str, cfg: PathConfig) -> DataFrame:
    """The matches that pass, with ``until_ms``: up to when their key is barred.

    A match passes if its key is not barred at its time ``at``, and then bars the key for the time to live. That is the rule
    of late trips, with a key for the bike, so any number of copies in a batch is decided as there.
    """
    key = F.to_json(F.struct(*KEY))  # told apart even where a part is null
    zero = F.lit(0).cast("bigint")
    barred = seen.select(*[F.col(c).alias(f"_of_{c}") for c in KEY], "until_ms")
    rows = matches.join(barred, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in KEY], "left") \
        .where(F.col("until_ms").isNull() | (F.col(at) >= F.col("until_ms"))).select(*matches.columns)
    walk = rows.select(key.alias("bike_id"), F.col(at).alias("started_at_ms"), (F.col(at) + cfg.dedupe_ttl_ms).alias("ended_at_ms"),
                       F.xxhash64(*rows.columns).alias("trip_seq"), zero.alias("start_station_id"), zero.alias("end_station_id"),
                       F.struct(*rows.columns).alias("_m"))
    return sequence.drop_late(walk, "time", cfg).select("_m.*", F.col("ended_at_ms").alias("until_ms"))


def dedupe_sink(matches: DataFrame, path: str, state: str, checkpoint: str, cfg: PathConfig = DEFAULT,
                at: str | None = None) -> DataStreamWriter:
    """Matches once within the time to live of their first sight, as JSON Lines, a folder a batch (T4).

    The clock is that of the batch, or the milliseconds in column ``at``. Keys are barred each by its own sight, not by a
    clock over all keys, so a match that comes late is never taken for a duplicate. A key is forgotten at a snapshot once the
    newest sight is a second time to live beyond its end.
    """
    spark = matches.sparkSession
    log = StateLog(spark, state, _SEEN, KEY)

    def step(batch: DataFrame, number: int) -> None:
        place = fresh_path(spark, "dedupe-batch")
        try:
            clock = "_at" if at is None else at
            rows = batch if at else batch.withColumn("_at", now_ms())
            rows.write.parquet(place)
            rows = spark.read.schema(rows.schema).parquet(place)
            passed = dedupe_batch(rows, log.before(number, rows), clock, cfg)
            passed.write.mode("overwrite").parquet(f"{place}-passed")
            passed = spark.read.schema(passed.schema).parquet(f"{place}-passed")
            as_text(passed.select(*[f.name for f in MATCH])).write.mode("overwrite").json(batch_path(path, number))
            newest = rows.agg(F.max(clock)).first()[0]
            live = None if newest is None else F.col("until_ms") + cfg.dedupe_ttl_ms > F.lit(newest)
            log.put(number, passed.groupBy(*KEY).agg(F.max("until_ms").alias("until_ms")), live)
        finally:
            for p in (place, f"{place}-passed"):
                drop_path(spark, p)

    return matches.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
