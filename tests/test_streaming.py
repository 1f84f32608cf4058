"""Streams against batch, restarts, shedding, dedupe."""

import random
from collections import deque
from dataclasses import replace

from pyspark.sql import functions as F

from pedalpath import (PathConfig, attach_flag, dedupe_sink, dedupe_stream, hot_path_sink, hot_path_stream, latency_sink,
                       latency_stream, overload_stream, read_latency)
from pedalpath.plans import driver_queries
from pedalpath.schemas import BACKLOG, LATENCY, MATCH, SHED_FLAGS
from pedalpath.sources import sinks, streams
from pedalpath.streaming import matcher
from pedalpath.streaming.matcher import advance
from pedalpath.streaming.state import StateLog
from datetime import datetime, timedelta, timezone
from . import oracle
from .test_hot_paths import COLS, random_trips

CFG = PathConfig(files_per_trigger=1)


def land(spark, folder, trips):
    """One file per call, the next in arrival order."""
    spark.createDataFrame([(b, s, e, t, d, t, q) for b, s, e, t, d, q in trips], COLS) \
        .coalesce(1).write.mode("append").parquet(folder)


def run(spark, base, cfg=CFG, order="time"):
    stream = streams.stream_trip_records(spark, f"{base}/trips", cfg, "parquet")
    sinks.run_available(sinks.stream_match_sink(hot_path_stream(stream, cfg, order, 1), f"{base}/out",
                                                f"{base}/checkpoint"))


def found(spark, base):
    return sorted((r.bike_id, r.a1_start, r.ai_end, r.b_end, r.first_ts_ms, r.b_ended_ms, r.length_a)
                  for r in streams.read_matches(spark, f"{base}/out").collect())


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    trips = oracle.time_order(random_trips(21, 90))
    want = oracle.longest_matches(trips)
    assert want
    for i in range(0, 90, 30):
        land(spark, f"{tmp_path}/trips", trips[i:i + 30])
        run(spark, tmp_path)
    assert found(spark, tmp_path) == want
    run(spark, tmp_path)
    assert found(spark, tmp_path) == want


def test_arrival_order(spark, tmp_path):
    trips = random_trips(22, 60)
    for i in range(0, 60, 30):
        land(spark, f"{tmp_path}/trips", trips[i:i + 30])
    run(spark, tmp_path, order="arrival")
    assert found(spark, tmp_path) == oracle.longest_matches(trips, "arrival")


def walk(trips, cfg, active):
    chain, ts, end, out = None, 0, 0, []
    for t in trips:
        chain, ts, end, m = advance(chain, ts, end, t[1:5], active(t), cfg)
        out.append((m, None if chain is None else list(chain)))
    return out


def test_advance_is_the_stateful_rule():
    for seed in range(30):
        for bike, ts in oracle.by_bike(random_trips(seed, 60)).items():
            got = [(bike, *m) for m, _ in walk(ts, PathConfig(), lambda t: False) if m]
            assert sorted(got) == oracle.longest_matches(ts, "arrival")
            capped = [(bike, *m) for m, _ in walk(ts, PathConfig(max_chain=2), lambda t: False) if m]
            assert sorted(capped) == oracle.longest_matches(ts, "arrival", cap=2)


def test_shedding_in_the_matcher():
    h = 60_000
    trips = [("x", i, i + 1, i * h, i * h + h, i) for i in range(5)] + [("x", 5, 7, 5 * h, 6 * h, 5)]
    last = lambda t: t[5] == 5
    for cfg, length in ((PathConfig(shed_policy="drop_oldest", shed_keep_last_n=2), 2),
                        (PathConfig(shed_policy="drop_k", shed_drop_k=3), 2),
                        (PathConfig(shed_policy="shrink_window", shed_window_ms=h), 1), (PathConfig(), 5)):
        match, _ = walk(trips, cfg, last)[-1]
        assert match == (5 - length, 5, 7, (5 - length) * h, 6 * h, length)
    # A chain shed to nothing restarts with the next accepted trip; the late test still holds.
    gone = PathConfig(shed_policy="drop_k", shed_drop_k=9)
    match, chain = walk(trips, gone, last)[-1]
    assert match is None and chain == [(5, 7, 5 * h, 6 * h)]
    late = advance(deque([(1, 2, 0, 10 * h)]), 10 * h, 2, (2, 7, 5 * h, 6 * h), True, gone)
    assert late[0] == deque() and late[1:] == (10 * h, 2, None)


def test_idle_state_goes(spark, tmp_path):
    day = 24 * 3_600_000
    for i, bike in enumerate("abc"):
        land(spark, f"{tmp_path}/trips", [(bike, 1, 2, i * 3 * day, i * 3 * day + 1, i)])
    stream = streams.stream_trip_records(spark, f"{tmp_path}/trips", CFG, "parquet")
    query = sinks.run_available(sinks.stream_match_sink(hot_path_stream(stream, CFG), f"{tmp_path}/out",
                                                        f"{tmp_path}/checkpoint"))
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1


def test_bikes_share_groups(spark, tmp_path, monkeypatch):
    """Many bikes, shed or not, over restarts: the matches of each bike's own walk, by far fewer stateful calls than bikes."""
    monkeypatch.setattr(matcher, "_BUCKETS", 4, raising=False)
    rng = random.Random(31)
    trips = oracle.time_order([(f"bike{rng.randrange(60)}", *t[1:]) for t in random_trips(31, 900)])
    active = lambda t: t[5] % 3 == 0
    for name, cfg in {"oldest": PathConfig(shed_policy="drop_oldest"), "k": PathConfig(shed_policy="drop_k", shed_drop_k=1),
                      "window": PathConfig(shed_policy="shrink_window", shed_window_ms=600_000)}.items():
        cfg = replace(cfg, files_per_trigger=1, watermark=None, window_ms=24 * 3_600_000)
        base = f"{tmp_path}/{name}"
        for i in range(0, 900, 300):
            land(spark, f"{base}/trips", trips[i:i + 300])
            stream = streams.stream_trip_records(spark, f"{base}/trips", cfg, "parquet").withColumn("active", F.col("trip_seq") % 3 == 0)
            query = sinks.run_available(sinks.stream_match_sink(hot_path_stream(stream, cfg, emit_ts_ms=1), f"{base}/out", f"{base}/ck"))
            assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4
        walked = sorted((bike, *m) for bike, ts in oracle.by_bike(trips).items() for m, _ in walk(ts, cfg, active) if m)
        assert walked and found(spark, base) == walked
        assert walked != sorted((bike, *m) for bike, ts in oracle.by_bike(trips).items() for m, _ in walk(ts, cfg, lambda t: False) if m)


def test_idle_bikes_leave_a_group(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(matcher, "_BUCKETS", 1, raising=False)
    day = 24 * 3_600_000
    for i, bike in enumerate("abc"):
        land(spark, f"{tmp_path}/trips", [(bike, 1, 2, i * 3 * day, i * 3 * day + 1, i)])
    run(spark, tmp_path)
    state = spark.read.format("statestore").load(f"{tmp_path}/checkpoint")
    assert [r.bikes for r in state.select("value.groupState.bikes").collect()] == [["c"]]


def test_stamps_of_a_group_stay_whole(spark, tmp_path, monkeypatch):
    """A bike without stamps does not round those of a bike in its group."""
    monkeypatch.setattr(matcher, "_BUCKETS", 1, raising=False)
    big = (1 << 53) + 1
    rows = [(b, s, s + 1, s, s + 1, None if b == "x" else big, s) for b in "xy" for s in (5, 6)]
    spark.createDataFrame(rows, COLS).coalesce(1).write.parquet(f"{tmp_path}/trips")
    run(spark, tmp_path)
    assert sorted((r.bike_id, r.ingest_ts_ms) for r in streams.read_matches(spark, f"{tmp_path}/out").collect()) == [("x", None), ("y", big)]


def test_a_slice_is_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(driver_queries, "SLICE_ROWS", 100)
    monkeypatch.setattr(driver_queries, "FILE_ROWS", 30, raising=False)
    rows = spark.range(300).select((300 - F.col("id")).alias("at"))
    files_each = driver_queries._arrive(rows, "at", f"{tmp_path}/in", 300)
    assert files_each == 4
    stream = spark.readStream.schema("at bigint").option("maxFilesPerTrigger", files_each).parquet(f"{tmp_path}/in")
    batches = []
    sinks.run_available(stream.writeStream.foreachBatch(lambda df, n: batches.append(sorted(r["at"] for r in df.collect())))
                        .option("checkpointLocation", f"{tmp_path}/ck"))
    assert len(batches) == 3 and all(batches) and sum(batches, []) == list(range(1, 301))


def test_flag_joined_to_a_stream(spark, tmp_path):
    h = 60_000
    trips = [("x", i, i + 1, i * h, i * h + h, i) for i in range(6)] + [("x", 6, 7, 6 * h, 7 * h, 6)]
    land(spark, f"{tmp_path}/trips", trips)
    flags = spark.createDataFrame([(0, datetime.fromtimestamp(330, timezone.utc), True)], SHED_FLAGS)
    cfg = PathConfig(files_per_trigger=1, shed_policy="drop_oldest")
    stream = streams.stream_trip_records(spark, f"{tmp_path}/trips", cfg, "parquet").withColumn("shard", F.lit(0))
    found_stream = hot_path_stream(attach_flag(stream, flags), cfg, emit_ts_ms=1)
    sinks.run_available(sinks.stream_match_sink(found_stream, f"{tmp_path}/out", f"{tmp_path}/ck"))
    assert found(spark, tmp_path) == [("x", 5, 6, 7, 5 * h, 7 * h, 1)]


def test_dedupe(spark, tmp_path):
    trips = oracle.time_order(random_trips(21, 90))
    land(spark, f"{tmp_path}/trips", trips)
    run(spark, tmp_path)
    want = found(spark, tmp_path)
    for copy in range(2):
        sinks.write_matches(streams.read_matches(spark, f"{tmp_path}/out"), f"{tmp_path}/in")
        once = dedupe_stream(streams.stream_matches(spark, f"{tmp_path}/in"))
        sinks.run_available(sinks.stream_match_sink(once, f"{tmp_path}/once/out", f"{tmp_path}/ck2"))
    def key(m):
        return m[0], m[4], m[5], m[3]

    once = [key(m) for m in found(spark, f"{tmp_path}/once")]
    assert sorted(once) == sorted({key(m) for m in want})


def test_switch_stream(spark, tmp_path):
    t0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rng = random.Random(5)
    series = {s: [rng.choice([0, 3, 4, 9]) for _ in range(40)] for s in range(2)}
    for part in (slice(0, 25), slice(25, 40)):
        rows = [(s, t0 + timedelta(seconds=5 * i), p) for s, ps in series.items()
                for i, p in list(enumerate(ps))[part]]
        rng.shuffle(rows)
        spark.createDataFrame(rows, BACKLOG).write.mode("append").parquet(f"{tmp_path}/in")
        flags = overload_stream(streams.stream_backlog(spark, f"{tmp_path}/in", PathConfig(files_per_trigger=99)))
        sinks.run_available(flags.writeStream.format("parquet").option("path", f"{tmp_path}/out")
                            .option("checkpointLocation", f"{tmp_path}/ck"))
    out = {}
    for r in spark.read.parquet(f"{tmp_path}/out").orderBy("shard", "ts").collect():
        out.setdefault(r.shard, []).append((r.status, r.active))
    assert out == {s: oracle.switch(p) for s, p in series.items()}


def test_latency_stream(spark, tmp_path):
    t0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(0, t0 + timedelta(seconds=s), float(s)) for s in (0, 1, 6, 7, 300)]
    spark.createDataFrame(rows, LATENCY).coalesce(1).write.parquet(f"{tmp_path}/in")
    means = latency_stream(streams.stream_latency(spark, f"{tmp_path}/in"))
    sinks.run_available(means.writeStream.format("parquet").option("path", f"{tmp_path}/out")
                        .option("checkpointLocation", f"{tmp_path}/ck"))
    base = int(t0.timestamp())
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == \
        [(0, base, 0.5, 2), (0, base + 5, 6.5, 2)]


# --- matching, dedupe and latency by stored state, without a clock over all keys

def run_sink(spark, base, cfg=CFG, order="time"):
    stream = streams.stream_trip_records(spark, f"{base}/trips", cfg, "parquet")
    sinks.run_available(hot_path_sink(stream, f"{base}/out", f"{base}/chains", f"{base}/checkpoint", cfg, order, 1))


def test_sink_equals_batch_over_restarts_and_capped(spark, tmp_path):
    trips = oracle.time_order(random_trips(21, 90))
    for cap in (None, 2):
        base, cfg = f"{tmp_path}/{cap}", PathConfig(files_per_trigger=1, max_chain=cap)
        for i in range(0, 90, 30):
            land(spark, f"{base}/trips", trips[i:i + 30])
            run_sink(spark, base, cfg)
        want = oracle.longest_matches(trips, cap=cap)
        assert want and found(spark, base) == want
        run_sink(spark, base, cfg)
        assert found(spark, base) == want


def test_sink_in_arrival_order(spark, tmp_path):
    trips = random_trips(22, 60)
    for i in range(0, 60, 20):
        land(spark, f"{tmp_path}/trips", trips[i:i + 20])
        run_sink(spark, tmp_path, order="arrival")
    assert found(spark, tmp_path) == oracle.longest_matches(trips, "arrival")


def test_late_bike_loses_nothing(spark, tmp_path):
    """One bike's trips come weeks after all others were seen; late within its own order is late all the same."""
    day = 24 * 3_600_000
    early = [("x", 1, 2, 0, 10, 0), ("x", 2, 7, 10, 20, 1), ("x", 7, 8, 5, 30, 2)]
    others = [("y", 1, 2, 40 * day, 40 * day + 1, 3), ("y", 2, 9, 40 * day + 1, 40 * day + 2, 4)]
    for part in (others, early[:1], early[1:2], early[2:]):
        land(spark, f"{tmp_path}/trips", part)
        run_sink(spark, tmp_path)
    want = [("x", 1, 2, 7, 0, 20, 1), ("y", 1, 2, 9, 40 * day, 40 * day + 2, 1)]
    assert found(spark, tmp_path) == want
    # the same with the walk trip by trip, without a clock over all bikes
    stream = streams.stream_trip_records(spark, f"{tmp_path}/trips", CFG, "parquet")
    walked = hot_path_stream(stream, PathConfig(files_per_trigger=1, watermark=None), "time", 1)
    sinks.run_available(sinks.stream_match_sink(walked, f"{tmp_path}/w/out", f"{tmp_path}/w/checkpoint"))
    assert found(spark, f"{tmp_path}/w") == want


def test_a_batch_that_runs_again_writes_the_same(spark, tmp_path):
    trips = oracle.time_order(random_trips(23, 60))
    rows = [spark.createDataFrame([(b, s, e, t, d, t, q) for b, s, e, t, d, q in part], COLS) for part in (trips[:30], trips[30:])]
    log = StateLog(spark, f"{tmp_path}/chains", matcher._CHAINS, ("bike_id",))
    held = []

    def keep(df, label):
        held.append(f"{tmp_path}/{label}-{len(held)}")
        df.write.parquet(held[-1])
        return spark.read.parquet(held[-1])

    got = {}
    for number, part in ((0, 0), (1, 1), (1, 1)):
        matches, chains = matcher.match_batch(rows[part], log.before(number, rows[part]), CFG, "time", keep)
        got[number] = sorted(map(tuple, matches.select("bike_id", "a1_start", "ai_end", "b_end", "first_ts_ms", "b_ended_ms", "length_a").collect()))
        log.put(number, chains)
    assert sorted(got[0] + got[1]) == oracle.longest_matches(trips)


def test_state_log_keeps_the_newest_row_and_what_a_rerun_reads(spark, tmp_path):
    log = StateLog(spark, f"{tmp_path}/log", "k string, v bigint", ("k",), every=3)
    assert log.before(0).collect() == []
    want = {}
    for n in range(11):
        rows = [("a", n), (f"k{n % 4}", 10 * n), (None, n)]
        before = dict(want)
        log.put(n, spark.createDataFrame(rows, "k string, v bigint"), F.col("v") >= 0)
        want.update(dict(rows))
        assert dict(map(tuple, log.before(n + 1).collect())) == want
        assert dict(map(tuple, log.before(n).collect())) == before
    some = spark.createDataFrame([("k1",), ("k1",), (None,), ("new",)], "k string")
    assert dict(map(tuple, log.before(11, some).collect())) == {"k1": want["k1"], None: 10}
    assert len(log._numbers("delta")) < 8 and len(log._numbers("full")) <= 2


def test_dedupe_sink_by_each_keys_own_sight(spark, tmp_path):
    hour = 3_600_000

    def match(bike, at, station=7):
        return (bike, 1, 2, station, 5, 6, 1, at, at)

    batches = [[match("a", 100 * hour), match("a", 100 * hour), match("b", 100 * hour)],
               [match("c", 0), match("a", 101 * hour), match(None, 1)],        # c is first seen 100 hours behind the others
               [match("c", 1 * hour), match("a", 123 * hour), match("a", 124 * hour), match("a", 125 * hour), match(None, 2)],
               [match("c", 25 * hour), match("a", 147 * hour), match("a", 148 * hour), match("b", 100 * hour, 8)]]
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, MATCH).write.mode("append").json(f"{tmp_path}/in")
        stream = streams.stream_matches(spark, f"{tmp_path}/in")
        sinks.run_available(dedupe_sink(stream, f"{tmp_path}/out", f"{tmp_path}/seen", f"{tmp_path}/checkpoint", at="emit_ts_ms"))
    got = sorted(((r.bike_id or "", r.b_end, r.emit_ts_ms // hour) for r in streams.read_matches(spark, f"{tmp_path}/out").collect()))
    assert got == [("", 7, 0), ("a", 7, 100), ("a", 7, 124), ("a", 7, 148), ("b", 7, 100), ("b", 8, 100), ("c", 7, 0), ("c", 7, 25)]


def test_latency_sink_shows_open_and_late_buckets(spark, tmp_path):
    t0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
    base = int(t0.timestamp())
    parts = [[(0, 300, 1.0), (0, 301, 2.0), (1, 0, 5.0)], [(0, 302, 6.0), (0, 1, 4.0)]]
    for part in parts:
        spark.createDataFrame([(s, t0 + timedelta(seconds=at), v) for s, at, v in part], LATENCY).write.mode("append").parquet(f"{tmp_path}/in")
        sinks.run_available(latency_sink(streams.stream_latency(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    got = sorted((r.shard, r.bucket_s - base, r.mean_ms, r.n) for r in read_latency(spark, f"{tmp_path}/out").collect())
    assert got == [(0, 0, 4.0, 1), (0, 300, 3.0, 3), (1, 0, 5.0, 1)]
