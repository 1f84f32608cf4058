"""Backlog, overload switch, flags, shedding, latency metrics."""

import random

import pytest
from pyspark.sql import functions as F

from pedalpath import PathConfig, attach_flag, backlog, overload_switch, shed
from pedalpath.operators import metrics
from pedalpath.operators.select import nth_by_group, smallest
from pedalpath.sources import series
from pedalpath.schemas import BACKLOG, CHAIN, SHED_FLAGS
from . import oracle
from datetime import datetime, timedelta, timezone

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def polls(spark, series):
    rows = [(s, T0 + timedelta(seconds=5 * i), p) for s, ps in series.items() for i, p in enumerate(ps)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, BACKLOG)


def statuses(df):
    out = {}
    for r in df.orderBy("shard", "ts").collect():
        out.setdefault(r.shard, []).append((r.status, r.active))
    return out


def test_switch_golden(spark):
    series = {0: [4, 4, 4, 4, 0, 9, 9, 0, 0, 0], 1: [5, 0, 5, 5, 5, 2, 2, 2]}
    got = statuses(overload_switch(polls(spark, series)))
    assert [s for s, _ in got[0]] == [1, 2, 3, 3, 2, 3, 3, 2, 1, 0]
    assert [a for _, a in got[0]] == [False, False, True, True, False, True, True, False, False, False]
    assert [s for s, _ in got[1]] == [1, 0, 1, 2, 3, 2, 1, 0]


@pytest.mark.parametrize("limit", [1_000_000, 400])
def test_switch_long(spark, limit):
    rng = random.Random(2)
    series = {s: [rng.choice([0, 3, 4, 9]) for _ in range(n)] for s, n in ((0, 1500), (1, 513), (2, 512), (3, 1))}
    got = statuses(overload_switch(polls(spark, series), PathConfig(max_group_rows=limit)))
    assert got == {s: oracle.switch(p) for s, p in series.items()}


def test_flag_in_force(spark):
    rng = random.Random(3)
    flags, at = [], 0
    for _ in range(60):
        at += rng.choice([5, 60, 5000, 9000])
        flags.append((rng.randrange(2), T0 + timedelta(seconds=at), rng.random() < 0.5))
    base = int(T0.timestamp() * 1000)
    trips = [(i, rng.randrange(3), base + rng.randrange(-1000, at + 9000) * 1000) for i in range(300)]
    trips += [(1000 + i, s, int(t.timestamp() * 1000)) for i, (s, t, _) in enumerate(flags)]
    df = spark.createDataFrame(trips, "id bigint, shard int, started_at_ms bigint")
    got = {r.id: r.active for r in attach_flag(df, spark.createDataFrame(flags, SHED_FLAGS)).collect()}
    want = {}
    for i, s, t in trips:
        before = [(f[1], f[2]) for f in flags if f[0] == s and int(f[1].timestamp() * 1000) <= t]
        want[i] = max(before)[1] if before else False
    assert got == want


def test_backlog(spark):
    trips = spark.createDataFrame([(i, i % 3) for i in range(10)], "trip_seq bigint, shard int")
    done = spark.createDataFrame([(0,), (3,), (6,), (9,), (1,)], "trip_seq bigint")
    assert sorted(map(tuple, backlog(trips, done, 4).collect())) == [(0, 0), (1, 2), (2, 3), (3, 0)]


@pytest.mark.parametrize("policy", ["none", "drop_oldest", "DROP_K", "Shrink_Window", "what"])
@pytest.mark.parametrize("knob", [(1, 3, 1800), (0, 0, 0), (4, 9, 10)])
def test_shed(spark, policy, knob):
    n, k, w = knob
    chains = [[(i, i + 1, 100 * i, 100 * i + 90) for i in range(m)] for m in (1, 2, 5, 30)]
    cfg = PathConfig(shed_keep_last_n=n, shed_drop_k=k, shed_window_ms=w)
    df = spark.createDataFrame([(i, c, c[-1][3]) for i, c in enumerate(chains)],
                               f"id int, chain {CHAIN.simpleString()}, last bigint")
    got = {r.id: [tuple(t) for t in r.c] for r in df.select("id", shed("chain", "last", policy, cfg).alias("c")).collect()}
    assert got == {i: oracle.shed(c, c[-1][3], policy.lower(), n, k, w) for i, c in enumerate(chains)}


def test_latency(spark):
    rows = [(0, T0, 1.0, 1), (0, T0, 3.0, 2), (0, T0 + timedelta(seconds=12), 5.0, 3),
            (1, T0 + timedelta(hours=2), 7.0, 4), (1, T0, 9.0, 5)]
    df = spark.createDataFrame(rows, "shard int, ts timestamp, latency_ms double, seq bigint")
    base = int(T0.timestamp())
    two = metrics.latency_buckets(df.where("shard = 0")).orderBy("bucket_s").collect()
    assert [tuple(r) for r in two] == [(0, base, 2.0, 2), (0, base + 5, None, 0), (0, base + 10, 5.0, 1)]
    # two hours of five-second buckets for the other shard
    assert metrics.latency_buckets(df).where("shard = 1").count() == 1441
    assert sorted(map(tuple, metrics.newest_mean(metrics.latency_buckets(df)).collect())) == \
        [(0, base + 10, 5.0), (1, base + 7200, 7.0)]
    kept = metrics.latency_series(df).select("shard", "latency_ms").collect()
    assert sorted(map(tuple, kept)) == [(0, 3.0), (0, 5.0), (1, 7.0)]
    assert sorted(map(tuple, metrics.slow_counts(df).collect())) == [(0, 2, 3), (1, 2, 2)]
    polls = spark.createDataFrame([(0, 1, 10), (0, 2, 10), (0, 3, 12), (1, 1, None), (1, 2, 4)],
                                  "shard int, poll_ts int, last_ts int")
    news = {(r.shard, r.poll_ts): r.is_new for r in metrics.poll_news(polls).collect()}
    assert news == {(0, 1): True, (0, 2): False, (0, 3): True, (1, 1): False, (1, 2): True}


def test_event_latency_series(spark, tmp_path):
    trips = spark.createDataFrame([(0, 1_000, 1), (0, 5_000, 2), (1, 0, 3)],
                                  "shard int, ingest_ts_ms bigint, trip_seq bigint")
    series.append_samples(metrics.event_latency(trips, F.lit(6_000).cast("bigint")), f"{tmp_path}/series")
    back = spark.read.parquet(f"{tmp_path}/series")
    # two values at one time stamp: the one written last stays
    assert sorted((r.shard, r.latency_ms) for r in metrics.latency_series(back).collect()) == [(0, 1000.0), (1, 6000.0)]


def test_switch_over_seven_levels(spark):
    """A fold of four over 4 ** 7 polls; the walk is the same."""
    rng = random.Random(11)
    pending = [rng.choice([0, 3, 4, 9]) for _ in range(4 ** 7)]
    t0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
    polls = spark.createDataFrame([(0, t0 + timedelta(seconds=i), p) for i, p in enumerate(pending)] + [(1, t0, 9)], BACKLOG)
    got = overload_switch(polls, fold=4).orderBy("shard", "ts").collect()
    assert [(r.status, r.active) for r in got] == [*oracle.switch(pending), *oracle.switch([9])]


def test_nth_smallest(spark):
    rng = random.Random(12)
    for values in ([5], [3] * 50, [rng.randrange(-10, 10) for _ in range(300)], [rng.randrange(-(1 << 40), 1 << 40) for _ in range(300)],
                   [-(1 << 62), 0, (1 << 62) - 1, 7, 7]):
        df = spark.createDataFrame(list(enumerate(values)), "id bigint, v bigint")
        for n in {1, 2, len(values) // 2 or 1, len(values), len(values) + 1}:
            got = sorted(r.v for r in smallest(df, "v", n).collect())
            assert got == sorted(values)[:n]
    assert smallest(df, "v", 0).collect() == [] and smallest(df.limit(0), "v", 3).collect() == []


def test_nth_by_group(spark):
    rng = random.Random(13)
    rows = [(rng.choice("aab"), rng.randrange(10_000_000)) for _ in range(300)] + [("c", 1)] * 40 + [("d", 5), ("d", 6)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    for n in (1, 2, 30):
        want = {g: sorted(v for x, v in rows if x == g)[n - 1] for g in "abcd" if sum(x == g for x, _ in rows) > n}
        assert {r.g: r.cut for r in nth_by_group(df, "g", "v", n, fan=16).collect()} == want


def test_series_store_reads_what_is_retained(spark, tmp_path):
    """Shards that ended at other times, two writes of a stamp, compaction; only the folders that matter are read."""
    path = f"{tmp_path}/series"
    rows = [(0, T0 + timedelta(hours=h), float(h), h) for h in range(30)] + [(1, T0 + timedelta(hours=h), 100.0 + h, h) for h in range(5)]
    again = [(0, T0 + timedelta(hours=h), -float(h), 1000 + h) for h in range(25, 30)]
    kind = "shard int, ts timestamp, latency_ms double, seq bigint"
    cfg = PathConfig(latency_retention_ms=2 * 3_600_000)
    assert series.read_samples(spark, path, cfg).collect() == []
    want = [(0, -float(h)) for h in (27, 28, 29)] + [(1, 102.0), (1, 103.0), (1, 104.0)]
    for part in (rows, again):
        series.append_samples(spark.createDataFrame(part, kind), path, cfg)
    for _ in range(2):
        got = series.read_samples(spark, path, cfg)
        assert sorted((r.shard, r.latency_ms) for r in got.orderBy("shard", "ts").collect()) == sorted(want)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "span" in plan.split("PartitionFilters: [")[1].split("]")[0]
        series.compact_samples(spark, path, cfg)
    # beyond the retention time nothing is left
    assert {s: len(h) for s, h in series._spans(spark, path).items()} == {0: 3, 1: 3}
