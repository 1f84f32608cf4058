"""Batch matching against golden rows and the plain restatement."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from pedalpath import PathConfig, drop_late, early_variant, hot_paths, match_counts, sequence_trips
from pedalpath.operators.sequence import chain_summary, open_chains, prune_chain
from pedalpath.plans.hot_paths import match_details
from pedalpath.operators.ordered import HotKeys
from pedalpath.plans.hot_paths import first_details, first_pairs
from pedalpath.plans.reports import sample_details
from . import oracle

BASE, MIN = 1_483_220_000_000, 60_000
COLS = "bike_id string, start_station_id bigint, end_station_id bigint, started_at_ms bigint, " \
       "ended_at_ms bigint, ingest_ts_ms bigint, trip_seq bigint"
PIECES = PathConfig(max_group_rows=5, max_pieces=5)

GOLDEN = {
    "basic": ([(100, 200, 8, 16), (200, 327, 18, 26)], [(100, 200, 327, 8, 26, 1)], None),
    "left_eviction": ([(10, 11, 0, 10), (11, 12, 12, 20), (12, 339, 69, 72)], [(11, 12, 339, 12, 72, 1)], None),
    "emptied": ([(100, 200, 0, 5), (200, 300, 6, 10), (300, 317, 150, 155)], [], None),
    "break": ([(10, 11, 0, 10), (99, 107, 12, 20)], [], None),
    "out_of_order": ([(1, 2, 10, 20), (2, 307, 5, 15)], [], None),
    "not_hot": ([(50, 60, 0, 10), (60, 1234, 12, 20)], [], None),
    "one_hour": ([(1, 2, 0, 10), (2, 3, 12, 20), (3, 329, 58, 60)], [(1, 3, 329, 0, 60, 2)],
                 [(1, 3, 329, 0, 60, 2), (2, 3, 329, 12, 60, 1)]),
}


def frame(spark, trips):
    return spark.createDataFrame([(b, s, e, t, d, t, q) for b, s, e, t, d, q in trips], COLS)


def rows(df):
    return sorted((r.bike_id, r.a1_start, r.ai_end, r.b_end, r.first_ts_ms, r.b_ended_ms, r.length_a)
                  for r in df.collect())


def golden_trips(name):
    return [(name, s, e, BASE + a * MIN, BASE + b * MIN, i) for i, (s, e, a, b) in enumerate(GOLDEN[name][0])]


def golden_rows(name, which):
    want = GOLDEN[name][which] if GOLDEN[name][which] is not None else GOLDEN[name][1]
    return [(name, a, i, b, BASE + f * MIN, BASE + d * MIN, n) for a, i, b, f, d, n in want]


def test_golden(spark):
    trips = [t for name in GOLDEN for t in golden_trips(name)]
    df = frame(spark, trips)
    assert rows(hot_paths(df, "longest", order="arrival")) == sorted(r for n in GOLDEN for r in golden_rows(n, 1))
    assert rows(hot_paths(df, "longest")) == oracle.longest_matches(trips)
    want = sorted(r for n in GOLDEN if n != "out_of_order" for r in golden_rows(n, 2))
    assert rows(hot_paths(df.where("bike_id <> 'out_of_order'"), "all")) == want


def random_trips(seed, n=60, bikes=3, overlap=True, stations=4):
    rng = random.Random(seed)
    out, clock = [], {}
    for i in range(n):
        # One bike holds most of the trips.
        bike = "hot" if rng.random() < 0.5 else f"b{rng.randrange(bikes)}"
        at = clock.get(bike, BASE) + rng.choice([0, 0, 1, 3, 7, 20]) * MIN
        if overlap and rng.random() < 0.2:
            at -= rng.choice([1, 5, 12]) * MIN
        length = rng.choice([0, 0, 1, 4, 9, 25, 70]) * MIN
        out.append((bike, rng.randrange(5, 5 + stations), rng.randrange(5, 5 + stations), at, at + length, i))
        clock[bike] = at + (0 if overlap else length)
    return out


@pytest.mark.parametrize("cfg, seed", [(PathConfig(), 1), (PathConfig(), 2), (PIECES, 1)],
                         ids=["whole-1", "whole-2", "pieces-1"])
def test_random(spark, cfg, seed):
    trips = random_trips(seed)
    df = frame(spark, trips).cache()
    want_all = oracle.all_matches(trips)
    assert want_all, "the input must have matches"
    assert rows(hot_paths(df, "all", cfg=cfg)) == want_all
    assert rows(hot_paths(df, "longest", cfg=cfg)) == oracle.longest_matches(trips)
    assert rows(hot_paths(df, "longest", order="arrival", cfg=cfg)) == oracle.longest_matches(trips, "arrival")
    counts = {r.bike: r.matches for r in match_counts(df, cfg=cfg).collect()}
    assert counts == {b: sum(m[0] == b for m in want_all) for b in {t[0] for t in trips}}
    df.unpersist()


@pytest.mark.parametrize("limit", [1_000_000, 5])
def test_late_drop(spark, limit):
    cfg = PathConfig(max_group_rows=limit, max_pieces=5)
    for seed in (3, 4) if limit > 5 else (3,):
        trips = random_trips(seed, 80)
        df = frame(spark, trips)
        for order in ("time", "arrival"):
            got = sorted(r.trip_seq for r in drop_late(df, order, cfg).collect())
            assert got == sorted(t[5] for t in oracle.keep(trips, order))


def test_late_drop_long_block(spark):
    """One bike, one block: every trip overlaps the next, more than the fold's short tail holds."""
    trips = [("x", 1, 2, BASE + i * 1000, BASE + i * 1000 + 1900, i) for i in range(3000)]
    want = sorted(t[5] for t in oracle.keep(trips))
    assert len(want) == 1500
    for cfg in (PathConfig(), PathConfig(max_group_rows=400)):
        got = sorted(r.trip_seq for r in drop_late(frame(spark, trips), "time", cfg).collect())
        assert got == want


@pytest.mark.parametrize("cfg", [PathConfig(), PathConfig(max_group_rows=20, max_pieces=4)], ids=["whole", "pieces"])
def test_copies(spark, cfg):
    """A third of the rows are copies of one trip, sequence number included."""
    copies = [("x", 7, 7, BASE + MIN, BASE + 2 * MIN, 1)] * 15 + [("x", 7, 7, BASE + MIN, BASE + MIN, 1)] * 15
    trips = copies + random_trips(17, 20) + [("x", 7, 8, BASE + 2 * MIN, BASE + 3 * MIN, 9)]
    df = frame(spark, trips)
    assert sorted(r.trip_seq for r in drop_late(df, "time", cfg).collect()) == sorted(t[5] for t in oracle.keep(trips))
    assert rows(hot_paths(df, "longest", cfg=cfg)) == oracle.longest_matches(trips)
    assert rows(hot_paths(df, "all", cfg=cfg)) == oracle.all_matches(trips)
    assert match_counts(df, cfg=cfg).agg(F.sum("matches")).first()[0] == len(oracle.all_matches(trips))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("xy"), st.integers(6, 8), st.integers(6, 8), st.integers(0, 90),
                          st.integers(0, 70)), min_size=1, max_size=25))
def test_property(spark, raw):
    trips = [(b, s, e, BASE + t * MIN, BASE + (t + d) * MIN, i) for i, (b, s, e, t, d) in enumerate(raw)]
    df = frame(spark, trips)
    assert rows(hot_paths(df, "all")) == oracle.all_matches(trips)
    assert rows(hot_paths(df, "longest")) == oracle.longest_matches(trips)
    assert sorted(r.trip_seq for r in drop_late(df, "arrival").collect()) == \
        sorted(t[5] for t in oracle.keep(trips, "arrival"))


@pytest.mark.parametrize("limit", [1_000_000, 5])
def test_options(spark, limit):
    trips = random_trips(7, 80, overlap=False)
    df = frame(spark, trips)
    cap = PathConfig(max_chain=2, max_group_rows=limit, max_pieces=4)
    assert rows(hot_paths(df, "all", cfg=cap)) == oracle.all_matches(trips, cap=2)
    assert rows(hot_paths(df, "longest", cfg=cap)) == oracle.longest_matches(trips, cap=2)
    alone = PathConfig(min_a=0, max_group_rows=limit, max_pieces=4)
    assert rows(hot_paths(df, "all", cfg=alone)) == oracle.all_matches(trips, min_a=0)
    assert match_counts(df, cfg=alone).agg(F.sum("matches")).first()[0] == len(oracle.all_matches(trips, min_a=0))
    literal = PathConfig(hot=(6, 12), hot_mode="literal", max_group_rows=limit, max_pieces=4)
    mine = rows(hot_paths(df, "all", cfg=literal))
    assert mine == [m for m in oracle.all_matches(trips, hot=tuple(range(10))) if m[3] in (6, 12)]


def test_longest_is_maximum_of_all(spark):
    trips = random_trips(11, 80, overlap=False)
    df = frame(spark, trips)
    best = {}
    for m in rows(hot_paths(df, "all")):
        best[(m[0], m[5], m[3])] = max(best.get((m[0], m[5], m[3]), m), m, key=lambda x: x[6])
    assert sorted(best.values()) == rows(hot_paths(df, "longest", "keep"))


def test_negative_station(spark):
    df = frame(spark, [("n", 1, 2, BASE, BASE + MIN, 0), ("n", 2, -3, BASE + MIN, BASE + 2 * MIN, 1)])
    assert len(rows(hot_paths(df))) == 1


def test_details_and_sample(spark):
    trips = random_trips(5, 90)
    df = frame(spark, trips)
    details = match_details(df, "all")
    want = oracle.all_matches(trips)
    got = details.collect()
    assert len(got) == len(want)
    assert sorted(r.chain_len for r in got) == sorted(m[6] + 1 for m in want)
    sample = sample_details(details, 2).collect()
    per = {}
    for r in sorted(got, key=lambda r: (r.bike, r.a_pos, r.b_pos)):
        per.setdefault(r.bike, []).append((r.a_pos, r.b_pos))
    assert sorted((r.bike, r.a_pos, r.b_pos) for r in sample) == \
        sorted((b, *p) for b, ps in per.items() for p in ps[:2])


@pytest.mark.parametrize("cfg", [PathConfig(), PIECES, PathConfig(max_chain=2), PathConfig(min_a=0)], ids=["whole", "pieces", "capped", "alone"])
def test_first_pairs_are_those_of_the_whole_list(spark, cfg):
    trips = random_trips(6, 90, stations=3)
    df = frame(spark, trips)
    whole = sorted((r.bike, r.a_pos, r.b_pos, r.chain_len) for r in match_details(df, "all", cfg=cfg).collect())
    assert len(whole) > 10
    for n in (1, 2, 7, 10_000):
        got = [(r.bike, r.a_pos, r.b_pos, r.chain_len) for r in first_details(df, n, cfg=cfg).collect()]
        assert sorted(got) == whole[:n]
        per = [(r.bike, r.a_pos, r.b_pos, r.chain_len) for r in first_details(df, n, per_bike=True, cfg=cfg).collect()]
        assert sorted(per) == [x for b in sorted({w[0] for w in whole}) for x in [w for w in whole if w[0] == b][:n]]
    assert first_details(df.limit(0), 5, cfg=cfg).collect() == []


def test_no_more_pairs_are_listed_than_wanted(spark):
    """A bike whose trips all chain and all end hot has a pair for any two; ten wanted are ten listed."""
    trips = [("d", 7, 7, BASE + i, BASE + i + 1, i) for i in range(400)] + [("e", 7, 7, BASE + i, BASE + i + 1, 400 + i) for i in range(30)]
    df = frame(spark, trips)
    spans = spark.createDataFrame([("d", i, 0, i - 1) for i in range(1, 400)] + [("e", i, 0, i - 1) for i in range(1, 30)],
                                  "bike_id string, p bigint, lo bigint, hi bigint").select("bike_id", F.struct(F.col("p").alias("pos")).alias("b"), "lo", "hi")
    for n, per_bike, want in ((10, False, 10), (10, True, 20), (400, False, 400), (100_000, False, 399 * 200 + 29 * 15)):
        assert first_pairs(spans, n, per_bike, HotKeys()).count() == want
    assert first_details(df, 10).count() == 10
    plan = match_details(df, "all")._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "CartesianProduct" not in plan


def test_early_variant(spark):
    trips = [("v", 1, 17, BASE, BASE + MIN, 0), ("v", 17, 8, BASE + MIN, BASE + 2 * MIN, 1),
             ("v", 8, 27, BASE + 2 * MIN, BASE + 3 * MIN, 2)]
    got = sorted((r.a1_start, r.b_end, r.length_a) for r in early_variant(frame(spark, trips)).collect())
    # every trip alone; the pair into station 8; the chains into 27 fail the literal test
    assert got == [(1, 8, 1), (1, 17, 0), (8, 27, 0), (17, 8, 0)]


@pytest.mark.parametrize("limit", [1_000_000, 5])
def test_sequence(spark, limit):
    cfg = PathConfig(max_group_rows=limit)
    trips = random_trips(9, 70)
    df = frame(spark, trips)
    want, runs = [], {}
    for bike, ts in oracle.by_bike(trips).items():
        run = 0
        ordered = oracle.time_order(ts)
        for i, t in enumerate(ordered):
            if i == 0 or ordered[i - 1][2] != t[1]:
                run, head = run + 1, i + 1
            want.append((t[5], i + 1, run, head))
            runs.setdefault((bike, run), []).append(t)
    got = sorted((r.trip_seq, r.pos, r.run_no, r.run_start_pos) for r in sequence_trips(df, cfg).collect())
    assert got == sorted(want)
    summary = {(r.bike_id, r.run_no): tuple(r)[2:] for r in chain_summary(df, cfg).collect()}
    assert summary == {k: (v[0][1], v[0][3], v[-1][2], v[-1][4], len(v)) for k, v in runs.items()}


@pytest.mark.parametrize("cfg", [PathConfig(), PIECES], ids=["whole", "pieces"])
def test_open_chains(spark, cfg):
    trips = oracle.keep(random_trips(13, 90))
    got = {r.bike_id: [tuple(t) for t in r.chain] for r in open_chains(frame(spark, trips), cfg).collect()}
    for bike, ts in oracle.by_bike(trips).items():
        chain = []
        for t in oracle.time_order(ts):
            chain = [c for c in chain if c[2] >= t[4] - oracle.W]
            if chain and chain[-1][1] != t[1]:
                chain = []
            chain.append(t[1:5])
        assert got[bike] == chain


def test_prune_chain(spark):
    df = spark.createDataFrame([([(1, 2, 0, 5), (2, 3, 10, 12), (3, 4, 20, 30)], 70)],
                               "chain array<struct<s:bigint,e:bigint,started_at_ms:bigint,d:bigint>>, ended bigint")
    left = df.select(prune_chain("chain", "ended", 60).alias("c"), prune_chain("chain", F.lit(200), 60).alias("d"))
    row = left.first()
    assert [t.started_at_ms for t in row.c] == [10, 20] and row.d == []


def test_config():
    assert PathConfig(hot="7, x,9,").hot == (7, 9)
    assert PathConfig(shed_policy=" Drop_K ").shed_policy == "drop_k"
    assert PathConfig(shed_policy="other").shed_policy == "none"
    assert PathConfig(n_shards=0).n_shards == 1
    with pytest.raises(ValueError):
        PathConfig(hot=(7, 12))
    with pytest.raises(ValueError):
        hot_paths(None, "longest", "keep", "arrival")
