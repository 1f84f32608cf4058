"""Sources, cleaning, sharding, sinks."""

import hashlib
import json
import os
import statistics
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from pedalpath import PathConfig, clean_trips, hot_paths, match_counts, rejected_trips, sharded_rows, totals
from pedalpath.functions import scalar
from pedalpath.operators import clean
from pedalpath.plans import reports
from pedalpath.plans.hot_paths import early_variant
from pedalpath.schemas import RAW_TRIP
from pedalpath.sources import logs, sinks, streams, trips as src
from pedalpath.streaming.ingest import csv_ingest_sink

HEADER = ",".join(f.name for f in RAW_TRIP)


def line(bike, start, end, begun, done):
    return f"1,{begun},{done},{start},A,40.1,-73.9,{end},B,40.2,-73.8,{bike},Subscriber,,1"


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join([HEADER, *lines]) + "\n")


GOOD = [
    line("19728", 474, 3259, "2017-01-01 00:08:00", "2017-01-01 00:12:00"),
    line("25542", 3226, 3165, "2017-01-01 00:00:21", "2017-01-01 00:11:41"),
    line("19728", 3259, 3258, "2017-01-01 00:20:00", "2017-01-01 00:25:59"),
    line("21136", 3263, 498, "2017-01-01 00:00:45", "2017-01-01 00:22:08"),
]


def test_csv_to_match(spark, tmp_path):
    write(f"{tmp_path}/1_January/d.csv", GOOD)
    trips = clean_trips(src.read_trip_csv(spark, f"{tmp_path}/1_January/d.csv"), ingest_ts_ms=5)
    found = hot_paths(trips).collect()
    assert [tuple(r) for r in found] == [("19728", 474, 3259, 3258, 1483229280000, 1483230359000, 1, 5)]
    counts = match_counts(trips)
    assert {r.bike: r.matches for r in counts.collect()} == {"19728": 1, "25542": 0, "21136": 0}
    assert tuple(totals(counts).first()) == (1, 3, 1)
    assert early_variant(trips).count() == 3


def test_arrival_order_is_file_order(spark, tmp_path):
    lines = [line(i, 1, 2, "2017-01-01 00:00:00", "2017-01-01 00:00:01") for i in range(5000)]
    write(f"{tmp_path}/1_January/a.csv", lines[:3000])
    write(f"{tmp_path}/1_January/b.csv", lines[3000:4000])
    write(f"{tmp_path}/2_February/c.csv", lines[4000:])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        raw = src.read_month_folders(spark, str(tmp_path))
        got = [r["Bike ID"] for r in raw.orderBy("trip_seq").collect()]
        assert got == [str(i) for i in range(5000)]
        assert raw.select("trip_seq").distinct().count() == 5000
        assert {(r.month, r["count"]) for r in raw.groupBy("month").count().collect()} == {(1, 4000), (2, 1000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_rejects(spark, tmp_path):
    ok = "2017-01-01 00:00:00", "2017-01-01 00:10:00"
    rows = [
        line("", 1, 2, *ok), line("a", "3226.0", 2, *ok), line("a", 1, "x", *ok), line("a", " 42 ", "+7", *ok),
        line("a", 1, 2, "soon", ok[1]), line("a", 1, 2, ok[1], ok[0]), line("a", 1, -3, *ok),
        line("a", 1, 2, "2017-01-01 00:00:00+02:00", "2017-01-01T00:10:00Z"), line("a", 3.5, 2, *ok),
        line("a", 1, 2, ok[0], ok[0]),
    ]
    write(f"{tmp_path}/d.csv", rows)
    raw = src.read_trip_csv(spark, f"{tmp_path}/d.csv")
    reasons = [r.reject_reason for r in rejected_trips(raw).orderBy("trip_seq").collect()]
    assert reasons == ["bike_id", "start_station_id", "end_station_id", "started_at_ms", "ends_before_start",
                       "start_station_id"]
    good = clean_trips(raw, ingest_ts_ms=0).orderBy("trip_seq").collect()
    assert [(r.start_station_id, r.end_station_id) for r in good] == [(42, 7), (1, -3), (1, 2), (1, 2)]
    assert good[2].started_at_ms == 1483228800000 - 2 * 3_600_000
    assert clean_trips(raw, "numeric").count() == 5
    assert clean_trips(raw, max_rows=2, ingest_ts_ms=0).count() == 2
    assert rejected_trips(raw, "numeric").where("reject_reason = 'start_station_id'").count() == 1


def test_parse_time_ignores_session_zone(spark):
    df = spark.createDataFrame([("2017-01-01 00:00:00",), ("2017-01-01",), ("2017-01-01 00:00:00.250",),
                                ("nope",), (None,)], "t string")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r[0] for r in df.select(scalar.parse_time_ms("t")).collect()]
        local = spark.range(1).select(scalar.local_time(F.lit(1483228800000), "Europe/Helsinki")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [1483228800000, 1483228800000, 1483228800250, None, None]
    assert local == "2017-01-01 02:00:00"


def test_shards(spark):
    ids = [str(i) for i in range(200)] + ["25542", "21136", "19728", "bike é"]
    df = spark.createDataFrame([(i,) for i in ids], "b string")
    for n in (1, 7, 8, 10, 1000):
        want = [int(hashlib.md5(i.encode()).hexdigest(), 16) % n for i in ids]
        assert [r[0] for r in df.select(scalar.shard_of("b", n)).collect()] == want
    known = {"25542": (3, 3), "21136": (1, 3), "19728": (1, 5)}
    for r in df.select("b", scalar.shard_of("b", 8).alias("e"), scalar.shard_of("b", 10).alias("t")).collect():
        assert known.get(r.b, (r.e, r.t)) == (r.e, r.t)


def test_bike_column():
    assert src.find_bike_column(["x", "bikeid", "Bike ID"]) == "Bike ID"
    assert src.find_bike_column(["x", "My Bike No"]) == "My Bike No"
    with pytest.raises(KeyError):
        src.find_bike_column(["x"])


def test_typed_bikes(spark):
    whole = spark.createDataFrame([("1",), ("22",)], "bike_id string")
    assert dict(clean.typed_bikes(whole).dtypes)["bike_id"] == "bigint"
    mixed = spark.createDataFrame([("1",), ("a",)], "bike_id string")
    assert dict(clean.typed_bikes(mixed).dtypes)["bike_id"] == "string"


@pytest.mark.parametrize("limit", [1_000_000, 100])
def test_sharded_rows(spark, limit):
    rows = [("hot" if i % 2 else f"b{i % 6}", 1, 2, (i * 7919) % 1000, 5000, i) for i in range(400)]
    df = spark.createDataFrame(rows, "bike_id string, start_station_id bigint, end_station_id bigint, "
                                     "started_at_ms bigint, ended_at_ms bigint, trip_seq bigint")
    placed = sharded_rows(df, 6, PathConfig(max_group_rows=limit))
    assert sorted(r.trip_seq for r in placed.collect()) == list(range(400))
    parts = placed.rdd.glom().collect()
    homes = {}
    for no, part in enumerate(parts):
        last = {}
        for r in part:
            homes.setdefault(r.bike_id, set()).add(no)
        cold = [r for r in part if r.bike_id != "hot"]
        for r in cold:
            assert last.get(r.bike_id, (-1, -1)) < (r.started_at_ms, r.trip_seq)
            last[r.bike_id] = (r.started_at_ms, r.trip_seq)
    assert all(len(h) == 1 for b, h in homes.items() if b != "hot")
    assert len(homes["hot"]) == 1 if limit > 400 else len(homes["hot"]) > 1


def test_wire_round_trip(spark, tmp_path):
    write(f"{tmp_path}/d.csv", GOOD)
    trips = clean_trips(src.read_trip_csv(spark, f"{tmp_path}/d.csv"), ingest_ts_ms=9)
    sinks.write_trip_records(trips, f"{tmp_path}/wire")
    assert all(d.startswith("shard=") for d in os.listdir(f"{tmp_path}/wire") if "." not in d and d != "_SUCCESS")
    back = src.read_trip_records(spark, f"{tmp_path}/wire")
    cols = ["bike_id", "start_station_id", "end_station_id", "started_at_ms", "ended_at_ms", "ingest_ts_ms", "trip_seq"]
    assert sorted(map(tuple, back.select(cols).collect())) == sorted(map(tuple, trips.select(cols).collect()))
    bare = spark.createDataFrame([(b"1", b"2", b"3", b"4", b"5")], "bike_id binary, start_station_id binary, "
                                 "end_station_id binary, started_at_ms binary, ended_at_ms binary")
    assert tuple(src.decode_wire(bare).first()) == ("1", 2, 3, 4, 5, 0, None)


def test_match_lines_and_reports(spark, tmp_path):
    write(f"{tmp_path}/d.csv", GOOD)
    trips = clean_trips(src.read_trip_csv(spark, f"{tmp_path}/d.csv"), ingest_ts_ms=9)
    stamped = sinks.stamped_matches(hot_paths(trips), 50)
    sinks.write_matches(stamped, f"{tmp_path}/m")
    texts = [json.loads(x) for f in os.listdir(f"{tmp_path}/m") if f.endswith(".json")
             for x in open(f"{tmp_path}/m/{f}")]
    assert texts == [{"bike_id": "19728", "a1_start": "474", "ai_end": "3259", "b_end": "3258",
                      "first_ts_ms": "1483229280000", "b_ended_ms": "1483230359000", "length_a": "1",
                      "ingest_ts_ms": "9", "emit_ts_ms": "50"}]
    assert sinks.match_latency(streams.read_matches(spark, f"{tmp_path}/m")).first().latency_ms == 41
    assert not sinks.write_detail_sample(spark.createDataFrame([], "a int"), f"{tmp_path}/none")
    assert not os.path.exists(f"{tmp_path}/none")


def test_log_and_compare(spark):
    lines = spark.createDataFrame([("x bike=5 end=17  lenA=2 y",), ("bike=5 end=18 lenA=1",), ("bike= end=1 lenA=1",),
                                   ("bike=6 end=19 lenA=3",)], "value string")
    online = reports.count_by_bike(logs.parse_match_log(lines))
    batch = spark.createDataFrame([(5, 3), (7, 4)], "bike bigint, matches bigint")
    both = reports.compare_counts(batch, online)
    assert sorted(map(tuple, both.collect())) == [(5, 3, 2, 1), (6, 0, 1, -1), (7, 4, 0, 4)]
    assert [r.bike for r in reports.top_bikes(both, 2, "batch_matches").collect()] == [7, 5]
    want = statistics.correlation((3, 0, 4), (2, 1, 0))
    assert abs(reports.count_correlation(both).first()[0] - want) < 1e-9


def test_months_in_their_order(spark, tmp_path):
    """October comes after January, and rows of a later file have larger numbers, however many files there are."""
    ok = "2017-01-01 00:00:00", "2017-01-01 00:10:00"
    for month in ("10_October", "1_January", "2_February"):
        write(f"{tmp_path}/{month}/d.csv", [line(f"{month}{i}", 1, 2, *ok) for i in range(3)])
    got = [r["Bike ID"] for r in src.read_month_folders(spark, str(tmp_path)).orderBy("trip_seq").collect()]
    assert got == [f"{m}{i}" for m in ("1_January", "2_February", "10_October") for i in range(3)]


def test_many_files_are_numbered():
    """Numbers rise with the files, and nothing wraps behind 2 ** 20 of them."""
    files = [(f"/in/1_Month/{i:08d}.csv", 1 << 30) for i in range((1 << 20) + 3)]
    starts, after = src.file_starts(files, 1 << 28, 7)
    assert starts[files[0][0]] == 7 and starts[files[-1][0]] == 7 + ((1 << 20) + 2) * ((1 << 30) + (1 << 28))
    assert after == 7 + len(files) * ((1 << 30) + (1 << 28)) < 1 << 63


def test_small_files_in_one_task_keep_their_order(spark, tmp_path):
    """Many files share a scan task; their rows' numbers neither meet nor cross."""
    for i in range(40):
        write(f"{tmp_path}/1_January/{i:02d}.csv", [line(100 * i + k, 1, 2, "2017-01-01 00:00:00", "2017-01-01 00:00:01") for k in range(i % 7)])
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        raw = src.read_month_folders(spark, str(tmp_path))
        rows = raw.orderBy("trip_seq").select("Bike ID", "trip_seq").collect()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)
    assert [int(r[0]) for r in rows] == [100 * i + k for i in range(40) for k in range(i % 7)]
    assert len({r[1] for r in rows}) == len(rows) and raw.rdd.getNumPartitions() < 20


def test_columns_by_header(spark, tmp_path):
    (tmp_path / "d.csv").write_text("Bike ID,Extra,Start Time,Stop Time,Start Station ID,End Station ID\n"
                                    "7,x,1/2/2017 00:00:21,2017/01/02 1:05,3,4\n")
    row = clean_trips(src.read_trip_csv(spark, f"{tmp_path}/d.csv"), ingest_ts_ms=0).first()
    assert (row.bike_id, row.start_station_id, row.end_station_id) == ("7", 3, 4)
    assert (row.started_at_ms, row.ended_at_ms) == (1483315221000, 1483319100000)


def test_different_headers_are_read_together(spark, tmp_path):
    """Two years' headers, other orders, a column more, another bike header, an empty file and one with a header only."""
    (tmp_path / "a.csv").write_text("Bike ID,Start Time,Stop Time,Start Station ID,End Station ID\n7,2017-01-02 00:00:21,2017-01-02 00:01:21,3,4\n")
    (tmp_path / "b.csv").write_text("\"end station id\",extra,starttime,stoptime,start station id,bikeid\n5,\"x,y\",1/2/2017 00:00:21,1/2/2017 00:02:21,4,8\n")
    (tmp_path / "c d.csv").write_text("ended_at,started_at,end_station_id,start_station_id,City bike no\n2017-01-02 00:03:21,2017-01-02 00:00:21,6,5,9\n")
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "f.csv").write_text("Bike ID,Start Time\n")
    raw = src.read_trip_csv(spark, str(tmp_path))
    rows = clean_trips(raw, ingest_ts_ms=0).orderBy("trip_seq").collect()
    assert [(r.bike_id, r.start_station_id, r.end_station_id, r.ended_at_ms - r.started_at_ms) for r in rows] == [
        ("7", 3, 4, 60_000), ("8", 4, 5, 120_000), ("9", 5, 6, 180_000)]
    assert {r.extra for r in raw.collect()} == {None, "x,y"}


def test_resolved_header():
    assert src.resolved_header(["starttime", "Start Time", "bike_id", "BIKE ID", "note", "_c5"]) == \
        ["starttime", "Start Time", "Bike ID", "BIKE ID_", "note", "_c5"]


def test_no_file_at_all(spark, tmp_path):
    raw = src.read_trip_csv(spark, str(tmp_path))
    assert raw.collect() == [] and clean_trips(raw, ingest_ts_ms=0).collect() == []


def test_streamed_files_by_their_own_headers(spark, tmp_path):
    """Three batches with other headers; numbers go on, and a batch that runs again gives the same."""
    ok = "2017-01-01 00:00:00", "2017-01-01 00:10:00"
    heads = ["Bike ID,Start Time,Stop Time,Start Station ID,End Station ID", "bikeid,stoptime,starttime,end station id,start station id"]
    for n in range(3):
        (tmp_path / "in").mkdir(exist_ok=True)
        rows = [(f"{n}{i}", *(ok if n % 2 == 0 else ok[::-1]), *(("1", "2") if n % 2 == 0 else ("2", "1"))) for i in range(3)]
        (tmp_path / "in" / f"{9 - n}.csv").write_text("\n".join([heads[n % 2], *map(",".join, rows)]) + "\n")
        sinks.run_available(csv_ingest_sink(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/numbers", f"{tmp_path}/ck", ingest_ts_ms=0))
    rows = src.read_trip_records(spark, f"{tmp_path}/out").orderBy("trip_seq").collect()
    assert [r.bike_id for r in rows] == [f"{n}{i}" for n in range(3) for i in range(3)] and len({r.trip_seq for r in rows}) == 9
    assert {(r.start_station_id, r.end_station_id, r.ended_at_ms - r.started_at_ms) for r in rows} == {(1, 2, 600_000)}


def test_time_forms_of_files(spark):
    def ms(*at):
        return int(datetime(*at, tzinfo=timezone.utc).timestamp() * 1000)

    t = (2017, 1, 2, 0, 0, 21)
    forms = {
        "1/2/2017 1:05:30 PM": ms(2017, 1, 2, 13, 5, 30), "2 January 2017 00:00:21": ms(*t), "02-Jan-2017 00:00:21": ms(*t),
        "13/2/2017 00:00:00": ms(2017, 2, 13), "20170102": ms(2017, 1, 2), "2017-01-02 00:00:21": ms(*t), "2017-01-02T00:00:21": ms(*t),
        "2017-01-02 00:00:21.5": ms(*t) + 500, "20170102T000021": ms(*t), "20170102000021": ms(*t), "201701020105": ms(2017, 1, 2, 1, 5),
        "20170102 00:00:21": ms(*t), "1/2/17 00:00:21": ms(*t), "1-2-2017 00:00:21": ms(*t), "2017/01/02 00:00:21": ms(*t),
        "2017.1.2 00:00:21": ms(*t), "Jan 2 2017 00:00:21": ms(*t), "January 2, 2017 12:00:21 AM": ms(*t), "Mon Jan 2 2017 00:00:21": ms(*t),
        "2nd Jan 2017": ms(2017, 1, 2), "1/2/2017 12:05 PM": ms(2017, 1, 2, 12, 5), "1/2/2017 12 am": ms(2017, 1, 2), "2017-01-02 00:00:21Z": ms(*t),
        "1/2/2017 00:00:21 America/New_York": ms(2017, 1, 2, 5, 0, 21), "12/31/69 00:00": ms(2069, 12, 31), "1/2/70 00:00": ms(1970, 1, 2),
        "  2017-01-02 00:00:21 ": ms(*t), "1/2/2017 13:05 PM": None, "2 Foo 2017": None, "13/13/2017": None, "": None,
        "2017-02-30 00:00:00": None, "20171302": None, "2017-01-02 00:00:21 pm": None}
    df = spark.createDataFrame([(x,) for x in forms], "t string")
    assert {r.t: r.ms for r in df.select("t", scalar.parse_time_ms("t").alias("ms")).collect()} == forms


def test_zones_are_honoured(spark):
    forms = {"2017-01-01 00:00:00 America/New_York": 1483246800000, "2017-01-01 00:00:00 GMT+2": 1483221600000,
             "2017-01-01 00:00:00-5": 1483246800000, "2017-01-01 00:00:00 Nowhere/Zone": None, "Jan 2 2017 00:00:21": 1483315221000,
             "1/2/2017 1:05": 1483319100000, "Foo 2 2017 00:00:21": None, "13/40/2017 00:00:00": None}
    df = spark.createDataFrame([(t,) for t in forms], "t string")
    assert {r.t: r.ms for r in df.select("t", scalar.parse_time_ms("t").alias("ms")).collect()} == forms


def test_malformed_records_alter_no_match(spark):
    """A record without a field is reported, and the trips around it still match."""
    rows = [("a", "1", "2", "0", "10", "0", "1"), ("a", "2", None, "20", "30", "0", "2"), ("a", "2", "7", "40", "50", "0", "3"),
            ("", "2", "7", "40", "50", "0", "4")]
    wire = spark.createDataFrame(rows, "bike_id string, start_station_id string, end_station_id string, started_at_ms string, "
                                       "ended_at_ms string, ingest_ts_ms string, trip_seq string")
    assert sorted(r.reject_reason for r in src.rejected_records(wire).collect()) == ["bike_id", "end_station_id"]
    from pedalpath import hot_paths
    for trips in (src.usable_records(wire), src.decode_wire(wire).where("bike_id <> ''")):
        assert [(r.a1_start, r.ai_end, r.b_end) for r in hot_paths(trips, "longest").collect()] == [(1, 2, 7)]
