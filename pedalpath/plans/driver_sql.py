"""The same queries as SQL over the same tables, written independently of the engine.

Late trips go by a recursive walk over each bike's trips, chains by a self join within a run.
"""

from __future__ import annotations

HOUR = 3_600_000
STAMP = 1_700_000_000_000

_EV = r"""
ev AS (SELECT event_id AS trip_seq, CAST(user_id AS VARCHAR) AS bike_id, ts, event_type, value,
              CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, epoch_us(ts) // 1000 AS started_at_ms
       FROM events)"""

_NEIGHBOURS = """
nb AS (SELECT *, lag(k) OVER w AS pk, lead(started_at_ms) OVER w AS nx FROM ev
       WINDOW w AS (PARTITION BY bike_id ORDER BY ts, trip_seq))"""


def _trips(overlapping: bool = False, arrivals: bool = False) -> str:
    raw = "started_at_ms + CAST(floor(value * 60000) AS BIGINT)"
    end = raw if overlapping else f"least({raw}, coalesce(nx, {raw}))"
    seq = "(trip_seq + (trip_seq * 37) % 11 * 300) * 1048576 + trip_seq % 1048576" if arrivals else "trip_seq"
    return f"""{_EV},{_NEIGHBOURS},
trips AS (SELECT bike_id, CASE WHEN event_type = 'error' OR pk IS NULL THEN 300 + k ELSE 100 + pk END
                 AS start_station_id, 100 + k AS end_station_id, started_at_ms, {end} AS ended_at_ms,
                 started_at_ms AS ingest_ts_ms, {seq} AS trip_seq FROM nb)"""


def _kept(order: str = "started_at_ms, ended_at_ms, trip_seq") -> str:
    return f"""
numbered AS (SELECT *, row_number() OVER (PARTITION BY bike_id ORDER BY {order}) AS n FROM trips),
walk AS (SELECT bike_id, n, ended_at_ms AS until, TRUE AS ok FROM numbered WHERE n = 1
         UNION ALL
         SELECT t.bike_id, t.n, CASE WHEN t.started_at_ms >= w.until THEN t.ended_at_ms ELSE w.until END,
                t.started_at_ms >= w.until
         FROM walk w JOIN numbered t ON t.bike_id = w.bike_id AND t.n = w.n + 1),
kept AS (SELECT numbered.* EXCLUDE (n) FROM numbered JOIN walk USING (bike_id, n) WHERE ok)"""


def _runs(source: str = "trips") -> str:
    return f"""
seq AS (SELECT *, row_number() OVER w AS pos, lag(end_station_id) OVER w AS prev_end FROM {source}
        WINDOW w AS (PARTITION BY bike_id ORDER BY started_at_ms, ended_at_ms, trip_seq)),
brk AS (SELECT *, coalesce(prev_end <> start_station_id, TRUE) AS is_break FROM seq),
runs AS (SELECT *, sum(CAST(is_break AS BIGINT)) OVER (PARTITION BY bike_id ORDER BY pos) AS run_no FROM brk)"""


def _pairs(window: int, hot: str = "b.end_station_id % 10 IN (7, 8, 9)", extra: str = "TRUE") -> str:
    return f"""
pairs AS (SELECT b.bike_id, a.start_station_id AS a1_start, b.start_station_id AS ai_end,
                 b.end_station_id AS b_end, a.started_at_ms AS first_ts_ms, b.ended_at_ms AS b_ended_ms,
                 CAST(b.pos - a.pos AS INTEGER) AS length_a, b.ingest_ts_ms, a.pos AS a_pos, b.pos AS b_pos
          FROM runs a JOIN runs b ON a.bike_id = b.bike_id AND a.run_no = b.run_no AND a.pos < b.pos
          WHERE {hot} AND b.ended_at_ms - a.started_at_ms <= {window} AND {extra}),
longest AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY bike_id, b_pos ORDER BY length_a DESC) = 1)"""


_MATCH = "bike_id, a1_start, ai_end, b_end, first_ts_ms, b_ended_ms, length_a, ingest_ts_ms"
DAY = 24 * HOUR


def _with(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",".join(ctes) + "\n"


def _all(window: int = DAY, overlapping: bool = False, **kw) -> str:
    return _with(_trips(overlapping), _runs(), _pairs(window, **kw))


def _longest_kept(window: int = DAY, arrivals: bool = False) -> str:
    order = "trip_seq" if arrivals else "started_at_ms, ended_at_ms, trip_seq"
    return _with(_trips(True, arrivals), _kept(order), _runs("kept"), _pairs(window), recursive=True)


_COUNTS = """
counts AS (SELECT t.bike_id AS bike, CAST(coalesce(p.n, 0) AS BIGINT) AS matches
           FROM (SELECT DISTINCT bike_id FROM trips) t
           LEFT JOIN (SELECT bike_id, count(*) AS n FROM {src} GROUP BY bike_id) p USING (bike_id))"""


def _counted(src: str = "pairs") -> str:
    return "," + _COUNTS.format(src=src) + "\n"


_DETAIL = """bike_id AS bike, first_ts_ms AS a1_start_ms, ai_end AS a_last_end_station, b_end AS b_end_station,
       b_ended_ms AS b_stop_ms, CAST(length_a + 1 AS INTEGER) AS chain_len"""


def _shard(column: str, n: int) -> str:
    expr = "0"
    for start in (1, 9, 17, 25):
        piece = f"('0x' || substr(md5({column}), {start}, 8))::BIGINT"
        expr = f"(({expr}) * ({1 << 32} % {n}) + {piece}) % {n}"
    return f"CAST({expr} AS INTEGER)"


# --- raw rows with faults ---------------------------------------------------------------------

_MESSY = r"""
f AS (SELECT event_id, user_id, event_type, value, ts, regexp_extract(props, '([0-9]+)', 1) AS k FROM events),
typed AS (SELECT event_id AS trip_seq,
    CASE WHEN event_type = 'error' AND length(k) = 1 THEN '' ELSE CAST(user_id AS VARCHAR) END AS bike_id,
    CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(k AS BIGINT) END AS strict_start,
    CAST(k AS BIGINT) AS numeric_start,
    CASE WHEN event_type = 'click' AND length(k) = 1 THEN NULL ELSE CAST('1' || k AS BIGINT) END AS end_station_id,
    CASE WHEN event_type = 'purchase' AND length(k) = 1 THEN NULL
         WHEN event_type = 'view' THEN epoch_ms(date_trunc('second', ts)) - 3600000
         ELSE epoch_ms(date_trunc('second', ts)) END AS started_at_ms,
    epoch_ms(date_trunc('second', ts)) + CAST(floor(value * 60) AS BIGINT) * 1000 AS ended_at_ms
  FROM f)"""


def _good(column: str) -> str:
    return f"""
good AS (SELECT bike_id, {column} AS start_station_id, end_station_id, started_at_ms, ended_at_ms, trip_seq
         FROM typed WHERE bike_id <> '' AND {column} IS NOT NULL AND end_station_id IS NOT NULL
           AND started_at_ms IS NOT NULL AND ended_at_ms >= started_at_ms)"""


# --- metrics ----------------------------------------------------------------------------------

_SAMPLES = f"""
samples AS (SELECT {_shard('CAST(user_id AS VARCHAR)', 10)} AS shard, epoch_us(ts) // 1000 AS ts_ms, value AS latency_ms,
                   event_id AS seq FROM events)"""

_BUCKETS = """
means AS (SELECT shard, CAST(ts_ms // 600000 * 600 AS BIGINT) AS bucket_s, avg(latency_ms) AS mean_ms,
                 count(*) AS n FROM samples GROUP BY ALL),
grid AS (SELECT shard, unnest(generate_series(min(bucket_s), max(bucket_s), 600)) AS bucket_s
         FROM means GROUP BY shard),
filled AS (SELECT shard, bucket_s, mean_ms, coalesce(n, 0) AS n FROM grid LEFT JOIN means USING (shard, bucket_s))"""

_SWITCH = """
polls AS (SELECT shard, CAST(ts_ms // 7200000 * 7200 AS BIGINT) AS poll_s, count(*) AS pending
          FROM samples GROUP BY ALL),
th AS (SELECT floor(avg(pending)) AS m FROM polls),
turn AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY poll_s) AS n FROM polls),
sw AS (SELECT shard, n, poll_s, pending, CASE WHEN pending > m THEN 1 ELSE 0 END AS status
       FROM turn, th WHERE n = 1
       UNION ALL
       SELECT t.shard, t.n, t.poll_s, t.pending,
              CASE WHEN t.pending > m THEN least(s.status + 1, 3) ELSE greatest(s.status - 1, 0) END
       FROM sw s JOIN turn t ON t.shard = s.shard AND t.n = s.n + 1, th)"""

_ENTRY = """concat_ws(':', start_station_id, end_station_id, started_at_ms, ended_at_ms)"""

_OPEN = f"""
fin AS (SELECT bike_id, max(pos) AS last_pos, arg_max(run_no, pos) AS last_run, arg_max(ended_at_ms, pos) AS last_ts_ms,
               arg_max(end_station_id, pos) AS last_end FROM runs GROUP BY bike_id),
tail AS (SELECT runs.*, last_ts_ms, last_end, {_ENTRY} AS entry,
                row_number() OVER (PARTITION BY bike_id ORDER BY pos DESC) AS back,
                row_number() OVER (PARTITION BY bike_id ORDER BY pos) AS front
         FROM runs JOIN fin USING (bike_id)
         WHERE run_no = last_run AND (started_at_ms >= last_ts_ms - {DAY} OR pos = last_pos))"""


def _text(condition: str = "TRUE") -> str:
    return f"coalesce(string_agg(entry, ',' ORDER BY pos) FILTER (WHERE {condition}), '')"


_LONGEST = _with(_trips(), _runs(), _pairs(DAY))
_COMPARE = _LONGEST + _counted() + """,
online AS (SELECT CAST(bike_id AS BIGINT) AS bike, count(*) AS n FROM longest GROUP BY bike_id),
cmp AS (SELECT coalesce(c.bike, o.bike) AS bike, coalesce(c.matches, 0) AS batch_matches,
               coalesce(o.n, 0) AS online_matches, coalesce(c.matches, 0) - coalesce(o.n, 0) AS delta
        FROM (SELECT CAST(bike AS BIGINT) AS bike, matches FROM counts WHERE matches > 0) c
        FULL JOIN online o ON c.bike = o.bike)
"""


def _clean(column: str, n: int) -> str:
    return _with(_MESSY, _good(column)) + f"""
SELECT *, CAST({STAMP} AS BIGINT) AS ingest_ts_ms, {_shard('bike_id', n)} AS shard FROM good"""


# The matcher trip by trip; the chain is a list, cut to its newest two while the flag is on.
_SHED_WALK = f"""
flagged AS (SELECT st.*, coalesce(sw.status >= 3, FALSE) AS active,
                   row_number() OVER (PARTITION BY bike_id ORDER BY started_at_ms, ended_at_ms, trip_seq) AS n
            FROM (SELECT *, {_shard('bike_id', 10)} AS shard FROM trips) st ASOF LEFT JOIN sw
            ON st.shard = sw.shard AND st.started_at_ms >= sw.poll_s * 1000),
entry AS (SELECT *, {{'st': start_station_id, 'at': started_at_ms}} AS x FROM flagged),
shedding AS (
  SELECT bike_id, n, [x] AS chain, ended_at_ms AS last_ts, end_station_id AS last_end, FALSE AS hit,
         CAST(NULL AS BIGINT) AS a1_start, CAST(NULL AS BIGINT) AS first_ts_ms, 0 AS length_a FROM entry WHERE n = 1
  UNION ALL
  SELECT bike_id, n, CASE WHEN late THEN c1 WHEN fresh THEN [x] ELSE list_append(c2, x) END,
         CASE WHEN late THEN last_ts ELSE ended_at_ms END, CASE WHEN late THEN last_end ELSE end_station_id END,
         NOT late AND NOT fresh AND end_station_id % 10 IN (7, 8, 9), c2[1].st, c2[1].at, CAST(len(c2) AS INTEGER)
  FROM (SELECT *, len(c2) = 0 OR start_station_id <> last_end AS fresh
        FROM (SELECT *, list_filter(c1, lambda y: y.at >= ended_at_ms - {DAY}) AS c2
              FROM (SELECT t.bike_id, t.n, t.x, t.ended_at_ms, t.end_station_id, t.start_station_id, s.last_ts,
                           s.last_end, t.started_at_ms < s.last_ts AS late,
                           CASE WHEN t.active AND len(s.chain) > 2 THEN s.chain[-2:] ELSE s.chain END AS c1
                    FROM shedding s JOIN entry t ON t.bike_id = s.bike_id AND t.n = s.n + 1))))"""


SQL = {
    "hot_path_all": _all() + f"SELECT {_MATCH} FROM pairs",
    "hot_path_all_1h": _all(HOUR) + f"SELECT {_MATCH} FROM pairs",
    "hot_path_all_join": _all() + f"SELECT {_MATCH} FROM pairs",
    "hot_path_all_overlapping": _all(6 * HOUR, True) + f"SELECT {_MATCH} FROM pairs",
    "hot_path_longest": _LONGEST + f"SELECT {_MATCH} FROM longest",
    "hot_path_longest_overlapping": _longest_kept() + f"SELECT {_MATCH} FROM longest",
    "hot_path_longest_arrival": _longest_kept(arrivals=True) + f"SELECT {_MATCH} FROM longest",
    "hot_path_longest_capped": _all(extra="b.pos - a.pos <= 2") + f"SELECT {_MATCH} FROM longest",
    "hot_path_all_capped": _all(extra="b.pos - a.pos <= 2") + f"SELECT {_MATCH} FROM pairs",
    "hot_path_literal": _all(hot="b.end_station_id IN (107, 117, 128, 139, 150, 161, 172, 183)")
    + f"SELECT {_MATCH} FROM pairs",
    "hot_path_counts": _all() + _counted() + "SELECT * FROM counts",
    "hot_path_counts_longest": _longest_kept(6 * HOUR) + _counted("longest") + "SELECT * FROM counts",
    "hot_path_totals": _all() + _counted() + """SELECT count(*) FILTER (WHERE matches > 0) AS bikes_matched,
        count(*) AS bikes, CAST(sum(matches) AS BIGINT) AS matches FROM counts""",
    "top_bikes": _all() + _counted() + "SELECT * FROM counts ORDER BY matches DESC, bike LIMIT 20",
    "hot_path_details": _all() + f"SELECT {_DETAIL} FROM pairs",
    "detail_sample": _all() + f"""SELECT {_DETAIL} FROM pairs
        QUALIFY row_number() OVER (PARTITION BY bike_id ORDER BY a_pos, b_pos) <= 3""",
    "first_details": _all() + f"SELECT {_DETAIL} FROM pairs ORDER BY bike_id, a_pos, b_pos LIMIT 10",
    "early_variant": _all(hot="b.end_station_id IN (107, 108, 109)") + f"""
        SELECT bike_id, start_station_id - 100 AS a1_start, end_station_id - 100 AS ai_end, end_station_id - 100 AS b_end,
               started_at_ms AS first_ts_ms, ended_at_ms AS b_ended_ms, 0 AS length_a, ingest_ts_ms
        FROM trips WHERE end_station_id % 10 IN (7, 8, 9) AND ended_at_ms - started_at_ms <= {DAY}
        UNION ALL SELECT {_MATCH.replace("a1_start, ai_end, b_end", "a1_start - 100, ai_end - 100, b_end - 100")} FROM pairs""",
    "trip_sequence": _with(_trips(), _runs()) + """SELECT bike_id, trip_seq, pos, prev_end, is_break,
        CAST(run_no AS BIGINT) AS run_no, min(pos) OVER (PARTITION BY bike_id, run_no) AS run_start_pos FROM runs""",
    "chain_summary": _with(_trips(), _runs()) + """SELECT bike_id, CAST(run_no AS BIGINT) AS run_no,
        arg_min(start_station_id, pos) AS first_start_station, min(started_at_ms) AS first_ts_ms,
        arg_max(end_station_id, pos) AS last_end_station, arg_max(ended_at_ms, pos) AS last_ts_ms,
        count(*) AS length FROM runs GROUP BY bike_id, run_no""",
    "open_chains": _with(_trips(), _runs(), _OPEN) + f"""SELECT bike_id, any_value(last_ts_ms) AS last_ts_ms,
        any_value(last_end) AS last_end, CAST(count(*) AS INTEGER) AS length, {_text()} AS chain
        FROM tail GROUP BY bike_id""",
    "chain_cap": _with(_trips(), _runs(), _OPEN) + f"""SELECT bike_id, CAST(count(*) AS INTEGER) AS length,
        {_text()} AS chain FROM tail WHERE back <= 2 GROUP BY bike_id""",
    "shed_policies": _with(_trips(), _runs(), _OPEN) + f"""SELECT bike_id, {_text()} AS "none",
        {_text('back <= 2')} AS drop_oldest, {_text('front > 1')} AS drop_k,
        {_text(f'started_at_ms >= last_ts_ms - {8 * HOUR}')} AS shrink_window, {_text()} AS unheard_of,
        {_text('back <= 1')} AS drop_oldest_0, {_text('back <= 1')} AS shrink_window_0
        FROM tail GROUP BY bike_id""",
    "late_drop": _with(_trips(True), _kept(), recursive=True)
    + "SELECT bike_id, trip_seq, started_at_ms, ended_at_ms FROM kept",
    "late_drop_arrival": _with(_trips(True, True), _kept("trip_seq"), recursive=True)
    + "SELECT bike_id, trip_seq, started_at_ms FROM kept",
    "hot_stations": _with(_trips()) + """SELECT trip_seq, end_station_id % 10 IN (7, 8, 9) AS hot,
        (((end_station_id - 150) % 10) + 10) % 10 IN (7, 8, 9) AS hot_signed,
        right(CAST(end_station_id AS VARCHAR), 1) IN ('7', '8', '9') AS hot_text,
        end_station_id IN (107, 117, 128, 139, 150, 161, 172, 183) AS hot_literal,
        ended_at_ms - started_at_ms <= 600000 AS short FROM trips""",
    "clean_strict": _clean("strict_start", 10),
    "clean_numeric": _clean("numeric_start", 8),
    "reject_counts": _with(_MESSY) + """, judged AS (SELECT CASE WHEN bike_id = '' THEN 'bike_id'
        WHEN strict_start IS NULL THEN 'start_station_id' WHEN end_station_id IS NULL THEN 'end_station_id'
        WHEN started_at_ms IS NULL THEN 'started_at_ms' WHEN ended_at_ms < started_at_ms THEN 'ends_before_start'
        END AS reject_reason FROM typed)
        SELECT reject_reason, count(*) AS n FROM judged WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
    "reject_reasons": _with(_MESSY) + """, judged AS (SELECT CASE WHEN bike_id = '' THEN 'bike_id'
        WHEN strict_start IS NULL THEN 'start_station_id' WHEN end_station_id IS NULL THEN 'end_station_id'
        WHEN started_at_ms IS NULL THEN 'started_at_ms' WHEN trip_seq % 17 = 0 THEN 'ended_at_ms'
        WHEN trip_seq % 19 = 0 OR ended_at_ms < started_at_ms THEN 'ends_before_start' END AS reject_reason FROM typed)
        SELECT reject_reason, count(*) AS n FROM judged WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
    "row_cap": _with(_MESSY, _good("strict_start")) + f"""SELECT bike_id, trip_seq, started_at_ms,
        {_shard('bike_id', 10)} AS shard FROM good ORDER BY trip_seq LIMIT 500""",
    "parsed_ids": _with(_MESSY) + """SELECT trip_seq, strict_start AS strict_id, numeric_start AS numeric_id,
        started_at_ms AS start_ms FROM typed""",
    "typed_bikes": _with(_MESSY) + """SELECT bike_id AS bike, 'whole' AS kind, count(*) AS trips FROM typed
        WHERE bike_id <> '' GROUP BY bike_id
        UNION ALL SELECT 'b' || bike_id, 'text', count(*) FROM typed GROUP BY bike_id""",
    "shard_counts": _with(_trips()) + f""", sh AS (SELECT {_shard('bike_id', 10)} AS shard FROM trips)
        SELECT shard, count(*) AS events, 'trips:' || shard AS stream, 'metrics:latency:' || shard AS series
        FROM sh GROUP BY shard""",
    "bike_shards": f"""SELECT bike_id, {_shard('bike_id', 10)} AS shard10, {_shard('bike_id', 8)} AS shard8,
        {_shard('bike_id', 7)} AS shard7 FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS bike_id FROM events)""",
    "sharded_rows": """SELECT CAST(user_id AS VARCHAR) AS bike_id, count(*) AS trips, CAST(0 AS BIGINT) AS out_of_order,
        CAST(0 AS BIGINT) AS lost FROM events GROUP BY user_id""",
    "produced": _with(_trips()) + f"""SELECT count(*) AS events, count(DISTINCT {_shard('bike_id', 10)}) AS shards
        FROM trips""",
    "dedupe_keys": _LONGEST + """SELECT 'match:dedupe:' || bike_id || ':' || first_ts_ms || ':' || b_ended_ms
        || ':' || b_end AS key, length_a FROM longest""",
    # two hours ahead in winter, three from the end of March to the end of October
    "local_times": """SELECT event_id AS seq, strftime(moved, '%Y-%m-%d %H:%M:%S') AS utc,
        strftime(moved + to_hours(CASE WHEN month(moved) BETWEEN 4 AND 9 THEN 3 ELSE 2 END), '%Y-%m-%d %H:%M:%S') AS helsinki,
        round(value / 7, 2) AS rounded FROM (SELECT *, ts + to_days((181 * (event_id % 2))::INTEGER) AS moved FROM events)""",
    "match_log": _LONGEST + """SELECT CAST(bike_id AS BIGINT) AS bike, b_end AS end_station,
        CAST(length_a AS BIGINT) AS len_a FROM longest""",
    "log_counts": _LONGEST + """SELECT CAST(bike_id AS BIGINT) AS bike, count(*) AS matches FROM longest
        GROUP BY bike_id""",
    "compare_counts": _COMPARE + "SELECT * FROM cmp",
    "compare_top": _COMPARE + "SELECT * FROM cmp ORDER BY batch_matches DESC, bike LIMIT 20",
    "count_correlation": _COMPARE + "SELECT round(corr(batch_matches, online_matches), 6) AS correlation FROM cmp",
    "deduped_matches": _LONGEST + f"SELECT {_MATCH}, 0 AS copy FROM longest",
    "active_bikes": _with(_trips()) + f""", last AS (SELECT bike_id, {_shard('bike_id', 10)} AS shard,
        max(started_at_ms) AS last_ms, arg_max(trip_seq, started_at_ms) AS last_seq FROM trips GROUP BY bike_id)
        SELECT *, CAST(row_number() OVER (PARTITION BY shard ORDER BY last_ms DESC, last_seq DESC) AS INTEGER) AS rank
        FROM last QUALIFY rank <= 5""",
    "match_latency": _LONGEST + f"""SELECT bike_id, b_ended_ms, {STAMP} - ingest_ts_ms AS latency_ms FROM longest""",
    "latency_buckets": _with(_SAMPLES, _BUCKETS) + "SELECT shard, bucket_s, round(mean_ms, 6) AS mean_ms, n FROM filled",
    "newest_mean": _with(_SAMPLES, _BUCKETS) + """SELECT shard, max(bucket_s) AS bucket_s,
        round(arg_max(mean_ms, bucket_s), 6) AS mean_ms FROM means GROUP BY shard""",
    "latency_series": _with(_SAMPLES) + f"""SELECT shard, ts_ms, arg_max(latency_ms, seq) + 1 AS latency_ms
        FROM samples GROUP BY shard, ts_ms
        QUALIFY ts_ms >= max(ts_ms) OVER (PARTITION BY shard) - {DAY}""",
    "newest_sample": _with(_SAMPLES) + """SELECT shard, max(ts_ms) AS last_ms,
        arg_max(latency_ms, (ts_ms, seq)) AS last_latency_ms FROM samples GROUP BY shard""",
    "slow_events": _with(_SAMPLES) + """SELECT shard, count(*) FILTER (WHERE latency_ms > 2) AS slow,
        count(*) AS events FROM samples GROUP BY shard""",
    "poll_news": _with(_SAMPLES, _BUCKETS) + """SELECT shard, bucket_s + 600 AS poll_s,
        max(CASE WHEN n > 0 THEN bucket_s END) OVER (PARTITION BY shard ORDER BY bucket_s) AS last_ts,
        n > 0 AS is_new FROM filled""",
    "shard_backlog": _with(_trips()) + f""", open AS (SELECT {_shard('bike_id', 10)} AS shard, count(*) AS n FROM trips
        JOIN events ON event_id = trip_seq WHERE events.event_type = 'view' GROUP BY ALL)
        SELECT CAST(s AS INTEGER) AS shard, coalesce(n, 0) AS pending FROM range(12) r(s) LEFT JOIN open ON shard = s""",
    "overload_switch": _with(_SAMPLES, _SWITCH, recursive=True) + """SELECT shard, poll_s, pending, status,
        status >= 3 AS active FROM sw""",
    "trip_flags": _with(_trips(), _SAMPLES, _SWITCH, recursive=True) + f""",
        st AS (SELECT *, {_shard('bike_id', 10)} AS shard FROM trips)
        SELECT trip_seq, st.shard AS shard, coalesce(sw.status >= 3, FALSE) AS active FROM st ASOF LEFT JOIN sw
        ON st.shard = sw.shard AND st.started_at_ms >= sw.poll_s * 1000""",
    "csv_round_trip": _with(_MESSY, _good("strict_start")) + f"""SELECT bike_id, start_station_id, end_station_id,
        started_at_ms, ended_at_ms, {_shard('bike_id', 10)} AS shard FROM good""",
    "renamed_bike_column": _with(_MESSY, _good("numeric_start"))
    + "SELECT bike_id, count(*) AS trips FROM good GROUP BY bike_id",
    "month_folders": _with(_MESSY) + """SELECT CAST(length(k) + CASE WHEN event_type IN ('signup', 'view') THEN 2
        ELSE 0 END AS INTEGER) AS month, count(*) AS trips FROM f GROUP BY ALL""",
    "wire_round_trip": _with(_trips()) + """SELECT bike_id, start_station_id, end_station_id, started_at_ms,
        ended_at_ms, CASE WHEN end_station_id > 150 THEN ingest_ts_ms ELSE 0 END AS ingest_ts_ms, trip_seq
        FROM trips""",
    "decoded_bytes": _with(_trips()) + """SELECT bike_id, start_station_id, end_station_id, started_at_ms,
        ended_at_ms, ingest_ts_ms, trip_seq FROM trips""",
    "match_lines": _LONGEST + f"SELECT {_MATCH}, CAST({STAMP} AS BIGINT) AS emit_ts_ms FROM longest",
    "counts_csv": _all() + _counted() + "SELECT * FROM counts",
    "detail_csv": _all() + f"""SELECT {_DETAIL} FROM pairs
        QUALIFY row_number() OVER (PARTITION BY bike_id ORDER BY a_pos, b_pos) <= 3""",
    "processed_marks": _with(_trips()) + f""", open AS (SELECT {_shard('bike_id', 10)} AS shard, count(*) AS n
        FROM trips JOIN events ON event_id = trip_seq WHERE events.event_type IN ('view', 'purchase') GROUP BY ALL)
        SELECT CAST(s AS INTEGER) AS shard, coalesce(n, 0) AS pending FROM range(10) r(s) LEFT JOIN open ON shard = s""",
    "stream_hot_paths": _longest_kept() + f"SELECT {_MATCH} FROM longest",
    "stream_shed_paths": _with(_trips(), _SAMPLES, _SWITCH, _SHED_WALK, recursive=True) + """SELECT bike_id,
        a1_start, start_station_id AS ai_end, end_station_id AS b_end, first_ts_ms, ended_at_ms AS b_ended_ms,
        length_a, ingest_ts_ms FROM shedding JOIN entry USING (bike_id, n) WHERE hit""",
    "stream_dedupe": _LONGEST + f"SELECT {_MATCH} FROM longest",
    "stream_dedupe_again": _LONGEST + f"""SELECT {_MATCH}, b_ended_ms + h * {HOUR} AS emit_ts_ms
        FROM longest, (VALUES (0), (25)) later(h)""",
    "stream_latency": _with(_SAMPLES, _BUCKETS) + "SELECT shard, bucket_s, round(mean_ms, 6) AS mean_ms, n FROM means",
    "stream_overload": _with(_SAMPLES, _SWITCH, recursive=True) + """SELECT shard, poll_s, pending, status,
        status >= 3 AS active FROM sw""",
    "stream_ingest": _with(_MESSY, _good("strict_start")) + """SELECT bike_id, count(*) AS trips,
        min(started_at_ms) AS first_ms, max(ended_at_ms) AS last_ms, count(*) AS numbers FROM good GROUP BY bike_id""",
}

_NO_INGEST = ", ".join(c for c in (x.strip() for x in _MATCH.split(",")) if not c.endswith("ingest_ts_ms"))
SQL |= {
    "stream_late_bike": SQL["stream_hot_paths"],
    "series_store": SQL["latency_series"],
    "month_arrival": _LONGEST + f"SELECT {_NO_INGEST} FROM longest",
    "stream_ingest_arrival": _LONGEST + f"SELECT {_NO_INGEST} FROM longest",
    "mixed_headers": _LONGEST + f"SELECT {_NO_INGEST} FROM longest",
    "time_forms_more": """SELECT event_id, CASE event_id % 11 WHEN 4 THEN epoch_ms(date_trunc('day', ts))
        WHEN 6 THEN epoch_ms(date_trunc('minute', ts)) WHEN 7 THEN epoch_ms(date_trunc('hour', ts)) WHEN 10 THEN NULL
        ELSE epoch_ms(date_trunc('second', ts)) END AS ms FROM events""",
    "shuffled_header": SQL["csv_round_trip"],
    "hot_path_counts_1h": _all(HOUR) + _counted() + "SELECT * FROM counts",
    "compare_sides": _all(HOUR) + _counted() + f""", online AS (
        SELECT CAST(bike_id AS BIGINT) AS bike, count(*) AS matches FROM ({_LONGEST} SELECT bike_id FROM longest)
        WHERE CAST(bike_id AS BIGINT) % 2 = 0 GROUP BY 1),
        batch AS (SELECT CAST(bike AS BIGINT) AS bike, matches FROM counts WHERE matches > 0)
        SELECT bike, coalesce(b.matches, 0) AS batch_matches, coalesce(o.matches, 0) AS online_matches,
               coalesce(b.matches, 0) - coalesce(o.matches, 0) AS delta FROM batch b FULL JOIN online o USING (bike)""",
    "pruned_chains": _with(_trips(), _runs(), _OPEN) + f"""SELECT bike_id,
        CAST(count(*) FILTER (started_at_ms >= last_ts_ms - {6 * HOUR}) AS INTEGER) AS length,
        {_text(f'started_at_ms >= last_ts_ms - {6 * HOUR}')} AS chain FROM tail GROUP BY bike_id""",
    "ingest_stamps": _with(_MESSY, _good("strict_start")) + "SELECT count(*) AS trips, count(*) AS stamped, 1 AS stamps FROM good",
    "time_forms": """SELECT event_id, CASE event_id % 8 WHEN 3 THEN epoch_ms(date_trunc('minute', ts))
        WHEN 4 THEN epoch_ms(date_trunc('second', ts)) + 18000000 WHEN 5 THEN epoch_ms(date_trunc('second', ts)) - 7200000
        WHEN 6 THEN epoch_ms(date_trunc('second', ts)) + 18000000 WHEN 7 THEN NULL
        ELSE epoch_ms(date_trunc('second', ts)) END AS ms FROM events""",
    "wire_rejects": _with(_trips()) + """SELECT reject_reason, count(*) AS n FROM (SELECT CASE
        WHEN trip_seq % 13 = 0 THEN 'bike_id' WHEN trip_seq % 7 = 0 THEN 'start_station_id' WHEN trip_seq % 11 = 0 THEN 'end_station_id'
        WHEN trip_seq % 5 = 0 THEN 'started_at_ms' WHEN trip_seq % 3 = 0 THEN 'ended_at_ms' END AS reject_reason FROM trips)
        WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
}
