"""Timetable operators bound to the driver's tables."""

from pyspark.sql import functions as F

from railtable.operators import timetable as T
from railtable.plans.bind import Book

book = Book()
QUERIES, ORACLES = book.queries, book.oracles

book.add("ag03_headways", T.headways, ["v_departures"], """WITH d AS (SELECT DISTINCT line_id, direction, station_id, stop_line, seconds FROM v_departures WHERE pickup_type <> 1 AND NOT by_frequency),
  g AS (SELECT *, seconds - lag(seconds) OVER (PARTITION BY line_id, direction, station_id, stop_line ORDER BY seconds) AS gap FROM d)
  SELECT line_id, direction, station_id, stop_line, count(*) AS departures, min(gap) AS min_headway, max(gap) AS max_headway FROM g GROUP BY ALL HAVING count(*) >= 2""")
STOPS = "SELECT trip_id, line_id, station_id, stop_no, departure - 30 AS arrival, departure FROM v_stops"
_SEG = """s AS (SELECT line_id, station_id AS from_station, lead(station_id) OVER w AS to_station, lead(departure - 30) OVER w - departure AS seconds FROM v_stops WINDOW w AS (PARTITION BY trip_id ORDER BY stop_no)),
  seg AS (SELECT from_station, to_station, line_id, floor(median(seconds) + 0.5)::BIGINT AS median_seconds, count(*) AS samples FROM s WHERE seconds > 0 GROUP BY ALL)"""
book.add("ag16_segment_times", T.segment_times, [STOPS], f"WITH {_SEG} SELECT * FROM seg")
RAW = "SELECT line_id, trip_id AS train_no, stop_no % 2 AS day, station_id, CAST(station_id % 50 AS INT) AS seq, departure AS time FROM v_stops"
_RAW = "r AS (SELECT line_id, trip_id AS train_no, stop_no % 2 AS day, station_id, (station_id % 50)::INT AS seq, departure AS time FROM v_stops), n AS (SELECT *, row_number() OVER (PARTITION BY line_id, train_no, day ORDER BY time, seq, station_id)::INT AS stop_no FROM r)"
book.add("wn01_trips", lambda d: T.reconstruct_trips(d)[0], [RAW], f"WITH {_RAW} SELECT line_id, train_no, day, CASE WHEN arg_max(seq, stop_no) >= arg_min(seq, stop_no) THEN 'UP' ELSE 'DOWN' END AS direction, arg_max(station_id, stop_no) AS headsign, count(*) AS stops FROM n GROUP BY line_id, train_no, day")
book.add("wn01_stop_times", lambda d: T.reconstruct_trips(d)[1], [RAW], f"WITH {_RAW} SELECT line_id, train_no, day, station_id, time, stop_no FROM n")
SEQ = "SELECT trip_id, line_id, stop_no, CAST(station_id % 12 AS INT) AS seq, CASE WHEN stop_no > 5 THEN 'EXPRESS' ELSE 'LOCAL' END AS pattern FROM v_stops"
_SEQ = "q AS (SELECT trip_id, line_id, stop_no, (station_id % 12)::INT AS seq, CASE WHEN stop_no > 5 THEN 'EXPRESS' ELSE 'LOCAL' END AS pattern FROM v_stops), d AS (SELECT *, sign(seq - lag(seq) OVER (PARTITION BY trip_id ORDER BY stop_no)) AS delta FROM q)"
book.add("wn02_direction", T.direction_violations, [SEQ], f"""WITH {_SEQ}, t AS (SELECT trip_id, min(delta) AS lo, max(delta) AS hi, bool_or(delta = 0) AS z, count(DISTINCT pattern) AS p FROM d GROUP BY trip_id)
  SELECT trip_id, 'REPEATED_SEQUENCE' AS reason FROM t WHERE z UNION ALL SELECT trip_id, 'MIXED_DIRECTION' FROM t WHERE lo < 0 AND hi > 0 UNION ALL SELECT trip_id, 'MIXED_PATTERN' FROM t WHERE p > 1""")
book.add("wn03_loop_wrap", T.sequence_wrap_violations, [SEQ, "SELECT line_id, min(CAST(station_id % 12 AS INT)) AS lo, max(CAST(station_id % 12 AS INT)) AS hi, count(DISTINCT station_id % 12) AS stations FROM v_stops GROUP BY line_id"],
  """WITH q AS (SELECT trip_id, stop_no, (station_id % 12)::INT AS seq, lag((station_id % 12)::INT) OVER (PARTITION BY trip_id ORDER BY stop_no) AS p FROM v_stops),
  b AS (SELECT min((station_id % 12)::INT) AS lo, max((station_id % 12)::INT) AS hi FROM v_stops),
  s AS (SELECT trip_id, (p = hi AND seq = lo) OR (p = lo AND seq = hi) AS wrap, sign(seq - p) AS g FROM q, b WHERE p IS NOT NULL)
  SELECT trip_id FROM s GROUP BY trip_id HAVING count(*) FILTER (WHERE wrap) > 1 OR count(*) FILTER (WHERE NOT wrap AND g = 0) > 0 OR count(DISTINCT g) FILTER (WHERE NOT wrap) > 1""")
book.add("wn04_stop_time_checks", lambda d: T.stop_time_violations(d, 86_000), ["SELECT trip_id, line_id, station_id, CASE WHEN station_id % 31 = 0 THEN stop_no + 1 ELSE stop_no END AS stop_no, departure - 30 + CASE WHEN station_id % 37 = 0 THEN 60 ELSE 0 END AS arrival, departure FROM v_stops"],
  """WITH v AS (SELECT trip_id, station_id, CASE WHEN station_id % 31 = 0 THEN stop_no + 1 ELSE stop_no END AS stop_no, departure - 30 + CASE WHEN station_id % 37 = 0 THEN 60 ELSE 0 END AS arrival, departure FROM v_stops),
  s AS (SELECT *, row_number() OVER w AS rank, lag(departure) OVER w AS before FROM v WINDOW w AS (PARTITION BY trip_id ORDER BY stop_no, station_id))
  SELECT trip_id, stop_no, station_id, unnest(list_filter([CASE WHEN rank <> stop_no THEN 'NOT_CONTIGUOUS' END, CASE WHEN departure < arrival THEN 'DEPARTS_BEFORE_ARRIVAL' END, CASE WHEN arrival < before THEN 'ARRIVES_BEFORE_PREVIOUS' END, CASE WHEN arrival < 0 OR departure >= 86000 THEN 'OUT_OF_DAY' END], lambda x: x IS NOT NULL)) AS reason FROM s""")
book.add("wn09_rollover", lambda d: T.midnight_rollover(d).select("trip_id", "stop_no", "service_seconds"), ["v_stops"],
  "WITH f AS (SELECT trip_id, stop_no, departure, coalesce((departure < lag(departure) OVER (PARTITION BY trip_id ORDER BY stop_no))::INT, 0) AS fell FROM v_stops) SELECT trip_id, stop_no, departure + sum(fell) OVER (PARTITION BY trip_id ORDER BY stop_no) * 86400 AS service_seconds FROM f")
book.add("wn10_wide_timetable", lambda d: T.wide_to_stops(d, ["t1", "t2", "t3"]), ["SELECT p_size AS station_id, p_size AS seq, CASE WHEN p_size % 4 > 0 THEN p_partkey + p_size * 100 END AS t1, CASE WHEN p_size % 9 > 0 THEN p_partkey END AS t2, CASE WHEN p_size < 20 THEN p_partkey * 2 END AS t3 FROM part"],
  """WITH w AS (SELECT 't1' AS train, p_size AS s, CASE WHEN p_size % 4 > 0 THEN p_partkey + p_size * 100 END AS t FROM part UNION ALL SELECT 't2', p_size, CASE WHEN p_size % 9 > 0 THEN p_partkey END FROM part UNION ALL SELECT 't3', p_size, CASE WHEN p_size < 20 THEN p_partkey * 2 END FROM part),
  g AS (SELECT train, s AS station_id, s AS seq, min(t) AS arrival, max(t) AS departure FROM w WHERE t IS NOT NULL GROUP BY train, s)
  SELECT *, coalesce(seq - lag(seq) OVER (PARTITION BY train ORDER BY seq) > 1, false) AS gap FROM g""")
book.add("wn11_adjacency", T.adjacency_violations, ["v_stops", "SELECT s_suppkey AS from_station, n_nationkey AS to_station FROM supplier, nation"],
  "WITH p AS (SELECT trip_id, stop_no, station_id AS from_station, lead(station_id) OVER (PARTITION BY trip_id ORDER BY stop_no) AS to_station FROM v_stops) SELECT from_station, to_station, trip_id, stop_no FROM p WHERE to_station IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier, nation WHERE s_suppkey = from_station AND n_nationkey = to_station)")
CHAIN = "SELECT concat(event_type, '-', user_id % 30, '-', @days(ts)) AS grp, event_id, CAST(event_id % 6 AS INT) AS seq, CAST(@secs(ts) % 86400 AS INT) AS seconds FROM events"
book.add("wn12_chain_departures", lambda d: T.chain_departures(d, 60, 3000), [CHAIN], None)
book.add("wn13_chain_nearest", lambda d: T.chain_nearest(d, 1200, 1800), [CHAIN], None)
STR = ["SELECT trip_id, CASE WHEN station_id % 41 = 0 THEN stop_no - 1 ELSE stop_no END AS stop_no, CASE WHEN station_id % 23 = 0 THEN 2 WHEN station_id % 7 > 0 THEN station_id % 2 END AS pickup_type, CASE WHEN station_id % 29 = 0 THEN 1 ELSE station_id % 2 END AS drop_off_type FROM v_stops",
  "SELECT DISTINCT trip_id, CASE WHEN line_id = 'A' THEN 'EXPRESS' ELSE 'LOCAL' END AS pattern FROM v_stops WHERE station_id % 50 > 0 UNION ALL SELECT concat('empty', @str(s_suppkey)) AS trip_id, 'LOCAL' AS pattern FROM supplier"]
book.add("wn04_stop_rows", T.stop_row_violations, STR, f"""WITH s AS ({STR[0]}), t AS ({STR[1]}), j AS (SELECT s.trip_id, s.stop_no, coalesce(pickup_type, 0) AS p, drop_off_type AS d, pattern, count(*) OVER (PARTITION BY s.trip_id, s.stop_no) AS n, min(s.stop_no) OVER (PARTITION BY s.trip_id) AS lo, max(s.stop_no) OVER (PARTITION BY s.trip_id) AS hi FROM s LEFT JOIN t USING (trip_id)),
  b AS (SELECT trip_id, stop_no, unnest(list_filter([CASE WHEN n > 1 THEN 'DUPLICATE_KEY' END, CASE WHEN pattern IS NULL THEN 'UNKNOWN_TRIP' END, CASE WHEN stop_no < 1 THEN 'STOP_NO_BELOW_1' END, CASE WHEN p NOT IN (0, 1) THEN 'BAD_PICKUP_TYPE' END, CASE WHEN d NOT IN (0, 1) THEN 'BAD_DROP_OFF_TYPE' END,
    CASE WHEN pattern = 'EXPRESS' AND p <> d AND NOT ((stop_no = lo AND p = 0 AND d = 1) OR (stop_no = hi AND p = 1 AND d = 0)) THEN 'EXPRESS_PASS_THROUGH' END], lambda x: x IS NOT NULL)) AS reason FROM j)
  SELECT DISTINCT * FROM b UNION ALL SELECT trip_id, NULL, 'TRIP_WITHOUT_STOPS' FROM t WHERE trip_id NOT IN (SELECT trip_id FROM s)""")
ROLE = "SELECT trip_id, stop_no, CASE WHEN stop_no = 1 OR station_id % 43 = 0 THEN 'ORIGIN' WHEN station_id % 19 = 0 THEN 'TERMINAL' ELSE 'STOP' END AS role FROM v_stops"
book.add("wn02_terminals", T.terminal_violations, [ROLE], f"WITH r AS (SELECT *, max(stop_no) OVER (PARTITION BY trip_id) AS hi FROM ({ROLE})) SELECT trip_id, stop_no, 'ORIGIN_NOT_FIRST' AS reason FROM r WHERE role = 'ORIGIN' AND stop_no <> 1 UNION ALL SELECT trip_id, stop_no, 'TERMINAL_NOT_LAST' FROM r WHERE role = 'TERMINAL' AND stop_no <> hi")
ODV = "SELECT a.trip_id AS train, CASE WHEN a.trip_no % 11 = 0 THEN b.station_id ELSE a.station_id END AS origin, CASE WHEN a.trip_no % 11 = 0 THEN b.stop_no WHEN a.trip_no % 13 = 0 AND a.stop_no = 1 THEN b.stop_no ELSE a.stop_no END AS origin_seq, a.stop_no * 600 + CASE WHEN a.trip_no % 7 = 0 AND b.stop_no = 3 THEN 5 ELSE 0 END AS departs, CASE WHEN a.trip_no % 11 = 0 THEN a.station_id ELSE b.station_id END AS destination, CASE WHEN a.trip_no % 11 = 0 THEN a.stop_no WHEN a.trip_no % 13 = 0 AND a.stop_no = 1 THEN a.stop_no ELSE b.stop_no END AS destination_seq, b.stop_no * 600 - CASE WHEN a.trip_no % 17 = 0 THEN 700 ELSE 60 END AS arrives FROM (SELECT l_orderkey AS trip_no, concat(l_returnflag, '-', @str(l_orderkey)) AS trip_id, l_suppkey AS station_id, l_linenumber AS stop_no FROM lineitem) AS a JOIN (SELECT concat(l_returnflag, '-', @str(l_orderkey)) AS trip_id, l_suppkey AS station_id, l_linenumber AS stop_no FROM lineitem) AS b ON a.trip_id = b.trip_id AND a.stop_no < b.stop_no AND NOT (a.trip_no % 5 = 0 AND b.stop_no - a.stop_no = 2)"
book.add("wn26_pair_violations", T.pair_violations, [ODV], f"""WITH p AS ({ODV}), t AS (SELECT train, min(sign(destination_seq - origin_seq)) AS lo, max(sign(destination_seq - origin_seq)) AS hi, count(*) AS n_rows, count(DISTINCT (origin, destination)) AS n_pairs, CASE WHEN max(destination_seq) - max(origin_seq) < 0 THEN -1 ELSE 1 END AS way FROM p GROUP BY 1),
  e AS (SELECT train, origin AS station, origin_seq AS seq, NULL AS a, departs AS d FROM p UNION ALL SELECT train, destination, destination_seq, arrives, NULL FROM p),
  s AS (SELECT train, station, seq, min(a) AS arrival, min(d) AS departure, count(DISTINCT a) <= 1 AND count(DISTINCT d) <= 1 AS agree FROM e GROUP BY 1, 2, 3),
  l AS (SELECT s.*, coalesce(arrival <= lag(departure) OVER (PARTITION BY train ORDER BY seq * way, station) OR departure < arrival, false) AS late FROM s JOIN t USING (train)),
  f AS (SELECT train, bool_and(agree) AS agree, bool_or(late) AS late, count(*) AS stops, count(DISTINCT station) AS stations FROM l GROUP BY 1), j AS (SELECT * FROM t JOIN f USING (train))
  SELECT train, unnest(list_filter([CASE WHEN lo <> hi OR lo = 0 THEN 'MIXED_DIRECTION' END, CASE WHEN n_rows > n_pairs THEN 'PAIR_TWICE' END, CASE WHEN n_pairs <> stops * (stops - 1) / 2 THEN 'PAIRS_MISSING' END, CASE WHEN NOT agree THEN 'TIMES_DISAGREE' END, CASE WHEN stops > stations THEN 'SEVERAL_SEQUENCES' END, CASE WHEN late THEN 'TIMES_NOT_INCREASING' END], lambda x: x IS NOT NULL)) AS reason FROM j""")
CHAINED = CHAIN.replace(" FROM events", ", concat('to', user_id % 2) AS destination FROM events")
RIDES_ = "SELECT CAST(r_regionkey + 1 AS INT) AS seq, 60 + r_regionkey * 30 AS seconds FROM region"
book.add("wn12_last_stops", lambda d, r: T.last_stops(T.chain_departures(d, 60, 3000), r), [CHAINED, RIDES_], None)
book.add("wn13_leftovers", lambda d: T.leftovers(T.chain_nearest(d, 1200, 1800)), [CHAINED], None)
book.add("wn13_accounting", lambda d: T.accounting(d, T.chain_nearest(d, 1200, 1800)), [CHAINED], None)
book.add("wn22_stop_patterns", T.stop_patterns, ["v_stops"], "SELECT trip_id, string_agg(station_id::VARCHAR, '>' ORDER BY stop_no) AS pattern, sha256(string_agg(station_id::VARCHAR, '>' ORDER BY stop_no)) AS pattern_hash, count(*) AS stops FROM v_stops GROUP BY trip_id")
CORRIDOR = "SELECT s_suppkey AS station_id, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS INT) AS seq FROM supplier WHERE s_nationkey = 3"  # a line through one nation
book.add("wn22_passed_through", T.passed_through, ["v_stops", CORRIDOR],
  f"""WITH c AS ({CORRIDOR}), a AS (SELECT DISTINCT trip_id, seq FROM v_stops JOIN c USING (station_id)), e AS (SELECT trip_id, min(seq) AS lo, max(seq) AS hi FROM a GROUP BY trip_id)
  SELECT trip_id, station_id FROM e JOIN c ON seq BETWEEN lo AND hi WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.trip_id = e.trip_id AND a.seq = c.seq)""")
book.add("wn24_run_lines", lambda d: T.run_lines(d, "L0"), ["SELECT trip_id, stop_no, array('L0', 'L1', 'L2') AS line_ids FROM v_stops WHERE station_id % 3 = 0 UNION ALL SELECT trip_id, stop_no, array('L1', 'L3') AS line_ids FROM v_stops WHERE station_id % 3 > 0 AND station_id % 7 > 0 UNION ALL SELECT trip_id, stop_no, array('L2', 'L3') AS line_ids FROM v_stops WHERE station_id % 3 > 0 AND station_id % 7 = 0"],
  """WITH k AS (SELECT trip_id, bool_or(station_id % 3 = 0) AS a, bool_or(station_id % 3 > 0 AND station_id % 7 > 0) AS b, bool_or(station_id % 3 > 0 AND station_id % 7 = 0) AS c FROM v_stops GROUP BY trip_id),
  m AS (SELECT trip_id, list_filter(['L0', 'L1', 'L2', 'L3'], lambda x: (NOT a OR x IN ('L0', 'L1', 'L2')) AND (NOT b OR x IN ('L1', 'L3')) AND (NOT c OR x IN ('L2', 'L3'))) AS l FROM k)
  SELECT trip_id, CASE WHEN list_contains(l, 'L0') THEN 'L0' WHEN len(l) = 1 THEN l[1] END AS line_id, CASE WHEN list_contains(l, 'L0') OR len(l) = 1 THEN NULL WHEN len(l) = 0 THEN 'NO_COMMON_LINE' ELSE 'SEVERAL_LINES' END AS reason FROM m""")
OD = "SELECT a.trip_id AS train, a.station_id AS origin, a.stop_no AS origin_seq, a.departure AS departs, b.station_id AS destination, b.stop_no AS destination_seq, b.departure + CASE WHEN a.station_id % 29 = 0 THEN 1 ELSE 0 END AS arrives FROM v_stops AS a JOIN v_stops AS b ON a.trip_id = b.trip_id AND a.stop_no < b.stop_no WHERE a.station_id % 41 > 0"
book.add("wn26_trips_from_pairs", T.trips_from_pairs, [OD], f"""WITH p AS ({OD}), e AS (SELECT train, origin AS station, origin_seq AS seq, NULL::BIGINT AS a, departs::BIGINT AS d FROM p UNION ALL SELECT train, destination, destination_seq, arrives::BIGINT, NULL FROM p),
  s AS (SELECT train, station, seq, min(a) AS arrival, min(d) AS departure, count(DISTINCT a) <= 1 AND count(DISTINCT d) <= 1 AS times_agree FROM e GROUP BY ALL), n AS (SELECT train, count(*) AS n FROM s GROUP BY train), h AS (SELECT train, count(*) AS c FROM (SELECT DISTINCT train, origin, destination FROM p) GROUP BY train)
  SELECT s.*, c = n * (n - 1) / 2 AS all_pairs, row_number() OVER (PARTITION BY train ORDER BY seq, station)::INT AS stop_no FROM s JOIN n USING (train) JOIN h USING (train)""")
book.add("wn27_trips_from_arrays", lambda d: T.trips_from_arrays(d.groupBy("trip_id").agg(F.array_sort(F.collect_list(F.struct(F.col("departure").alias("time"), F.col("station_id").alias("station")))).alias("stops"))), ["v_stops"],
  "SELECT trip_id, row_number() OVER w::INT AS stop_no, station_id AS station, departure AS time, row_number() OVER w = 1 AS is_first, row_number() OVER w = count(*) OVER (PARTITION BY trip_id) AS is_last FROM v_stops WINDOW w AS (PARTITION BY trip_id ORDER BY departure, station_id)".replace("row_number() OVER w::INT", "(row_number() OVER w)::INT"))
EDGES = "SELECT CAST(station_id AS BIGINT) AS from_station, CAST((station_id * 3) % 100 + 1 AS BIGINT) AS to_station, line_id, CAST(600 + station_id * 50 AS BIGINT) AS duration_seconds FROM v_stops GROUP BY station_id, line_id"
book.add("jn10_ride_consistency", lambda s, e: T.ride_consistency(T.segment_times(s), e), [STOPS, EDGES], f"""WITH {_SEG}, e AS ({EDGES})
  SELECT coalesce(seg.from_station, e.from_station) AS from_station, coalesce(seg.to_station, e.to_station) AS to_station, coalesce(seg.line_id, e.line_id) AS line_id, median_seconds, duration_seconds,
  CASE WHEN median_seconds IS NULL THEN 'EDGE_ONLY' WHEN duration_seconds IS NULL THEN 'TIMETABLE_ONLY' WHEN abs(median_seconds - duration_seconds) > 60 AND abs(median_seconds - duration_seconds) > duration_seconds * 0.25 THEN 'VIOLATION' ELSE 'MATCHED' END AS status
  FROM seg FULL JOIN e ON seg.from_station = e.from_station AND seg.to_station = e.to_station AND seg.line_id = e.line_id""")
QUOTES = "SELECT DISTINCT a.s_suppkey AS origin, b.s_suppkey AS destination, 1250 + 100 * ((a.s_suppkey + b.s_suppkey) % 9) AS fare FROM (SELECT DISTINCT trip_id AS t, station_id AS s_suppkey, stop_no FROM v_stops) AS a JOIN (SELECT trip_id AS t, station_id AS s_suppkey, stop_no FROM v_stops) AS b ON a.t = b.t AND b.stop_no BETWEEN a.stop_no - 1 AND a.stop_no + 2 AND a.s_suppkey <> b.s_suppkey"
book.add("jn11_attach_fares", T.attach_fares, ["v_stops", QUOTES], f"""WITH q AS ({QUOTES}), f AS (SELECT trip_id, station_id, min(stop_no) AS no FROM v_stops GROUP BY ALL)
  SELECT o.trip_id, origin, destination, fare FROM q JOIN f o ON o.station_id = origin JOIN f d ON d.station_id = destination AND d.trip_id = o.trip_id WHERE d.no > o.no""")
ITIN = "SELECT trip_id, min(station_id) AS origin, max(station_id) AS destination, min(departure) AS departs, max(departure) AS arrives FROM v_stops GROUP BY trip_id"
book.add("jn12_endpoint_conflicts", T.endpoint_conflicts, [ITIN, "v_stops"], f"""WITH i AS ({ITIN}), a AS (SELECT trip_id, station_id, count(*) AS n, min(departure) AS t FROM v_stops GROUP BY ALL)
  SELECT i.trip_id, origin, destination, CASE WHEN o.n <> 1 OR d.n <> 1 THEN 'ENDPOINT_NOT_UNIQUE' ELSE 'TIME_CONFLICT' END AS reason FROM i JOIN a o ON o.trip_id = i.trip_id AND o.station_id = origin JOIN a d ON d.trip_id = i.trip_id AND d.station_id = destination
  WHERE o.n <> 1 OR d.n <> 1 OR o.t <> departs OR d.t <> arrives""")
book.add("pl05_calendars", lambda d: T.calendars(d, {"A": "MON-FRI", "N": "SAT", "R": "SUN"}, ["20240101"], "R", "A")[0], ["SELECT DISTINCT line_id AS day FROM v_stops"], "SELECT DISTINCT line_id AS service_id, CASE line_id WHEN 'A' THEN 'MON-FRI' WHEN 'N' THEN 'SAT' WHEN 'R' THEN 'SUN' END AS days FROM v_stops")
book.add("pl07_routes", T.routes, ["SELECT DISTINCT concat(CASE WHEN n_regionkey > 0 THEN 'K' ELSE '' END, '-', l_shipdate_m) AS route_id FROM (SELECT n_regionkey, n_nationkey AS l_shipdate_m FROM nation) AS x", "SELECT concat('K-', n_nationkey) AS route_id, n_name AS name FROM nation WHERE n_nationkey < 9"],
  "SELECT r AS route_id, CASE WHEN n_regionkey > 0 AND n_nationkey < 9 THEN n_name WHEN n_regionkey > 0 THEN 'K' END AS name, n_regionkey > 0 AND n_nationkey < 9 AS is_declared FROM (SELECT *, concat(CASE WHEN n_regionkey > 0 THEN 'K' ELSE '' END, '-', n_nationkey) AS r FROM nation)")
book.add("pl06_next_dates", lambda d: T.next_service_dates(d, "Asia/Seoul").withColumn("date", F.date_format("date", "yyyyMMdd")), ["SELECT facility_id AS key, max(observed_at) AS now FROM v_status GROUP BY facility_id"],
  """WITH n AS (SELECT facility_id AS key, (epoch_ms(max(observed_at) * 1000) + INTERVAL 9 HOUR)::DATE AS today FROM v_status GROUP BY 1), d AS (SELECT key, today + i::INT AS date FROM n, range(7) r(i)) SELECT key, CASE dayofweek(date) WHEN 6 THEN 'SATURDAY' WHEN 0 THEN 'SUNDAY' ELSE 'WEEKDAY' END AS day_type, strftime(min(date), '%Y%m%d') AS date FROM d GROUP BY 1, 2""")
