"""Quality and coverage operators bound to the driver's tables."""

from railtable.operators import coverage as C
from railtable.operators import quality as Q
from railtable.plans.bind import Book, canonical

book = Book()
QUERIES, ORACLES = book.queries, book.oracles
_r = lambda a, b: f"CASE WHEN {b} > 0 THEN round({a}::DOUBLE / {b}, 4) ELSE 0.0 END"
M = ["SELECT p_size % 6 AS pack_id, p_partkey AS station_line, p_partkey % 3 > 0 AS covered, p_partkey % 4 > 0 AS evidence FROM part", "SELECT s_nationkey % 6 AS pack_id, s_suppkey AS facility_id, s_suppkey % 2 = 0 AS eligible, s_suppkey % 3 = 0 AS status_known, s_acctbal > 0 AS fresh FROM supplier",
     "SELECT user_id % 5 AS pack_id, event_id AS edge_id, CASE WHEN event_id % 3 = 0 THEN 'PATHWAY' ELSE 'RIDE' END AS kind, event_id % 2 = 0 AS verified, CASE WHEN event_id % 7 = 0 THEN 'UNKNOWN' ELSE 'OK' END AS access FROM events"]
_M = f"""s AS (SELECT pack_id, count(*) AS n, count(*) FILTER (WHERE covered) AS c, count(*) FILTER (WHERE evidence) AS e FROM ({M[0]}) GROUP BY 1), f AS (SELECT pack_id, count(*) AS n, count(*) FILTER (WHERE eligible) AS g, count(*) FILTER (WHERE status_known) AS k, count(*) FILTER (WHERE fresh) AS h FROM ({M[1]}) GROUP BY 1),
  e AS (SELECT pack_id, count(DISTINCT edge_id) FILTER (WHERE kind = 'PATHWAY') AS p, count(DISTINCT edge_id) FILTER (WHERE kind = 'PATHWAY' AND verified) AS v, count(DISTINCT edge_id) AS n, count(DISTINCT edge_id) FILTER (WHERE access = 'UNKNOWN') AS u FROM ({M[2]}) GROUP BY 1),
  m AS (SELECT s.pack_id, s.n AS station_lines, coalesce(f.n, 0) AS facilities, coalesce(p, 0) AS pathways, {_r('c', 's.n')} AS coverage, {_r('s.e', 's.n')} AS evidence, {_r('g', 'f.n')} AS eligible, {_r('k', 'f.n')} AS status_known, {_r('h', 'f.n')} AS fresh, {_r('v', 'p')} AS verified_pathways, {_r('u', 'e.n')} AS unknown_access FROM s LEFT JOIN f USING (pack_id) LEFT JOIN e USING (pack_id))"""
book.add("ag01_regional_metrics", Q.regional_metrics, M, f"WITH {_M} SELECT * FROM m")
book.add("ag02_worst_of", lambda *d: Q.worst_of(Q.regional_metrics(*d), ["coverage", "evidence", "fresh"]), M, f"WITH {_M} SELECT min(coverage) AS coverage, min(evidence) AS evidence, min(fresh) AS fresh, 0::BIGINT AS out_of_bounds FROM m")
CON = "SELECT o_orderpriority AS region, o_orderstatus AS edge_type, o_orderkey % 3 = 0 AS generated FROM orders"
book.add("ag04_connector_ratio", lambda d: Q.connector_ratio(d, ["region", "edge_type"]), [CON], f"SELECT region, edge_type, count(*) FILTER (WHERE generated) AS generated, count(*) FILTER (WHERE NOT generated) AS explicit, grouping(region) * 2 + grouping(edge_type) AS level, round(count(*) FILTER (WHERE generated)::DOUBLE / count(*), 4) AS generated_ratio FROM ({CON}) GROUP BY CUBE (region, edge_type)")
OD = "SELECT event_id, event_id % 4 > 0 AS found, CASE WHEN event_id % 8 = 0 THEN event_type END AS reason_code, CASE WHEN user_id % 5 = 0 THEN 'HIGH' END AS priority FROM events"
book.add("ag05_route_not_found", Q.route_not_found, [OD], f"WITH o AS ({OD}) SELECT coalesce(reason_code, 'UNKNOWN') AS reason, count(*) AS n, count(*) FILTER (WHERE priority = 'HIGH') AS high_priority, round(count(*)::DOUBLE / (SELECT count(*) FROM o), 4) AS rate FROM o WHERE NOT found GROUP BY 1")
FAC = "SELECT CASE WHEN event_id % 21 > 0 THEN user_id END AS station_id, event_type AS facility_type, event_id % 40 AS detail FROM events"
TYPES = ["click", "view", "purchase", "lift"]
_TY = ", ".join(f"('{t}')" for t in TYPES)
book.add("ag10_facility_counts", lambda d: Q.facility_counts(d, TYPES), [FAC], f"WITH f AS (SELECT * FROM ({FAC}) WHERE station_id IS NOT NULL), c AS (SELECT station_id, t, (SELECT count(*) FROM f x WHERE x.station_id = s.station_id AND facility_type = t) AS n FROM (SELECT DISTINCT station_id FROM f) s, (VALUES {_TY}) v(t)) SELECT station_id, t AS facility_type, n, CASE WHEN n > 0 THEN 'EXISTS' ELSE 'NOT_EXISTS' END AS existence FROM c")
F2 = "SELECT CASE WHEN user_id % 4 > 0 OR event_type = 'view' THEN user_id % 60 ELSE user_id % 60 + 60 END AS station_id, event_type AS facility_type, event_id % 9 AS detail FROM events"
book.add("ag11_numbered_facilities", lambda d: Q.numbered_facilities(d, TYPES, ["station_id", "facility_type", "detail"]), [F2], f"""WITH f AS ({F2}), d AS (SELECT DISTINCT station_id, facility_type, sha256({canonical('detail', 'facility_type', 'station_id')}) AS h FROM f), n AS (SELECT station_id, facility_type, (row_number() OVER (PARTITION BY station_id, facility_type ORDER BY h))::INT AS no, h FROM d)
  SELECT * FROM n UNION ALL SELECT station_id, t, 0, NULL FROM (SELECT DISTINCT station_id FROM f) s, (VALUES {_TY}) v(t) WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.station_id = s.station_id AND facility_type = t)""")
ST = ["SELECT s_suppkey AS station_id FROM supplier", "SELECT user_id AS station_id, CASE WHEN user_id % 7 = 0 THEN NULL WHEN event_id % 60 = 0 THEN false ELSE true END AS operational FROM events WHERE user_id % 3 > 0"]
book.add("ag12_status_rollup", Q.status_rollup, ST, f"WITH f AS (SELECT station_id, count(*) AS n, bool_or(NOT operational) AS down, count(*) FILTER (WHERE operational) AS up FROM ({ST[1]}) GROUP BY 1) SELECT s_suppkey AS station_id, CASE WHEN n IS NULL THEN 'NOT_COVERED' WHEN down THEN 'UNDER_MAINTENANCE' WHEN up = n THEN 'AVAILABLE' ELSE 'UNKNOWN' END AS status FROM supplier LEFT JOIN f ON station_id = s_suppkey")
DM = ["SELECT p_brand AS operator_id, p_partkey AS station_line FROM part", "SELECT p_partkey AS station_line, CASE WHEN p_size % 2 = 0 THEN 'exit' ELSE 'facility' END AS domain, p_size = 44 AS stale FROM part WHERE p_brand < 'Brand#2' OR p_size % 3 = 0 UNION ALL SELECT p_partkey AS station_line, 'exit' AS domain, false AS stale FROM part WHERE p_brand = 'Brand#2'"]
book.add("ag13_domain_matrix", lambda a, b: Q.domain_matrix(a, ["facility", "exit", "transfer"], b), DM, f"""WITH t AS (SELECT p_brand AS operator_id, count(*) AS total FROM part GROUP BY 1), e AS (SELECT p_brand AS operator_id, domain, count(DISTINCT station_line) AS k, bool_or(stale) AS stale FROM ({DM[1]}) JOIN part ON p_partkey = station_line GROUP BY 1, 2),
  j AS (SELECT t.operator_id, d AS domain, coalesce(k, 0) AS evaluated, total, list_filter([CASE WHEN coalesce(k, 0) = 0 THEN 'NOT_EVALUATED' END, CASE WHEN k > 0 AND k < total THEN 'PARTIAL' END, CASE WHEN stale THEN 'STALE' END], lambda x: x IS NOT NULL) AS l FROM t, (VALUES ('facility'), ('exit'), ('transfer')) v(d) LEFT JOIN e ON e.operator_id = t.operator_id AND e.domain = d)
  SELECT operator_id, domain, evaluated, total, array_to_string(l, ',') AS reasons, CASE WHEN len(l) = 0 THEN 'ADMITTED' ELSE 'BLOCKED' END AS status FROM j""")
CL = "SELECT concat('s', user_id % 9) AS source_id, event_type AS domain, concat('a', event_id % 12) AS artifact FROM events"
book.add("ag14_claim_matrix", Q.claim_matrix, [CL], f"SELECT source_id, domain, count(*) AS claims, string_agg(DISTINCT artifact, ',' ORDER BY artifact) AS artifacts FROM ({CL}) GROUP BY 1, 2")
EC = "SELECT lower(o_orderstatus) AS edge_type, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS pattern, CASE WHEN o_orderkey % 2 = 0 THEN 'itx' END AS service_class FROM orders"
book.add("ag15_edge_counts", Q.edge_counts, [EC], f"SELECT upper(coalesce(edge_type, 'UNKNOWN')) AS edge_type, upper(coalesce(pattern, 'LOCAL')) AS pattern, upper(coalesce(service_class, 'SUBWAY')) AS service_class, count(*) AS edges FROM ({EC}) GROUP BY 1, 2, 3")
MP = "SELECT station_id % 300 AS station_id, line_id, CASE WHEN station_id % 4 > 0 THEN 'M 0 0' WHEN station_id % 8 = 0 THEN '' END AS path FROM v_positions"
book.add("ag21_map_summary", Q.map_summary, [MP], f"WITH p AS ({MP}) SELECT count(*) AS rows, count(*) FILTER (WHERE path <> '') AS with_path, (SELECT count(*) FROM (SELECT station_id FROM p GROUP BY 1 HAVING count(DISTINCT line_id) > 1)) AS interchanges, count(DISTINCT line_id) AS lines FROM p")
book.add("ag22_reason_histogram", Q.reason_histogram, ["SELECT concat(event_type, CASE WHEN user_id % 2 = 0 THEN concat(': ', event_id, ':x') ELSE '' END) AS reason FROM events"], "SELECT event_type AS reason, count(*) AS n FROM events GROUP BY 1")
IC = "SELECT event_type AS artifact, CASE event_id % 5 WHEN 0 THEN 'MALFORMED' WHEN 1 THEN 'SELF_LOOP' WHEN 2 THEN 'QUARANTINED' ELSE 'ADMITTED' END AS status, user_id AS station_id FROM events"
book.add("ag23_ingestion", Q.ingestion_coverage, [IC], f"SELECT artifact, count(*) AS total, count(*) FILTER (WHERE status = 'MALFORMED') AS malformed, count(*) FILTER (WHERE status = 'SELF_LOOP') AS self_loops, count(*) FILTER (WHERE status = 'QUARANTINED') AS quarantined, count(*) FILTER (WHERE status = 'ADMITTED') AS admitted, count(DISTINCT station_id) FILTER (WHERE status = 'ADMITTED') AS stations FROM ({IC}) GROUP BY 1")
book.add("ag24_silent_sources", Q.silent_sources, ["SELECT n_nationkey AS source_id FROM nation", "SELECT s_nationkey AS source_id FROM supplier WHERE s_suppkey % 4 = 0", "SELECT c_nationkey AS source_id FROM customer WHERE c_nationkey % 5 = 0"], "SELECT n_nationkey AS source_id FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey % 4 = 0) AND n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_nationkey % 5 = 0)")
book.add("ag25_evidence_horizon", lambda r, e: Q.evidence_horizon(r, e, 1_710_000_000), ["SELECT user_id % 20 AS pack_id, event_id AS evidence_id FROM events", "SELECT seq AS evidence_id, expires_at FROM v_status WHERE seq % 70 > 0"], "SELECT facility_id % 20 AS pack_id, min(CASE WHEN seq % 70 > 0 THEN expires_at END) AS fresh_until, count(*) FILTER (WHERE seq % 70 = 0) AS missing, count(*) FILTER (WHERE seq % 70 > 0 AND expires_at <= 1710000000) AS stale FROM v_status GROUP BY 1")
TS = ["SELECT event_id AS rule_id, user_id AS seconds, event_type AS source_id FROM events", "SELECT event_id AS rule_id, CASE WHEN event_id % 5 = 0 THEN user_id + 1 ELSE user_id END AS seconds, CASE WHEN event_id % 3 = 0 THEN 'other' ELSE event_type END AS source_id FROM events WHERE event_id % 11 > 0"]
book.add("ag26_time_sources", Q.time_source_check, TS, f"""WITH j AS (SELECT a.rule_id, b.seconds AS s, array_to_string(list_filter([CASE WHEN a.seconds <> b.seconds THEN 'SECONDS' END, CASE WHEN a.source_id <> b.source_id THEN 'SOURCE' END, CASE WHEN b.seconds <= 0 THEN 'NOT_POSITIVE' END], lambda x: x IS NOT NULL), ',') AS bad FROM ({TS[0]}) a LEFT JOIN ({TS[1]}) b USING (rule_id))
  SELECT rule_id, bad, CASE WHEN s IS NULL THEN 'SKIPPED' WHEN bad = '' THEN 'PASS' ELSE 'FAIL' END AS status FROM j""")
TC = "SELECT trip_id, line_id, stop_no, CASE WHEN station_id % 5 > 0 THEN departure - 30 END AS arrival, CASE WHEN station_id % 7 > 0 THEN departure END AS departure FROM v_stops"
book.add("ag27_completeness", Q.timestamp_completeness, [TC], f"""WITH s AS (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY stop_no) AS no, count(*) OVER (PARTITION BY trip_id) AS n FROM ({TC})) SELECT line_id, sum((no > 1)::INT + (no < n)::INT)::BIGINT AS required, sum((no > 1 AND arrival IS NOT NULL)::INT + (no < n AND departure IS NOT NULL)::INT)::BIGINT AS present FROM s GROUP BY 1""")
SR = "SELECT s_nationkey AS station_id, s_suppkey AS facility_id, CASE WHEN s_acctbal > 0 THEN 'UP' ELSE 'DOWN' END AS status FROM supplier"
book.add("ag28_station_rollup", Q.station_rollup, [SR], f"SELECT station_id, count(*) AS n, string_agg(concat(facility_id, '=', status), ';' ORDER BY facility_id, status) AS facilities, sha256(string_agg(concat(facility_id, '=', status), ';' ORDER BY facility_id, status)) AS hash FROM ({SR}) GROUP BY 1")
book.add("ag29_quota_conflicts", Q.quota_conflicts, ["SELECT s_nationkey AS store, s_suppkey % 2 AS daily, 60 AS per_minute FROM supplier"], "SELECT s_nationkey AS store, count(DISTINCT s_suppkey % 2) AS limits, count(*) AS sources FROM supplier GROUP BY 1 HAVING count(DISTINCT s_suppkey % 2) > 1")
SCO = "SELECT n_regionkey AS region_id, n_nationkey AS operator_id, concat('L', n_nationkey) AS line_id FROM nation"
DOM = "SELECT 'timetable' AS domain, array('a', 'b') AS fields, 1.0E0 AS threshold UNION ALL SELECT 'facility' AS domain, array('a', 'c', 'd') AS fields, 0.6E0 AS threshold"
SRC = "SELECT s_suppkey AS source_id, array(n_regionkey) AS region_ids, array(CASE WHEN s_suppkey % 3 = 0 THEN n_nationkey ELSE n_nationkey + 50 END) AS operator_ids, array(concat('L', n_nationkey)) AS line_ids, CASE WHEN s_suppkey % 2 = 0 THEN 'timetable' ELSE 'facility' END AS domain, CASE WHEN s_suppkey % 5 = 0 THEN array('a', 'b', 'c', 'd') ELSE array('a', 'c') END AS fields FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 4 > 0 OR s_suppkey % 20 = 0"
_COV = """sc AS (SELECT n_regionkey AS region_id, n_nationkey AS operator_id, concat('L', n_nationkey) AS line_id FROM nation), dm AS (SELECT 'timetable' AS domain, unnest(['a', 'b']) AS field, 1.0::DOUBLE AS threshold, 2 AS n UNION ALL SELECT 'facility', unnest(['a', 'c', 'd']), 0.6::DOUBLE, 3),
  sr AS (SELECT s_suppkey AS source_id, n_nationkey AS nk, s_suppkey % 3 = 0 AS own, CASE WHEN s_suppkey % 2 = 0 THEN 'timetable' ELSE 'facility' END AS domain, unnest(CASE WHEN s_suppkey % 5 = 0 THEN ['a', 'b', 'c', 'd'] ELSE ['a', 'c'] END) AS field FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 4 > 0 OR s_suppkey % 20 = 0)"""
book.add("ag06_evaluate", C.evaluate, [SCO, DOM, SRC], f"""WITH {_COV}, g AS (SELECT region_id, operator_id, line_id, dm.domain, threshold, count(*) AS required, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM sr WHERE own AND nk = operator_id AND sr.domain = dm.domain AND sr.field = dm.field)) AS covered FROM sc, dm GROUP BY ALL)
  SELECT region_id, operator_id, line_id, domain, required, covered, round(covered::DOUBLE / required, 4) AS ratio, CASE WHEN round(covered::DOUBLE / required, 4) >= threshold THEN 'COVERED' ELSE 'MISSING' END AS status FROM g""")
book.add("ag07_tally", C.tally, [SCO, DOM, SRC], f"""WITH {_COV}, k AS (SELECT nk, own, sr.domain, source_id, count(DISTINCT sr.field) AS c, any_value(n) AS n FROM sr JOIN dm ON dm.domain = sr.domain AND dm.field = sr.field GROUP BY ALL), b AS (SELECT DISTINCT region_id, operator_id, line_id, domain FROM sc, dm)
  SELECT b.*, CASE WHEN EXISTS (SELECT 1 FROM k WHERE nk = operator_id AND own AND k.domain = b.domain AND c = n) THEN 'SUPPORTED' WHEN EXISTS (SELECT 1 FROM k WHERE nk = operator_id AND k.domain = b.domain AND c = n) THEN 'DUAL_OPERATOR_UNMATCHED' ELSE 'NO_ADMITTED_SOURCE' END AS status FROM b""")
REQ = "SELECT event_id AS id, concat('t', user_id % 3) AS tier, event_type AS domain, concat('r', user_id % 5) AS region_id, CASE event_id % 4 WHEN 0 THEN 'SUPPORTED' WHEN 1 THEN 'UNSUPPORTED' ELSE 'MISSING' END AS status, event_id % 1000 AS review_at, concat('L', user_id % 12) AS line_id FROM events"
_A = "count(*) AS requirements, count(*) FILTER (WHERE status = 'SUPPORTED') AS supported, round(count(*) FILTER (WHERE status <> 'MISSING')::DOUBLE / count(*), 4) AS terminal_ratio, min(review_at) AS next_review"
book.add("ag08_tier_summary", C.tier_summary, [REQ], f"SELECT tier, domain, region_id, {_A} FROM ({REQ}) GROUP BY GROUPING SETS ((tier), (tier, domain), (tier, region_id))")
RES = "SELECT event_id + CASE WHEN user_id % 30 = 0 THEN 900000 ELSE 0 END AS id, event_id % 900 AS expires_at, CASE WHEN user_id % 2 = 0 THEN event_id % 700 END AS support_from FROM events WHERE event_id % 7 = 0"
book.add("ag09_resolutions", lambda a, b: C.apply_resolutions(a, b, 400), [REQ, RES], f"WITH q AS ({REQ}), r AS ({RES}) SELECT q.id, CASE WHEN expires_at IS NOT NULL AND status = 'SUPPORTED' THEN 'CONFLICT' WHEN status = 'MISSING' AND expires_at > 400 AND (support_from IS NULL OR support_from > 400) THEN 'UNSUPPORTED' ELSE status END AS status FROM q LEFT JOIN r USING (id)")
book.add("ag09_orphans", C.orphan_resolutions, [REQ, RES], "SELECT event_id + 900000 AS id FROM events WHERE event_id % 7 = 0 AND user_id % 30 = 0")
ES = ["SELECT event_id AS id, concat('L', user_id % 12) AS line_id, CASE WHEN event_id % 4 = 0 THEN 'SUPPORTED' ELSE 'MISSING' END AS status, array('a', 'b') AS fields FROM events", "SELECT concat('L', p_size % 14) AS line_id, CASE WHEN p_partkey % 3 = 0 THEN 'a' ELSE 'c' END AS field, CASE p_partkey % 4 WHEN 0 THEN 'OFFICIAL' WHEN 1 THEN 'FIELD_VERIFIED' ELSE 'CROWD' END AS kind FROM part"]
book.add("ag30_evidence_support", C.evidence_support, ES, f"WITH p AS (SELECT line_id, field, count(*) AS n FROM ({ES[1]}) WHERE kind <> 'CROWD' GROUP BY 1, 2) SELECT event_id AS id, f AS field, coalesce(n, 0) AS records FROM events, (VALUES ('a'), ('b')) v(f) LEFT JOIN p ON line_id = concat('L', user_id % 12) AND field = f WHERE event_id % 4 = 0")
book.add("pl09_release_coverage", C.release_coverage, [REQ, "SELECT concat('L', n_nationkey) AS line_id FROM nation WHERE n_nationkey < 6"], f"SELECT substr(line_id, 2)::INT < 6 AS in_scope, count(*) AS requirements, count(*) FILTER (WHERE status = 'SUPPORTED') AS supported, round(count(*) FILTER (WHERE status = 'SUPPORTED')::DOUBLE / count(*), 4) AS ratio, count(*) = count(*) FILTER (WHERE status = 'SUPPORTED') AS complete FROM ({REQ}) GROUP BY 1")
