"""Versioning operators bound to the driver's tables."""

from pyspark.sql import functions as F

from railtable.operators import topology as G
from railtable.operators import versioning as V
from railtable.plans.bind import Book, canonical

book = Book()
QUERIES, ORACLES = book.queries, book.oracles
OLD = "SELECT p_partkey, p_name, p_brand, p_size FROM part WHERE p_partkey % 19 > 0"
NEW = "SELECT p_brand, p_partkey, CASE WHEN p_partkey % 7 = 0 THEN concat(p_name, '*') ELSE p_name END AS p_name, p_size FROM part WHERE p_partkey % 23 > 0"
_D = f"""o AS ({OLD}), n AS ({NEW}), d AS (SELECT coalesce(o.p_partkey, n.p_partkey) AS p_partkey, coalesce(o.p_brand, n.p_brand) AS b, CASE WHEN n.p_partkey IS NULL THEN 'REMOVED' WHEN o.p_partkey IS NULL THEN 'ADDED' WHEN o.p_name <> n.p_name THEN 'CHANGED' END AS change FROM o FULL JOIN n ON o.p_partkey = n.p_partkey)"""
book.add("dq01_diff_table", lambda a, b: V.diff_table(a, b, ["p_partkey"]), [OLD, NEW], f"WITH {_D} SELECT p_partkey, change FROM d WHERE change IS NOT NULL")
book.add("dq02_diff_by_line", lambda a, b: V.diff_by_line(a, b, ["p_brand", "p_partkey"], "p_brand"), [OLD, NEW], f"WITH {_D} SELECT b AS p_brand, count(*) FILTER (WHERE change = 'ADDED') AS added, count(*) FILTER (WHERE change = 'REMOVED') AS removed, count(*) FILTER (WHERE change = 'CHANGED') AS modified FROM d WHERE change IS NOT NULL GROUP BY b")
P0 = "SELECT station_id, line_id, x, y FROM v_positions WHERE station_id % 29 > 0"
P1 = "SELECT station_id, line_id, x + station_id % 9 AS x, y FROM v_positions WHERE station_id % 31 > 0"
book.add("dq03_diff_positions", lambda a, b: V.diff_positions(a, b, 3.0, 50).withColumn("moved", F.round("moved", 6)), [P0, P1], f"""WITH a AS ({P0}), b AS ({P1}), j AS (SELECT coalesce(a.line_id, b.line_id) AS line_id, coalesce(a.station_id, b.station_id) AS station_id, CASE WHEN a.station_id IS NULL THEN 'ADDED' WHEN b.station_id IS NULL THEN 'REMOVED' WHEN abs(b.x - a.x) > 3 THEN 'MOVED' END AS change, abs(b.x - a.x)::DOUBLE AS moved FROM a FULL JOIN b ON a.station_id = b.station_id AND a.line_id = b.line_id),
  m AS (SELECT * FROM j WHERE change = 'MOVED' ORDER BY moved DESC, line_id, station_id LIMIT 50) SELECT * FROM j WHERE change IN ('ADDED', 'REMOVED') UNION ALL SELECT * FROM m""")
book.add("dq03_line_counts", V.line_counts, [P0, P1], f"WITH a AS (SELECT line_id, count(*) AS n FROM ({P0}) GROUP BY 1), b AS (SELECT line_id, count(*) AS n FROM ({P1}) GROUP BY 1) SELECT line_id, coalesce(a.n, 0) AS before, coalesce(b.n, 0) AS after, coalesce(b.n, 0) - coalesce(a.n, 0) AS change FROM a FULL JOIN b USING (line_id)")
book.add("dq04_unequal_within", lambda a, b: V.unequal_within(a, b, ["station_id"], ["x", "y"], 2.0), [P0, P1], "SELECT station_id FROM v_positions WHERE (station_id % 29 = 0) <> (station_id % 31 = 0) OR (station_id % 29 > 0 AND station_id % 31 > 0 AND station_id % 9 > 2)")
SNAP5 = "SELECT snapshot_id, source_id, previous_id, retrieved_at, raw_mark, schema_mark, row_count, CASE WHEN row_count % 5 > 0 THEN raw_mark END AS request_mark, CASE WHEN row_count % 4 > 0 THEN retrieved_at - row_count % 7 END AS source_time, row_count % 50 AS coverage_count FROM v_snapshots"
DIFF5 = f"""SELECT s.snapshot_id, s.raw_mark IS DISTINCT FROM p.raw_mark AS raw_changed, s.schema_mark IS DISTINCT FROM p.schema_mark AS schema_changed, s.request_mark IS DISTINCT FROM p.request_mark AS request_changed,
  s.source_time IS DISTINCT FROM p.source_time AS source_time_changed, s.row_count - p.row_count AS row_delta, s.coverage_count - p.coverage_count AS coverage_delta,
  CASE WHEN s.raw_mark IS DISTINCT FROM p.raw_mark OR s.schema_mark IS DISTINCT FROM p.schema_mark OR s.request_mark IS DISTINCT FROM p.request_mark OR s.source_time IS DISTINCT FROM p.source_time OR s.row_count IS DISTINCT FROM p.row_count OR s.coverage_count IS DISTINCT FROM p.coverage_count THEN 'CHANGED' ELSE 'NO_CHANGE' END AS status
  FROM ({SNAP5}) AS s JOIN ({SNAP5}) AS p ON p.snapshot_id = s.previous_id"""
book.add("dq05_snapshot_changes", V.snapshot_changes, [SNAP5], DIFF5)
STORED = f"""SELECT snapshot_id, raw_changed, schema_changed, request_changed, source_time_changed, CASE WHEN snapshot_id % 31 = 0 THEN row_delta + 1 ELSE row_delta END AS row_delta, coverage_delta, status FROM ({DIFF5}) AS d WHERE snapshot_id % 37 > 0
  UNION ALL SELECT snapshot_id, false AS raw_changed, false AS schema_changed, false AS request_changed, false AS source_time_changed, CAST(0 AS BIGINT) AS row_delta, CAST(0 AS BIGINT) AS coverage_delta, 'NO_CHANGE' AS status FROM v_snapshots WHERE previous_id IS NULL AND snapshot_id % 41 = 0"""
book.add("gr10_stored_diffs", lambda s, d: G.stored_diffs(V.snapshot_changes(s), s, d), [SNAP5, STORED], """SELECT snapshot_id, CASE WHEN snapshot_id % 37 = 0 THEN 'DIFF_MISSING' ELSE 'DIFF_DIFFERS' END AS reason FROM v_snapshots WHERE previous_id IS NOT NULL AND (snapshot_id % 37 = 0 OR snapshot_id % 31 = 0)
  UNION ALL SELECT snapshot_id, 'ROOT_HAS_DIFF' FROM v_snapshots WHERE previous_id IS NULL AND snapshot_id % 41 = 0""")
S0 = "SELECT user_id % 7 AS day, event_type AS set_name, user_id AS member FROM events WHERE event_id % 3 > 0"
S1 = "SELECT user_id % 7 AS day, event_type AS set_name, user_id AS member FROM events WHERE event_id % 5 > 2"
book.add("dq06_compare_sets", V.compare_sets, [S0, S1], f"""WITH a AS (SELECT DISTINCT * FROM ({S0})), b AS (SELECT DISTINCT * FROM ({S1})), d AS (SELECT *, 'R' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'A' FROM (SELECT * FROM b EXCEPT SELECT * FROM a))
  SELECT day, set_name, count(*) FILTER (WHERE side = 'R') AS removed, count(*) FILTER (WHERE side = 'A') AS added FROM d GROUP BY 1, 2""")
NAMES = "SELECT p_name AS name, p_partkey AS station_id, p_brand AS line_id FROM part"
DEC = "SELECT p_name AS name, max(CASE WHEN p_size % 5 = 0 THEN 'MAYBE' ELSE 'MERGE' END) AS decision, {} AS station_ids FROM part WHERE p_size > 20 GROUP BY p_name"
book.add("dq07_identity", V.identity_violations, [NAMES, DEC.format("array_agg(CAST(p_partkey AS STRING))")], f"""WITH s AS (SELECT name, count(DISTINCT station_id) AS n, list_sort(list(DISTINCT station_id::VARCHAR)) AS actual FROM ({NAMES}) GROUP BY name HAVING count(DISTINCT station_id) > 1), d AS ({DEC.format("list_sort(list(DISTINCT p_partkey::VARCHAR))")}),
  r AS (SELECT s.name, n, CASE WHEN decision IS NULL THEN 'NO_DECISION' WHEN decision NOT IN ('MERGE', 'DISTINCT') THEN 'UNKNOWN_DECISION' WHEN station_ids <> actual THEN 'OTHER_STATIONS' END AS reason FROM s LEFT JOIN d USING (name)) SELECT * FROM r WHERE reason IS NOT NULL""")
LDEC = "SELECT p_name AS name, 'MERGE' AS decision, {} AS station_ids, {} AS line_ids FROM part WHERE p_size > 3 GROUP BY p_name"
book.add("dq07_line_sets", V.identity_violations, [NAMES, LDEC.format("array_agg(CAST(p_partkey AS STRING))", "array_agg(CASE WHEN p_size % 7 > 0 THEN p_brand ELSE p_type END)")], f"""WITH s AS (SELECT name, count(DISTINCT station_id) AS n, list_sort(list(DISTINCT station_id::VARCHAR)) AS actual, list_sort(list(DISTINCT line_id)) AS lines FROM ({NAMES}) GROUP BY name HAVING count(DISTINCT station_id) > 1),
  d AS ({LDEC.format("list_sort(list(DISTINCT p_partkey::VARCHAR))", "list_sort(list(DISTINCT CASE WHEN p_size % 7 > 0 THEN p_brand ELSE p_type END))")}), j AS (SELECT s.*, decision, station_ids, line_ids FROM s LEFT JOIN d USING (name))
  SELECT name, n, 'NO_DECISION' AS reason FROM j WHERE decision IS NULL UNION ALL SELECT name, n, 'OTHER_STATIONS' FROM j WHERE decision IS NOT NULL AND station_ids <> actual UNION ALL SELECT name, n, 'OTHER_LINES' FROM j WHERE decision IS NOT NULL AND line_ids <> lines""")
book.add("dq08_id_collisions", lambda a, b: V.id_collisions(a, b, "id"), ["SELECT p_partkey AS id FROM part", "SELECT s_suppkey * 3 AS id FROM supplier"], "SELECT p_partkey AS id FROM part INTERSECT SELECT s_suppkey * 3 FROM supplier")
book.add("dq09_canonical_digest", lambda d: V.canonical_digest(d, "station_id", "line_id"), ["v_stops"], "SELECT line_id, count(DISTINCT station_id) AS n, sha256(to_json(list_sort(list(DISTINCT station_id::VARCHAR)))::VARCHAR) AS digest FROM v_stops GROUP BY line_id")
ENT = "SELECT p_partkey AS entity_id, concat('s', p_size % 5) AS source_id, array(p_brand, p_type) AS line_ids, CASE WHEN p_size % 3 > 0 THEN p_name END AS name, CAST(p_size AS INT) AS size FROM part"
SC = "SELECT concat('s', n_nationkey) AS source_id, array('Brand#11', 'Brand#12', 'Brand#13', 'Brand#21') AS line_ids FROM nation WHERE n_nationkey < 6 AND n_nationkey <> 3"
OV = "SELECT p_partkey AS entity_id, 'name' AS field, 's5' AS source_id FROM part WHERE p_partkey % 9 = 0"
book.add("dq10_field_provenance", lambda e, s, o: V.field_provenance(e, ["name", "size"], s, o), [ENT, SC, OV], """WITH f AS (SELECT p_partkey AS entity_id, 'name' AS field, CASE WHEN p_partkey % 9 = 0 THEN 's5' ELSE concat('s', p_size % 5) END AS source_id, p_brand FROM part WHERE p_size % 3 > 0 AND p_name IS NOT NULL UNION ALL SELECT p_partkey, 'size', concat('s', p_size % 5), p_brand FROM part)
  SELECT entity_id, field, source_id, p_brand AS line_id FROM f WHERE source_id <> 's3' AND p_brand IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#21')""")
REC = "SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'OFFICIAL' ELSE 'OTHER' END AS kind, array(s_nationkey % 4, s_nationkey % 3) AS region_ids, array(s_suppkey % 5) AS operator_ids, array(s_nationkey, s_suppkey % 7) AS line_ids, array('a', 'b') AS domains FROM supplier"
book.add("dq11_scope_index", V.scope_index, [REC], """SELECT DISTINCT r AS region_id, s_suppkey % 5 AS operator_id, l AS line_id, d AS domain FROM supplier, LATERAL (SELECT unnest([s_nationkey % 4, s_nationkey % 3]) AS r) a, LATERAL (SELECT unnest([s_nationkey, s_suppkey % 7]) AS l) b, (VALUES ('a'), ('b')) t(d) WHERE s_suppkey % 3 = 0""")
book.add("dq12_line_operators", V.line_operators, ["SELECT n_name AS line_id, n_regionkey AS operator_id FROM nation", "SELECT n_name AS line_id, s_suppkey AS operator_id FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE s_suppkey % 2 = 0"],
  "WITH d AS (SELECT n_name AS line_id, s_suppkey AS operator_id FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE s_suppkey % 2 = 0) SELECT * FROM d UNION ALL SELECT n_name, n_regionkey FROM nation WHERE n_name NOT IN (SELECT line_id FROM d)")
LED = "SELECT p_brand, p_partkey, p_name, p_size FROM part"
book.add("dq13_ledger_hash", lambda d: V.ledger_hash(d, "p_brand"), [LED], f"""WITH h AS (SELECT p_brand, sha256({canonical('p_name', 'p_partkey', 'p_size')}) AS h FROM part), b AS (SELECT p_brand, ('0x' || substr(h, 1, 8))::BIGINT % 256 AS b, count(*) AS n, sha256(string_agg(h, '' ORDER BY h)) AS d FROM h GROUP BY 1, 2)
  SELECT p_brand, sum(n)::BIGINT AS n_rows, sha256(string_agg(d, '' ORDER BY b)) AS ledger_hash FROM b GROUP BY 1""")
book.add("dq14_inherited", V.inherited_violations, ["SELECT p_brand, p_size FROM part", "SELECT p_brand, p_size FROM part WHERE p_partkey % 11 > 0"], f"""WITH a AS (SELECT {canonical('p_brand', 'p_size')} AS row, count(*) AS n0, count(*) FILTER (WHERE p_partkey % 11 > 0) AS n1 FROM part GROUP BY 1) SELECT * FROM a WHERE n1 < n0""")
book.add("dq15_scope_transition", lambda d: d.select("n_nationkey", V.scope_transition(F.col("a"), F.col("b"), F.col("c")).alias("class")), ["SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN filter(array(0), x -> x > 0) ELSE array(1, 2) END AS a, array(3, n_regionkey) AS b, CASE WHEN n_nationkey % 4 = 0 THEN array(n_regionkey, 3) WHEN n_nationkey % 4 = 1 THEN array(2, 1) WHEN n_nationkey % 4 = 2 THEN array(1, 2, 9) ELSE array(1, 3) END AS c FROM nation"],
  "SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'NEW' WHEN 1 THEN 'UNCHANGED' WHEN 2 THEN 'UNDECLARED_EXTENSION' ELSE 'INVALID' END AS class FROM nation")
K = ["SELECT p_partkey AS key FROM part WHERE p_partkey % 2 = 0", "SELECT p_partkey AS key FROM part WHERE p_partkey % 9 = 0", "SELECT p_partkey AS key FROM part WHERE p_partkey % 27 = 0", "SELECT p_partkey AS key FROM part WHERE (p_partkey % 2 = 0 OR p_partkey % 9 = 0) AND p_partkey % 13 > 0"]
book.add("dq16_transition_check", V.transition_violations, K, """WITH k AS (SELECT p_partkey AS key, (p_partkey % 2 = 0 OR p_partkey % 9 = 0) AND p_partkey % 27 > 0 AS want, (p_partkey % 2 = 0 OR p_partkey % 9 = 0) AND p_partkey % 13 > 0 AS a FROM part)
  SELECT key, 'MISSING' AS reason FROM k WHERE want AND NOT a UNION ALL SELECT key, 'UNDECLARED' FROM k WHERE a AND NOT want UNION ALL SELECT key, 'SUPPORTED_BEFORE' FROM k WHERE key % 18 = 0""")
book.add("wn15_latest", lambda d: V.latest_per_key(d, "facility_id", "observed_at", "seq"), ["v_status"], "SELECT * FROM v_status QUALIFY row_number() OVER (PARTITION BY facility_id ORDER BY observed_at DESC, seq DESC) = 1")
book.add("wn16_representative", lambda d: V.representative(d, "facility_id", {"purchase": 3, "click": 2, "view": 1}, "status", "seq"), ["SELECT facility_id, status, seq FROM v_status"],
  "SELECT facility_id, seq, status FROM v_status QUALIFY row_number() OVER (PARTITION BY facility_id ORDER BY CASE status WHEN 'purchase' THEN 3 WHEN 'click' THEN 2 WHEN 'view' THEN 1 ELSE -1 END DESC, seq) = 1")
book.add("wn17_keep_first", lambda d: V.keep_first(d, ["p_name"], "p_partkey"), ["SELECT p_name, p_partkey FROM part"], "SELECT p_name, p_partkey, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey)::INT AS place, min(p_partkey) OVER (PARTITION BY p_name) AS first_seen FROM part".replace("row_number() OVER (PARTITION BY p_name ORDER BY p_partkey)::INT", "(row_number() OVER (PARTITION BY p_name ORDER BY p_partkey))::INT"))
book.add("wn18_divergent", lambda d: V.divergent_keys(d, ["p_name"]), ["SELECT p_name, p_brand, p_type FROM part"], "SELECT p_name, count(DISTINCT concat(p_brand, '|', p_type)) AS versions FROM part GROUP BY 1 HAVING versions > 1")
