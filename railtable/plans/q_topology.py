"""Topology operators bound to the driver's tables."""

from pyspark.sql import functions as F

from railtable.operators import topology as G
from railtable.plans.bind import Book

book = Book()
QUERIES, ORACLES = book.queries, book.oracles
LINES = "SELECT p_brand AS line_id, p_partkey AS station_id, p_partkey AS seq FROM part"
book.add("wn05_adjacent_edges", G.adjacent_edges, [LINES], """WITH e AS (SELECT p_brand AS line_id, p_partkey AS a, lead(p_partkey) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS b FROM part)
  SELECT line_id, a AS from_station, b AS to_station FROM e WHERE b IS NOT NULL UNION ALL SELECT line_id, b, a FROM e WHERE b IS NOT NULL""")
DIST = "SELECT p_brand AS line_id, p_partkey AS seq, p_partkey AS station_id, p_size * 100 AS forward_m, p_size * 100 + CASE WHEN p_partkey % 10 = 0 THEN 5 ELSE 0 END AS backward_m, p_partkey % 17 = 0 AS is_depot FROM part"
book.add("wn06_distance_edges", G.edges_from_distances, [DIST], f"""WITH d AS ({DIST}), e AS (SELECT *, lead(station_id) OVER (PARTITION BY line_id ORDER BY seq) AS n FROM d WHERE NOT is_depot), f AS (SELECT *, CASE WHEN forward_m <> backward_m THEN 'ASYMMETRIC' END AS reason FROM e WHERE n IS NOT NULL)
  SELECT line_id, station_id AS from_station, n AS to_station, forward_m AS distance_m, reason FROM f UNION ALL SELECT line_id, n, station_id, backward_m, reason FROM f""")
LIST = "SELECT p_brand AS line_id, p_partkey AS pos, p_size AS station_id, CASE WHEN p_size % 6 > 0 THEN p_size * 90 END AS distance_m FROM part"
_LIST = f"l AS ({LIST}), g AS (SELECT *, (pos > min(pos) OVER (PARTITION BY line_id, station_id))::INT AS again FROM l), s AS (SELECT line_id, pos, station_id, distance_m, sum(again) OVER (PARTITION BY line_id ORDER BY pos)::BIGINT AS segment FROM g)"
book.add("wn07_branch_segments", G.branch_segments, [LIST], f"WITH {_LIST} SELECT * FROM s")
book.add("wn07_segment_edges", lambda d: G.segment_edges(G.branch_segments(d)), [LIST], f"""WITH {_LIST}, e AS (SELECT line_id, segment, station_id AS from_station, lead(station_id) OVER w AS to_station, lead(distance_m) OVER w AS distance_m FROM s WINDOW w AS (PARTITION BY line_id, segment ORDER BY pos))
  SELECT * FROM e WHERE to_station IS NOT NULL AND distance_m IS NOT NULL""")
RUNS = "SELECT p_brand AS line_id, p_partkey AS pos, p_size AS station_id, CASE WHEN p_size % 6 > 0 THEN p_size * 90 END AS distance_m, CASE WHEN p_size % 4 > 0 THEN p_size * 80 END AS trailing_m, CASE WHEN p_partkey % 400 < 250 THEN 'one' ELSE 'two' END AS operator FROM part"
_RUNS = f"""l AS ({RUNS}), b AS (SELECT *, coalesce((operator <> lag(operator) OVER (PARTITION BY line_id ORDER BY pos))::INT, 0) AS border FROM l), u AS (SELECT *, sum(border) OVER (PARTITION BY line_id ORDER BY pos) AS run FROM b),
  g AS (SELECT *, (pos > min(pos) OVER (PARTITION BY line_id, run, station_id) OR (border = 1))::INT AS again FROM u), s AS (SELECT line_id, pos, station_id, distance_m, trailing_m, operator, sum(again) OVER (PARTITION BY line_id ORDER BY pos)::BIGINT AS segment FROM g)"""
book.add("wn07_operator_segments", lambda d: G.branch_segments(d, "operator"), [RUNS], f"WITH {_RUNS} SELECT * FROM s")
book.add("wn07_operator_edges", lambda d: G.segment_edges(G.branch_segments(d, "operator"), "trailing_m", close=True), [RUNS], f"""WITH {_RUNS}, e AS (SELECT line_id, segment, station_id AS from_station, lead(station_id) OVER w AS to_station, coalesce(CASE WHEN lead(distance_m) OVER w > 0 THEN lead(distance_m) OVER w END, CASE WHEN trailing_m > 0 THEN trailing_m END) AS distance_m FROM s WINDOW w AS (PARTITION BY line_id, segment ORDER BY pos))
  SELECT * FROM e WHERE to_station IS NOT NULL AND distance_m IS NOT NULL UNION ALL SELECT line_id, segment, max_by(station_id, pos), min_by(station_id, pos), arg_min_null(distance_m, pos) FROM s GROUP BY 1, 2 HAVING count(*) >= 3 AND arg_min_null(distance_m, pos) > 0""")
SPL = "SELECT DISTINCT p_brand AS line_id, p_size AS from_station, p_size % 13 + 40 AS to_station, p_size % 30 + 1 AS anchor_station, p_size % 2 = 0 AS use_trailing FROM part"
_SPL = f"WITH l AS ({RUNS}), f AS (SELECT line_id, station_id, arg_min_null(distance_m, pos) AS d, arg_min_null(trailing_m, pos) AS t FROM l GROUP BY 1, 2), j AS (SELECT s.line_id, from_station, to_station, b.station_id AS there, c.d, c.t, use_trailing, CASE WHEN use_trailing THEN c.t ELSE c.d END AS metres FROM ({SPL}) s LEFT JOIN f b ON b.line_id = s.line_id AND b.station_id = to_station LEFT JOIN f c ON c.line_id = s.line_id AND c.station_id = anchor_station)"
book.add("wn07_splices", lambda d, s: G.splice_edges(d, s)[0], [RUNS, SPL], f"{_SPL} SELECT line_id, from_station, to_station, metres AS distance_m FROM j WHERE there IS NOT NULL AND metres > 0")
book.add("wn07_splice_violations", lambda d, s: G.splice_edges(d, s)[1], [RUNS, SPL], f"{_SPL} SELECT line_id, from_station, to_station, CASE WHEN there IS NULL THEN 'STATION_MISSING' ELSE 'DISTANCE_MISSING' END AS reason FROM j WHERE there IS NULL OR metres IS NULL OR metres <= 0")
UP = "SELECT l_returnflag AS line_id, l_suppkey % 30 AS from_station, l_partkey % 30 AS to_station, CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_linenumber * 100 END AS distance_m, l_linestatus AS branch FROM lineitem"
_UP = f"u AS ({UP}), p AS (SELECT line_id, least(from_station, to_station) AS a, greatest(from_station, to_station) AS b, coalesce(max(nullif(distance_m, 0)), 0) AS distance_m, count(DISTINCT nullif(distance_m, 0)) > 1 AS conflict, string_agg(DISTINCT branch, ',' ORDER BY branch) AS branches FROM u GROUP BY 1, 2, 3)"
book.add("wn08_undirected_upsert", G.undirected_upsert, [UP], f"WITH {_UP} SELECT * FROM p")
book.add("wn08_both_ways", lambda d: G.both_ways(G.undirected_upsert(d)), [UP], f"WITH {_UP} SELECT line_id, a AS from_station, b AS to_station, distance_m FROM p UNION ALL SELECT line_id, b, a, distance_m FROM p")
TR = "SELECT l_suppkey AS station_id, l_linenumber AS from_line, CAST(l_partkey % 7 + 1 AS INT) AS to_line, CAST(l_quantity AS INT) AS seconds FROM lineitem WHERE l_linenumber <> l_partkey % 7 + 1"
book.add("wn19_direction_pairs", G.direction_pairs, [TR], f"""WITH t AS ({TR}), o AS (SELECT station_id, from_line, to_line, min(seconds) AS s FROM t GROUP BY 1, 2, 3)
  SELECT o.station_id, o.from_line, o.to_line, o.s AS forward_seconds, r.s AS reverse_seconds, coalesce(o.s <> r.s, false) AS mismatch FROM o LEFT JOIN o r ON r.station_id = o.station_id AND r.from_line = o.to_line AND r.to_line = o.from_line WHERE o.from_line < o.to_line OR r.s IS NULL""")
book.add("wn20_insert_at", lambda d: G.insert_at(d, "Brand#11", 40, 999_999), [LINES], "SELECT p_brand AS line_id, p_partkey AS station_id, CASE WHEN p_brand = 'Brand#11' AND p_partkey >= 40 THEN p_partkey + 1 ELSE p_partkey END AS seq FROM part UNION ALL SELECT 'Brand#11', 999999, 40")
NAMED = "SELECT p_brand AS line_id, p_partkey AS station_id, p_name AS name, p_partkey AS seq FROM part"
NEWER = "SELECT p_brand AS line_id, p_partkey AS station_id, CASE WHEN p_partkey % 23 = 0 THEN 'new' ELSE p_name END AS name, CASE WHEN p_size < 25 THEN -p_partkey ELSE p_partkey END AS seq FROM part"
book.add("wn21_same_neighbours", G.same_neighbours, [NAMED, NEWER], f"""WITH o AS (SELECT line_id, station_id, lag(name) OVER w AS a, lead(name) OVER w AS b FROM ({NAMED}) WINDOW w AS (PARTITION BY line_id ORDER BY seq)), n AS (SELECT line_id, station_id, lag(name) OVER w AS c, lead(name) OVER w AS d FROM ({NEWER}) WINDOW w AS (PARTITION BY line_id ORDER BY seq))
  SELECT line_id, station_id, (a IS NOT DISTINCT FROM c AND b IS NOT DISTINCT FROM d) OR (a IS NOT DISTINCT FROM d AND b IS NOT DISTINCT FROM c) AS same FROM o JOIN n USING (line_id, station_id)""")
RIDES = "SELECT l_orderkey * 10 + l_linenumber AS edge_id, l_returnflag AS line_id, l_suppkey AS from_station, l_suppkey + l_linenumber AS to_station, CAST(l_quantity AS INT) * 4 AS seconds, CAST(l_quantity AS INT) * l_linenumber * 20 AS metres, CASE WHEN l_linestatus = 'O' THEN 'LOCAL' ELSE 'EXPRESS' END AS pattern FROM lineitem"
ON = "SELECT DISTINCT l_returnflag AS line_id, l_suppkey AS station_id, l_suppkey AS seq FROM lineitem WHERE l_suppkey % 9 > 0"
book.add("gr01_edge_audit", G.edge_audit, [RIDES, ON], f"""WITH r AS ({RIDES}), o AS ({ON}), e AS (SELECT r.*, a.seq AS s, b.seq AS t FROM r LEFT JOIN o a ON a.line_id = r.line_id AND a.station_id = from_station LEFT JOIN o b ON b.line_id = r.line_id AND b.station_id = to_station)
  SELECT edge_id, 'SPEED_OUT_OF_RANGE' AS reason FROM e WHERE seconds > 0 AND NOT (metres / seconds * 3.6::DOUBLE BETWEEN 15 AND 110) UNION ALL SELECT edge_id, 'LOCAL_OFF_LINE' FROM e WHERE pattern = 'LOCAL' AND (s IS NULL OR t IS NULL)
  UNION ALL SELECT edge_id, 'LOCAL_NOT_ADJACENT' FROM e WHERE pattern = 'LOCAL' AND abs(s - t) <> 1 UNION ALL SELECT edge_id, 'EXPRESS_ADJACENT' FROM e WHERE pattern = 'EXPRESS' AND abs(s - t) = 1""")
SL = "SELECT DISTINCT l_returnflag || l_linestatus AS line_id, l_suppkey AS station_id FROM lineitem"
book.add("gr02_generated_transfers", G.generated_transfers, [SL], f"WITH s AS ({SL}), b AS (SELECT * FROM s WHERE line_id IN (SELECT line_id FROM s GROUP BY 1 HAVING count(*) > 1)) SELECT a.station_id, a.line_id AS from_line, b.line_id AS to_line FROM b a JOIN b ON a.station_id = b.station_id AND a.line_id <> b.line_id")
book.add("gr03_isolated", G.isolated_nodes, ["v_nodes", "v_edges"], "SELECT node FROM v_nodes WHERE node NOT IN (SELECT from_node FROM v_edges UNION SELECT to_node FROM v_edges)")
book.add("gr04_unreachable", G.unreachable_pairs, ["v_nodes", "v_edges"], """WITH RECURSIVE r(source, node) AS (SELECT from_node, to_node FROM v_edges UNION SELECT source, to_node FROM r JOIN v_edges ON node = from_node)
  SELECT a.node AS source, b.node AS node FROM v_nodes a, v_nodes b WHERE a.node <> b.node AND NOT EXISTS (SELECT 1 FROM r WHERE source = a.node AND r.node = b.node)""")
book.add("gr05_components", lambda n, e: G.components(e, n), ["v_nodes", "v_edges"], """WITH RECURSIVE e AS (SELECT from_node AS a, to_node AS b FROM v_edges UNION SELECT to_node, from_node FROM v_edges),
  r(node, c) AS (SELECT node, node FROM v_nodes UNION SELECT b, c FROM r JOIN e ON node = a) SELECT node, min(c) AS component FROM r GROUP BY node""")
book.add("gr06_service_edges", G.service_edges, ["v_stops"], """WITH e AS (SELECT DISTINCT a AS from_node, b AS to_node FROM (SELECT station_id AS a, lead(station_id) OVER (PARTITION BY trip_id ORDER BY stop_no) AS b FROM v_stops) WHERE b IS NOT NULL AND a <> b)
  SELECT e.*, EXISTS (SELECT 1 FROM e r WHERE r.from_node = e.to_node AND r.to_node = e.from_node) AS has_reverse FROM e""")
COR = ["SELECT trip_id, stop_no, station_id, line_id, CASE WHEN station_id % 37 = 0 THEN NULL WHEN line_id = 'R' THEN 'down' ELSE 'up' END AS direction, CASE WHEN station_id % 23 = 0 THEN station_id + 1 ELSE station_id END AS seq FROM v_stops",
  "SELECT s_suppkey AS station_id, r_name AS line_id, s_suppkey AS seq FROM supplier CROSS JOIN (SELECT 'A' AS r_name UNION ALL SELECT 'N' AS r_name UNION ALL SELECT 'R' AS r_name) AS l WHERE s_suppkey % 19 > 0 UNION ALL SELECT s_suppkey AS station_id, 'N' AS line_id, s_suppkey + 5000 AS seq FROM supplier WHERE s_suppkey % 29 = 0"]
_COR = f"""WITH t AS ({COR[0]}), c AS (SELECT station_id, line_id, min(seq) AS k FROM ({COR[1]}) GROUP BY 1, 2), s AS (SELECT t.*, k, lead(k) OVER w AS k2, lead(seq) OVER w AS q2, lead(stop_no) OVER w AS more FROM t LEFT JOIN c USING (station_id, line_id) WINDOW w AS (PARTITION BY trip_id ORDER BY stop_no)),
  r AS (SELECT trip_id, stop_no, CASE WHEN direction IS NULL THEN 'UNKNOWN_DIRECTION' WHEN k IS NULL OR k2 IS NULL THEN 'NOT_ON_CORRIDOR' WHEN seq <> k OR q2 <> k2 THEN 'OTHER_SEQUENCE' WHEN (direction = 'up' AND k >= k2) OR (direction = 'down' AND k <= k2) THEN 'AGAINST_DIRECTION' END AS reason FROM s WHERE more IS NOT NULL)"""
book.add("gr06_corridor_steps", G.corridor_steps, COR, f"{_COR} SELECT * FROM r")
book.add("gr06_corridor_agreement", lambda s, c: G.corridor_agreement(G.corridor_steps(s, c)), COR, f"{_COR}, u AS (SELECT *, sum((reason IS NOT NULL)::INT) OVER (PARTITION BY trip_id ORDER BY stop_no) AS run FROM r), v AS (SELECT trip_id, run, count(*) AS n, count(*) FILTER (WHERE reason IS NULL) AS good FROM u GROUP BY 1, 2) SELECT trip_id, sum(n)::BIGINT AS steps, sum(good)::BIGINT AS agreeing, max(good) AS longest FROM v GROUP BY 1")
book.add("gr07_bidirectional", G.expand_bidirectional, ["SELECT from_node, to_node, from_node % 2 = 0 AS bidirectional FROM v_edges", "SELECT n_nationkey AS from_node, n_regionkey AS to_node FROM nation"], "SELECT from_node, to_node FROM v_edges UNION ALL SELECT to_node, from_node FROM v_edges WHERE from_node % 2 = 0 UNION ALL SELECT n_nationkey, n_regionkey FROM nation")
book.add("gr08_replace_edges", lambda e, n: G.replace_edges(e, "A", n), [RIDES, "SELECT CAST(-n_nationkey - 1 AS BIGINT) AS edge_id, 'A' AS line_id, CAST(n_nationkey AS BIGINT) AS from_station, CAST(n_regionkey AS BIGINT) AS to_station, 60 AS seconds, 900 AS metres, 'LOCAL' AS pattern FROM nation"],
  f"SELECT * FROM ({RIDES}) WHERE NOT (line_id = 'A' AND pattern = 'LOCAL') UNION ALL SELECT -n_nationkey - 1, 'A', n_nationkey, n_regionkey, 60, 900, 'LOCAL' FROM nation")
book.add("gr09_remap_ids", lambda e, m: G.remap_ids(e, m, "from_node", "to_node"), ["v_edges", "SELECT node AS old_id, node + 100 AS new_id FROM v_nodes WHERE node % 6 = 0"], "SELECT CASE WHEN from_node % 6 = 0 THEN from_node + 100 ELSE from_node END AS from_node, CASE WHEN to_node % 6 = 0 THEN to_node + 100 ELSE to_node END AS to_node FROM v_edges")
IDS = "SELECT CASE WHEN p_partkey % 11 = 0 THEN p_size ELSE p_partkey + 1000 END AS old_id, CASE WHEN p_partkey % 11 = 0 THEN p_partkey % 60 + 40 ELSE p_partkey % 700 + 1200 END AS new_id FROM part"
book.add("gr09_remap_conflicts", G.remap_conflicts, [IDS], f"WITH m AS ({IDS}) SELECT old_id, 'TWO_TARGETS' AS reason FROM m GROUP BY 1 HAVING count(DISTINCT new_id) > 1 UNION ALL SELECT DISTINCT old_id, 'IS_TARGET' FROM m WHERE old_id IN (SELECT new_id FROM m)")
IDM = "SELECT node AS old_id, CASE WHEN node % 6 = 0 THEN node + 3 WHEN node % 6 = 3 THEN node + 5 WHEN node % 30 = 1 THEN node + 1 WHEN node % 30 = 2 THEN node - 1 ELSE -node END AS new_id FROM v_nodes WHERE node % 6 IN (0, 3) OR node % 30 IN (1, 2, 10)"
TWO = IDM + " UNION ALL SELECT node AS old_id, node + 1 AS new_id FROM v_nodes WHERE node % 30 = 10"
_IDM = f"WITH RECURSIVE m AS ({TWO}), t AS (SELECT old_id FROM m GROUP BY 1 HAVING count(DISTINCT new_id) > 1), o AS (SELECT DISTINCT * FROM m WHERE old_id NOT IN (SELECT old_id FROM t)), r(old_id, cur, k) AS (SELECT old_id, new_id, 1 FROM o UNION ALL SELECT r.old_id, o.new_id, k + 1 FROM r JOIN o ON o.old_id = r.cur WHERE k < 12), f AS (SELECT old_id, cur AS new_id FROM r WHERE cur NOT IN (SELECT old_id FROM o))"
book.add("gr09_merged_ids", lambda m: G.merged_ids(m)[0], [TWO], f"{_IDM} SELECT * FROM f WHERE new_id NOT IN (SELECT old_id FROM t)")
book.add("gr09_refused", lambda m: G.merged_ids(m)[1], [TWO], f"{_IDM} SELECT old_id, 'TWO_TARGETS' AS reason FROM t UNION ALL SELECT old_id, 'CYCLE' FROM o WHERE old_id NOT IN (SELECT old_id FROM f) UNION ALL SELECT old_id, 'LEADS_TO_REFUSED' FROM f WHERE new_id IN (SELECT old_id FROM t)")
KEYED = "SELECT concat(@str(from_node), ':L', @str(to_node % 4)) AS from_key, to_node FROM v_edges"
book.add("gr09_rewritten", lambda e, m: G.rewrite_ids({"e": e}, G.merged_ids(m)[0], {"e": ["to_node"]}, {"e": ["from_key"]})["e"], [KEYED, TWO], f"{_IDM}, g AS (SELECT * FROM f WHERE new_id NOT IN (SELECT old_id FROM t)) SELECT coalesce(a.new_id, from_node)::VARCHAR || ':L' || (to_node % 4)::VARCHAR AS from_key, coalesce(b.new_id, to_node) AS to_node FROM v_edges LEFT JOIN g a ON a.old_id = from_node LEFT JOIN g b ON b.old_id = to_node")
ALI = "SELECT node AS station_id, concat('n', @str(node % 50)) AS alias FROM v_nodes"
book.add("gr09_aliases", lambda a, m: G.alias_rows(G.merged_ids(m)[0], a), [ALI, TWO], f"{_IDM}, g AS (SELECT * FROM f WHERE new_id NOT IN (SELECT old_id FROM t)) SELECT coalesce(new_id, node) AS station_id, 'n' || (node % 50)::VARCHAR AS alias FROM v_nodes LEFT JOIN g ON old_id = node UNION SELECT new_id, old_id::VARCHAR FROM g")
SNAP = "SELECT snapshot_id, source_id, CASE WHEN snapshot_id % 13 = 0 THEN NULL WHEN snapshot_id % 17 = 0 THEN -snapshot_id ELSE previous_id END AS previous_id, retrieved_at - CASE WHEN snapshot_id % 19 = 0 THEN 900000000 ELSE 0 END AS retrieved_at FROM v_snapshots"
book.add("gr10_lineage", G.lineage, [SNAP], f"""WITH s AS ({SNAP}), j AS (SELECT s.*, p.retrieved_at AS before, p.source_id AS ps, CASE WHEN s.previous_id IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY s.source_id, s.previous_id) END AS children, sum((s.previous_id IS NULL)::INT) OVER (PARTITION BY s.source_id) AS roots FROM s LEFT JOIN s p ON p.snapshot_id = s.previous_id)
  SELECT source_id, snapshot_id, 'SEVERAL_ROOTS' AS reason FROM j WHERE roots <> 1 AND previous_id IS NULL UNION ALL SELECT source_id, snapshot_id, 'FORK' FROM j WHERE children > 1 UNION ALL SELECT source_id, snapshot_id, 'UNKNOWN_PREVIOUS' FROM j WHERE previous_id IS NOT NULL AND ps IS NULL
  UNION ALL SELECT source_id, snapshot_id, 'OTHER_SOURCE' FROM j WHERE ps <> source_id UNION ALL SELECT source_id, snapshot_id, 'TIME_NOT_INCREASING' FROM j WHERE before >= retrieved_at""")
book.add("gr10_heads", G.lineage_heads, ["v_snapshots"], "SELECT source_id, snapshot_id FROM v_snapshots WHERE snapshot_id NOT IN (SELECT previous_id FROM v_snapshots WHERE previous_id IS NOT NULL)")
RINGS = "SELECT snapshot_id, source_id, CASE WHEN snapshot_id % 29 = 0 THEN lead(snapshot_id) OVER (PARTITION BY source_id ORDER BY retrieved_at, snapshot_id) WHEN snapshot_id % 17 = 0 THEN -snapshot_id ELSE previous_id END AS previous_id, retrieved_at FROM v_snapshots"
book.add("gr10_chain", G.lineage_chain, [RINGS], f"""WITH RECURSIVE s AS ({RINGS}), l AS (SELECT s.*, p.snapshot_id AS parent FROM s LEFT JOIN s p ON p.snapshot_id = s.previous_id AND p.source_id = s.source_id),
  r(snapshot_id, pos, root) AS (SELECT snapshot_id, 0::BIGINT, previous_id IS NULL FROM l WHERE parent IS NULL UNION ALL SELECT l.snapshot_id, pos + 1, root FROM r JOIN l ON l.parent = r.snapshot_id)
  SELECT l.source_id, l.snapshot_id, CASE WHEN root THEN pos END AS position, CASE WHEN pos IS NULL THEN 'CYCLE' WHEN root THEN 'ON_CHAIN' ELSE 'DISCONNECTED' END AS status FROM l LEFT JOIN r USING (snapshot_id)""")
book.add("gr10_without_root", G.sources_without_root, [RINGS], f"SELECT source_id FROM ({RINGS}) GROUP BY 1 HAVING count(*) FILTER (WHERE previous_id IS NULL) = 0")
book.add("gr11_ancestors", G.ancestors, ["v_snapshots", "SELECT snapshot_id FROM v_snapshots WHERE snapshot_id % 101 = 0"], "WITH RECURSIVE r(snapshot_id) AS (SELECT snapshot_id FROM v_snapshots WHERE snapshot_id % 101 = 0 UNION SELECT previous_id FROM r JOIN v_snapshots USING (snapshot_id) WHERE previous_id IS NOT NULL) SELECT snapshot_id FROM r")
book.add("gr12_degrees", G.node_degrees, ["v_edges"], "SELECT node, count(*) AS degree, count(*) > 8 AS over FROM (SELECT from_node AS node FROM v_edges UNION ALL SELECT to_node FROM v_edges) GROUP BY node")
POS = "SELECT station_id % 200 AS station_id, concat('L', line_id) AS line_id, x, y, station_id AS seq FROM v_positions"
book.add("gr13_nodes", lambda d: G.physical_graph(d)[0].select("station_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y")), [POS], "SELECT station_id % 200 AS station_id, round(avg(x), 6) AS x, round(avg(y), 6) AS y FROM v_positions GROUP BY 1")
book.add("gr13_edges", lambda d: G.physical_graph(d)[1], [POS], f"""WITH p AS ({POS}), e AS (SELECT line_id, station_id AS a, lead(station_id) OVER (PARTITION BY line_id ORDER BY seq, station_id) AS b FROM p), u AS (SELECT line_id, least(a, b) AS from_station, greatest(a, b) AS to_station FROM e WHERE b IS NOT NULL AND a <> b)
  SELECT from_station, to_station, string_agg(DISTINCT line_id, ',' ORDER BY line_id) AS lines FROM u GROUP BY 1, 2""")
