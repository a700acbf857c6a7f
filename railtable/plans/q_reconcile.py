"""Reconciliation operators bound to the driver's tables."""

from pyspark.sql import functions as F

from railtable.operators import digests as D
from railtable.operators import reconcile as R
from railtable.plans.bind import Book, canonical

book = Book()
QUERIES, ORACLES = book.queries, book.oracles
ROSTER = "SELECT p_partkey AS station_id, concat(p_name, '(', p_size, ')') AS name, array(concat(p_name, ' alt', p_partkey, '역')) AS aliases, p_brand AS line_id, p_type AS line_name FROM part WHERE p_partkey % 3 = 0"
NAMED = "SELECT p_partkey AS row_id, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE concat(p_name, ' alt', p_partkey) END AS raw_name, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_type END AS raw_line FROM part"
_N = r"regexp_replace({}, '[·.\s]', '', 'g')"
book.add("jn01_match_roster", lambda a, b: R.match_roster(a, b).select("row_id", "n_candidates", "match_status", "station_id", "n_lines", "line_id"), [NAMED, ROSTER], f"""WITH k AS (SELECT p_partkey AS station_id, {_N.format('p_name')} AS key FROM part WHERE p_partkey % 3 = 0 UNION SELECT p_partkey, {_N.format("concat(p_name, ' alt', p_partkey)")} FROM part WHERE p_partkey % 3 = 0),
  r AS ({NAMED}), c AS (SELECT row_id, raw_line, count(DISTINCT station_id) AS n, min(station_id) AS s FROM r LEFT JOIN k ON key = {_N.format('raw_name')} GROUP BY 1, 2), m AS (SELECT *, CASE WHEN n = 1 THEN s END AS station_id FROM c)
  SELECT row_id, n AS n_candidates, CASE WHEN n = 0 THEN 'unmatched' WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END AS match_status, station_id, (p_partkey IS NOT NULL)::BIGINT AS n_lines, p_brand AS line_id FROM m LEFT JOIN part ON p_partkey = station_id AND (raw_line = p_brand OR raw_line = p_type)""")
TUP = "SELECT concat('op', c_nationkey % 6) AS operator, c_mktsegment AS line, CASE WHEN c_custkey % 37 = 0 THEN '' ELSE concat('n', c_custkey % 40) END AS name FROM customer"
MAP = "SELECT concat('op', n_nationkey % 6) AS operator, c_mktsegment AS line, concat('L', n_regionkey % 3) AS line_id FROM nation JOIN (SELECT DISTINCT c_mktsegment FROM customer) AS m ON n_nationkey % 5 = length(c_mktsegment) % 5"
STA = "SELECT concat('L', s_suppkey % 3) AS line_id, concat('n', s_suppkey % 50) AS name, s_suppkey AS station_id FROM supplier"
book.add("jn02_partition_tuples", R.partition_tuples, [TUP, MAP, STA], f"""WITH t AS (SELECT operator, line, name, count(*) AS n_rows FROM ({TUP}) GROUP BY 1, 2, 3), m AS (SELECT operator, line, count(DISTINCT line_id) AS lines, min(line_id) AS line_id FROM ({MAP}) GROUP BY 1, 2),
  s AS (SELECT line_id, name, count(DISTINCT station_id) AS k, min(station_id) AS sid FROM ({STA}) GROUP BY 1, 2), j AS (SELECT t.*, lines, k, sid, CASE WHEN t.name = '' THEN 'NAME_MISSING' WHEN lines IS NULL THEN 'LINE_UNMAPPED' WHEN lines > 1 THEN 'LINE_AMBIGUOUS' WHEN k IS NULL THEN 'STATION_NOT_ON_LINE' WHEN k > 1 THEN 'STATION_AMBIGUOUS' END AS reason
  FROM t LEFT JOIN m USING (operator, line) LEFT JOIN s ON s.line_id = m.line_id AND s.name = t.name)
  SELECT operator, line, name, n_rows, CASE WHEN reason IS NULL THEN 'JOINED' WHEN reason LIKE '%AMBIGUOUS' THEN 'AMBIGUOUS' ELSE 'UNMATCHED' END AS status, reason, CASE WHEN reason IS NULL THEN sid END AS station_id FROM j""")
MK = ["SELECT p_partkey AS row_id, p_name AS name, p_size * 7 AS code FROM part", "SELECT p_name AS name, p_partkey AS station_id FROM part WHERE p_partkey % 40 = 1", "SELECT s_suppkey AS code, s_suppkey AS station_id FROM supplier", "SELECT p_partkey AS row_id, p_partkey AS station_id FROM part WHERE p_partkey % 26 = 0"]
_MK = f"r AS ({MK[0]}), c AS (SELECT row_id, station_id FROM r JOIN ({MK[1]}) USING (name) UNION SELECT row_id, station_id FROM r JOIN ({MK[2]}) USING (code) UNION {MK[3]}), m AS (SELECT row_id, count(c.station_id) AS n_candidates, CASE WHEN count(c.station_id) = 1 THEN min(c.station_id) END AS station_id, CASE count(c.station_id) WHEN 0 THEN 'unmatched' WHEN 1 THEN 'matched' ELSE 'ambiguous' END AS match_status FROM r LEFT JOIN c USING (row_id) GROUP BY row_id)"
book.add("jn03_multi_key", R.multi_key_match, MK, f"WITH {_MK} SELECT * FROM m")
book.add("jn03_never_covered", lambda a, b, c, d, e: R.never_covered(e, R.multi_key_match(a, b, c, d)), [*MK, "SELECT s_suppkey AS station_id FROM supplier"], f"WITH {_MK} SELECT s_suppkey AS station_id FROM supplier WHERE s_suppkey NOT IN (SELECT station_id FROM m WHERE match_status = 'matched')")
LAB = ["SELECT c_custkey AS label_id, concat('n', c_custkey % 70) AS name FROM customer", "SELECT concat('n', s_suppkey % 60) AS name, s_suppkey AS station_id FROM supplier", "SELECT c_custkey AS label_id, c_custkey % 50 AS station_id FROM customer WHERE c_custkey % 8 = 0"]
_LAB = f"l AS ({LAB[0]}), s AS ({LAB[1]}), v AS ({LAB[2]}), a AS (SELECT label_id, CASE WHEN count(DISTINCT station_id) = 1 THEN min(station_id) END AS station_id, CASE count(DISTINCT station_id) WHEN 0 THEN 'unmatched' WHEN 1 THEN 'matched' ELSE 'ambiguous' END AS match_status FROM l LEFT JOIN s USING (name) WHERE label_id NOT IN (SELECT label_id FROM v) GROUP BY 1), o AS (SELECT label_id, station_id, 'reviewed' AS match_status FROM v UNION ALL SELECT * FROM a)"
book.add("jn04_match_labels", lambda a, b, c: R.match_labels(a, b, c)[0], LAB, f"WITH {_LAB} SELECT * FROM o")
book.add("jn04_unlabelled", lambda a, b, c: R.match_labels(a, b, c)[1], LAB, f"WITH {_LAB} SELECT station_id FROM s WHERE station_id NOT IN (SELECT station_id FROM o WHERE station_id IS NOT NULL)")
PRO = "SELECT p_brand AS line_id, p_partkey AS seq, CASE WHEN p_partkey % 12 = 0 THEN 'x' ELSE concat(p_name, '역') END AS name FROM part WHERE p_partkey % 10 > 0"
CAN = "SELECT p_brand AS line_id, p_partkey AS seq, p_partkey AS station_id, concat(p_name, '[', p_size, ']') AS name FROM part WHERE p_partkey % 14 > 0"
book.add("jn05_ordinal", R.ordinal_mapping, [PRO, CAN], "SELECT p_brand AS line_id, p_partkey AS seq, CASE WHEN p_partkey % 14 > 0 THEN p_partkey END AS station_id, CASE WHEN p_partkey % 10 = 0 THEN 'NOT_AT_PROVIDER' WHEN p_partkey % 14 = 0 THEN 'NOT_CANONICAL' WHEN p_partkey % 12 = 0 THEN 'NAME_DIFFERS' END AS reason FROM part WHERE p_partkey % 10 > 0 OR p_partkey % 14 > 0")
COD = "SELECT s_suppkey % 90 AS code, s_suppkey % 95 AS station_id, CASE WHEN s_suppkey % 10 = 0 THEN 'RETIRED' WHEN s_suppkey % 15 = 1 THEN 'PLANNED' ELSE 'ACTIVE' END AS state, CASE WHEN s_suppkey % 4 = 0 THEN 'e' END AS evidence FROM supplier"
USE = "SELECT c_custkey % 110 AS code FROM customer"
book.add("jn06_code_lookup", R.code_lookup, [USE, COD], f"""WITH m AS ({COD}), n AS (SELECT *, count(*) OVER (PARTITION BY code) AS n FROM m) SELECT DISTINCT code, 'DUPLICATE_CODE' AS reason FROM n WHERE n > 1 UNION SELECT code, 'NO_EVIDENCE' FROM n WHERE state <> 'ACTIVE' AND evidence IS NULL
  UNION SELECT code, 'RETIRED_ID_REUSED' FROM n WHERE state = 'ACTIVE' AND station_id IN (SELECT station_id FROM m WHERE state = 'RETIRED') UNION SELECT code, 'UNMAPPED' FROM ({USE}) WHERE code NOT IN (SELECT code FROM m)""")
RAWE = "SELECT l_orderkey * 10 + l_linenumber AS edge_id, l_suppkey AS from_code, l_partkey % 130 AS to_code, CASE WHEN l_linenumber > 2 THEN l_linenumber * 30 END AS seconds, CASE WHEN l_linenumber = 1 THEN 'EXPRESS' END AS pattern FROM lineitem"
book.add("jn07_assemble_edges", R.assemble_edges, [RAWE, "SELECT s_suppkey AS code, s_suppkey + 1000 AS station_id FROM supplier WHERE s_suppkey % 6 > 0"], f"SELECT edge_id, from_code + 1000 AS from_station, to_code + 1000 AS to_station, coalesce(seconds, 120) AS seconds, coalesce(pattern, 'LOCAL') AS pattern FROM ({RAWE}) JOIN supplier a ON a.s_suppkey = from_code AND from_code % 6 > 0 JOIN supplier b ON b.s_suppkey = to_code AND to_code % 6 > 0")
book.add("jn08_missing_evidence", R.missing_evidence, ["SELECT p_partkey AS station_line FROM part", "SELECT r_name AS facility_type FROM region", "SELECT p_partkey AS station_line, r_name AS facility_type FROM part JOIN region ON (p_partkey + r_regionkey) % 3 > 0"], "SELECT p_partkey AS station_line, r_name AS facility_type FROM part, region WHERE (p_partkey + r_regionkey) % 3 = 0")
book.add("jn08_scope", lambda a, b: R.scope_differences(a, b, "id"), ["SELECT p_partkey % 700 AS id FROM part", "SELECT c_custkey * 2 AS id FROM customer"], "SELECT DISTINCT p_partkey % 700 AS id, 'OUT_OF_SCOPE' AS reason FROM part WHERE p_partkey % 700 NOT IN (SELECT c_custkey * 2 FROM customer) UNION ALL SELECT c_custkey * 2, 'NO_ROWS' FROM customer WHERE c_custkey * 2 NOT IN (SELECT p_partkey % 700 FROM part)")
EE = "SELECT l_orderkey * 10 + l_linenumber AS edge_id, CASE WHEN l_linenumber % 2 = 0 THEN concat(l_suppkey, '') ELSE concat(l_suppkey, ':', l_returnflag) END AS from_node, CASE WHEN l_linenumber % 3 = 0 THEN concat(l_suppkey, '') ELSE concat(l_suppkey + l_linenumber % 4, ':', l_returnflag) END AS to_node, CASE l_linestatus WHEN 'O' THEN 'ENTRY' ELSE 'EXIT' END AS edge_type FROM lineitem"
SLN = "SELECT DISTINCT l_suppkey AS station_id, l_returnflag AS line_id FROM lineitem WHERE l_suppkey % 11 > 0"
book.add("jn09_endpoints", R.endpoint_violations, [EE, SLN], f"""WITH e AS ({EE}), s AS ({SLN}), n AS (SELECT DISTINCT concat(station_id, ':', line_id) AS node, 'LINE' AS kind FROM s UNION SELECT concat(station_id, ''), 'STATION' FROM s), j AS (SELECT e.*, a.kind AS fk, b.kind AS tk, split_part(from_node, ':', 1) = split_part(to_node, ':', 1) AS same FROM e LEFT JOIN n a ON a.node = from_node LEFT JOIN n b ON b.node = to_node)
  SELECT edge_id, 'UNKNOWN_FROM' AS reason FROM j WHERE fk IS NULL UNION ALL SELECT edge_id, 'UNKNOWN_TO' FROM j WHERE tk IS NULL UNION ALL SELECT edge_id, 'BAD_ENTRY' FROM j WHERE edge_type = 'ENTRY' AND NOT (fk = 'STATION' AND tk = 'LINE' AND same) UNION ALL SELECT edge_id, 'BAD_EXIT' FROM j WHERE edge_type = 'EXIT' AND NOT (fk = 'LINE' AND tk = 'STATION' AND same)""")
AE = "SELECT event_id AS edge_id, CASE event_id % 3 WHEN 0 THEN 'ENTRY' WHEN 1 THEN 'EXIT' ELSE 'RIDE' END AS edge_type, CASE event_id % 4 WHEN 0 THEN 'AVAILABLE' WHEN 1 THEN 'UNDER_MAINTENANCE' WHEN 2 THEN 'NO_OFFICIAL_FEED' ELSE 'GUESS' END AS status FROM events"
EV = "SELECT event_id AS edge_id, CASE user_id % 3 WHEN 0 THEN 'OPERATION' WHEN 1 THEN 'MAINTENANCE_NOTICE' ELSE 'FEED_SEARCH' END AS kind FROM events"
book.add("jn19_access_gate", R.accessibility_gate, [AE, EV], """SELECT event_id AS edge_id, CASE event_id % 4 WHEN 0 THEN 'LACKS_OPERATION' WHEN 1 THEN 'LACKS_MAINTENANCE_NOTICE' WHEN 2 THEN 'LACKS_FEED_SEARCH' ELSE 'STATUS_UNPROVEN' END AS reason FROM events WHERE event_id % 3 < 2 AND (event_id % 4 = 3 OR event_id % 4 <> user_id % 3)""")
LN = lambda cond: f"SELECT p_brand AS line_id, p_name AS name, p_partkey AS station_id FROM part WHERE {cond}"
book.add("jn20_missing_stations", R.missing_stations, [LN("TRUE"), LN("p_size % 4 = 0"), LN("p_partkey % 50 = 0"), LN("p_size % 9 = 0")], "SELECT DISTINCT p_brand AS line_id, p_name AS name FROM part EXCEPT SELECT p_brand, p_name FROM part WHERE p_size % 4 = 0 OR p_partkey % 50 = 0 OR p_size % 9 = 0")
book.add("jn20_name_collisions", R.name_collisions, [LN("TRUE")], f"SELECT p_brand AS line_id, {_N.format('p_name')} AS key, count(DISTINCT p_partkey) AS n FROM part GROUP BY 1, 2 HAVING n > 1")
book.add("jn21_rename_check", R.rename_check, ["SELECT concat('n', s_suppkey) AS old_name, concat('n', s_suppkey + 3) AS new_name FROM supplier", "SELECT concat('n', s_suppkey) AS name FROM supplier WHERE s_suppkey % 5 < 2"], """WITH r AS (SELECT concat('n', s_suppkey) AS old_name, concat('n', s_suppkey + 3) AS new_name FROM supplier), t AS (SELECT concat('n', s_suppkey) AS name FROM supplier WHERE s_suppkey % 5 < 2), f AS (SELECT *, old_name IN (SELECT name FROM t) AS o, new_name IN (SELECT name FROM t) AS n FROM r)
  SELECT old_name, new_name, CASE WHEN n AND NOT o THEN 'ADOPTED' WHEN o AND NOT n THEN 'STALE' WHEN o THEN 'BOTH' ELSE 'NEITHER' END AS status FROM f""")
book.add("jn22_allow_list", lambda a, b: R.not_listed(a, b, "from_node", "to_node"), ["v_edges", "SELECT to_node AS from_node, from_node AS to_node FROM v_edges WHERE from_node % 3 = 0"], "SELECT * FROM v_edges e WHERE NOT EXISTS (SELECT 1 FROM v_edges a WHERE a.from_node % 3 = 0 AND least(a.from_node, a.to_node) = least(e.from_node, e.to_node) AND greatest(a.from_node, a.to_node) = greatest(e.from_node, e.to_node))")
book.add("jn23_work_plan", lambda s, d: R.work_plan(s, ["01", "02", "03"], ["U", "D"], d, 50), ["SELECT p_partkey AS station_id FROM part", "SELECT p_partkey AS station_id, '02' AS day_type, 'U' AS direction FROM part WHERE p_size % 3 = 0"], """WITH f AS (SELECT p_partkey AS station_id, d AS day_type, r AS direction FROM part, (VALUES ('01'), ('02'), ('03')) a(d), (VALUES ('U'), ('D')) b(r) WHERE NOT (d = '02' AND r = 'U' AND p_size % 3 = 0))
  SELECT *, ceil(row_number() OVER (ORDER BY station_id, day_type, direction) / 50.0)::BIGINT AS batch FROM f""")
book.add("jn24_search_plan", R.search_plan, ["SELECT p_partkey AS line_id, p_size % 2 = 0 AS active FROM part", "SELECT n_name AS domain FROM nation", "SELECT p_partkey AS line_id, n_name AS domain FROM part JOIN nation ON p_partkey % 25 <> n_nationkey", "SELECT n_name AS domain, r_name AS term FROM nation JOIN region ON r_regionkey <= n_regionkey"], "SELECT p_partkey AS line_id, n_name AS domain, r_name AS term FROM part JOIN nation ON p_partkey % 25 = n_nationkey AND p_size % 2 = 0 JOIN region ON r_regionkey <= n_regionkey")
PB = ["SELECT DISTINCT l_suppkey AS station_id, l_returnflag AS from_line, l_linestatus AS to_line, l_linenumber * 60 AS seconds FROM lineitem", "SELECT l_suppkey AS station_id, l_linestatus AS from_line, l_returnflag AS to_line FROM lineitem WHERE l_suppkey % 4 = 0 AND l_returnflag = 'N'", "SELECT s_suppkey AS station_id, 'A' AS line_id, concat('pA', s_suppkey) AS node FROM supplier UNION ALL SELECT s_suppkey AS station_id, 'F' AS line_id, concat('pF', s_suppkey) AS node FROM supplier WHERE s_suppkey % 2 = 0"]
book.add("jn25_pathway_baseline", R.pathway_baseline, PB, f"""WITH p AS ({PB[0]}), x AS ({PB[1]}), f AS ({PB[2]}), n AS (SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.station_id = p.station_id AND least(x.from_line, x.to_line) = least(p.from_line, p.to_line) AND greatest(x.from_line, x.to_line) = greatest(p.from_line, p.to_line)))
  SELECT n.*, a.node AS from_node, b.node AS to_node, CASE WHEN a.node IS NULL OR b.node IS NULL THEN 'NO_PLATFORM_NODE' END AS reason FROM n LEFT JOIN f a ON a.station_id = n.station_id AND a.line_id = from_line LEFT JOIN f b ON b.station_id = n.station_id AND b.line_id = to_line""")
book.add("jn26_od_matrix", R.od_matrix, ["SELECT s_suppkey AS station_id FROM supplier"], "SELECT a.s_suppkey AS origin, b.s_suppkey AS destination FROM supplier a, supplier b WHERE a.s_suppkey <> b.s_suppkey")
SUP = "SELECT s_suppkey AS station_id FROM supplier"


def _tree(name: str, source: str, text: str, fan: int = 1000) -> str:
    """CTEs of a hash tree over one set, of up to fan ** 3 texts; name_r holds n and digest."""
    level = lambda n, of: f"{name}_{n} AS (SELECT k // {fan} AS k, sha256(string_agg(h, '' ORDER BY k)) AS h, sum(n)::BIGINT AS n FROM {name}_{of} GROUP BY 1)"
    return f"""{name}_0 AS (SELECT row_number() OVER (ORDER BY t) - 1 AS k, sha256(t) AS h, 1 AS n FROM (SELECT {text} AS t FROM {source})), {level(1, 0)}, {level(2, 1)}, {level(3, 2)},
  {name}_r AS (SELECT n, h AS digest FROM (SELECT * FROM {name}_1 WHERE (SELECT count(*) FROM {name}_1) = 1 UNION ALL SELECT * FROM {name}_2 WHERE (SELECT count(*) FROM {name}_1) > 1 AND (SELECT count(*) FROM {name}_2) = 1 UNION ALL SELECT * FROM {name}_3 WHERE (SELECT count(*) FROM {name}_2) > 1))"""


_OD = "(SELECT a.s_suppkey AS o, b.s_suppkey AS d FROM supplier a, supplier b WHERE a.s_suppkey <> b.s_suppkey)"
book.add("jn26_od_digests", D.od_matrix_digests, [SUP], f"""WITH {_tree("s", "supplier", "to_json([s_suppkey::VARCHAR])::VARCHAR")}, {_tree("p", _OD, "to_json([o::VARCHAR, d::VARCHAR])::VARCHAR")}
  SELECT s_r.n AS stations, s_r.n * (s_r.n - 1) AS expected, p_r.n AS pairs, s_r.n * (s_r.n - 1) = p_r.n AS complete, s_r.digest AS station_digest, p_r.digest AS pair_digest FROM s_r, p_r""")
book.add("dq09_tree_digest", lambda d: D.tree_digest(d, [], F.to_json(F.array("trip_id", F.col("stop_no").cast("string"), F.col("station_id").cast("string")))), ["v_stops"], f"""WITH {_tree("t", "v_stops", "to_json([trip_id, stop_no::VARCHAR, station_id::VARCHAR])::VARCHAR")} SELECT * FROM t_r""")
ND = ["SELECT c_custkey AS node_id, concat('n', c_custkey % 80) AS name, concat('L', c_nationkey % 4) AS line_id FROM customer", "SELECT concat('n', s_suppkey % 60) AS name, s_suppkey AS station_id, concat('L', s_nationkey % 4) AS line_id FROM supplier"]
book.add("jn27_assign_nodes", R.assign_nodes, ND, f"WITH n AS ({ND[0]}), s AS ({ND[1]}) SELECT node_id, station_id, coalesce(s.line_id = n.line_id, false) AS on_line FROM n LEFT JOIN s USING (name) QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY CASE WHEN s.line_id = n.line_id THEN 0 ELSE 1 END, station_id NULLS LAST) = 1")
SPR = "SELECT station_id % 150 AS station_id, x, y FROM v_positions"
EXM = "SELECT s_suppkey AS station_id, CAST(s_suppkey % 40 * 100 AS DOUBLE) AS max_spread FROM supplier WHERE s_suppkey % 3 = 0"
_SPR = f"WITH p AS ({SPR}), b AS (SELECT a.station_id, max(sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2))) AS spread FROM p a JOIN p b ON a.station_id = b.station_id GROUP BY 1)"
book.add("jn27_spread", lambda d: R.spread_violations(d, 500.0).withColumn("spread", F.round("spread", 6)), [SPR], f"{_SPR} SELECT station_id, round(spread, 6) AS spread FROM b WHERE spread > 500")
book.add("jn27_spread_exempt", lambda d, e: R.spread_violations(d, 500.0, e).withColumn("spread", F.round("spread", 6)), [SPR, EXM], f"{_SPR} SELECT b.station_id, round(spread, 6) AS spread FROM b LEFT JOIN ({EXM}) e USING (station_id) WHERE spread > coalesce(max_spread, 500)")
MN = "SELECT c_custkey AS node_id, concat('n', c_custkey % 70) AS name, CASE WHEN c_custkey % 9 > 0 THEN concat('L', c_nationkey % 4) END AS line_id, c_custkey % 5 = 0 AS by_line, c_custkey * 7 % 900 AS x, c_custkey * 13 % 700 AS y FROM customer"
ML = "SELECT concat('n', p_partkey % 90) AS name, p_partkey * 3 % 900 AS x, p_partkey * 5 % 700 AS y FROM part"
MS_ = "SELECT s_suppkey AS station_id, concat('n', s_suppkey % 60) AS name, concat('L', s_nationkey % 4) AS line_id, CASE WHEN s_suppkey % 3 = 0 THEN 'here' ELSE 'there' END AS region FROM supplier UNION ALL SELECT s_suppkey AS station_id, concat('n', s_suppkey % 60) AS name, concat('L', s_suppkey % 7) AS line_id, 'there' AS region FROM supplier UNION ALL SELECT -1 - n_nationkey AS station_id, concat('n', n_nationkey + 60) AS name, 'L1' AS line_id, 'there' AS region FROM nation"
_MN = f"""WITH n AS ({MN}), l AS ({ML}), s AS ({MS_}), g AS (SELECT name, station_id, list(line_id) AS lines, max((region = 'here')::INT) AS here, count(*) OVER (PARTITION BY name) AS k FROM s GROUP BY 1, 2),
  m AS (SELECT node_id, name, line_id, by_line, x, y, 'NODE' AS source FROM n UNION ALL SELECT NULL, name, NULL, false, x, y, 'LABEL' FROM l),
  f AS (SELECT m.*, station_id, k FROM m LEFT JOIN g ON g.name = m.name AND NOT (by_line AND line_id IS NULL) AND (k = 1 OR CASE WHEN by_line THEN list_contains(lines, line_id) ELSE here = 1 END)),
  c AS (SELECT DISTINCT CASE WHEN by_line AND k > 1 THEN min(station_id) OVER (PARTITION BY source, node_id, name, x, y) ELSE station_id END AS station_id, source, node_id, x, y, name FROM f WHERE station_id IS NOT NULL OR source = 'NODE')"""
book.add("jn27_candidates", lambda n, l, s: R.node_candidates(n, l, s, "here"), [MN, ML, MS_], f"{_MN} SELECT DISTINCT station_id, source, node_id, x, y FROM c")
book.add("jn27_assignments", lambda n, l, s: R.first_assignments(n, l, s, "here"), [MN, ML, MS_], f"{_MN} SELECT station_id, source, node_id, x, y FROM c WHERE station_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY source = 'LABEL', node_id, x, y) = 1")
RC = ["SELECT p_partkey AS station_id, p_brand AS line_id FROM part WHERE p_partkey % 7 > 0", "SELECT p_partkey AS station_id, p_brand AS line_id FROM part WHERE p_partkey % 5 > 0", "SELECT p_partkey AS station_id, p_brand AS line_id FROM part WHERE p_size < 10"]
book.add("jn28_reconcile", R.reconcile_catalog, RC, "SELECT p_partkey AS station_id, p_brand AS line_id, CASE WHEN p_partkey % 5 = 0 THEN 'UNASSIGNED' ELSE 'ORPHAN' END AS reason FROM part WHERE (p_partkey % 7 > 0) <> (p_partkey % 5 > 0) AND p_size >= 10")
PP = ["SELECT p_brand AS line_id, p_partkey AS name FROM part", "SELECT p_brand AS line_id, p_partkey AS name, p_size AS x, 1 AS y FROM part WHERE p_partkey % 3 = 0 AND p_size < 30 AND p_brand < 'Brand#30' UNION ALL SELECT 'other' AS line_id, p_partkey AS name, 7 AS x, 2 AS y FROM part WHERE p_partkey % 11 = 0", "SELECT p_brand AS line_id, p_partkey AS name, 9 AS x, 3 AS y FROM part WHERE p_partkey % 2 = 0"]
book.add("jn29_precedence", R.positions_by_precedence, PP, f"""WITH r AS ({PP[0]}), o AS ({PP[1]}), m AS ({PP[2]}), a AS (SELECT name, arg_min(x, line_id) AS x, arg_min(y, line_id) AS y FROM o GROUP BY name)
  SELECT r.line_id, r.name, coalesce(o.x, a.x, CASE WHEN r.line_id NOT IN (SELECT line_id FROM o) THEN m.x END) AS x, coalesce(o.y, a.y, CASE WHEN r.line_id NOT IN (SELECT line_id FROM o) THEN m.y END) AS y,
  CASE WHEN o.x IS NOT NULL THEN 'OFFICIAL' WHEN a.x IS NOT NULL THEN 'OFFICIAL_OTHER_LINE' WHEN r.line_id NOT IN (SELECT line_id FROM o) AND m.x IS NOT NULL THEN 'MAP' END AS position_source FROM r LEFT JOIN o USING (line_id, name) LEFT JOIN a ON a.name = r.name LEFT JOIN m ON m.line_id = r.line_id AND m.name = r.name""")
GP = ["SELECT n_nationkey AS gap_id, concat('op', n_regionkey) AS operator, 'L1' AS line, concat('n', n_nationkey) AS name FROM nation", "SELECT concat('op', c_nationkey % 5) AS operator, 'L1' AS line, concat('n', c_custkey % 40) AS name, c_custkey AS row_no FROM customer WHERE c_custkey % 3 > 0"]
book.add("jn32_gap_evidence", lambda g, r: R.gap_evidence(g, r, F.col("operator") != "op0"), GP, f"""WITH g AS ({GP[0]}), r AS ({GP[1]}), j AS (SELECT gap_id, g.operator, count(r.row_no) AS n_rows, sha256(string_agg(sha256({canonical(line='r.line', name='r.name', operator='r.operator', row_no='r.row_no')}), '' ORDER BY sha256({canonical(line='r.line', name='r.name', operator='r.operator', row_no='r.row_no')})) FILTER (WHERE row_no IS NOT NULL)) AS hash FROM g LEFT JOIN r USING (operator, line, name) GROUP BY 1, 2)
  SELECT gap_id, n_rows, hash, CASE WHEN operator = 'op0' THEN 'OUT_OF_SCOPE' WHEN n_rows > 0 THEN 'MATCHED' ELSE 'UNMATCHED' END AS status FROM j""")
CD = ["SELECT CASE WHEN c_custkey % 17 = 0 THEN c_nationkey ELSE c_custkey + 100 END AS region, c_mktsegment AS domain FROM customer", "SELECT s_nationkey AS region, 'BUILDING' AS domain FROM supplier"]
book.add("jn33_declarations", lambda a, b: R.coverage_declarations(a, b, ["region", "domain"]), CD, f"WITH d AS ({CD[0]}), s AS (SELECT DISTINCT * FROM ({CD[1]})) SELECT region, domain, 'DUPLICATE' AS reason FROM d GROUP BY 1, 2 HAVING count(*) > 1 UNION ALL (SELECT region, domain, 'UNSUPPORTED' FROM d EXCEPT SELECT region, domain, 'UNSUPPORTED' FROM s) UNION ALL (SELECT region, domain, 'MISSING' FROM s EXCEPT SELECT region, domain, 'MISSING' FROM d)")
SCOPES = ["SELECT CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE p_size + 20 END AS id FROM part", "SELECT CASE WHEN p_partkey % 3 = 0 THEN p_size ELSE p_size + 35 END AS id FROM part"]
book.add("jn34_scope_equality", lambda a, b: R.scope_equality({"roster": a, "queried": b}, ["id"]), SCOPES, "(SELECT id, 'roster' AS has, 'queried' AS lacks FROM ({0}) EXCEPT ALL SELECT id, 'roster', 'queried' FROM ({1})) UNION ALL (SELECT id, 'queried', 'roster' FROM ({1}) EXCEPT ALL SELECT id, 'queried', 'roster' FROM ({0}))".format(*SCOPES))
