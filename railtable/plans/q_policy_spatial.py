"""Policy and spatial operators bound to the driver's tables."""

from pyspark.sql import functions as F

from railtable.operators import policy as P
from railtable.operators import spatial as S
from railtable.plans.bind import Book

book = Book()
QUERIES, ORACLES = book.queries, book.oracles
AT = 1_704_200_000
SRC = "SELECT snapshot_id AS source_id, CASE WHEN snapshot_id % 5 = 0 THEN 'd' WHEN snapshot_id % 5 = 1 THEN 's' WHEN snapshot_id % 5 = 2 THEN 'none' WHEN snapshot_id % 35 = 3 THEN 'bad' ELSE 'w' END AS class_id, retrieved_at AS basis_at, CASE WHEN snapshot_id % 7 = 0 THEN retrieved_at + 1000 END AS provider_end, CASE WHEN snapshot_id % 3 = 0 THEN retrieved_at END AS stored_expiry FROM v_snapshots"
POL = "SELECT 'd' AS class_id, 'P30D' AS cadence UNION ALL SELECT 's' AS class_id, 'PT300S' AS cadence UNION ALL SELECT 'w' AS class_id, 'P7D' AS cadence UNION ALL SELECT 'bad' AS class_id, '7 days' AS cadence"
NOW = 850_000_000
book.add("pl01_freshness", lambda a, b: P.freshness(a, b, NOW), [SRC, POL], f"""WITH s AS ({SRC}), e AS (SELECT *, basis_at + CASE class_id WHEN 'd' THEN 2592000 WHEN 's' THEN 300 WHEN 'w' THEN 604800 END AS e FROM s), x AS (SELECT source_id, class_id, basis_at, stored_expiry, CASE WHEN e IS NOT NULL THEN least(e, coalesce(provider_end, e)) END AS expires_at FROM e)
  , r AS (SELECT source_id, expires_at, CASE WHEN class_id = 'none' THEN 'NO_POLICY' WHEN class_id = 'bad' THEN 'BAD_CADENCE' WHEN basis_at > {NOW} + 300 THEN 'FUTURE_BASIS' WHEN stored_expiry <> expires_at THEN 'STORED_EXPIRY_DIFFERS' END AS reason FROM x)
  SELECT source_id, expires_at, CASE WHEN reason IS NOT NULL THEN 'INVALID' WHEN expires_at <= {NOW} THEN 'STALE' ELSE 'FRESH' END AS state, reason FROM r""")
book.add("pl02_remaining", lambda d: P.remaining_class(d, AT), ["v_status"], f"SELECT facility_id, seq, expires_at - {AT} AS remaining, CASE WHEN expires_at <= {AT} THEN 'EXPIRED' WHEN expires_at - {AT} <= 172800 THEN 'CRITICAL' WHEN expires_at - {AT} <= 604800 THEN 'WARNING' ELSE 'OK' END AS class, expires_at - {AT} <= 604800 AS refresh FROM v_status")
GOV = "SELECT s_suppkey AS source_id, CASE WHEN s_suppkey % 4 > 0 THEN 'team' ELSE ' ' END AS owner, CASE WHEN s_suppkey % 3 > 0 THEN 'FRESH' ELSE 'STALE' END AS state, s_suppkey % 6 AS retention_days, CASE WHEN s_suppkey % 5 > 0 THEN 'KOGL' END AS licence, s_suppkey % 7 > 0 AS redistributable FROM supplier"
book.add("pl03_governance", P.governance, [GOV], """WITH r AS (SELECT s_suppkey AS source_id, list_sort(list_filter([CASE WHEN s_suppkey % 4 = 0 THEN 'OWNER_MISSING' END, CASE WHEN s_suppkey % 3 = 0 THEN 'STALE' END, CASE WHEN s_suppkey % 6 = 0 THEN 'RETENTION_MISSING' END, CASE WHEN s_suppkey % 5 = 0 THEN 'LICENCE_MISSING' END, CASE WHEN s_suppkey % 7 = 0 THEN 'REDISTRIBUTION_NOT_ALLOWED' END], lambda x: x IS NOT NULL)) AS l FROM supplier)
  SELECT source_id, array_to_string(l, ',') AS reasons, CASE WHEN len(l) = 0 THEN 'GO' ELSE 'NO_GO' END AS decision FROM r""")
PG = ["SELECT snapshot_id FROM v_snapshots WHERE snapshot_id % 9 > 0 UNION ALL SELECT -1 - n_nationkey AS snapshot_id FROM nation", "SELECT snapshot_id, retrieved_at, snapshot_id % 400 AS retention_days FROM v_snapshots", "SELECT snapshot_id FROM v_snapshots WHERE snapshot_id % 10 = 0"]
book.add("pl04_purge_plan", lambda a, b, c: P.purge_plan(a, b, c, NOW), PG, f"SELECT snapshot_id, CASE WHEN snapshot_id % 9 = 0 THEN 'RAW_MISSING' WHEN snapshot_id % 10 = 0 THEN 'PROTECTED' WHEN retrieved_at + snapshot_id % 400 * 86400 <= {NOW} THEN 'DELETE' ELSE 'NOT_EXPIRED' END AS disposition FROM v_snapshots UNION ALL SELECT -1 - n_nationkey, 'NOT_IN_LEDGER' FROM nation".replace("FROM v_snapshots UNION ALL", "FROM v_snapshots WHERE snapshot_id NOT IN (SELECT -1 - n_nationkey FROM nation) UNION ALL"))
OC = ["SELECT s_suppkey AS facility_id, s_nationkey AS station_id, 'AVAILABLE' AS status FROM supplier", "SELECT facility_id, CASE WHEN status = 'click' THEN 'AVAILABLE' ELSE 'UNDER_MAINTENANCE' END AS status, observed_at, seq FROM v_status", "SELECT p_partkey AS edge_id, p_partkey % 140 AS facility_id, 'AVAILABLE' AS status FROM part", "SELECT c_custkey AS rule_id, c_custkey % 1200 AS edge_id FROM customer"]
_OC = f"l AS (SELECT facility_id, status FROM ({OC[1]}) QUALIFY row_number() OVER (PARTITION BY facility_id ORDER BY observed_at DESC, seq DESC) = 1), f AS (SELECT s_suppkey AS facility_id, s_nationkey AS station_id, coalesce(l.status, 'AVAILABLE') AS status FROM supplier LEFT JOIN l ON l.facility_id = s_suppkey), e AS (SELECT p_partkey AS edge_id, p_partkey % 140 AS facility_id, coalesce(f.status, 'AVAILABLE') AS status FROM part LEFT JOIN f ON f.facility_id = p_partkey % 140)"
book.add("pl08_facilities", lambda *d: P.override_cascade(*d)["facilities"], OC, f"WITH {_OC} SELECT * FROM f")
book.add("pl08_edges", lambda *d: P.override_cascade(*d)["edges"], OC, f"WITH {_OC} SELECT * FROM e")
book.add("pl08_transfers", lambda *d: P.override_cascade(*d)["transfers"], OC, f"WITH {_OC} SELECT c_custkey AS rule_id, CASE WHEN coalesce(status, 'AVAILABLE') = 'AVAILABLE' THEN c_custkey % 1200 END AS step_free_edge FROM customer LEFT JOIN e ON edge_id = c_custkey % 1200")
book.add("pl08_stations", lambda *d: P.override_cascade(*d)["stations"], OC, f"WITH {_OC} SELECT station_id, count(*) AS facilities, count(*) FILTER (WHERE status = 'AVAILABLE') AS available FROM f GROUP BY 1")
book.add("pl08_orphans", lambda *d: P.override_cascade(*d)["orphans"], OC, f"WITH {_OC} SELECT facility_id FROM l WHERE facility_id NOT IN (SELECT s_suppkey FROM supplier)")
SEL = ["SELECT snapshot_id FROM v_snapshots WHERE snapshot_id % 30 = 0 UNION ALL SELECT snapshot_id FROM v_snapshots WHERE snapshot_id % 210 = 0 UNION ALL SELECT -5 - n_nationkey * 1000000 AS snapshot_id FROM nation", "v_snapshots", "SELECT c_custkey AS source_id FROM customer"]
book.add("pl10_select_snapshots", P.select_snapshots, SEL, f"""WITH w AS (SELECT snapshot_id, count(*) AS n FROM ({SEL[0]}) GROUP BY 1), j AS (SELECT w.*, source_id FROM w LEFT JOIN v_snapshots USING (snapshot_id)), k AS (SELECT source_id, count(*) AS k FROM j WHERE source_id IS NOT NULL GROUP BY 1)
  SELECT snapshot_id::VARCHAR AS id, 'UNKNOWN' AS reason FROM j WHERE source_id IS NULL UNION ALL SELECT snapshot_id::VARCHAR, 'TWICE' FROM j WHERE n > 1 UNION ALL SELECT snapshot_id::VARCHAR, 'NOT_HEAD' FROM j WHERE snapshot_id IN (SELECT previous_id FROM v_snapshots)
  UNION ALL SELECT c_custkey::VARCHAR, 'SOURCE_MISSING' FROM customer WHERE c_custkey NOT IN (SELECT source_id FROM k) UNION ALL SELECT source_id::VARCHAR, 'SOURCE_TWICE' FROM k JOIN customer ON c_custkey = source_id WHERE k > 1""")
SFR = ["SELECT snapshot_id FROM v_snapshots", "SELECT snapshot_id, source_id, retrieved_at AS basis_at, CASE WHEN snapshot_id % 7 = 0 THEN retrieved_at + 1000 END AS provider_end, CASE WHEN snapshot_id % 3 = 0 THEN retrieved_at END AS stored_expiry FROM v_snapshots",
  "SELECT c_custkey AS source_id, CASE WHEN c_custkey % 5 = 0 THEN 'd' WHEN c_custkey % 5 = 1 THEN 's' WHEN c_custkey % 5 = 2 THEN 'none' ELSE 'w' END AS class_id FROM customer WHERE c_custkey % 8 > 0 UNION ALL SELECT c_custkey AS source_id, 'w' AS class_id FROM customer WHERE c_custkey % 9 = 1", POL]
book.add("pl10_selection_freshness", lambda w, s, c, p: P.selection_freshness(w, s, c, p, NOW), SFR, f"""WITH s AS ({SFR[1]}), c AS (SELECT source_id, count(DISTINCT class_id) AS n, min(class_id) AS class_id FROM ({SFR[2]}) GROUP BY 1), j AS (SELECT s.*, n, class_id FROM s LEFT JOIN c USING (source_id)),
  e AS (SELECT *, basis_at + CASE class_id WHEN 'd' THEN 2592000 WHEN 's' THEN 300 WHEN 'w' THEN 604800 END AS e FROM j WHERE n = 1), x AS (SELECT *, CASE WHEN e IS NOT NULL THEN least(e, coalesce(provider_end, e)) END AS expires_at FROM e),
  r AS (SELECT snapshot_id, source_id, expires_at, CASE WHEN class_id = 'none' THEN 'NO_POLICY' WHEN basis_at > {NOW} + 300 THEN 'FUTURE_BASIS' WHEN stored_expiry <> expires_at THEN 'STORED_EXPIRY_DIFFERS' WHEN expires_at <= {NOW} THEN 'STALE' END AS reason FROM x)
  SELECT snapshot_id, source_id, reason FROM r WHERE reason IS NOT NULL UNION ALL SELECT snapshot_id, source_id, CASE WHEN n IS NULL THEN 'NO_CLASS' ELSE 'SEVERAL_CLASSES' END FROM j WHERE n IS NULL OR n > 1""")
book.add("pl11_expiry_notice", lambda d: P.expiry_notice(d, AT, 3), ["v_status"], f"WITH d AS (SELECT facility_id, seq, expires_at, floor((expires_at - {AT}) / 86400.0)::BIGINT AS days_left FROM v_status), s AS (SELECT *, CASE WHEN expires_at <= {AT} THEN 'EXPIRED' WHEN days_left <= 3 THEN 'WARNING' ELSE 'OK' END AS state FROM d) SELECT facility_id, seq, days_left, state, CASE state WHEN 'EXPIRED' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END AS severity FROM s")

PT = "SELECT station_id AS id, line_id, x, y FROM v_positions"
book.add("jn13_near_pairs", lambda d: S.near_pairs(d, ["line_id"], 60.0).withColumn("distance", F.round("distance", 6)), [PT], "SELECT a.line_id, a.station_id AS a, b.station_id AS b, round(sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)), 6) AS distance FROM v_positions a JOIN v_positions b ON a.line_id = b.line_id AND a.station_id < b.station_id WHERE sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)) < 60")
MS = "SELECT station_id AS id, concat('n', station_id % 25) AS name, x, y FROM v_positions"
book.add("jn14_merge_suspects", lambda d: S.merge_suspects(d, 200.0).withColumn("distance", F.round("distance", 6)), [MS], f"WITH p AS ({MS}) SELECT a.name, a.id AS a, b.id AS b, round(sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)), 6) AS distance FROM p a JOIN p b ON a.name = b.name AND a.id < b.id WHERE sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)) < 200")
BX = "SELECT station_id AS id, x AS x0, y AS y0, x + 40 + station_id % 30 AS x1, y + 22 AS y1 FROM v_positions"
book.add("jn15_box_overlaps", lambda d: S.box_overlaps(d, 64.0, 50), [BX], f"WITH b AS ({BX}), j AS (SELECT a.id AS a, b.id AS b, (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS area FROM b a JOIN b ON a.id < b.id WHERE least(a.x1, b.x1) > greatest(a.x0, b.x0) AND least(a.y1, b.y1) > greatest(a.y0, b.y0)) SELECT * FROM j ORDER BY area DESC, a, b LIMIT 50")
CO = "SELECT station_id AS id, line_id % 5 AS line_id, CAST(x AS DOUBLE) AS x0, CAST((y + 2000) % 40 AS DOUBLE) AS y0, CAST(x + 60 AS DOUBLE) AS x1, CAST((y + 2000) % 40 AS DOUBLE) AS y1 FROM v_positions"
book.add("jn16_collinear", S.collinear_overlaps, [CO], f"WITH s AS ({CO}) SELECT a.id AS a, b.id AS b, least(60.0, b.x1 - a.x0) - greatest(0.0, b.x0 - a.x0) AS overlap FROM s a JOIN s b ON a.id < b.id AND a.line_id <> b.line_id WHERE abs(b.y0 - a.y0) < 2 AND least(60.0, b.x1 - a.x0) - greatest(0.0, b.x0 - a.x0) > 0".replace("60.0", "60.0::DOUBLE").replace("0.0,", "0.0::DOUBLE,").replace("60.0::DOUBLE::DOUBLE", "60.0::DOUBLE").replace("60.0::DOUBLE,", "60.0::DOUBLE,"))
XS = "SELECT station_id AS id, line_id AS track, x AS x0, y AS y0, x + (station_id * 37) % 301 - 150 AS x1, y + (station_id * 53) % 301 - 150 AS y1 FROM v_positions"
book.add("jn17_crossings", lambda d: S.crossings(d, 160.0), [XS], f"""WITH s AS ({XS}) SELECT a.id AS a, b.id AS b FROM s a JOIN s b ON a.id < b.id AND a.track <> b.track WHERE sign((a.x1 - a.x0) * (b.y0 - a.y0) - (a.y1 - a.y0) * (b.x0 - a.x0)) * sign((a.x1 - a.x0) * (b.y1 - a.y0) - (a.y1 - a.y0) * (b.x1 - a.x0)) < 0
  AND sign((b.x1 - b.x0) * (a.y0 - b.y0) - (b.y1 - b.y0) * (a.x0 - b.x0)) * sign((b.x1 - b.x0) * (a.y1 - b.y0) - (b.y1 - b.y0) * (a.x1 - b.x0)) < 0""")
XL = XS.replace("line_id AS track", "line_id AS track, line_id")
CE = "SELECT CAST(x + 7 AS DOUBLE) AS x, CAST(y - 5 AS DOUBLE) AS y FROM v_positions"
AL = "SELECT station_id % 10 AS line_a, (station_id * 7 + 3) % 10 AS line_b, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, CASE WHEN station_id % 3 > 0 THEN 400.0 END AS radius FROM v_positions"
_X = f"""s AS ({XL}), c AS (SELECT a.id AS a, b.id AS b, a.line_id AS la, b.line_id AS lb, a.x0, a.y0, a.x1, a.y1, ((b.x1 - b.x0) * (a.y0 - b.y0) - (b.y1 - b.y0) * (a.x0 - b.x0))::DOUBLE AS d1, ((b.x1 - b.x0) * (a.y1 - b.y0) - (b.y1 - b.y0) * (a.x1 - b.x0))::DOUBLE AS d2,
  ((a.x1 - a.x0) * (b.y0 - a.y0) - (a.y1 - a.y0) * (b.x0 - a.x0))::DOUBLE AS d3, ((a.x1 - a.x0) * (b.y1 - a.y0) - (a.y1 - a.y0) * (b.x1 - a.x0))::DOUBLE AS d4 FROM s a JOIN s b ON a.id < b.id AND a.track <> b.track
  AND greatest(least(a.x0, a.x1), least(b.x0, b.x1)) <= least(greatest(a.x0, a.x1), greatest(b.x0, b.x1))),
  xs AS (SELECT a, b, la, lb, x0 + d1 / (d1 - d2) * (x1 - x0) AS x, y0 + d1 / (d1 - d2) * (y1 - y0) AS y FROM c WHERE sign(d1) * sign(d2) < 0 AND sign(d3) * sign(d4) < 0), e AS ({CE}), l AS ({AL}),
  n AS (SELECT xs.*, (SELECT min(sqrt(power(xs.x - e.x, 2) + power(xs.y - e.y, 2))) FROM e) AS d, EXISTS (SELECT 1 FROM l WHERE ((line_a = la AND line_b = lb) OR (line_a = lb AND line_b = la)) AND sqrt(power(xs.x - l.x, 2) + power(xs.y - l.y, 2)) <= coalesce(radius, 50)) AS ok FROM xs)"""
book.add("jn17_classes", lambda s, c, a: S.classify_crossings(s, c, a, 160.0, 60.0).withColumns({"x": F.round("x", 4), "y": F.round("y", 4)}), [XL, CE, AL], f"WITH {_X} SELECT a, b, round(x, 4) AS x, round(y, 4) AS y, CASE WHEN d < 17 THEN 'COVERED' WHEN d < 60 THEN 'VISIBLE' WHEN ok THEN 'ALLOWED' ELSE 'FREE' END AS class FROM n")
HUB = "SELECT station_id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM v_positions"
book.add("gr05_dense_hubs", lambda d: S.dense_hubs(d, 60.0), [HUB], """WITH RECURSIVE e AS (SELECT a.station_id AS a, b.station_id AS b FROM v_positions a JOIN v_positions b ON abs(a.x - b.x) < 60 AND a.station_id <> b.station_id AND sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)) < 60),
  r(station_id, c) AS (SELECT a, a FROM e UNION SELECT b, c FROM r JOIN e ON station_id = a) SELECT station_id, min(c) AS hub FROM r GROUP BY station_id""")
SG = "SELECT line_id, station_id AS seg_id, x AS x0, y AS y0, x + 100 AS x1, y + station_id % 50 AS y1 FROM v_positions WHERE station_id % 3 = 0"
NO = "SELECT station_id AS id, line_id, x, y, CASE WHEN station_id % 5 = 0 THEN 'interchange' ELSE 'stop' END AS role FROM v_positions WHERE station_id % 3 > 0"
_NS = f"""g AS ({SG}), n AS ({NO}), t AS (SELECT n.*, seg_id, x0, y0, x1 - x0 AS dx, y1 - y0 AS dy, greatest(0.0::DOUBLE, least(1.0::DOUBLE, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0))::DOUBLE / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS u FROM n JOIN g USING (line_id)),
  d AS (SELECT *, sqrt(power(x - x0 - u * dx, 2) + power(y - y0 - u * dy, 2)) AS dist FROM t), m AS (SELECT id, line_id, role, min(dist) AS distance FROM d GROUP BY ALL)"""
book.add("jn18_nearest_segment", lambda a, b: S.nearest_segment(a, b).select("id", "line_id", F.round("distance", 6).alias("distance")), [NO, SG], f"WITH {_NS} SELECT id, line_id, round(distance, 6) AS distance FROM m")
book.add("jn30_off_track", lambda a, b: S.off_track(a, b, {"interchange": 60.0, "stop": 30.0}, 30.0).withColumn("distance", F.round("distance", 6)), [NO, SG], f"WITH {_NS} SELECT id, line_id, role, round(distance, 6) AS distance FROM m WHERE distance > CASE role WHEN 'interchange' THEN 60 ELSE 30 END")
SK = "SELECT line_id, station_id AS seg_id, CASE WHEN station_id % 5 = 0 THEN 'curve' ELSE 'line' END AS kind, x AS x0, y AS y0, x + station_id % 120 + 1 AS x1, y + station_id % 50 AS y1 FROM v_positions WHERE station_id % 3 = 0"
book.add("jn30_leads", lambda a, b: S.straight_lead_violations(a, b, 60.0, 200.0).withColumn("length", F.round("length", 6)), [NO, SK], f"""WITH g AS ({SK}), n AS ({NO}), t AS (SELECT n.*, seg_id, kind, x0, y0, x1 - x0 AS dx, y1 - y0 AS dy, greatest(0.0::DOUBLE, least(1.0::DOUBLE, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0))::DOUBLE / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS u FROM n JOIN g USING (line_id)),
  d AS (SELECT *, sqrt(power(x - x0 - u * dx, 2) + power(y - y0 - u * dy, 2)) AS dist, sqrt(power(dx, 2) + power(dy, 2)) AS length FROM t QUALIFY row_number() OVER (PARTITION BY id, line_id ORDER BY dist, seg_id) = 1)
  SELECT id, line_id, seg_id, round(length, 6) AS length, CASE WHEN kind = 'curve' THEN 'NODE_ON_CURVE' ELSE 'SHORT_LEAD' END AS reason FROM d WHERE dist <= 200 AND (kind = 'curve' OR length < 60)""")
ED = "SELECT station_id AS track, line_id, x, y FROM v_positions WHERE station_id % 4 = 0"
NN = "SELECT station_id AS id, line_id, x, y FROM v_positions WHERE station_id % 4 > 0"
book.add("jn31_snap_ends", lambda a, b: S.snap_ends(a, b, 120.0), [ED, NN], f"""WITH e AS ({ED}), n AS ({NN}), j AS (SELECT e.*, n.id, n.x AS nx, n.y AS ny, sqrt(power(e.x - n.x, 2) + power(e.y - n.y, 2)) AS d FROM e LEFT JOIN n USING (line_id) QUALIFY row_number() OVER (PARTITION BY track ORDER BY d, n.id) = 1)
  SELECT track, CASE WHEN d <= 120 THEN id END AS node, CASE WHEN d <= 120 THEN nx ELSE x END AS x, CASE WHEN d <= 120 THEN ny ELSE y END AS y, coalesce(d <= 120, false) AS snapped FROM j""")
LE = "SELECT line_id, abs(x) + abs(y) + 1 AS length FROM v_positions"
book.add("ag17_spacing", S.spacing_stats, [LE], f"SELECT line_id, quantile_disc(length, 0.05) AS p5, quantile_disc(length, 0.25) AS p25, quantile_disc(length, 0.5) AS p50, quantile_disc(length, 0.75) AS p75, quantile_disc(length, 0.95) AS p95, max(length) AS longest, round(quantile_disc(length, 0.95)::DOUBLE / quantile_disc(length, 0.05), 4) AS spread FROM ({LE}) GROUP BY 1")
book.add("ag18_quantiles", lambda d: S.distance_quantiles(d, 300.0), ["SELECT line_id, CAST(abs(x) AS DOUBLE) AS distance FROM v_positions"], "SELECT line_id, round(quantile_cont(abs(x)::DOUBLE, 0.5), 6) AS p50, round(quantile_cont(abs(x)::DOUBLE, 0.9), 6) AS p90, round(avg((abs(x) <= 300)::INT::DOUBLE), 6) AS share FROM v_positions GROUP BY 1")
IC = "SELECT station_id % 120 AS station_id, line_id, x, y FROM v_positions"
book.add("ag19_spreads", lambda d: S.interchange_spreads(d).withColumn("spread", F.round("spread", 6)), [IC], f"WITH p AS ({IC}), n AS (SELECT station_id, count(DISTINCT line_id) AS lines, count(*) AS members FROM p GROUP BY 1 HAVING count(DISTINCT line_id) >= 2) SELECT n.*, (SELECT round(max(sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2))), 6) FROM p a JOIN p b ON a.station_id = b.station_id WHERE a.station_id = n.station_id) AS spread FROM n")
_IC = f"p AS ({IC}), n AS (SELECT station_id, count(DISTINCT line_id) AS lines FROM p GROUP BY 1 HAVING count(DISTINCT line_id) >= 2), g AS (SELECT n.*, (SELECT max(sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2))) FROM p a JOIN p b ON a.station_id = b.station_id WHERE a.station_id = n.station_id) AS spread FROM n), t AS (SELECT lines, quantile_disc(spread, 0.9) AS target FROM g GROUP BY 1)"
book.add("ag19_targets", lambda d: S.span_targets(S.interchange_spreads(d)).withColumn("target", F.round("target", 6)), [IC], f"WITH {_IC} SELECT lines, round(target, 6) AS target FROM t")
book.add("ag19_tiers", lambda d: S.displacement_tiers(S.interchange_spreads(d), S.span_targets(S.interchange_spreads(d.where("line_id < 7")))).withColumns({c: F.round(c, 6) for c in ("spread", "target", "displacement")}), [IC], f"""WITH {_IC}, q AS (SELECT * FROM p WHERE line_id < 7), h AS (SELECT station_id, count(DISTINCT line_id) AS lines, (SELECT max(sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2))) FROM q a JOIN q b ON a.station_id = b.station_id WHERE a.station_id = q.station_id) AS spread FROM q GROUP BY station_id HAVING count(DISTINCT line_id) >= 2),
  u AS (SELECT lines, quantile_disc(spread, 0.9) AS target FROM h GROUP BY 1), j AS (SELECT g.*, coalesce(u.target, (SELECT target FROM u WHERE lines = 5), 56) AS t2 FROM g LEFT JOIN u USING (lines)), d AS (SELECT *, greatest(0, (spread - t2) / 2) AS m FROM j)
  SELECT station_id, lines, round(spread, 6) AS spread, round(t2, 6) AS target, round(m, 6) AS displacement, CASE WHEN m < 4 THEN 'mild' WHEN m < 20 THEN 'mid' WHEN m < 35 THEN 'large' ELSE 'extreme' END AS tier, spread > t2 AS converge, spread > 60 AS suspect_split FROM d""")
book.add("ag18_octolinear", lambda d: S.octolinear_shares(d, 5.0), [XS.replace("line_id AS track", "line_id % 4 AS region")], f"WITH a AS (SELECT track % 4 AS region, degrees(atan2(y1 - y0, x1 - x0)) AS d FROM ({XS}) WHERE x0 <> x1 OR y0 <> y1), b AS (SELECT region, CASE WHEN d < 0 THEN d + 360 ELSE d END % 45 AS g FROM a) SELECT region, count(*) AS segments, round(avg((round(least(g, 45 - g), 6) <= 5)::INT::DOUBLE), 6) AS share FROM b GROUP BY 1")
book.add("ag20_centroids", S.interchange_centroids, [IC], f"WITH p AS ({IC}), c AS (SELECT station_id, floor(avg(x) + 0.5)::BIGINT AS cx, floor(avg(y) + 0.5)::BIGINT AS cy FROM p GROUP BY 1 HAVING count(DISTINCT line_id) >= 2) SELECT p.*, cx, cy FROM p JOIN c USING (station_id) WHERE cx <> x OR cy <> y")
FP = "SELECT line_id, CAST(station_id AS INT) AS seq, station_id, CASE WHEN station_id % 3 = 0 THEN x + 3000 END AS x, CASE WHEN station_id % 3 = 0 THEN y + 3000 END AS y FROM v_positions"
book.add("wn14_fill_positions", S.fill_positions, [FP], None)
book.add("wn23_octolinear", S.octolinear_deviation, [XS], f"WITH a AS (SELECT id, degrees(atan2(y1 - y0, x1 - x0)) AS d FROM ({XS})), b AS (SELECT id, CASE WHEN d < 0 THEN d + 360 ELSE d END AS g FROM a) SELECT id, round(g, 6) AS angle, round(least(g % 45, 45 - g % 45), 6) AS deviation FROM b")
OR = "SELECT line_id, station_id, station_id AS seq, x, y FROM v_positions"
book.add("wn25_label_offsets", S.label_offsets, [OR], f"""WITH d AS (SELECT line_id, station_id, coalesce(lead(x) OVER w - x, x - lag(x) OVER w, 0) AS dx, coalesce(lead(y) OVER w - y, y - lag(y) OVER w, 0) AS dy FROM ({OR}) WINDOW w AS (PARTITION BY line_id ORDER BY seq))
  SELECT line_id, station_id, CASE WHEN abs(dx) >= abs(dy) THEN 0 ELSE 18 END AS off_x, CASE WHEN abs(dx) < abs(dy) THEN 0 WHEN dx >= 0 THEN -18 ELSE 18 END AS off_y FROM d""")
book.add("wn28_half_paths", S.half_paths, [OR], f"SELECT line_id, station_id, 'M ' || x || ' ' || y || ' L ' || lag(x) OVER w || ' ' || lag(y) OVER w AS to_previous, 'M ' || x || ' ' || y || ' L ' || lead(x) OVER w || ' ' || lead(y) OVER w AS to_next FROM ({OR}) WINDOW w AS (PARTITION BY line_id ORDER BY seq)")
book.add("ud01_simplify", lambda d: S.simplify(d, 0.5).selectExpr("track", "size(xs) AS n", "xs[0] AS x0", "element_at(xs, -1) AS x1"), ["SELECT vec_id AS track, transform(sequence(0, 63), i -> CAST(i AS DOUBLE)) AS xs, transform(embedding, e -> CAST(e * 10 AS DOUBLE)) AS ys FROM embeddings"], None)
