"""Scans, sinks and the status stream bound to the driver's tables."""

from pyspark.sql import functions as F

from railtable.plans.bind import Book, canonical
from railtable.sources import io as IO
from railtable.streaming import status as ST

book = Book()
QUERIES, ORACLES = book.queries, book.oracles
EVENTS = "SELECT event_id, event_type, user_id, props FROM events"
book.add("io01_explode_json", lambda d: IO.explode_json(d, "j", "a long, b string"), ["SELECT event_id, concat(chr(123), '\"a\": ', user_id, ', \"b\": \"', event_type, '\"', chr(125)) AS j FROM events"], "SELECT event_id, user_id AS a, event_type AS b FROM events")
book.add("io02_parse_csv", lambda d: IO.parse_csv(d, "line", "name string, size int, price double"), ["SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN concat(p_name, ',x', p_size, ',1.5') WHEN p_partkey % 11 = 0 THEN p_name ELSE concat('\"', p_name, ', ', p_brand, '\",', p_size, ',2.25') END AS line FROM part"],
         """SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 OR p_partkey % 11 = 0 THEN p_name ELSE concat(p_name, ', ', p_brand) END AS name, CASE WHEN p_partkey % 7 > 0 AND p_partkey % 11 > 0 THEN p_size END AS size, CASE WHEN p_partkey % 7 = 0 THEN 1.5 WHEN p_partkey % 11 > 0 THEN 2.25 END::DOUBLE AS price,
         CASE WHEN p_partkey % 7 = 0 THEN concat(p_name, ',x', p_size, ',1.5') WHEN p_partkey % 11 = 0 THEN p_name END AS corrupt FROM part""")
book.add("io03_field_inventory", lambda d: IO.field_inventory(d, "props", "event_type"), [EVENTS], "WITH k AS (SELECT DISTINCT event_type, unnest(json_keys(props)) AS k FROM events) SELECT event_type, string_agg(k, ',' ORDER BY k) AS fields, sha256(string_agg(k, ',' ORDER BY k)) AS fingerprint FROM k GROUP BY 1")
book.add("io04_typed_load", lambda d: IO.typed(d, "station_lines", {"stationId": "station_id", "lineId": "line_id", "seq": "line_sequence"}, {"pack_id": "capital", "line_sequence": -1}),
         ["SELECT p_partkey AS stationId, p_brand AS lineId, CASE WHEN p_size % 3 > 0 THEN concat(p_size, CASE WHEN p_size % 5 = 0 THEN 'x' ELSE '' END) END AS seq FROM part"],
         "SELECT 'capital' AS pack_id, p_partkey::VARCHAR AS station_id, p_brand AS line_id, CASE WHEN p_size % 3 = 0 THEN -1 WHEN p_size % 5 = 0 THEN NULL ELSE p_size::INT END AS line_sequence FROM part")
book.add("io04_range_check", IO.range_violations, ["SELECT 'p' AS pack_id, s_suppkey AS station_id, s_acctbal / 50 AS latitude, s_acctbal / 40 AS longitude FROM supplier"],
         "SELECT 'p' AS pack_id, s_suppkey AS station_id, 'LATITUDE' AS reason FROM supplier WHERE NOT (s_acctbal / 50 BETWEEN -90 AND 90) UNION ALL SELECT 'p', s_suppkey, 'LONGITUDE' FROM supplier WHERE NOT (s_acctbal / 40 BETWEEN -180 AND 180)")
book.add("io05_component", lambda d: IO.component(d, ["p_brand", "p_partkey"]), ["SELECT * FROM part"], "SELECT p_brand, p_partkey FROM part ORDER BY 1, 2")
book.add("io06_export", IO.export_rows, ["SELECT p_partkey AS station_id, p_name AS name_ko, p_size AS line_sequence FROM part"], 'SELECT p_partkey AS "stationId", p_name AS "nameKo", p_size AS "lineSequence" FROM part')
_L = lambda name, row, table, least: f"""SELECT '{name}' AS table_name, sum(n)::BIGINT AS n_rows, sha256(string_agg(d, '' ORDER BY b)) AS content_hash, sum(n) >= {least} AS enough FROM (SELECT ('0x' || substr(h, 1, 8))::BIGINT % 256 AS b, count(*) AS n, sha256(string_agg(h, '' ORDER BY h)) AS d FROM (SELECT sha256(concat('{{"row":"', sha256({row}), '"}}')) AS h FROM {table}) GROUP BY 1)"""
book.add("io07_manifest", lambda a, b: IO.manifest({"stations": (a, 100), "lines": (b, 26)}), ["SELECT p_partkey, p_name FROM part", "SELECT n_nationkey, n_name FROM nation"],
         _L("stations", canonical("p_name", "p_partkey"), "part", 100) + " UNION ALL " + _L("lines", canonical("n_name", "n_nationkey"), "nation", 26))
book.add("io08_search_index", IO.search_index, ["SELECT p_name AS name, p_partkey AS station_id FROM part", "SELECT upper(p_name) AS alias, p_partkey AS station_id FROM part WHERE p_size % 2 = 0 UNION ALL SELECT p_type AS alias, p_partkey AS station_id FROM part"],
         r"SELECT lower(regexp_replace(p_name, '[·.\s]', '', 'g')) AS token, p_partkey AS station_id FROM part UNION SELECT lower(regexp_replace(p_type, '[·.\s]', '', 'g')), p_partkey FROM part")
AT = 1_704_200_000
book.add("st01_status_at", lambda d: ST.status_at(d, AT), ["v_status"], f"SELECT facility_id, observed_at, seq, CASE WHEN expires_at <= {AT} THEN 'UNKNOWN' ELSE status END AS status, expires_at FROM v_status WHERE observed_at <= {AT} QUALIFY row_number() OVER (PARTITION BY facility_id ORDER BY observed_at DESC, seq DESC) = 1")
