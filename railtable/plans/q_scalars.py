"""SC-1 to SC-26 bound to the driver's tables."""

from pyspark.sql import functions as F

from railtable.functions import scalars as S
from railtable.plans.bind import Book, canonical

book = Book()
QUERIES, ORACLES = book.queries, book.oracles
PART = "SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part"

book.add("sc01_station_name", lambda d: d.select("p_partkey", S.station_name(F.col("raw")).alias("name")),
         ["SELECT p_partkey, concat(p_name, ' (', p_brand, ')·[', p_type, '] 역') AS raw FROM part"],
         r"""SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(concat(p_name, ' (', p_brand, ')·[', p_type, '] 역'), '\([^)]*\)|\[[^\]]*\]', '', 'g'), '[·.\s]', '', 'g'), '역$', '') AS name FROM part""")
book.add("sc02_station_name_strong", lambda d: d.select("p_partkey", S.station_name_strong(F.col("raw"), {"성서산업단지": "성서산단"}).alias("name")),
         ["SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN '성서산업단지 역' ELSE concat(p_name, '(x)', p_size) END AS raw FROM part"],
         r"""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN '성서산단' ELSE regexp_replace(regexp_replace(p_name || p_size, '[·.\s]', '', 'g'), '[0-9]+$', '') END AS name FROM part""")
book.add("sc03_line_name", lambda d: d.select("p_partkey", S.line_name(F.col("p_brand")).alias("line")), [PART], r"SELECT p_partkey, regexp_replace(p_brand, '[·.\s]', '', 'g') AS line FROM part")
CLOCK = "SELECT event_id, CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 19 = 0 THEN '000000' ELSE lpad(@str(event_id % 31), 2, '0') || lpad(@str(event_id % 61), 2, '0') || lpad(@str(user_id % 60), 2, '0') END AS t FROM events"
_CLOCK = """WITH c AS (%s), n AS (SELECT event_id, t, CASE WHEN regexp_full_match(t, '[0-9]{6}') AND substr(t, 1, 2)::INT <= 29 AND substr(t, 3, 2)::INT < 60 AND substr(t, 5, 2)::INT < 60
  THEN substr(t, 1, 2)::INT * 3600 + substr(t, 3, 2)::INT * 60 + substr(t, 5, 2)::INT END AS raw FROM c)
SELECT event_id, CASE WHEN raw < 10800 THEN raw + 86400 ELSE raw END AS seconds FROM n""" % CLOCK
book.add("sc04_clock", lambda d: d.select("event_id", S.clock(F.col("t")).alias("seconds")), [CLOCK], _CLOCK)
book.add("sc05_clock_or_missing", lambda d: d.select("event_id", S.clock_or_missing(F.col("t")).alias("seconds")), [CLOCK], _CLOCK.replace("THEN raw + 86400 ELSE raw END", "THEN raw + 86400 ELSE raw END * CASE WHEN regexp_full_match(t, '0+') THEN NULL ELSE 1 END"))
book.add("sc06_transfer_rows", S.transfer_rows,
         ["SELECT event_id, @str(event_id % 12) AS line, concat(lpad(@str(event_id % 70), 2, '0'), ':', lpad(@str(user_id % 60), 2, '0')) AS duration FROM events"],
         """SELECT event_id, (event_id % 12)::VARCHAR AS line, lpad((event_id % 70)::VARCHAR, 2, '0') || ':' || lpad((user_id % 60)::VARCHAR, 2, '0') AS duration,
         CASE WHEN event_id % 12 = 0 THEN 'LINE' WHEN event_id % 70 > 59 THEN 'DURATION' END AS reason,
         CASE WHEN event_id % 12 > 0 AND event_id % 70 < 60 THEN (event_id % 12)::VARCHAR || '호선' END AS line_name,
         CASE WHEN event_id % 12 > 0 AND event_id % 70 < 60 THEN (event_id % 70 * 60 + user_id % 60)::INT END AS duration_seconds FROM events""")
book.add("sc07_stop_role", lambda d: d.select("event_id", S.stop_role(F.col("a"), F.col("b")).alias("role")),
         ["SELECT event_id, CASE WHEN event_id % 3 > 0 THEN user_id END AS a, CASE WHEN event_id % 5 > 0 THEN user_id END AS b FROM events"],
         "SELECT event_id, CASE WHEN event_id % 3 = 0 AND event_id % 5 > 0 THEN 'ORIGIN' WHEN event_id % 3 > 0 AND event_id % 5 = 0 THEN 'TERMINAL' WHEN event_id % 3 > 0 THEN 'THROUGH' END AS role FROM events")
book.add("sc08_car_door", lambda d: d.select("event_id", S.car_door(F.col("v"))["car"].alias("car"), S.car_door(F.col("v"))["door"].alias("door")),
         ["SELECT event_id, concat(event_id % 13, '-', user_id % 6) AS v FROM events"],
         """SELECT event_id, CASE WHEN ok THEN (event_id % 13)::INT END AS car, CASE WHEN ok THEN (user_id % 6)::INT END AS door
         FROM (SELECT *, event_id % 13 BETWEEN 1 AND 10 AND user_id % 6 BETWEEN 1 AND 4 AS ok FROM events)""")
book.add("sc09_classify", lambda d: d.select("event_id", S.direction(F.col("code")).alias("direction"), S.facility_type(F.col("a"), F.col("b")).alias("facility")),
         ["""SELECT event_id, CASE event_id % 5 WHEN 0 THEN '상행' WHEN 1 THEN '하행' WHEN 2 THEN '내선' WHEN 3 THEN '외선' ELSE 'x' END AS code,
         CASE user_id % 4 WHEN 0 THEN '계 단' WHEN 1 THEN '외부 승강기' ELSE '' END AS a, CASE event_id % 3 WHEN 0 THEN '에스컬레이터' WHEN 1 THEN '환승 통로' ELSE '' END AS b FROM events"""],
         """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'UP' WHEN 1 THEN 'DOWN' WHEN 2 THEN 'INNER' WHEN 3 THEN 'OUTER' END AS direction,
         CASE WHEN user_id % 4 = 0 THEN 'STAIR' WHEN user_id % 4 = 1 THEN 'ELEVATOR' WHEN event_id % 3 = 0 THEN 'ESCALATOR' WHEN event_id % 3 = 1 THEN 'TRANSFER' END AS facility FROM events""")
book.add("sc10_units", lambda d: d.select("p_partkey", S.metres(F.col("km")).cast("long").alias("metres"), S.canvas(F.col("lat"), F.col("lon"), (38.2, 126.5), 100_000.0)["x"].alias("x"), S.canvas(F.col("lat"), F.col("lon"), (38.2, 126.5), 100_000.0)["y"].alias("y")),
         ["SELECT p_partkey, p_retailprice / 1024 AS km, 37.0 + p_size / 64.0E0 AS lat, 126.75E0 + p_size / 128.0E0 AS lon FROM part"],
         """SELECT p_partkey, floor(p_retailprice / 1024 * 1000 + 0.5)::BIGINT AS metres, greatest(1, floor((126.75::DOUBLE + p_size / 128.0::DOUBLE - 126.5::DOUBLE) * 100000 + 0.5)::BIGINT) AS x,
         greatest(1, floor((38.2::DOUBLE - (37.0::DOUBLE + p_size / 64.0::DOUBLE)) * 100000 + 0.5)::BIGINT) AS y FROM part""")
book.add("sc11_station_line", lambda d: d.select("trip_id", "stop_no", S.station_line_of(F.col("node")).alias("station_line")),
         ["SELECT trip_id, stop_no, CASE WHEN station_id % 7 = 0 THEN concat(station_id, '') WHEN station_id % 7 = 1 THEN concat(station_id, '::p') ELSE concat(station_id, ':', line_id, ':up') END AS node FROM v_stops"],
         "SELECT trip_id, stop_no, CASE WHEN station_id % 7 > 1 THEN concat(station_id, ':', line_id) END AS station_line FROM v_stops")
#: Values that a joined text would confuse: separators, quotes, a written null, nulls and empties.
ODD = "SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat(p_name, '|p_partkey=1') WHEN 3 THEN concat(chr(34), p_name, chr(92), 'N') ELSE p_name END AS p_name, CASE WHEN p_partkey % 5 > 0 THEN p_brand END AS p_brand, CASE WHEN p_partkey % 3 > 0 THEN p_size END AS p_size FROM part"
book.add("sc12_record_hash", lambda d: d.select("p_partkey", S.record_hash("p_partkey", "p_name", "p_brand", "p_size").alias("hash")), [ODD], f"SELECT p_partkey, sha256({canonical('p_brand', 'p_name', 'p_partkey', 'p_size')}) AS hash FROM ({ODD})")
book.add("sc13_credentials", lambda d: d.where(S.holds_credential(F.col("line"))).select("doc_id"), ["SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN concat('serviceKey=', doc_id) ELSE text END AS line FROM documents"],
         """SELECT doc_id FROM documents WHERE regexp_matches(CASE WHEN doc_id % 9 = 0 THEN concat('serviceKey=', doc_id) ELSE text END, '(?i)(serviceKey|apiKey|access[_-]?token|secret)[=:][^\\s&"'']+')""")
book.add("sc14_search", lambda d: S.search_rows(d, "p_name", [["a", "r"], ["e", "o"]], 25, ["p_partkey"]).select("p_partkey", "p_name"), [PART],
         "SELECT p_partkey, p_name FROM part WHERE (contains(lower(p_name), 'a') OR contains(lower(p_name), 'r')) AND (contains(lower(p_name), 'e') OR contains(lower(p_name), 'o')) ORDER BY p_partkey LIMIT 25")
book.add("sc15_abbreviation", lambda d: d.select("p_partkey", S.is_abbreviation(F.col("s"), F.col("p_name")).alias("short_form")),
         ["SELECT p_partkey, p_name, CASE WHEN p_partkey % 3 = 0 THEN substr(p_name, 2, 3) WHEN p_partkey % 3 = 1 THEN concat(substr(p_name, 1, 1), substr(p_name, 4, 2)) ELSE 'zq#' END AS s FROM part"],
         "SELECT p_partkey, CASE WHEN p_partkey % 3 = 2 THEN false ELSE length(CASE WHEN p_partkey % 3 = 0 THEN substr(p_name, 2, 3) ELSE concat(substr(p_name, 1, 1), substr(p_name, 4, 2)) END) < length(p_name) END AS short_form FROM part")
book.add("sc16_parenthetical", lambda d: d.select("p_partkey", F.explode(S.parenthetical_names(F.col("raw"))).alias("name")), ["SELECT p_partkey, concat(p_name, '( ', p_brand, ')(', p_type, ')( )') AS raw FROM part"],
         "SELECT p_partkey, trim(p_brand) AS name FROM part UNION ALL SELECT p_partkey, trim(p_type) FROM part")
book.add("sc17_mobility_parity", lambda d: S.mobility_parity(d, 108), ["SELECT event_id, user_id % 400 AS base_seconds FROM events"],
         """WITH s AS (SELECT event_id, user_id % 400 AS base_seconds, (user_id % 400 * 108 + 99) // 100 AS standard_seconds FROM events), d AS (SELECT *, CASE WHEN base_seconds = 0 THEN 0.0::DOUBLE ELSE (standard_seconds - base_seconds) * 100.0::DOUBLE / base_seconds END AS o FROM s)
         SELECT event_id, base_seconds, standard_seconds, round(o, 4) AS deviation_percent, abs(o) <= 10 AS within FROM d""")
FACILITY = "SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'Normal' WHEN 1 THEN 'OPEN' WHEN 2 THEN 'unknown' WHEN 3 THEN 'CLOSED' WHEN 4 THEN 'AVAILABLE' END AS st, CASE user_id % 3 WHEN 0 THEN 'FIELD_SURVEY' WHEN 1 THEN 'Operator_Confirmed' ELSE 'GUESS' END AS me FROM events"
book.add("sc18_eligibility", lambda d: d.select("event_id", S.strict_eligibility(F.col("st"), F.col("me"))["eligible"].alias("eligible"), S.strict_eligibility(F.col("st"), F.col("me"))["reason"].alias("reason")), [FACILITY],
         """WITH r AS (SELECT event_id, CASE WHEN event_id % 6 IN (2, 5) THEN 'OPERATION_STATUS_UNKNOWN' WHEN event_id % 6 = 3 THEN 'OPERATION_STATUS_NOT_AVAILABLE' WHEN user_id % 3 = 2 THEN 'OPERATION_EVIDENCE_MISSING' ELSE 'FACILITY_OPERATION_VERIFIED' END AS reason FROM events)
         SELECT event_id, reason = 'FACILITY_OPERATION_VERIFIED' AS eligible, reason FROM r""")
book.add("sc19_unverified", lambda d: S.unverified_unknown(d, ["step_free", "status"], F.col("event_id") % 50 == 0).select("event_id", "step_free", "status"),
         ["SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'VERIFIED' WHEN event_id % 3 = 1 THEN 'DRAFT' END AS verification, 'YES' AS step_free, event_type AS status FROM events"],
         "SELECT event_id, CASE WHEN event_id % 3 = 0 OR event_id % 50 = 0 THEN 'YES' ELSE 'UNKNOWN' END AS step_free, CASE WHEN event_id % 3 = 0 OR event_id % 50 = 0 THEN event_type ELSE 'UNKNOWN' END AS status FROM events")
PATH = "SELECT p_partkey, p_size, concat('M ', p_size, ' ', p_partkey % 50, ' L ', p_size + 30, ' ', p_partkey % 50, ' L ', p_size + 30, ' ', p_partkey % 50 + 40) AS path FROM part"
book.add("sc20_vertices", lambda d: d.select("p_partkey", F.posexplode(S.vertices(F.col("path"))).alias("i", "p"), (S.path_text(S.vertices(F.col("path"))) == F.col("path")).alias("same")).select("p_partkey", "i", "p.x", "p.y", "same"), [PATH],
         """SELECT p_partkey, i::INT AS i, (p_size + CASE WHEN i > 0 THEN 30 ELSE 0 END)::DOUBLE AS x, (p_partkey % 50 + CASE WHEN i > 1 THEN 40 ELSE 0 END)::DOUBLE AS y, true AS same FROM part, range(3) r(i)""")
book.add("sc21_arc_length", lambda d: d.select("p_partkey", S.vertices(F.col("path")).alias("v")).select("p_partkey", S.polyline_length(F.col("v")).alias("length"), F.posexplode(S.interior_points(F.col("v"), 6)).alias("i", "p")).select("p_partkey", "length", "i", "p.x", "p.y"), [PATH],
         """SELECT p_partkey, 70.0::DOUBLE AS length, i::INT AS i, (p_size + least(30, 10 * (i + 1)))::DOUBLE AS x, (p_partkey % 50 + greatest(0, 10 * (i + 1) - 30))::DOUBLE AS y FROM part, range(6) r(i)""")
book.add("sc22_label_box", lambda d: d.select("p_partkey", F.posexplode(S.label_box(F.col("p_name"), F.col("p_size"), F.col("p_partkey") % 60)).alias("i", "c")).select("p_partkey", "i", F.col("c.x").cast("long").alias("x"), F.col("c.y").cast("long").alias("y")), [PART],
         """WITH b AS (SELECT p_partkey, greatest(28, length(p_name) * 14) AS w, greatest(0, p_size - greatest(28, length(p_name) * 14) // 2) AS l, greatest(0, p_partkey % 60 - 34) AS t FROM part)
         SELECT p_partkey, i::INT AS i, (l + CASE WHEN i IN (1, 2) THEN w ELSE 0 END)::BIGINT AS x, (t + CASE WHEN i > 1 THEN 22 ELSE 0 END)::BIGINT AS y FROM b, range(4) r(i)""")
book.add("sc23_service_seconds", lambda d: d.select("event_id", S.service_seconds(F.col("v"), F.lit("2024-05-01").cast("date")).alias("seconds")),
         ["SELECT event_id, concat('2024-05-0', event_id % 3 + 1, 'T', lpad(@str(user_id % 24), 2, '0'), ':', lpad(@str(event_id % 60), 2, '0'), ':07+09:00') AS v FROM events"],
         """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN (user_id % 24 * 3600 + event_id % 60 * 60 + 7)::INT WHEN event_id % 3 = 1 AND user_id % 24 <= 2 THEN (user_id % 24 * 3600 + event_id % 60 * 60 + 7 + 86400)::INT END AS seconds FROM events""")
book.add("sc24_mercator", lambda d: d.select("p_partkey", F.round(S.mercator(F.col("lat"), F.col("lon"), 1000.0, 10.0, 20.0)["x"], 6).alias("x"), F.round(S.mercator(F.col("lat"), F.col("lon"), 1000.0, 10.0, 20.0)["y"], 6).alias("y")),
         ["SELECT p_partkey, 37.0E0 + p_size / 64.0E0 AS lat, 126.75E0 + p_size / 128.0E0 AS lon FROM part"],
         """WITH g AS (SELECT p_partkey, 37.0::DOUBLE + p_size / 64.0::DOUBLE AS lat, 126.75::DOUBLE + p_size / 128.0::DOUBLE AS lon FROM part)
         SELECT p_partkey, round(10 + radians(lon) * 1000, 6) AS x, round(20 - ln((1 + sin(radians(lat))) / (1 - sin(radians(lat)))) / 2 * 1000, 6) AS y FROM g""")
book.add("sc25_provider_status", lambda d: S.provider_status(d, d.sparkSession.createDataFrame([(k, o, s) for k, (o, s) in S.SITUATIONS.items()], "code string, operational boolean, situation string")).select("event_id", "code", "operational", "situation", "reason"),
         ["SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'M' WHEN 1 THEN ' S ' WHEN 2 THEN 'D' WHEN 3 THEN '' WHEN 4 THEN 'B' WHEN 5 THEN 'Q' END AS code FROM events"],
         """SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'M' WHEN 1 THEN 'S' WHEN 4 THEN 'B' WHEN 5 THEN 'Q' ELSE '' END AS code, CASE event_id % 8 WHEN 0 THEN true WHEN 1 THEN false WHEN 4 THEN false END AS operational,
         CASE event_id % 8 WHEN 0 THEN '사용가능' WHEN 1 THEN '보수중' WHEN 4 THEN '공사중' WHEN 5 THEN NULL ELSE 'PROVIDER_STATUS_MISSING' END AS situation, CASE WHEN event_id % 8 = 5 THEN 'UNKNOWN_CODE' END AS reason FROM events WHERE event_id % 8 <> 2""")
book.add("sc26_demote_unproven", lambda d: S.demote_unproven(d, "claim", ["src0", "src1", "src2", "src3", "src4"]).select("doc_id", "incomplete", "claim"),
         ["SELECT doc_id, source AS source_id, CASE WHEN doc_id % 6 > 0 THEN 's' END AS snapshot_id, sha2(text, 256) AS raw_sha256, CASE WHEN doc_id % 7 > 0 THEN sha2(lang, 256) ELSE 'x' END AS mapping_sha256, 'AVAILABLE' AS claim FROM documents"],
         """SELECT doc_id, NOT (doc_id % 6 > 0 AND doc_id % 7 > 0 AND source IN ('src0', 'src1', 'src2', 'src3', 'src4')) AS incomplete, CASE WHEN doc_id % 6 > 0 AND doc_id % 7 > 0 AND source IN ('src0', 'src1', 'src2', 'src3', 'src4') THEN 'AVAILABLE' ELSE 'UNKNOWN' END AS claim FROM documents""")
