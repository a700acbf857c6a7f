"""Operators on small rail rows of their own: the happy case and at least one that must be found."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from railtable import checks
from railtable.functions import scalars as S
from railtable.operators import coverage, policy, quality, reconcile, spatial, timetable, topology, versioning
from railtable.sources import io
from railtable.streaming import status


def test_exactly_one_and_strict(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    c = spark.createDataFrame([(1, 10), (1, 10), (2, 20), (2, 21), (2, None)], "id int, s int")
    assert rows(checks.exactly_one(left, c, "id", "s"), "id", "match_status", "s") == [(1, "matched", 10), (2, "ambiguous", None), (3, "unmatched", None)]
    bad = checks.violations(left, {"ODD": F.col("id") % 2 == 1, "NULL": F.lit(None).cast("boolean")})
    assert rows(bad) == [(1, "ODD"), (3, "ODD")]
    with pytest.raises(checks.Violation, match="ODD"):
        checks.strict(bad, "ids")
    checks.strict(bad.where("id > 9"), "ids")
    assert rows(checks.duplicate_keys(c, "id", "s")) == [(1, 10, 2)] and rows(checks.orphans(c, "id", left.where("id = 1"), "id"), "id") == [(2,), (2,), (2,)]


def test_names(spark):
    d = spark.createDataFrame([("서울역(1호선)",), ("시청·[2] 역",), ("ＡＢＣ 역12",), ("역",), (None,)], "n string")
    assert [r[0] for r in d.select(S.station_name(F.col("n"))).collect()] == ["서울", "시청", "ＡＢＣ역12", "", None]
    assert [r[0] for r in d.select(S.station_name_strong(F.col("n"), {"시청": "시청앞"})).collect()] == ["서울", "시청앞", "ABC역", "", None]
    assert d.select(S.parenthetical_names(F.col("n"))).first()[0] == ["1호선"]


def test_clock(spark):
    d = spark.createDataFrame([("052900",), ("000130",), ("253000",), ("300000",), ("0529",), ("",), (None,), ("106000",)], "t string")
    assert [r[0] for r in d.select(S.clock(F.col("t"))).collect()] == [19740, 86490, 91800, None, None, None, None, None]
    assert [r[0] for r in d.select(S.clock_or_missing(F.lit("000000"))).take(1)] == [None]


def test_transfer_rows(spark):
    d = spark.createDataFrame([("2", "03:15"), ("4호선", "00:59"), ("0", "01:00"), ("3", "1:00"), ("3", None), (None, "01:00")], "line string, duration string")
    got = [(r.line_name, r.duration_seconds, r.reason) for r in S.transfer_rows(d).collect()]
    assert got == [("2호선", 195, None), ("4호선", 59, None), (None, None, "LINE"), (None, None, "DURATION"), (None, None, "DURATION"), (None, None, "LINE")]


def test_polyline(spark):
    d = spark.createDataFrame([("M 0 0 L 10 0 L 10 10",), ("M 3.5 -2",), ("",)], "p string").withColumn("v", S.vertices(F.col("p")))
    assert [r[0] for r in d.select(S.polyline_length(F.col("v"))).collect()] == [20.0, 0.0, 0.0]
    assert d.select(S.point_at(F.col("v"), F.lit(15.0))).first()[0].asDict() == {"x": 10.0, "y": 5.0}
    assert [r[0] for r in d.select(S.path_text(F.col("v"))).collect()] == ["M 0 0 L 10 0 L 10 10", "M 3.5 -2", ""]


def test_headways(spark):
    d = spark.createDataFrame([("L", 0, 1, "L", t, p, f) for t, p, f in [(100, 0, False), (100, 0, False), (160, 0, False), (400, None, None), (500, 1, False), (600, 0, True)]], "line_id string, direction int, station_id int, stop_line string, seconds int, pickup_type int, by_frequency boolean")
    assert rows(timetable.headways(d), "departures", "min_headway", "max_headway") == [(3, 60, 240)]
    assert timetable.headways(d.limit(1)).count() == 0


def test_trips_and_direction(spark):
    d = spark.createDataFrame([("L", "t1", "W", f"s{k}", k, 100 * k) for k in (3, 1, 2)] + [("L", "t2", "W", "s2", 2, 10), ("L", "t2", "W", "s1", 1, 20)], "line_id string, train_no string, day string, station_id string, seq int, time int")
    trips, stops = timetable.reconstruct_trips(d)
    assert rows(trips, "train_no", "direction", "headsign", "stops") == [("t1", "UP", "s3", 3), ("t2", "DOWN", "s1", 2)]
    assert rows(stops.where("train_no = 't1'"), "stop_no", "station_id") == [(1, "s1"), (2, "s2"), (3, "s3")]
    s = spark.createDataFrame([("a", k, q, "LOCAL") for k, q in enumerate([1, 2, 2, 1])] + [("b", k, q, p) for k, (q, p) in enumerate([(1, "LOCAL"), (2, "EXPRESS")])] + [("c", 0, 5, "LOCAL")], "trip_id string, stop_no int, seq int, pattern string")
    assert rows(timetable.direction_violations(s)) == [("a", "MIXED_DIRECTION"), ("a", "REPEATED_SEQUENCE"), ("b", "MIXED_PATTERN")]


def test_loop_wrap(spark):
    seqs = {"ok": [7, 8, 1, 2], "two": [8, 1, 8, 1], "turn": [3, 4, 3], "back": [2, 1, 8, 7], "same": [4, 4]}
    s = spark.createDataFrame([(t, k, "C", q) for t, v in seqs.items() for k, q in enumerate(v)], "trip_id string, stop_no int, line_id string, seq int")
    loop = spark.createDataFrame([("C", 1, 8, 8)], "line_id string, lo int, hi int, stations int")
    assert {r[0] for r in timetable.sequence_wrap_violations(s, loop).collect()} == {"two", "turn", "same"}
    short = spark.createDataFrame([("C", 1, 8, 3)], "line_id string, lo int, hi int, stations int")
    assert "ok" in {r[0] for r in timetable.sequence_wrap_violations(s, short).collect()}


def test_rollover_and_dates(spark):
    s = spark.createDataFrame([("t", k, d) for k, d in enumerate([86000, 86300, 100, 200, 50])], "trip_id string, stop_no int, departure int")
    assert [r[0] for r in timetable.midnight_rollover(s).orderBy("stop_no").select("service_seconds").collect()] == [86000, 86300, 86500, 86600, 172850]
    now = spark.createDataFrame([(1, 1714752000)], "key int, now long")  # 2024-05-03 16:00 UTC, the 4th in Seoul
    got = {r.day_type: str(r.date) for r in timetable.next_service_dates(now, "Asia/Seoul").collect()}
    assert got == {"SATURDAY": "2024-05-04", "SUNDAY": "2024-05-05", "WEEKDAY": "2024-05-06"}


def test_chaining(spark):
    e = [("d", 1, 1, 0), ("d", 2, 2, 120), ("d", 3, 3, 300), ("d", 4, 1, 200), ("d", 5, 2, 290), ("d", 6, 2, 330), ("d", 7, 3, 5000)]
    df = spark.createDataFrame(e, "grp string, event_id long, seq int, seconds int")
    got = {r.event_id: r.trip_id for r in timetable.chain_departures(df, 60, 300).collect()}
    # departure 2 is eligible with 5 and none is sure for trip 1 (two eligible), so only sure links are made
    assert got[3] == got[2] and got[7] == 7 and len(got) == 7
    near = {r.event_id: r.trip_id for r in timetable.chain_nearest(df, 70, 120).collect()}
    assert near[2] == 1 and near[3] == 1 and near[5] == 5 or near[6] == 4


def test_branches_and_upsert(spark):
    r = spark.createDataFrame([("L", k, s, 5 if k else None) for k, s in enumerate("abcabd")], "line_id string, pos int, station_id string, distance_m int")
    seg = topology.branch_segments(r)
    assert [x[0] for x in seg.orderBy("pos").select("segment").collect()] == [0, 0, 0, 1, 2, 2]
    assert rows(topology.segment_edges(seg), "from_station", "to_station") == [("a", "b"), ("b", "c"), ("b", "d")]
    e = spark.createDataFrame([("L", "a", "b", 0, "x"), ("L", "b", "a", 500, "y"), ("L", "c", "a", 1, "x"), ("L", "a", "c", 2, "x")], "line_id string, from_station string, to_station string, distance_m int, branch string")
    assert rows(topology.undirected_upsert(e)) == [("L", "a", "b", 500, False, "x,y"), ("L", "a", "c", 2, True, "x")]


def test_graph(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (6, 7)], "from_node int, to_node int")
    n = spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 5, 6, 7)], "node int")
    assert rows(topology.isolated_nodes(n, e)) == [(5,)]
    assert (4, 1) in rows(topology.unreachable_pairs(n, e)) and (1, 4) not in rows(topology.unreachable_pairs(n, e))
    assert rows(topology.components(e, n)) == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 5), (6, 6), (7, 6)]
    s = spark.createDataFrame([(1, "s", None, 10), (2, "s", 1, 20), (3, "s", 1, 15), (4, "s", 9, 30), (5, "q", None, 1), (6, "q", 5, 1)], "snapshot_id int, source_id string, previous_id int, retrieved_at int")
    assert rows(topology.lineage(s)) == [("q", 6, "TIME_NOT_INCREASING"), ("s", 2, "FORK"), ("s", 3, "FORK"), ("s", 4, "UNKNOWN_PREVIOUS")]
    assert rows(topology.ancestors(s, s.where("snapshot_id = 2"))) == [(1,), (2,)]


def test_loops_end_at_the_fixed_point_or_fail(spark):
    chain = spark.range(1, 1501).select(F.col("id").alias("snapshot_id"), F.when(F.col("id") > 1, F.col("id") - 1).alias("previous_id"))
    assert rows(topology.ancestors(chain, chain.where("snapshot_id = 1400"))) == [(k,) for k in range(1, 1401)]
    ring = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (9, 1)], "snapshot_id long, previous_id long")
    assert rows(topology.ancestors(ring, ring.where("snapshot_id = 2"))) == [(1,), (2,), (3,)]
    e = spark.createDataFrame([(k, k + 1) for k in range(6)], "from_node int, to_node int")
    n = spark.createDataFrame([(k,) for k in range(7)], "node int")
    assert topology.reachable(e).count() == 21 and rows(topology.components(e, n)) == [(k, 0) for k in range(7)]
    for loop in (lambda: topology.ancestors(chain, chain, 0), lambda: topology.ancestors(chain, chain.where("snapshot_id = 9"), 2), lambda: topology.reachable(e, 2), lambda: topology.components(e, n, 1)):
        with pytest.raises(RuntimeError, match="no fixed point"):
            loop()


def test_roster(spark):
    roster = spark.createDataFrame([(1, "서울역", ["서울(경부)"], "l1", "1호선"), (1, "서울역", None, "l4", "4호선"), (2, "시청", None, "l1", "1호선"), (3, "시청", None, "l2", "2호선")], "station_id int, name string, aliases array<string>, line_id string, line_name string")
    raw = spark.createDataFrame([(1, "서울", "4호선"), (2, "시청", "1호선"), (3, "없음", "1호선"), (4, "서울", "9호선")], "row_id int, raw_name string, raw_line string")
    assert rows(reconcile.match_roster(raw, roster), "row_id", "match_status", "station_id", "line_id") == [(1, "matched", 1, "l4"), (2, "ambiguous", None, None), (3, "unmatched", None, None), (4, "matched", 1, None)]


def test_fold_positions(spark):
    r = spark.createDataFrame([("L", k, k, x, 100 if x is not None else None) for k, x in [(1, None), (2, None), (3, 200), (4, None), (5, 400), (6, None), (7, None)]], "line_id string, seq int, station_id long, x long, y long")
    got = [x.x for x in spatial.fill_positions(r).orderBy("seq").collect()]
    assert got == [144, 172, 200, 300, 400, 456, 512]
    near = spark.createDataFrame([("L", "a", 10.0, 0.0)], "line_id string, id string, x double, y double")
    assert rows(spatial.near_pairs(near.unionByName(spark.createDataFrame([("L", "b", 19.9, 0.0), ("L", "c", -0.1, 0.0), ("K", "d", 10.0, 0.0)], near.schema)), ["line_id"], 10.0), "a", "b") == [("a", "b")]


def test_simplify(spark):
    t = spark.createDataFrame([("a", [0.0, 1.0, 2.0, 3.0], [0.0, 0.01, 0.0, 5.0]), ("closed", [0.0, 4.0, 4.0, 0.0], [0.0, 0.0, 4.0, 0.0]), ("two", [1.0, 2.0], [1.0, 2.0])], "track string, xs array<double>, ys array<double>")
    got = {r.track: r.xs for r in spatial.simplify(t, 0.5).collect()}
    assert got == {"a": [0.0, 2.0, 3.0], "closed": [0.0, 4.0, 4.0, 0.0], "two": [1.0, 2.0]}


def test_versions(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3)], "k int, v string, w int")
    new = spark.createDataFrame([("a", 1, 1), ("b", None, 2), ("d", 3, 3), ("e", 4, 4)], "v string, w int, k int")
    assert rows(versioning.diff_table(old, new, ["k"])) == [(3, "CHANGED"), (4, "ADDED")]
    assert versioning.diff_table(old, old.repartition(3).select("w", "v", "k"), ["k"]).count() == 0
    a, b = versioning.ledger_hash(old.withColumn("g", F.lit(1)), "g").first(), versioning.ledger_hash(old.withColumn("g", F.lit(1)).orderBy(F.desc("k")).repartition(5), "g").first()
    assert a == b != versioning.ledger_hash(old.limit(2).withColumn("g", F.lit(1)), "g").first()
    assert versioning.inherited_violations(old, old.unionByName(new)).count() == 0 and versioning.inherited_violations(old, new.select("k", "v", "w")).count() == 1


def test_policy(spark):
    day = 86_400
    s = spark.createDataFrame([("a", "m", 1706659200, None, None), ("b", "m", 1706659200, 1706659300, 1), ("c", "x", 5, None, None), ("d", "y", 2_000_000_000, None, None), ("e", "bad", 5, None, None), ("f", "m", None, None, None), ("g", "m", 1706659200, 1706659201, None)], "source_id string, class_id string, basis_at long, provider_end long, stored_expiry long")
    p = spark.createDataFrame([("m", "P1M"), ("y", "P1Y"), ("bad", "monthly")], "class_id string, cadence string")
    got = rows(policy.freshness(s, p, 1706659200 + 10 * day))
    assert got == [("a", 1709164800, "FRESH", None), ("b", 1706659300, "INVALID", "STORED_EXPIRY_DIFFERS"), ("c", None, "INVALID", "NO_POLICY"), ("d", 2031536000, "INVALID", "FUTURE_BASIS"), ("e", None, "INVALID", "BAD_CADENCE"), ("f", None, "INVALID", "NO_BASIS"), ("g", 1706659201, "STALE", None)]


def test_coverage_diagnosis(spark):
    scopes = spark.createDataFrame([("r", "o1", "l"), ("r", "o2", "l"), ("r", "o1", "k")], "region_id string, operator_id string, line_id string")
    domains = spark.createDataFrame([("t", ["a", "b"], 1.0)], "domain string, fields array<string>, threshold double")
    sources = spark.createDataFrame([("s", ["r"], ["o1"], ["l"], "t", ["a", "b"])], "source_id string, region_ids array<string>, operator_ids array<string>, line_ids array<string>, domain string, fields array<string>")
    assert rows(coverage.tally(scopes, domains, sources), "operator_id", "line_id", "status") == [("o1", "k", "NO_ADMITTED_SOURCE"), ("o1", "l", "SUPPORTED"), ("o2", "l", "DUAL_OPERATOR_UNMATCHED")]
    assert quality.reason_histogram(spark.createDataFrame([("a: 1",), ("a: 2:3",), ("b",)], "reason string")).count() == 2


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,n\n서울,1\n시청,x\n")
    good, bad = io.scan_csv(spark, str(tmp_path / "a.csv"), "name string, n int")
    assert rows(good) == [("서울", 1)] and good.count() == 1 and bad.count() == 1 and rows(bad) == [("시청,x",)]
    (tmp_path / "b.json").write_text('{"sourceId": "s", "rows": [{"a": 1}, {"a": 2}]}')
    assert rows(io.scan_snapshots(spark, str(tmp_path / "b.json"), "sourceId string", "a int")) == [("s", 1), ("s", 2)]
    with pytest.raises(ValueError, match="unknown table"):
        io.export_rows(good, "stations")
    t = io.typed(spark.createDataFrame([("p", "s1", "서울", 37.5, 127.0)], "pack_id string, stationId string, nameKo string, lat double, lon double"), "stations", {"stationId": "station_id", "nameKo": "name_ko", "lat": "latitude", "lon": "longitude"})
    io.write_tables({"stations": t}, str(tmp_path / "out"))
    io.write_components({"stations": t}, str(tmp_path / "parts"))
    assert spark.read.parquet(str(tmp_path / "out/stations")).count() == 1 and spark.read.parquet(str(tmp_path / "parts/catalog/stations")).columns == t.columns
    assert io.range_violations(t.withColumn("latitude", F.lit(99.0))).count() == 1


def test_status_stream_equals_batch(spark, tmp_path):
    e = [(1, "AVAILABLE", 1000, 1, 50_000), (1, "UNDER_MAINTENANCE", 900, 9, 50_000), (1, "AVAILABLE", 2000, 2, 60_000), (1, "CLOSED", 2000, 3, 60_000), (2, "AVAILABLE", 1500, 4, 1800), (3, "AVAILABLE", 40_000, 5, 90_000)]
    df = spark.createDataFrame(e, "facility_id long, status string, observed_at long, seq long, expires_at long")
    for k in range(len(e)):
        df.where(F.col("seq") == sorted(x[3] for x in e)[k]).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    stream = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    q = status.current_status(stream, "0 seconds").writeStream.outputMode("update").format("memory").queryName("st1").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        q.processAllAvailable()
        out = spark.table("st1").collect()
    finally:
        q.stop()
    last = {}
    for r in out:  # the latest by (observed_at, seq); UNKNOWN follows its own event
        if r.facility_id not in last or (r.observed_at, r.seq, r.status == "UNKNOWN") >= (last[r.facility_id].observed_at, last[r.facility_id].seq, last[r.facility_id].status == "UNKNOWN"):
            last[r.facility_id] = r
    want = {r.facility_id: r.status for r in status.status_at(df, 40_000).collect()}
    assert {k: r.status for k, r in last.items()} == want == {1: "CLOSED", 2: "UNKNOWN", 3: "AVAILABLE"}


AWKWARD = ["x|b=y", "y", "x", "y|b=z", "\\N", "", None, 'q"', "a,b", "a=b", "{}", "null"]


def test_row_texts_are_unambiguous(spark):
    import itertools

    pairs = list(itertools.product(AWKWARD, AWKWARD))
    d = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
    assert d.select(checks.row_text("a", "b")).distinct().count() == len(pairs) and d.select(checks.row_hash("b", "a")).distinct().count() == len(pairs)
    moved = spark.createDataFrame([(k, *pairs[(k + 1) % len(pairs)]) for k in range(len(pairs))], d.schema)
    assert versioning.diff_table(d, moved, ["k"]).where("change = 'CHANGED'").count() == len(pairs) and versioning.diff_table(d, d.select("b", "k", "a").repartition(3), ["k"]).count() == 0
    assert versioning.inherited_violations(d.drop("k"), d.drop("k")).count() == 0 and versioning.inherited_violations(d.drop("k"), d.drop("k").where("k > 0" if False else "a IS NOT NULL")).count() == len(AWKWARD)
    assert versioning.divergent_keys(d.selectExpr("1 AS one", "a", "b"), ["one"]).first()["versions"] == len(pairs)
    one, two = (spark.createDataFrame([("g", m) for m in ms], "g string, m string") for ms in (["a,b"], ["a", "b"]))
    assert versioning.canonical_digest(one, "m", "g").first()["digest"] != versioning.canonical_digest(two, "m", "g").first()["digest"]
    st = spark.createDataFrame([("n", "1,2", "L"), ("n", "3", "L"), ("o", "1", "L"), ("o", "2", "L")], "name string, station_id string, line_id string")
    dec = spark.createDataFrame([("n", "MERGE", ["1", "2,3"]), ("o", "DISTINCT", ["2", "1"])], "name string, decision string, station_ids array<string>")
    assert rows(versioning.identity_violations(st, dec)) == [("n", 2, "OTHER_STATIONS")]
    gaps = spark.createDataFrame([(1, "o", "l", "n")], "gap_id int, operator string, line string, name string")
    got = [reconcile.gap_evidence(gaps, spark.createDataFrame([("o", "l", "n", v)], "operator string, line string, name string, v string"), F.lit(True)).first()["hash"] for v in AWKWARD]
    assert len(set(got)) == len(AWKWARD)


def test_results_do_not_depend_on_order_or_partitions(spark):
    d = spark.createDataFrame([(k % 5, f"s{k % 7}", k) for k in range(60)], "line_id int, station_id string, seq int")
    other = d.orderBy(F.rand(3)).repartition(7).select("seq", "station_id", "line_id")
    for f in (lambda x: versioning.ledger_hash(x, "line_id"), lambda x: versioning.canonical_digest(x, "station_id", "line_id"), lambda x: topology.adjacent_edges(x), lambda x: versioning.latest_per_key(x, "station_id", "seq", "line_id").select("line_id", "station_id", "seq")):
        assert rows(f(d)) == rows(f(other))


def test_official_files(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv/a.csv").write_bytes("name,n\n서울,1\n시청,x\n".encode("utf-8-sig"))
    (tmp_path / "csv/b.csv").write_bytes("name,n\n부산,2\n광주,3,4\n".encode("euc-kr"))
    assert {r["file"][-5:]: r["encoding"] for r in io.file_encodings(spark, str(tmp_path / "csv")).collect()} == {"a.csv": "UTF-8", "b.csv": "EUC-KR"}
    good, bad = io.scan_csv(spark, str(tmp_path / "csv"), "name string, n int")
    assert rows(good) == [("부산", 2), ("서울", 1)] and rows(bad) == [("광주,3,4",), ("시청,x",)]
    shape = "pack_id string, station_id string, line_id string, line_sequence int"
    once = spark.createDataFrame([("p", "s", "l", 1), ("p", "t", "l", 1)], shape)
    assert io.export_rows(once, "station_lines").columns == ["packId", "stationId", "lineId", "lineSequence"]
    with pytest.raises(checks.Violation, match="duplicate keys in station_lines"):
        io.export_rows(once.unionByName(spark.createDataFrame([("p", "s", "l", 2)], shape)), "station_lines")
    for wrong in (once.drop("line_id"), once.withColumn("more", F.lit(1))):
        with pytest.raises(ValueError, match="unknown table or columns"):
            io.export_rows(wrong, "station_lines")


def slow_chain(events, pick, skip):
    """WN-12 and WN-13 by trying every departure."""
    trip, used = {}, set()
    order = sorted(events, key=lambda e: (e[2], e[3], e[1]))
    for g, i, q, t, d in order:
        trip.setdefault((g, i), i)
        free = lambda n: [(e[3], k, e) for k, e in enumerate(order) if e[0] == g and e[2] == q + n and e[4] == d and e[1] not in used]  # noqa: B023, E731
        near = pick(t, free(1))
        if near is None and skip:
            near = skip(t, free(2))
        if near:
            used.add(near[1])
            trip[g, near[1]] = trip[g, i]
    return trip


def test_chaining_brute_force(spark):
    import random

    rng = random.Random(9)
    events = [(f"d{rng.randrange(3)}", k, rng.randrange(6), rng.randrange(0, 4000, 20), rng.choice(["N", "S"])) for k in range(400)]
    df = spark.createDataFrame(events, "grp string, event_id long, seq int, seconds int, destination string")

    def only(t, free):
        ok = [x for x in free if 60 <= x[0] - t <= 300]
        return ok[0][2] if len(ok) == 1 else None

    def nearest(want):
        def pick(t, free):
            ok = sorted((abs(x[0] - t - want), x[0], x[1], x[2]) for x in free if abs(x[0] - t - want) <= 120)
            return ok[0][3] if ok else None
        return pick

    got = timetable.chain_departures(df)
    assert {(r.grp, r.event_id): r.trip_id for r in got.collect()} == slow_chain(events, only, None)
    near = timetable.chain_nearest(df)
    assert {(r.grp, r.event_id): r.trip_id for r in near.collect()} == slow_chain(events, nearest(180), nearest(360)) and near.where("repaired").count() > 0
    book = timetable.accounting(df, near).collect()
    assert all(r.balanced and r.read == r.in_trips + r.left_over for r in book) and sum(r.left_over for r in book) == timetable.leftovers(near).count() > 0
    ends = timetable.last_stops(got, spark.createDataFrame([(k, 100 + k) for k in range(6)], "seq int, seconds int"))
    assert ends.count() == got.select("grp", "trip_id").distinct().count()


def test_nearest_and_spread_brute_force(spark):
    import math
    import random

    rng = random.Random(4)
    segs = [(f"L{k % 3}", k, x := rng.uniform(-900, 900), y := rng.uniform(-900, 900), x + rng.uniform(-300, 300), y + rng.uniform(-300, 300)) for k in range(30)] + [("far", 99, 9e4, 9e4, 9e4, 9e4)]
    nodes = [(k, ["L0", "L1", "L2", "far", "none"][k % 5], rng.uniform(-3000, 3000), rng.uniform(-3000, 3000)) for k in range(100)]

    def dist(x, y, s):
        dx, dy = s[4] - s[2], s[5] - s[3]
        n = dx * dx + dy * dy
        t = 0.0 if n == 0 else max(0.0, min(1.0, ((x - s[2]) * dx + (y - s[3]) * dy) / n))
        return math.hypot(x - s[2] - t * dx, y - s[3] - t * dy)

    got = {r.id: r.distance for r in spatial.nearest_segment(spark.createDataFrame(nodes, "id int, line_id string, x double, y double"), spark.createDataFrame(segs, "line_id string, seg_id int, x0 double, y0 double, x1 double, y1 double")).collect()}
    want = {k: min(dist(x, y, s) for s in segs if s[0] == line) for k, line, x, y in nodes if line != "none"}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)
    pts = [(s, f"l{k % (1 if s == 3 else 2)}", rng.randrange(500), rng.randrange(500)) for s in range(4) for k in range(1 + 30 * s)]
    spread = {r.station_id: r.spread for r in spatial.interchange_spreads(spark.createDataFrame(pts, "station_id int, line_id string, x int, y int")).collect()}
    assert spread.keys() == {1, 2} and all(math.isclose(spread[s], max(math.dist(p[2:], q[2:]) for p in pts for q in pts if p[0] == q[0] == s)) for s in spread)
    lines = [(k, k % 4, x := rng.uniform(0, 400), y := rng.uniform(0, 30), x + rng.uniform(20, 300), y + rng.uniform(-0.5, 0.5)) for k in range(80)]

    def overlaps(a, b):
        la, ang = math.hypot(a[4] - a[2], a[5] - a[3]), lambda s: math.degrees(math.atan2(s[5] - s[3], s[4] - s[2])) % 180
        ux, uy = (a[4] - a[2]) / la, (a[5] - a[3]) / la
        d = abs(ang(a) - ang(b))
        off = abs(((b[2] + b[4]) / 2 - a[2]) * uy - ((b[3] + b[5]) / 2 - a[3]) * ux)
        p, q = ((b[2] - a[2]) * ux + (b[3] - a[3]) * uy), ((b[4] - a[2]) * ux + (b[5] - a[3]) * uy)
        return a[1] != b[1] and min(d, 180 - d) <= 0.5 and off < 2 and min(la, max(p, q)) - max(0, min(p, q)) > 0

    pairs = spatial.collinear_overlaps(spark.createDataFrame(lines, "id int, line_id int, x0 double, y0 double, x1 double, y1 double"), cell=16.0)
    assert rows(pairs, "a", "b") == sorted((a[0], b[0]) for a in lines for b in lines if a[0] < b[0] and overlaps(a, b))


def test_no_nested_loop_and_no_single_task_window(spark):
    SF = "/root/testdata/sf0.001"
    if not __import__("os").path.isdir(SF):
        pytest.skip("the driver's tables are not here")
    from railtable.plans import registry

    for name in ("jn13_near_pairs", "jn15_box_overlaps", "jn16_collinear", "jn17_crossings", "jn18_nearest_segment", "jn23_work_plan", "jn30_off_track", "jn31_snap_ends", "wn22_passed_through", "ag19_spreads"):
        plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_lineage_chain(spark):
    n = 100_000
    chain = spark.range(n).select(F.col("id").alias("snapshot_id"), F.lit("s").alias("source_id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("previous_id"), F.col("id").alias("retrieved_at"))
    got = topology.lineage_chain(chain)
    assert got.where("position <> snapshot_id OR status <> 'ON_CHAIN'").count() == 0 and got.count() == n
    links = chain.where("snapshot_id < 1000").select(F.col("snapshot_id").alias("node"), F.col("previous_id").alias("parent"))
    with pytest.raises(RuntimeError, match="no fixed point"):
        topology.ranked(links, 9)
    assert topology.ranked(links, 12).where("top = 0 AND distance = node").count() == 1000
    odd = spark.createDataFrame([(1, "s", None, 1), (2, "s", 1, 2), (3, "s", 2, 3), (3, "s", 2, 3), (4, "s", 9, 4), (5, "s", 4, 5), (6, "s", 7, 6), (7, "s", 6, 7), (8, "s", 7, 8), (9, "t", None, 1), (10, "u", 10, 1)], "snapshot_id int, source_id string, previous_id int, retrieved_at int")
    assert rows(topology.lineage_chain(odd), "snapshot_id", "position", "status") == [
        (1, 0, "ON_CHAIN"), (2, 1, "ON_CHAIN"), (3, 2, "ON_CHAIN"), (4, None, "DISCONNECTED"), (5, None, "DISCONNECTED"), (6, None, "CYCLE"), (7, None, "CYCLE"), (8, None, "CYCLE"), (9, 0, "ON_CHAIN"), (10, None, "CYCLE")
    ]
    assert [tuple(r) for r in topology.lineage(odd).where("snapshot_id = 3").collect()] == [("s", 3, "DUPLICATE_ID")]
    assert rows(topology.sources_without_root(odd)) == [("u",)] and topology.lineage_chain(odd.limit(0)).count() == 0


def test_merged_ids(spark):
    m = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "c"), ("d", "c"), ("x", "y"), ("y", "x"), ("z", "x"), ("t", "u"), ("t", "v"), ("s", "t"), ("n", None)], "old_id string, new_id string")
    good, refused = topology.merged_ids(m)
    assert rows(good) == [("a", "c"), ("b", "c"), ("d", "c")]
    assert rows(refused) == [("s", "LEADS_TO_REFUSED"), ("t", "TWO_TARGETS"), ("x", "CYCLE"), ("y", "CYCLE"), ("z", "CYCLE")]
    e = spark.createDataFrame([("a", "b:L1:x", 1), ("x", "zz", 2), (None, None, 3), ("b", "a", 4)], "station string, node string, k int")
    got = topology.rewrite_ids({"e": e, "f": e}, good, {"e": ["station"]}, {"e": ["node"]})
    assert rows(got["e"].orderBy("k"), "k", "station", "node") == [(1, "c", "c:L1:x"), (2, "x", "zz"), (3, None, None), (4, "c", "a")] and rows(got["f"]) == rows(e)
    assert rows(topology.alias_rows(good, spark.createDataFrame([("a", "old A"), ("c", "C")], "station_id string, alias string"))) == [("c", "C"), ("c", "a"), ("c", "b"), ("c", "d"), ("c", "old A")]


def test_stop_rows_and_terminals(spark):
    s = spark.createDataFrame([("e", 1, 0, 1), ("e", 2, 1, 0), ("e", 3, None, None), ("e", 4, 1, 0), ("l", 1, 1, 0), ("l", 1, 0, 0), ("l", 0, 3, 0), ("q", 1, 0, 0)], "trip_id string, stop_no int, pickup_type int, drop_off_type int")
    t = spark.createDataFrame([("e", "EXPRESS"), ("l", "LOCAL"), ("w", "LOCAL")], "trip_id string, pattern string")
    assert rows(timetable.stop_row_violations(s, t), "trip_id", "stop_no", "reason") == [("e", 2, "EXPRESS_PASS_THROUGH"), ("l", 0, "BAD_PICKUP_TYPE"), ("l", 0, "STOP_NO_BELOW_1"), ("l", 1, "DUPLICATE_KEY"), ("q", 1, "UNKNOWN_TRIP"), ("w", None, "TRIP_WITHOUT_STOPS")]
    r = spark.createDataFrame([("a", 1, "ORIGIN"), ("a", 2, "TERMINAL"), ("a", 3, "ORIGIN"), ("a", 4, "TERMINAL")], "trip_id string, stop_no int, role string")
    assert rows(timetable.terminal_violations(r)) == [("a", 2, "TERMINAL_NOT_LAST"), ("a", 3, "ORIGIN_NOT_FIRST")]


def test_pair_violations(spark):
    def full(train, stations, step=1, times=True):
        out = []
        for i, a in enumerate(stations):
            for j, b in enumerate(stations):
                if i < j:
                    out.append((train, a, step * (i + 1), 600 * i, b, step * (j + 1), 600 * j - 60 if times else 600 * i))
        return out

    data = full("ok", "abcd") + full("down", "abcd", -1) + full("late", "abc", times=False) + full("twice", "abc") + [("twice", "a", 1, 0, "b", 2, 540)] + full("lacks", "abc")[:-1] + full("turn", "abc") + [("turn", "c", 3, 1300, "a", 1, 1400)]
    df = spark.createDataFrame(data, "train string, origin string, origin_seq int, departs int, destination string, destination_seq int, arrives int")
    got = rows(timetable.pair_violations(df))
    assert [r for r in got if r[0] in ("ok", "down", "twice", "lacks")] == [("lacks", "PAIRS_MISSING"), ("twice", "PAIR_TWICE")]
    assert {r[1] for r in got if r[0] == "turn"} >= {"MIXED_DIRECTION"} and ("late", "TIMES_NOT_INCREASING") in got
    assert [r.station for r in timetable.trips_from_pairs(df).where("train = 'down'").orderBy("stop_no").collect()] == list("abcd")


def test_corridor_order(spark):
    s = spark.createDataFrame([("u", k, st, "L", "up", q) for k, (st, q) in enumerate([("a", 1), ("b", 2), ("c", 3), ("b", 2), ("d", 9), ("e", None)])] + [("d", 1, "c", "L", "down", 3), ("d", 2, "a", "L", "down", 1), ("n", 1, "a", "L", "sideways", 1), ("n", 2, "b", "L", "up", 2)], "trip_id string, stop_no int, station_id string, line_id string, direction string, seq int")
    c = spark.createDataFrame([("a", "L", 1), ("b", "L", 2), ("c", "L", 3), ("d", "L", 4), ("b", "L", 7)], "station_id string, line_id string, seq int")
    steps = topology.corridor_steps(s, c)
    assert rows(steps) == [("d", 1, None), ("n", 1, "UNKNOWN_DIRECTION"), ("u", 0, None), ("u", 1, None), ("u", 2, "AGAINST_DIRECTION"), ("u", 3, "OTHER_SEQUENCE"), ("u", 4, "NOT_ON_CORRIDOR")]
    assert rows(topology.corridor_agreement(steps)) == [("d", 1, 1, 1), ("n", 1, 0, 0), ("u", 5, 2, 2)]
