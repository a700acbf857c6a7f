"""Joins by a name that many rows share make no row for each pair, and give what listing all pairs gives."""

import random
import re

from conftest import rows
from pyspark.sql import functions as F

from railtable.operators import reconcile as R
from railtable.operators import timetable as T
from railtable.operators import topology as G


def most_rows(df):
    """The most rows that a step of the plan made; df is run."""
    df.collect()

    def walk(p):
        for inner in ("executedPlan", "plan"):
            if p.getClass().getSimpleName() in {"executedPlan": ("AdaptiveSparkPlanExec",), "plan": ("ShuffleQueryStageExec", "BroadcastQueryStageExec", "ResultQueryStageExec", "TableCacheQueryStageExec")}[inner]:
                return walk(getattr(p, inner)())
        made = p.metrics().get("numOutputRows")
        return max([made.get().value() if made.isDefined() else 0, *(walk(p.children().apply(k)) for k in range(p.children().size()))])

    return walk(df._jdf.queryExecution().executedPlan())


def test_roster_of_one_name(spark):
    raw = spark.range(2000).select(F.col("id").alias("row_id"), F.lit("a").alias("raw_name"), F.lit("l").alias("raw_line"))
    roster = spark.range(2000).select(F.col("id").alias("station_id"), F.lit("a").alias("name"), F.lit(None).cast("array<string>").alias("aliases"), F.lit("l").alias("line_id"), F.lit("l").alias("line_name"))
    got = R.match_roster(raw, roster)
    assert most_rows(got) <= 10_000
    assert got.groupBy("match_status", "n_candidates").count().collect() == [("ambiguous", 2000, 2000)]


def test_labels_of_one_name(spark):
    labels = spark.range(2000).select(F.col("id").alias("label_id"), F.lit("a").alias("name"))
    stations = spark.range(2000).select(F.lit("a").alias("name"), F.col("id").alias("station_id"))
    out, left = R.match_labels(labels, stations, spark.createDataFrame([(5, 7)], "label_id long, station_id long"))
    assert most_rows(out) <= 10_000 and most_rows(left) <= 10_000
    assert rows(out.where("match_status <> 'ambiguous'")) == [(5, 7, "reviewed")] and left.count() == 1999


def test_keys_of_one_name(spark):
    r = spark.range(2000).select(F.col("id").alias("row_id"), F.lit("a").alias("name"), (F.col("id") % 2).alias("code"))
    names = spark.range(2000).select(F.lit("a").alias("name"), F.col("id").alias("station_id"))
    codes = spark.range(3000).select((F.col("id") % 3).alias("code"), F.col("id").alias("station_id"))
    got = R.multi_key_match(r, names, codes, r.select("row_id", F.col("row_id").alias("station_id")))
    assert most_rows(got) <= 20_000
    assert got.select("n_candidates").distinct().collect() == [(2333,)]  # 2,000 by name, 1,000 by code, 667 of them in both


def test_keys_against_sets(spark):
    """Small random inputs with nulls, doubles and overlaps, against sets in Python."""
    draw = random.Random(3)
    some = lambda n: draw.choice([None, *range(n)])
    r = [(k, some(4), some(4)) for k in range(40)]
    names, codes = ([(some(4), some(9)) for _ in range(9)] for _ in "ab")
    own = [(draw.randrange(45), some(9)) for _ in range(25)]
    d = lambda x, s: spark.createDataFrame(x, s)
    got = R.multi_key_match(d(r, "row_id long, name long, code long"), d(names, "name long, station_id long"), d(codes, "code long, station_id long"), d(own, "row_id long, station_id long"))
    want = []
    for k, name, code in r:
        s = ({b for a, b in names if a == name and a is not None} | {b for a, b in codes if a == code and a is not None} | {b for a, b in own if a == k}) - {None}
        want.append((k, len(s), next(iter(s)) if len(s) == 1 else None, ("unmatched", "matched")[len(s)] if len(s) < 2 else "ambiguous"))
    assert len({w[3] for w in want}) == 3
    assert rows(got, "row_id", "n_candidates", "station_id", "match_status") == sorted(want)


def _map(spark, n):
    nodes = spark.range(n).select(F.col("id").alias("node_id"), F.lit("a").alias("name"), F.lit("l").alias("line_id"), (F.col("id") % 2 == 0).alias("by_line"), F.col("id").alias("x"), F.lit(0).alias("y"))
    labels = spark.range(n).select(F.lit("a").alias("name"), F.lit(1).cast("long").alias("x"), F.lit(1).alias("y"))
    stations = spark.range(n).select(F.col("id").alias("station_id"), F.lit("a").alias("name"), F.lit("l").alias("line_id"), F.lit("here").alias("region"))
    return nodes, labels, stations


def test_assignments_of_one_name(spark):
    nodes, labels, stations = _map(spark, 2000)
    got = R.first_assignments(nodes, labels, stations, "here")
    assert most_rows(got) <= 10_000
    assert got.count() == 2000 and rows(got.where("station_id < 2"), "station_id", "node_id") == [(0, 0), (1, 1)]
    assigned = R.assign_nodes(nodes, stations)
    assert most_rows(assigned) <= 10_000 and assigned.where("station_id = 0 AND on_line").count() == 2000


def test_candidates_are_listed_once(spark):
    """The listing is the last step: as many rows as it has, and no step with more; equal labels and stations with two names count once."""
    nodes, labels, stations = _map(spark, 300)
    got = R.node_candidates(nodes, labels, stations, "here")
    assert most_rows(got) <= 150 * 300 + 300 + 150
    assert got.count() == got.distinct().count() == 150 * 300 + 150 + 300
    two = stations.unionByName(stations.withColumn("name", F.lit("b")))
    again = R.node_candidates(nodes, labels.unionByName(labels.withColumn("name", F.lit("b"))), two, "here")
    assert rows(again) == rows(got)
    firsts = R.first_candidates(got)
    assert rows(firsts) == rows(R.first_assignments(nodes, labels, stations, "here"))


def test_fares_of_one_origin(spark):
    """Every trip starts at station 0, which has a quote to each other station."""
    from railtable.operators.timetable import attach_fares

    stops = spark.range(2000).select(F.col("id").alias("trip_id"), F.explode(F.array(F.struct(F.lit(0).cast("long").alias("station_id"), F.lit(1).alias("stop_no")), F.struct((F.col("id") + 1).alias("station_id"), F.lit(2).alias("stop_no")))).alias("s")).select("trip_id", "s.*")
    quotes = spark.range(1, 2001).select(F.lit(0).cast("long").alias("origin"), F.col("id").alias("destination"), (F.col("id") + 5).alias("fare"))
    got = attach_fares(stops, quotes.unionByName(quotes.select(F.col("destination").alias("origin"), F.col("origin").alias("destination"), "fare")))
    assert most_rows(got) <= 10_000
    assert got.count() == 2000 and got.where("origin = 0 AND destination = trip_id + 1 AND fare = trip_id + 6").count() == 2000


def test_vertices_are_read_once(spark):
    """The path of SC-21 is taken apart once for x and once for y, however many points are asked for."""
    from railtable.plans import registry

    df = registry.queries()["sc21_arc_length"](spark, "/root/testdata/sf0.001")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") <= 2


def test_points_within(spark):
    """A target in the own cell, in the next ones, none; equal points each stand for themselves; most points of a crowd meet no target row by row."""
    import math

    from railtable.operators.spatial import within

    draw = random.Random(4)
    p = [(k, draw.uniform(0, 40), draw.uniform(0, 40)) for k in range(200)] + [(900, 0.0, 0.0), (901, 0.0, 0.0), (902, 17.0, 0.0), (903, 500.0, 0.0)]
    t = [(draw.uniform(-20, 60), draw.uniform(-20, 60)) for _ in range(12)] + [(0.0, -17.0)]
    near, rest = within(spark.createDataFrame(p, "id long, x double, y double"), spark.createDataFrame(t, "x double, y double"), 17.0, 10)
    want = {k: min(math.hypot(x - u, y - v) for u, v in t) < 17 for k, x, y in p}
    assert rows(near, "id") == sorted((k,) for k, w in want.items() if w) and rows(rest, "id") == sorted((k,) for k, w in want.items() if not w)


def test_crossings_on_borders_count_once(spark):
    """Crossings on a cell's corner, on its side, inside, and of two nearly parallel segments through many cells."""
    from railtable.operators.spatial import crossing_points

    s = [(1, 1, -50.0, -50.0, 50.0, 50.0), (2, 2, -50.0, 50.0, 50.0, -50.0), (3, 3, 5.0, -40.0, 5.0, 40.0), (4, 4, -1000.0, -200.0, 1000.0, -200.0), (5, 5, -1000.0, -200.0001, 1000.0, -199.9999)]
    got = crossing_points(spark.createDataFrame(s, "id long, track long, x0 double, y0 double, x1 double, y1 double"), 10.0)
    assert rows(got, "a", "b") == [(1, 2), (1, 3), (2, 3), (4, 5)]


def test_coming_reads_a_line_once(spark):
    """No frame ends with the line's last row (Spark works such a one out anew for each row); a line of 200,000 rows takes seconds."""
    from railtable.operators.ordered import along, coming

    lines = spark.range(200_000).select(F.lit("a").alias("line"), "id", F.when(F.col("id") % 1000 == 999, F.col("id")).alias("x"))
    for block in (10**6, 50_000):
        got = along(lines, ["line"], ["id"], {"c": coming("x")}, block)
        assert "unboundedfollowing" not in got._jdf.queryExecution().optimizedPlan().toString().lower()
        assert got.where("c <> id - id % 1000 + 999 OR c IS NULL").count() == 0


def test_unreachable_in_dense_graph(spark):
    """Two rings with chords, one leading into the other, single nodes before, between and behind: no step lists a path of each length, and the pairs are those of a plain search."""
    from railtable.operators.topology import unreachable_pairs

    ring = lambda lo, n: [(lo + k, lo + (k + d) % n) for k in range(n) for d in range(1, 12)]
    e = ring(0, 40) + ring(100, 30) + [(3, 200), (200, 104), (300, 5), (110, 301), (400, 400), (7, 999)]
    nodes = [*range(40), *range(100, 130), 200, 300, 301, 400, 500]
    out: dict[int, set[int]] = {}
    for a, b in e:
        out.setdefault(a, set()).add(b)
    want = []
    for a in nodes:
        seen, todo = set(), [a]
        while todo:
            todo = [y for x in todo for y in out.get(x, ()) if y not in seen and not seen.add(y)]
        want += [(a, b) for b in nodes if a != b and b not in seen]
    got = unreachable_pairs(spark.createDataFrame([(k,) for k in nodes], "node long"), spark.createDataFrame(e, "from_node long, to_node long"))
    assert rows(got, "source", "node") == sorted(want)
    assert got.rdd.getNumPartitions() >= 8


def test_agreement_needs_no_distinct_values(spark):
    """Whether values agree is told by the smallest and largest, so rows are not multiplied for each distinct count; nulls do not count."""
    from railtable.operators import timetable as T

    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    pairs = spark.createDataFrame([(1, "a", 1, 5, "b", 2, 9), (1, "a", 1, 5, "c", 3, 20), (1, "b", 2, 10, "c", 3, None), (2, "a", 1, None, "b", 2, 9), (2, "a", 1, 6, "b", 2, 8)], "train int, origin string, origin_seq int, departs long, destination string, destination_seq int, arrives long")
    got = T.trips_from_pairs(pairs)
    assert "Expand" not in plan(got) and "Expand" not in plan(T.pair_violations(pairs))
    assert rows(got, "train", "station", "times_agree") == [(1, "a", True), (1, "b", True), (1, "c", True), (2, "a", True), (2, "b", False)]
    stops = spark.createDataFrame([(1, 1, 1, "L"), (1, 2, 2, None), (1, 3, 3, "L"), (2, 1, 1, "L"), (2, 2, 2, "E"), (3, 1, 1, None)], "trip_id int, stop_no int, seq int, pattern string")
    found = T.direction_violations(stops)
    assert "distinct" not in plan(found) and rows(found) == [(2, "MIXED_PATTERN")]


def steps_of(df, *names):
    """How often each of the named steps stands in the plan that df was run by."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [len(re.findall(rf"(?m)^[ :*+\-()\d]*{n}\b", final)) for n in names]


def test_trips_need_one_sort(spark):
    """WN-1: trips come from the rows as sorted for their stops, without hash tables of trips; a null sequence at an end is the end's."""
    d = spark.createDataFrame([("A", "1", "w", 7, 3, 20), ("A", "1", "w", 8, 1, 10), ("A", "2", "w", 7, 1, 5), ("A", "2", "w", 9, 4, 5), ("B", "1", "w", 5, None, 1), ("B", "1", "w", None, 2, 2), (None, "1", "w", 4, 1, 1)], "line_id string, train_no string, day string, station_id int, seq int, time int")
    trips = T.reconstruct_trips(d)[0]
    assert rows(trips) == [(None, "1", "w", "UP", 4, 1), ("A", "1", "w", "UP", 7, 2), ("A", "2", "w", "UP", 9, 2), ("B", "1", "w", "DOWN", None, 2)]
    assert steps_of(trips, "HashAggregate", "SortAggregate", "Sort", "Exchange") == [0, 0, 1, 1]


def test_corridor_agreement_needs_one_sort(spark):
    """GR-6: against a count in Python, with stops of one number; no hash tables of trips or runs."""
    draw = random.Random(5)
    listed = [(draw.choice(["a", "b", "c", None]), draw.randrange(12), draw.choice([None, None, "X"])) for _ in range(60)]
    want = []
    for trip in {t for t, _, _ in listed}:
        own = [(n, r) for t, n, r in listed if t == trip]
        run = lambda n: sum(r is not None for m, r in own if m <= n)  # noqa: B023, E731
        want.append((trip, len(own), sum(r is None for _, r in own), max(sum(r is None for m, r in own if run(m) == k) for k in {run(n) for n, _ in own})))
    got = G.corridor_agreement(spark.createDataFrame(listed, "trip_id string, stop_no int, reason string"))
    assert rows(got) == sorted(want, key=lambda x: (x[0] is not None, x[0] or ""))
    assert steps_of(got, "HashAggregate", "Sort", "Exchange") == [0, 1, 1]


def test_stop_rows_read_stops_once(spark):
    """WN-4: stops and trips meet in one exchange, so the stops are not read once for each check; null keys and trips listed twice as in the SQL."""
    s = spark.createDataFrame([("e", 1, 0, 0), ("e", 1, 0, 0), ("e", None, 0, 0), (None, 1, 0, 0)], "trip_id string, stop_no int, pickup_type int, drop_off_type int")
    t = spark.createDataFrame([("e", "LOCAL"), ("w", "LOCAL"), ("w", "EXPRESS"), (None, "LOCAL")], "trip_id string, pattern string")
    got = T.stop_row_violations(s, t)
    assert rows(got) == [(None, None, "TRIP_WITHOUT_STOPS"), (None, 1, "UNKNOWN_TRIP"), ("e", 1, "DUPLICATE_KEY"), ("w", None, "TRIP_WITHOUT_STOPS")]
    assert steps_of(got, "SortMergeJoin", "BroadcastHashJoin", "Sort", "Exchange") == [0, 0, 1, 1]


def test_all_pairs_repeat_few_values(spark):
    """All pairs are listed in tiles, by as many tasks as asked for, whichever side is smaller: no partition goes through all of the other side again for each row, and none of the pairs is lost."""
    from railtable.operators.ordered import tiled

    for n, m in ((1100, 1300), (40, 1300), (1300, 40), (0, 3), (3, 0), (1, 1)):
        a, b = spark.range(n).select(F.col("id").alias("a")), spark.range(m).select(F.col("id").alias("b"))
        got = tiled(a, b, n, m, tile=100)
        assert got.distinct().count() == got.count() == n * m
        if n * m > 1:
            assert got.rdd.getNumPartitions() >= 8
            assert got.groupBy(F.spark_partition_id()).agg(F.count_distinct("b").alias("n")).where("n > 100").isEmpty()
    from railtable.operators.reconcile import od_matrix

    od = od_matrix(spark.range(2000).withColumnRenamed("id", "station_id"))
    assert od.count() == 2000 * 1999 and od.groupBy(F.spark_partition_id()).agg(F.count_distinct("destination").alias("n")).where("n > 512").isEmpty()


def test_crossings_are_compiled_and_once(spark):
    """The functions that Spark makes of the join are short enough for the JVM to compile (8,000 bytes), no rows are made distinct, and crossings on cells' corners and sides come once: brute force on a lattice."""
    import re

    from railtable.operators.spatial import crossing_points

    sign = lambda v: (v > 0) - (v < 0)
    s = [(k, k % 4, float(k * 7 % 50), float(k * 11 % 40), float(k * 7 % 50 + k * 37 % 61 - 30), float(k * 11 % 40 + k * 53 % 61 - 30)) for k in range(150)]
    turn = lambda a, x, y: (a[4] - a[2]) * (y - a[3]) - (a[5] - a[3]) * (x - a[2])
    split = lambda a, b: sign(turn(a, b[2], b[3])) * sign(turn(a, b[4], b[5])) < 0
    want = [(a[0], b[0]) for a in s for b in s if a[0] < b[0] and a[1] != b[1] and split(a, b) and split(b, a)]
    segments = spark.createDataFrame(s, "id long, track long, x0 double, y0 double, x1 double, y1 double")
    for crowd in (4096, 16):
        assert rows(crossing_points(segments, 10.0, crowd), "a", "b") == want
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = crossing_points(segments, 10.0)._jdf.queryExecution().executedPlan()
        code = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$").codegenString(plan)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000 and "HashAggregate" not in plan.toString()


def test_collinear_pairs_come_once(spark):
    """No pairs are made distinct, and those of lines in all directions, of lengths from 2 to 900 and far from the origin are those of a plain comparison."""
    import math
    import random

    from railtable.operators.spatial import collinear_overlaps

    r, s = random.Random(7), []
    for k in range(40):
        cx, cy, turn, far = r.uniform(-300, 300), r.uniform(-300, 300), r.choice([0, 0.2, 44.9, 90, 179.8, 359.9, 120.3]), 10.0 ** (5 * (k % 2))
        for i in range(8):
            t, half, d = math.radians(turn + r.uniform(-0.4, 0.4)), r.choice([1, 20, 30, 450]), r.uniform(-40, 40)
            x, y = far + cx + d * math.cos(t) - r.uniform(-3, 3) * math.sin(t), cy + d * math.sin(t) + r.uniform(-3, 3) * math.cos(t)
            s.append((8 * k + i, i % 3, x - half * math.cos(t), y - half * math.sin(t), x + half * math.cos(t), y + half * math.sin(t)))

    def meets(a, b):
        dx, dy = a[4] - a[2], a[5] - a[3]
        n = math.hypot(dx, dy)
        one, two = (math.degrees(math.atan2(v[5] - v[3], v[4] - v[2])) % 180 for v in (a, b))
        ux, uy, diff = dx / n, dy / n, abs(one - two)
        off = abs(((b[2] + b[4]) / 2 - a[2]) * uy - ((b[3] + b[5]) / 2 - a[3]) * ux)
        ends = [(b[i] - a[2]) * ux + (b[i + 1] - a[3]) * uy for i in (2, 4)]
        return min(diff, 180 - diff) <= 0.5 and off < 2 and min(n, max(ends)) > max(0.0, min(ends))

    want = [(a[0], b[0]) for a in s for b in s if a[0] < b[0] and a[1] != b[1] and meets(a, b)]
    d = spark.createDataFrame(s, "id long, line_id long, x0 double, y0 double, x1 double, y1 double")
    assert len(want) > 200
    for crowd in (4096, 4):
        got = collinear_overlaps(d, crowd=crowd)
        assert rows(got, "a", "b") == want
    assert "Aggregate" not in collinear_overlaps(d)._jdf.queryExecution().optimizedPlan().toString()


def test_candidates_of_one_name_are_dealt_out(spark):
    """5,000 nodes of one name and its 1,300 stations, 1,000 of them in the region: all 5,000,000 candidates once, from more than one task, beside a single station, a node without one and labels of one place."""
    from railtable.operators.reconcile import node_candidates

    nodes = spark.range(5000).selectExpr("id AS node_id", "'a' AS name", "'L' AS line_id", "false AS by_line", "id % 7 AS x", "id % 5 AS y")
    nodes = nodes.unionByName(spark.createDataFrame([(5000, "b", "L", False, 1, 1), (5001, "none", "L", False, 2, 2), (5002, None, "L", False, 3, 3)], "node_id long, name string, line_id string, by_line boolean, x long, y long"))
    stations = spark.range(1300).selectExpr("id AS station_id", "'a' AS name", "'L' AS line_id", "IF(id < 1000, 'here', 'there') AS region")
    stations = stations.unionByName(spark.createDataFrame([(2000, "b", "M", "there")], stations.schema))
    labels = spark.createDataFrame([("b", 9, 9), ("b", 9, 9), ("a", 8, 8)], "name string, x long, y long")
    got = node_candidates(nodes, labels, stations, "here")
    marked = got.where("source = 'NODE' AND node_id < 5000")
    assert marked.groupBy(F.spark_partition_id()).count().count() > 1
    whole = marked.agg(F.count("*"), F.count_distinct(F.col("node_id") * 1000 + F.col("station_id")), F.min("station_id"), F.max("station_id")).first()
    assert tuple(whole) == (5_000_000, 5_000_000, 0, 999)
    assert rows(got.where("source = 'NODE' AND node_id >= 5000"), "node_id", "station_id") == [(5000, 2000), (5001, None), (5002, None)]
    assert rows(got.where("source = 'LABEL'").groupBy("x").agg(F.count("*").alias("n")), "x", "n") == [(8, 1000), (9, 1)]
