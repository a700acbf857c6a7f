"""Scans along lines that are longer than a block: equal to plain windows, and no range holds a line."""

import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from railtable.operators import ordered, spatial, topology
from railtable.operators.ordered import after, along, before, coming, known, running

N = 4000


@pytest.fixture(scope="module")
def lines(spark):
    """One line with nine tenths of the rows, a few short ones, a null one; shuffled."""
    rng = random.Random(8)
    data = [("big" if k % 10 else rng.choice(["a", "b", None]), k, rng.randrange(300), rng.randrange(1000) if rng.random() < 0.2 else None, rng.randrange(1000), f"n{k % 7}", "op1" if k % 90 < 50 else "op2") for k in range(N)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "line_id string, seq int, station_id long, x long, y long, name string, operator string").repartition(7)


def test_like_windows(lines):
    w = Window.partitionBy("line_id").orderBy("seq")
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    want = lines.withColumns({
        "p": F.lag("x").over(w), "n": F.lead("x").over(w), "t": F.coalesce(F.sum("x").over(up), F.lit(0)), "k": F.last("x", ignorenulls=True).over(up),
        "c": F.first("x", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)),
    })
    steps = {"p": before("x"), "n": after("x"), "t": running("x"), "k": known("x"), "c": coming("x")}
    for block in (50, 10_000):
        assert rows(along(lines, ["line_id"], ["seq"], steps, block), *want.columns) == rows(want)
    assert along(lines.limit(0), ["line_id"], ["seq"], steps, 50).count() == 0


def test_no_range_holds_a_line(lines):
    most, total = ordered.longest(lines, ["line_id"])
    parts = ordered.ranges(lines, ["line_id"], ["seq"], total, 200)
    sizes = parts.groupBy("line_id", "_part").count()
    assert most > 0.85 * N and sizes.agg(F.max("count")).first()[0] <= 400
    spans = sorted((r.a, r.b) for r in parts.where("line_id = 'big'").groupBy("_part").agg(F.min("seq").alias("a"), F.max("seq").alias("b")).collect())
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_operators_in_ranges(lines):
    named = lines.where("line_id IS NOT NULL")
    for op in (topology.adjacent_edges, spatial.label_offsets, spatial.half_paths, lambda d, block: topology.same_neighbours(d, d.withColumn("seq", -F.col("seq")), block),
               lambda d, block: topology.physical_graph(d, block)[1], lambda d, block: topology.edges_from_distances(d.selectExpr("*", "seq AS forward_m", "seq % 3 AS backward_m", "seq % 17 = 0 AS is_depot"), block)):
        d = named.withColumn("x", F.coalesce("x", F.lit(5)))
        assert rows(op(d, block=60)) == rows(op(d, block=10**6))
    listed = named.withColumns({"pos": F.col("seq"), "distance_m": F.col("x")})
    cut_ = topology.branch_segments(listed, "operator", 60)
    assert rows(cut_) == rows(topology.branch_segments(listed, "operator")) and rows(topology.segment_edges(cut_, block=60)) == rows(topology.segment_edges(cut_))


def test_fill_positions_in_ranges(lines):
    """Against the fold along each whole line, written plainly."""
    d = lines.where("line_id IS NOT NULL").withColumn("y", F.when(F.col("x").isNotNull(), F.col("y")))
    d = d.withColumns({c: F.when((F.col("line_id") != "b") & F.col("seq").between(400, 3500), F.col(c)) for c in ("x", "y")})
    want = []
    by_line = {}
    for r in d.collect():
        by_line.setdefault(r.line_id, []).append(r)
    for line, rs in by_line.items():
        rs.sort(key=lambda r: (r.seq, r.station_id))
        prev = None
        for i, r in enumerate(rs):
            n = next((q for q in rs[i:] if q.x is not None), None)
            if r.x is not None:
                got = (r.x, r.y)
            elif prev and n:
                share = (r.seq - prev[0]) / (n.seq - prev[0])
                got = tuple(int((a + (b - a) * share + 0.5) // 1) for a, b in ((prev[1], n.x), (prev[2], n.y)))
            elif prev:
                got = (prev[1] + 56, prev[2])
            else:
                got = (max(0, n.x - 56), n.y) if n else (0, 0)
            want.append((line, r.seq, r.station_id, *got, r.x is None))
            prev = (r.seq, *got)
    for block in (100, 10**6):
        assert rows(spatial.fill_positions(d, block=block), "line_id", "seq", "station_id", "x", "y", "filled") == sorted(want)


def test_operator_borders_splices_and_closing(spark):
    data = [("A", "p"), ("B", "p"), ("C", "p"), ("B", "q"), ("D", "q"), ("E", "q"), ("D", "q"), ("F", "p"), ("A", "p")]
    d = spark.createDataFrame([("L", k, s, 100 * k if k % 4 else None, 7 if k == 3 else None, o) for k, (s, o) in enumerate(data)], "line_id string, pos int, station_id string, distance_m int, trailing_m int, operator string")
    seg = topology.branch_segments(d, "operator")
    assert [r.segment for r in seg.orderBy("pos").collect()] == [0, 0, 0, 1, 1, 1, 2, 3, 3]
    assert rows(topology.branch_segments(d).orderBy("pos"), "pos", "segment") == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 1), (5, 1), (6, 2), (7, 2), (8, 3)]
    assert rows(topology.segment_edges(seg, "trailing_m", close=True), "from_station", "to_station", "distance_m") == [("A", "B", 100), ("B", "C", 200), ("B", "D", 7), ("D", "E", 500), ("E", "B", 300)]
    splices = spark.createDataFrame([("L", "A", "F", "E", False), ("L", "A", "D", "B", True), ("L", "A", "Z", "E", False)], "line_id string, from_station string, to_station string, anchor_station string, use_trailing boolean")
    edges, bad = topology.splice_edges(d, splices)
    assert rows(edges) == [("L", "A", "F", 500)] and rows(bad) == [("L", "A", "D", "DISTANCE_MISSING"), ("L", "A", "Z", "STATION_MISSING")]
