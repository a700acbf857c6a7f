"""Spatial operators on crowded and skewed rows, against brute force."""

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from railtable.operators import hulls, spatial


def clusters(points, distance):
    root = {i: i for i, *_ in points}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for k, (a, x, y) in enumerate(points):
        for b, u, v in points[:k]:
            if math.hypot(x - u, y - v) < distance:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    size = {}
    for i in root:
        size[find(i)] = size.get(find(i), 0) + 1
    return sorted((i, find(i)) for i in root if size[find(i)] > 1)


@pytest.mark.parametrize("kind", ["spread", "crowded", "grid", "gaps"])
def test_dense_hubs(spark, kind):
    rng = random.Random(kind)
    if kind == "spread":
        points = [(k, rng.uniform(-900, 900), rng.uniform(-900, 900)) for k in range(2000)]
    elif kind == "crowded":  # half of all points in one cell, some more within reach of it or just beyond
        points = [(k, rng.uniform(0, 18), rng.uniform(0, 18)) for k in range(1000)] + [(k, rng.uniform(-60, 80), rng.uniform(-60, 80)) for k in range(1000, 1060)] + [(k, rng.uniform(300, 2000), rng.uniform(300, 2000)) for k in range(1060, 2000)]
    elif kind == "grid":  # many distances of exactly the threshold, which do not connect, and equal positions
        points = [(k, 13.0 * rng.randrange(60), 13.0 * rng.randrange(60)) for k in range(700)]
    else:  # pairs of clouds whose nearest two points are just near enough or not, off their extremes
        points, k = [], 0
        for g in range(60):
            for side in (0, 1):
                for _ in range(8):
                    a = rng.uniform(0, 12)
                    points.append((k, 200.0 * g + a, side * (36 + rng.uniform(-1, 1)) + (1 - 2 * side) * (6 + rng.uniform(-6, 0))))
                    k += 1
    df = spark.createDataFrame([*points, (None, 1.0, 1.0), (99_999, None, 1.0)], "station_id long, x double, y double")
    assert rows(spatial.dense_hubs(df), "station_id", "hub") == clusters(points, 26.0)


def test_dense_hubs_of_nothing(spark):
    assert spatial.dense_hubs(spark.createDataFrame([], "station_id long, x double, y double")).count() == 0


def test_near_pairs_in_a_crowd(spark):
    rng = random.Random(3)
    points = [(k, "L", rng.uniform(0, 50), rng.uniform(0, 50)) for k in range(150)] + [(k, "L", rng.uniform(0, 3000), rng.uniform(0, 3000)) for k in range(150, 300)]
    df = spark.createDataFrame(points, "id long, line_id string, x double, y double")
    want = sorted((a, b) for a, _, x, y in points for b, _, u, v in points if a < b and math.hypot(x - u, y - v) < 60)
    for crowd in (10, 4096):
        assert rows(spatial.near_pairs(df, ["line_id"], 60.0, crowd), "a", "b") == want


def crossing(s, t):
    def turn(a, x, y):
        return (a[2] - a[0]) * (y - a[1]) - (a[3] - a[1]) * (x - a[0])

    d = turn(t, *s[:2]), turn(t, *s[2:]), turn(s, *t[:2]), turn(s, *t[2:])
    if d[0] * d[1] < 0 and d[2] * d[3] < 0:
        u = d[0] / (d[0] - d[1])
        return s[0] + u * (s[2] - s[0]), s[1] + u * (s[3] - s[1])
    return None


def test_crossing_classes(spark):
    rng = random.Random(6)
    segments = []
    for k in range(260):
        x, y, r = rng.uniform(-400, 400), rng.uniform(-400, 400), rng.choice([30, 30, 300, 2000])
        if k < 130:
            x, y = rng.uniform(0, 20), rng.uniform(0, 20)  # half of all in one cell
        segments.append((k, k % 40, rng.choice("abc"), x, y, *rng.choice([(x + rng.uniform(-r, r), y + rng.uniform(-r, r)), (x, y + r), (x + r, y)])))
    segments += [(300, 90, "a", 0.0, 0.0, 50.0, 50.0), (301, 91, "b", 0.0, 0.0, 50.0, -50.0), (302, 92, None, 10.0, -90.0, 10.0, 90.0)]
    centres = [(rng.uniform(-400, 400), rng.uniform(-400, 400)) for _ in range(120)]
    allowed = [("a", "b", 10.0, 10.0, None), ("c", "a", -100.0, 50.0, 200.0), ("b", None, 0.0, 0.0, 999.0)]
    want = []
    for a, ta, la, *s in segments:
        for b, tb, lb, *t in segments:
            if a < b and ta != tb and (p := crossing(s, t)):
                d = min(math.hypot(p[0] - x, p[1] - y) for x, y in centres)
                ok = any(None not in (la, lb, x, y) and {la, lb} == {x, y} and (la != lb or x == y) and math.hypot(p[0] - u, p[1] - v) <= (r or 50) for x, y, u, v, r in allowed)
                want.append((a, b, "COVERED" if d < 17 else "VISIBLE" if d < 40 else "ALLOWED" if ok else "FREE"))
    df = spark.createDataFrame(segments, "id long, track long, line_id string, x0 double, y0 double, x1 double, y1 double")
    c, al = spark.createDataFrame(centres, "x double, y double"), spark.createDataFrame(allowed, "line_a string, line_b string, x double, y double, radius double")
    for crowd in (20, 4096):
        assert rows(spatial.classify_crossings(df, c, al, 64.0, 40.0, crowd=crowd), "a", "b", "class") == sorted(want)
    assert rows(spatial.classify_crossings(df, c, al.orderBy(F.desc("x")), 500.0, 40.0), "a", "b", "class") == sorted(want)
    assert {k for *_, k in want} == {"COVERED", "VISIBLE", "ALLOWED", "FREE"}


def test_boxes_of_all_sizes(spark):
    rng = random.Random(7)
    boxes = []
    for k in range(300):
        x, y, w = rng.uniform(-300, 300), rng.uniform(-300, 300), rng.choice([5, 20, 64, 150, 4000])
        boxes.append((k, x, y, x + rng.uniform(0.1, w), y + rng.uniform(0.1, w)))
    boxes += [(k, 1.0, 1.0, 3.0, 3.0) for k in range(300, 340)] + [(400, 0.0, 0.0, 0.0, 5.0), (401, 64.0, 0.0, 128.0, 64.0), (402, 128.0, 0.0, 192.0, 64.0)]
    want = sorted((a, b) for a, *s in boxes for b, *t in boxes if a < b and min(s[2], t[2]) > max(s[0], t[0]) and min(s[3], t[3]) > max(s[1], t[1]))
    df = spark.createDataFrame(boxes, "id long, x0 double, y0 double, x1 double, y1 double")
    for crowd in (15, 4096):
        assert rows(spatial.box_overlaps(df, 64.0, 10**6, crowd), "a", "b") == want


def test_long_segments_pass_few_cells(spark):
    d = spark.createDataFrame([(0.0, 0.0, 1000.0, 1000.0), (0.0, 0.0, 0.0, 1000.0), (5.0, 5.0, 5.0, 5.0)], "x0 double, y0 double, x1 double, y1 double")
    assert all(n < 4000 for n in (r[0] for r in d.select(F.size(spatial._passed(1.0))).collect()))


def test_farthest(spark):
    """Small groups, clouds, rings (all positions on the hull), lines, single and equal positions, against all pairs."""
    rng = random.Random(9)
    points = [("four", 0.0, 1.5), ("four", 3.0, 1.5), ("four", 1.5, 0.0), ("four", 1.5, 3.0), ("one", 5.0, 5.0), ("same", 1.0, 1.0), ("same", 1.0, 1.0), ("same", None, 2.0)]
    points += [("ring", math.cos(a) * 100, math.sin(a) * 100) for a in (rng.uniform(0, 7) for _ in range(900))]
    points += [("oval", math.cos(a) * 100, math.sin(a) * 99) for a in (rng.uniform(0, 7) for _ in range(300))]
    points += [("cloud", rng.gauss(0, 9), rng.gauss(0, 9)) for _ in range(700)] + [("line", 2.0 * k, 3.0 * k) for k in range(200)] + [("box", float(rng.randrange(12)), float(rng.randrange(12))) for _ in range(400)]
    want = {}
    for k in {p[0] for p in points}:
        own = [(x, y) for g, x, y in points if g == k and x is not None]
        want[k] = max(math.hypot(a - c, b - d) for a, b in own for c, d in own)
    got = {r.g: r.spread for r in hulls.farthest(spark.createDataFrame(points, "g string, x double, y double").repartition(6), "g").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want) and want["four"] == 3.0


def test_ranks_and_tiers(spark):
    rng = random.Random(10)
    data = [(rng.choice([2, 3]), float(rng.randrange(500))) for _ in range(2000)] + [(4, 1.0), (4, None), (9, None)]
    df = spark.createDataFrame(data, "lines int, spread double")
    for block in (100, 10**6):
        got = {r.lines: r.target for r in spatial.span_targets(df, block).collect()}
        for k in (2, 3, 4):
            own = sorted(s for n, s in data if n == k and s is not None)
            assert got[k] == own[math.ceil(0.9 * len(own)) - 1]
        assert 9 not in got
    spreads = spark.createDataFrame([(1, 2, 50.0), (2, 2, 70.0), (3, 7, 60.0), (4, 2, 300.0)], "station_id int, lines int, spread double")
    targets = spark.createDataFrame([(2, 55.0)], "lines int, target double")
    assert rows(spatial.displacement_tiers(spreads, targets), "station_id", "target", "displacement", "tier", "converge", "suspect_split") == [
        (1, 55.0, 0.0, "mild", False, False), (2, 55.0, 7.5, "mid", True, True), (3, 56.0, 2.0, "mild", True, False), (4, 55.0, 122.5, "extreme", True, True)
    ]


def test_straight_leads(spark):
    segments = spark.createDataFrame([("L", 1, "line", 0.0, 0.0, 100.0, 0.0), ("L", 2, "curve", 100.0, 0.0, 120.0, 20.0), ("L", 3, "line", 120.0, 20.0, 120.0, 24.0)], "line_id string, seg_id int, kind string, x0 double, y0 double, x1 double, y1 double")
    nodes = spark.createDataFrame([(1, "L", 50.0, 2.0), (2, "L", 110.0, 11.0), (3, "L", 121.0, 23.0), (4, "L", 50.0, 90.0), (5, "M", 0.0, 0.0)], "id int, line_id string, x double, y double")
    assert rows(spatial.straight_lead_violations(nodes, segments), "id", "reason") == [(2, "NODE_ON_CURVE"), (3, "SHORT_LEAD")]
