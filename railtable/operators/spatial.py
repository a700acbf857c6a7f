"""Spatial joins by grid cells, distances, spreads, interpolation, simplification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railtable.checks import cut
from railtable.operators.hulls import farthest
from railtable.operators.ordered import BLOCK, after, along, before, coming, known, running
from railtable.operators.topology import components


#: Rows of one cell that may meet the other side's in one task.
CROWD = 4096


def meet(p: DataFrame, q: DataFrame, on: list[str], crowd: int = CROWD) -> DataFrame:
    """The inner join of p and q on the cell columns `on`. A cell in which p has more than `crowd` rows is dealt out: its rows of p to shares of about that
    size, by hash, each of which meets a copy of the cell's rows of q. Cells of at most `crowd` rows are joined as they are. The work grows with the pairs, not with the bytes that Spark
    would merge small partitions by, so p's cells go to a fixed number of tasks."""
    tasks = 4 * int(p.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    crowded = cut(p.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > crowd).select(*on, F.ceil(F.col("_n") / crowd).cast("int").alias("_shares")))
    if crowded.isEmpty():
        return p.repartition(tasks, *on).join(q, on)
    shares = F.coalesce("_shares", F.lit(1))
    own = p.join(crowded, on, "left").withColumn("_share", F.pmod(F.xxhash64(*[c for c in p.columns if c not in on]), shares).cast("int")).drop("_shares")
    every = q.join(crowded, on, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("_shares")
    return own.repartition(tasks, *on, "_share").join(every, [*on, "_share"]).drop("_share")


def near_pairs(points: DataFrame, keys: list[str], distance: float, crowd: int = CROWD) -> DataFrame:
    """JN-13: pairs (a < b) of different ids with equal keys, nearer than `distance`: points of a cell as wide as the distance meet those of the
    cell and half of its neighbours, so each pair meets once and the join is on (keys, cell). Crowded cells are dealt out (`meet`)."""
    cell = lambda c: F.floor(F.col(c) / distance).cast("long")
    p = points.select(*keys, "id", "x", "y", cell("x").alias("cx"), cell("y").alias("cy"))
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    q = p.select(*keys, "id", "x", "y", F.explode(around).alias("o"), "cx", "cy").select(*keys, F.col("id").alias("id2"), F.col("x").alias("x2"), F.col("y").alias("y2"), (F.col("cx") + F.col("o.i")).alias("cx"), (F.col("cy") + F.col("o.j")).alias("cy"), ((F.col("o.i") == 0) & (F.col("o.j") == 0)).alias("own"))
    d = F.hypot(F.col("x") - F.col("x2"), F.col("y") - F.col("y2"))
    j = meet(p, q, [*keys, "cx", "cy"], crowd).where((F.col("id") != F.col("id2")) & (~F.col("own") | (F.col("id") < F.col("id2")))).withColumn("distance", d).where(F.col("distance") < distance)
    return j.select(*keys, F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b"), "distance")


def dense_hubs(stations: DataFrame, distance: float = 26.0) -> DataFrame:
    """GR-5: stations (station_id, x, y) that chains of steps shorter than `distance` connect: (station_id, hub), hub being the smallest id of two or more.

    Cells are so small that all points of one are near each other; they unite without being listed. Two cells are linked if their nearest two points are near
    enough: the extreme points of both (in eight directions) tell at once for most pairs of cells; for the others only points remain that the other cell's box is near to, and of these,
    for each x (or, for cells of one row, each y), the one that lies farthest towards the other cell: any other of that x is farther from all its points. Then the
    components of the cells are found. A null id or coordinate is in no hub; equal positions are near each other; the positions of one id belong together."""
    side = distance / math.sqrt(2) * (1 - 1e-9)
    p = stations.where("station_id IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL").select("station_id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    p = cut(p.withColumns({"cx": F.floor(F.col("x") / side).cast("long"), "cy": F.floor(F.col("y") / side).cast("long")}))
    ways = {"w": F.col("x"), "s": F.col("y"), "u": F.col("x") + F.col("y"), "v": F.col("x") - F.col("y")}
    ends = [f(F.struct("x", "y"), F.struct(v, F.col("x"))).alias(f"{k}{n}") for k, v in ways.items() for f, n in ((F.min_by, 0), (F.max_by, 1))]
    cells = cut(p.groupBy("cx", "cy").agg(F.min("station_id").alias("least"), *ends).select("cx", "cy", "least", F.array_distinct(F.array(*(f"{k}{n}" for k in ways for n in (0, 1)))).alias("ends"), F.col("w0.x").alias("x0"), F.col("w1.x").alias("x1"), F.col("s0.y").alias("y0"), F.col("s1.y").alias("y1")))
    offsets = [(i, j) for i in range(3) for j in range(-2, 3) if (i, j) > (0, 0)]
    moved = cells.select(*(F.col(c).alias(f"{c}_2") for c in cells.columns), F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in offsets))).alias("o"))
    moved = moved.select("*", (F.col("cx_2") - F.col("o.i")).alias("cx"), (F.col("cy_2") - F.col("o.j")).alias("cy"))
    apart = lambda a0, a1, b0, b1: F.greatest(F.lit(0.0), b0 - a1, a0 - b1)
    gap = F.hypot(*(apart(*(F.col(f"{c}{k}") for k in ("0", "1", "0_2", "1_2"))) for c in "xy"))
    pairs = cells.join(moved, ["cx", "cy"]).where(gap < distance)
    near = lambda a, b: F.hypot(a["x"] - b["x"], a["y"] - b["y"]) < distance
    at_once = F.exists("ends", lambda a: F.exists("ends_2", lambda b: near(a, b)))
    box = lambda t: F.struct(*(F.col(f"{c}{k}{t}").alias(f"{c}{k}") for c in "xy" for k in "01"))
    pairs = cut(pairs.select("cx", "cy", "least", "least_2", F.col("o.i").alias("i"), F.col("o.j").alias("j"), at_once.alias("sure"), box("").alias("box"), box("_2").alias("box_2")))
    open_ = pairs.where("NOT sure")

    def edge(own: str, i: int, other: str) -> DataFrame:
        """The points of one side's cells that may be the nearest to the other cell; i is 1 for the cell ahead, -1 for the one behind."""
        at = open_.select((F.col("cx") + (F.col("i") if own else 0)).alias("cx"), (F.col("cy") + (F.col("j") if own else 0)).alias("cy"), "least", "least_2", F.col("i").alias("i"), F.col("j").alias("j"), F.col(f"box{other}").alias("b"))
        q = p.join(at, ["cx", "cy"])
        far = F.hypot(apart(F.col("x"), F.col("x"), F.col("b.x0"), F.col("b.x1")), apart(F.col("y"), F.col("y"), F.col("b.y0"), F.col("b.y1")))
        q = q.where(far < distance)
        row = F.col("j") == 0
        fixed, towards = F.when(row, F.col("y")).otherwise(F.col("x")), F.when(row, i * F.col("i") * F.col("x")).otherwise(i * F.signum("j") * F.col("y"))
        return q.groupBy("least", "least_2", fixed.alias("fixed")).agg(F.max_by(F.struct("x", "y"), towards).alias("p" + own)).drop("fixed")

    met = edge("", 1, "_2").join(edge("_2", -1, ""), ["least", "least_2"]).where(near(F.col("p"), F.col("p_2"))).select("least", "least_2")
    links = pairs.where("sure").select("least", "least_2").unionByName(met).distinct().select(F.col("least").alias("from_node"), F.col("least_2").alias("to_node"))
    found = components(links, cells.select(F.col("least").alias("node")))
    hubs = p.join(cells.select("cx", "cy", "least"), ["cx", "cy"]).join(found, F.col("least") == F.col("node")).select("station_id", F.col("component").alias("hub"))
    several = hubs.groupBy("hub").agg(F.count_distinct("station_id").alias("n")).where("n >= 2").select("hub")
    return hubs.join(several, "hub", "left_semi").select("station_id", "hub").distinct()


def merge_suspects(stations: DataFrame, distance: float = 60.0) -> DataFrame:
    """JN-14: pairs of equal normalised name and different id nearer than the distance: a near-pair join inside each name."""
    return near_pairs(stations, ["name"], distance)


def box_overlaps(boxes: DataFrame, cell: float, top: int = 50, crowd: int = CROWD) -> DataFrame:
    """JN-15: pairs of label boxes (id, x0, y0, x1, y1) of different stations with a positive common area; the worst `top`. A box belongs to the level
    of its size, whose cells (`cell` times a power of two) are no smaller than it, and lies in at most four of them. It meets the boxes of its own level and of all
    larger ones in their cells, so a box of any size gives few rows; a pair counts in the cell of its common corner only. Crowded cells are dealt out (`meet`)."""
    size = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    level = F.greatest(F.lit(0), F.ceil(F.log2(size / cell))).cast("int")
    b = boxes.where("x1 > x0 AND y1 > y0").select("id", "x0", "y0", "x1", "y1").withColumn("level", level)
    levels = sorted(r[0] for r in b.select("level").distinct().collect())  # powers of two: a few dozen at most

    def at(lv: Column) -> DataFrame:
        d = b.withColumn("lv", lv)
        width = F.pow(F.lit(2.0), F.col("lv")) * cell
        seq = lambda lo, hi: F.sequence(F.floor(F.col(lo) / width).cast("long"), F.floor(F.col(hi) / width).cast("long"))
        return d.withColumn("cx", F.explode(seq("x0", "x1"))).withColumn("cy", F.explode(seq("y0", "y1"))).withColumn("width", width)

    home = at(F.col("level"))
    above = F.filter(F.array(*map(F.lit, levels)), lambda x: x >= F.col("level")) if levels else F.array().cast("array<int>")
    probe = at(F.explode(above)).select("lv", "cx", "cy", *(F.col(c).alias(f"{c}_2") for c in ("id", "x0", "y0", "x1", "y1", "level")))
    left, low = F.greatest("x0", "x0_2"), F.greatest("y0", "y0_2")
    w, h = F.least("x1", "x1_2") - left, F.least("y1", "y1_2") - low
    j = meet(home, probe, ["lv", "cx", "cy"], crowd).where((F.col("id") != F.col("id_2")) & ((F.col("level") > F.col("level_2")) | (F.col("id") < F.col("id_2"))))
    j = j.where((w > 0) & (h > 0) & (F.floor(left / F.col("width")) == F.col("cx")) & (F.floor(low / F.col("width")) == F.col("cy")))
    return j.select(F.least("id", "id_2").alias("a"), F.greatest("id", "id_2").alias("b"), (w * h).alias("area")).orderBy(F.desc("area"), "a", "b").limit(top)


def _samples(x0: str, y0: str, x1: str, y1: str, length: Column, cell: float) -> Column:
    """Cells (cx, cy) of points along a segment, half a cell apart, ends included: each point of it is within a quarter of a cell of one."""
    n = F.greatest(F.lit(1), F.ceil(length * 2 / cell)).cast("int")
    at = lambda a, b, k: F.floor((F.col(a) + (F.col(b) - F.col(a)) * k / n) / cell).cast("long")
    return F.array_distinct(F.transform(F.sequence(F.lit(0), n), lambda k: F.named_struct(F.lit("cx"), at(x0, x1, k), F.lit("cy"), at(y0, y1, k))))


def _around(reach: Column) -> Column:
    """Offsets (i, j) of all cells at most `reach` away in each direction."""
    side = F.sequence(-reach, reach)
    return F.flatten(F.transform(side, lambda i: F.transform(side, lambda j: F.named_struct(F.lit("i"), i.cast("long"), F.lit("j"), j.cast("long")))))


def collinear_overlaps(segments: DataFrame, angle: float = 0.5, offset: float = 3.0, separation: float = 2.0, cell: float = 64.0, crowd: int = CROWD) -> DataFrame:
    """JN-16: segments (id, line_id, x0, y0, x1, y1) of two lines whose angles differ by at most `angle` degrees, whose middles lie at most
    `offset` off the other's line and whose projections overlap, separated by less than `separation`. Joined by bins of angle and, in the frame of the bin's direction, by boxes: along it a
    segment's half length, across it what the half length rises over the angle, and for one side the separation. Boxes lie in cells as long as `cell` and as wide as the separation, so that
    few segments beside each other meet; a pair counts in the cell of its boxes' common corner only. Crowded cells are dealt out (`meet`)."""
    dx, dy, near, rise = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), min(offset, separation), math.sin(math.radians(angle))
    ends = ["x0", "y0", "x1", "y1"]
    s = segments.select("id", "line_id", *(F.col(c).cast("double").alias(c) for c in ends)).withColumns({"len": F.hypot(dx, dy), "ang": F.pmod(F.degrees(F.atan2(dy, dx)), F.lit(180.0))}).where("len > 0")
    s = s.withColumns({"ux": dx / F.col("len"), "uy": dy / F.col("len"), "mx": (F.col("x0") + F.col("x1")) / 2, "my": (F.col("y0") + F.col("y1")) / 2})
    bins, wide = int(180 / angle), max(near, cell / 64)
    bin_ = F.floor(F.col("ang") / angle).cast("long") % bins

    def boxed(d: DataFrame, more: float) -> DataFrame:
        """The cells (cq, cp) of d's boxes in the frame of its `bin`, and the boxes' low ends."""
        turn, half = F.radians((F.col("bin") + 0.5) * angle), F.col("len") / 2
        tiny = 1e-6 + 1e-12 * (F.abs("mx") + F.abs("my") + half)
        q, p = F.col("mx") * F.cos(turn) + F.col("my") * F.sin(turn), F.col("my") * F.cos(turn) - F.col("mx") * F.sin(turn)
        dq, dp = half + (more + half * rise) * rise + tiny, half * rise + more + tiny
        d = d.withColumns({"lq": q - dq, "lp": p - dp, "hq": q + dq, "hp": p + dp})
        cells = lambda c, size: F.explode(F.sequence(F.floor(F.col(f"l{c}") / size).cast("long"), F.floor(F.col(f"h{c}") / size).cast("long")))
        return d.withColumn("cq", cells("q", cell)).withColumn("cp", cells("p", wide)).drop("hq", "hp")

    here = boxed(s.withColumn("bin", bin_), 0.0).drop("mx", "my")
    o = boxed(s.withColumn("bin", F.explode(F.array(*[F.pmod(bin_ + k, F.lit(bins)) for k in (-1, 0, 1)]))), near)
    o = o.select("bin", "cq", "cp", *(F.col(c).alias(f"{c}_2") for c in ("id", "line_id", *ends, "ang", "mx", "my", "lq", "lp")))
    diff = F.abs(F.col("ang") - F.col("ang_2"))
    off = F.abs((F.col("mx_2") - F.col("x0")) * F.col("uy") - (F.col("my_2") - F.col("y0")) * F.col("ux"))
    j = meet(here, o, ["bin", "cq", "cp"], crowd).where((F.col("id") < F.col("id_2")) & (F.col("line_id") != F.col("line_id_2")) & (off <= offset) & (off < separation))
    corner = (F.floor(F.greatest("lq", "lq_2") / cell) == F.col("cq")) & (F.floor(F.greatest("lp", "lp_2") / wide) == F.col("cp"))
    j = j.where(corner & (F.least(diff, 180 - diff) <= angle))
    along = lambda x, y: (F.col(x) - F.col("x0")) * F.col("ux") + (F.col(y) - F.col("y0")) * F.col("uy")
    a, b = along("x0_2", "y0_2"), along("x1_2", "y1_2")
    common = F.least(F.col("len"), F.greatest(a, b)) - F.greatest(F.lit(0.0), F.least(a, b))
    return j.select(F.col("id").alias("a"), F.col("id_2").alias("b"), common.alias("overlap")).where("overlap > 0")


def _passed(cell: float, end: str = "") -> Column:
    """Cells (cx, cy) that a segment passes: column by column, the rows between where it enters and leaves, so their number grows with its length."""
    x0, x1, y0, y1 = (F.col(c + end).cast("double") for c in ("x0", "x1", "y0", "y1"))
    lo, hi, tiny = F.least(x0, x1), F.greatest(x0, x1), 1e-9
    y = lambda x: F.when(x1 == x0, y0).otherwise(y0 + (y1 - y0) * (x - x0) / F.nullif(x1 - x0, F.lit(0.0)))

    def column(cx: Column) -> Column:
        a, b = F.greatest(lo, cx * cell), F.least(hi, (cx + 1) * cell)
        ya, yb = F.when(x0 == x1, y0).otherwise(y(a)), F.when(x0 == x1, y1).otherwise(y(b))
        rows = F.sequence(F.floor(F.least(ya, yb) / cell - tiny).cast("long"), F.floor(F.greatest(ya, yb) / cell + tiny).cast("long"))
        return F.transform(rows, lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))

    columns = F.sequence(F.floor(lo / cell - tiny).cast("long"), F.floor(hi / cell + tiny).cast("long"))
    return F.flatten(F.transform(columns, column))


def crossing_points(segments: DataFrame, cell: float, crowd: int = CROWD) -> DataFrame:
    """JN-17: proper crossings of segments (id, track, x0, y0, x1, y1) of different tracks without a shared end (nearer than 1e-6), and where:
    (a, b, track_a, track_b, x, y), a < b, with line_a and line_b if segments have line_id. Segments meet in the cells that both pass; orientation tests decide. Crowded cells are dealt
    out (`meet`). The cell that the crossing lies in has the pair; for crossings beside a cell's border or of nearly parallel segments it is the first of the cells that both pass.

    The join itself only tests orientations. Where they cross stands in a row of its own behind it: written into the join's condition it is a function too long for the JVM to compile."""
    lines = ["line_id"] if "line_id" in segments.columns else []
    ends = ["x0", "y0", "x1", "y1"]
    s = segments.select("id", "track", *lines, *(F.col(c).cast("double").alias(c) for c in ends)).withColumns({"dx": F.col("x1") - F.col("x0"), "dy": F.col("y1") - F.col("y0")}).withColumn("len", F.hypot("dx", "dy"))
    c = s.select("*", F.explode(_passed(cell)).alias("c")).select(*s.columns, "c.cx", "c.cy")
    other = c.select("cx", "cy", *(F.col(n).alias(f"{n}_2") for n in s.columns))
    v = {f"{n}{t}": F.col(f"{n}{t}") for n in (*ends, "dx", "dy", "len") for t in ("", "_2")}
    turn = lambda t, x, y: v[f"dx{t}"] * (v[y] - v[f"y0{t}"]) - v[f"dy{t}"] * (v[x] - v[f"x0{t}"])
    d1, d2, d3, d4 = turn("_2", "x0", "y0"), turn("_2", "x1", "y1"), turn("", "x0_2", "y0_2"), turn("", "x1_2", "y1_2")
    j = meet(c, other, ["cx", "cy"], crowd).where((F.col("id") < F.col("id_2")) & (F.col("track") != F.col("track_2")) & (F.signum(d1) * F.signum(d2) < 0) & (F.signum(d3) * F.signum(d4) < 0))
    apart = lambda i, k: F.hypot(v[f"x{i}"] - v[f"x{k}_2"], v[f"y{i}"] - v[f"y{k}_2"])
    j = j.select("*", F.explode(F.array(F.struct(d1.alias("d1"), d2.alias("d2"), F.least(*(apart(i, k) for i in "01" for k in "01")).alias("apart")))).alias("d"))
    d1, d2 = F.col("d.d1"), F.col("d.d2")
    at = lambda c: v[f"{c}0"] + d1 / (d1 - d2) * v[f"d{c}"]
    j = j.where("d.apart >= 1e-6").withColumns({"x": at("x"), "y": at("y")})
    inside = lambda c: F.abs(F.col(c) / cell - F.floor(F.col(c) / cell) - 0.5) < 0.5 - 1e-6
    sure = (F.abs(d1 - d2) > 1e-6 * v["len"] * v["len_2"]) & inside("x") & inside("y")
    here = F.struct("cx", "cy")
    home = F.when(sure, (F.floor(F.col("x") / cell) == F.col("cx")) & (F.floor(F.col("y") / cell) == F.col("cy"))).otherwise(here == F.array_min(F.array_intersect(_passed(cell), _passed(cell, "_2"))))
    named = [F.col(f"{c}{t}").alias(f"{n}_{k}") for c, n in (("track", "track"), *((c, "line") for c in lines)) for t, k in (("", "a"), ("_2", "b"))]
    return j.where(home).select(F.col("id").alias("a"), F.col("id_2").alias("b"), *named, "x", "y")


def crossings(segments: DataFrame, cell: float) -> DataFrame:
    """JN-17: the pairs of segments that cross (see `crossing_points`)."""
    return crossing_points(segments, cell).select("a", "b")


def within(points: DataFrame, targets: DataFrame, radius: float, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """Points (x, y and others; each row by itself) nearer than `radius` to one of `targets` (x, y), and the rest. Cells are so small that a target in a point's own cell is near
    enough; only points of cells without targets meet the targets around them. `points` is read twice: cut it where it is dear."""
    side = radius / math.sqrt(2) * (1 - 1e-9)
    cell = lambda c: F.floor(F.col(c) / side).cast("long")
    t = targets.where("x IS NOT NULL AND y IS NOT NULL").select(F.col("x").alias("tx"), F.col("y").alias("ty"), cell("x").alias("cx"), cell("y").alias("cy")).distinct()
    p = points.withColumns({"cx": cell("x"), "cy": cell("y")}).join(t.select("cx", "cy").distinct().withColumn("_own", F.lit(True)), ["cx", "cy"], "left")
    at_once = p.where("_own").select(*points.columns)
    rest = cut(p.where("_own IS NULL").select(*points.columns, "cx", "cy").withColumn("_k", F.monotonically_increasing_id()))
    around = t.withColumn("o", F.explode(_around(F.lit(2)))).select("tx", "ty", (F.col("cx") + F.col("o.i")).alias("cx"), (F.col("cy") + F.col("o.j")).alias("cy"))
    d = F.hypot(F.col("x") - F.col("tx"), F.col("y") - F.col("ty"))
    near = meet(rest.select("_k", "x", "y", "cx", "cy"), around, ["cx", "cy"], crowd).where(d < radius).select("_k").distinct()
    rest = cut(rest.join(near.withColumn("_near", F.lit(True)), "_k", "left"))
    return at_once.unionByName(rest.where("_near").select(*points.columns)), rest.where("_near IS NULL").select(*points.columns)


def classify_crossings(segments: DataFrame, centres: DataFrame, allowed: DataFrame, cell: float, knot: float, cover: float = 17.0, tolerance: float = 50.0, crowd: int = CROWD) -> DataFrame:
    """JN-17: crossings (a, b, x, y) with a class by the nearest cluster centre (x, y): COVERED nearer than `cover`, VISIBLE nearer than `knot`, else FREE;
    a free one is ALLOWED where the allow-list (line_a, line_b, x, y, radius; the lines in either order, no radius: `tolerance`) names its two lines within the radius.
    segments also have line_id; a null line is on no list. Segments that share an end do not cross. List entries meet crossings in cells of the power of two above their radius."""
    found = cut(crossing_points(segments, cell, crowd).select("a", "b", "line_a", "line_b", "x", "y"))
    covered, left = within(found, centres, cover, crowd)
    visible, free = within(left, centres, knot, crowd) if knot > cover else (left.where("false"), left)
    pair = lambda a, b: [F.least(a, b).alias("l0"), F.greatest(a, b).alias("l1")]
    listed = allowed.where("line_a IS NOT NULL AND line_b IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL").select(*pair("line_a", "line_b"), F.col("x").alias("px"), F.col("y").alias("py"), F.coalesce("radius", F.lit(tolerance)).alias("r")).where("r >= 0")
    listed = listed.withColumn("lv", F.greatest(F.lit(0), F.ceil(F.log2(F.greatest("r", F.lit(1.0))))).cast("int"))
    levels = sorted(r[0] for r in listed.select("lv").distinct().collect())  # powers of two: a few dozen at most
    width = F.pow(F.lit(2.0), F.col("lv"))
    at = lambda x, y: {"cx": F.floor(F.col(x) / width).cast("long"), "cy": F.floor(F.col(y) / width).cast("long")}
    listed = listed.withColumns(at("px", "py")).withColumn("o", F.explode(_around(F.lit(1)))).withColumns({"cx": F.col("cx") + F.col("o.i"), "cy": F.col("cy") + F.col("o.j")}).drop("o")
    free = cut(free.withColumn("_k", F.monotonically_increasing_id()))
    asked = free.where("line_a IS NOT NULL AND line_b IS NOT NULL").select("_k", "x", "y", *pair("line_a", "line_b"), F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>")).alias("lv")).withColumns(at("x", "y"))
    near = F.hypot(F.col("x") - F.col("px"), F.col("y") - F.col("py")) <= F.col("r")
    keys = ["l0", "l1", "lv", "cx", "cy"]
    q = asked.alias("q")
    ok = q.join(listed.alias("e"), [*(F.col(f"q.{k}") == F.col(f"e.{k}") for k in keys), near], "left_semi").select("_k").distinct().withColumn("_ok", F.lit(True))
    named = lambda d, kind: d.select("a", "b", "x", "y", kind.alias("class"))
    return named(covered, F.lit("COVERED")).unionByName(named(visible, F.lit("VISIBLE"))).unionByName(named(free.join(ok, "_k", "left"), F.when(F.col("_ok"), "ALLOWED").otherwise("FREE")))


def _to_segment() -> Column:
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    n = dx * dx + dy * dy
    t = F.when(n == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("x") - F.col("x0")) * dx + (F.col("y") - F.col("y0")) * dy) / n)))
    return F.hypot(F.col("x") - F.col("x0") - t * dx, F.col("y") - F.col("y0") - t * dy)


def nearest_segment(nodes: DataFrame, segments: DataFrame, cell: float = 64.0, rounds: int = 48) -> DataFrame:
    """JN-18: for each node (id, line_id, x, y) the distance to the nearest segment (seg_id) of its own line; a line without
    segments gives none. Nodes meet the segments that pass the nine cells around them; a distance of at most three quarters of
    a cell is final (no other segment can be nearer), and all other nodes go on to cells of twice the size. So a node meets about
    as many segments as lie near it, and only nodes far from any meet many."""
    lines = segments.select("line_id").distinct()
    left = cut(nodes.join(lines, "line_id", "left_semi").select("id", "line_id", "x", "y"))
    done = None
    for _ in range(rounds):
        g = segments.withColumn("c", F.explode(_samples("x0", "y0", "x1", "y1", F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")), cell))).select("line_id", "seg_id", "x0", "y0", "x1", "y1", "c.cx", "c.cy")
        n = left.withColumn("o", F.explode(_around(F.lit(1)))).select("id", "line_id", "x", "y", (F.floor(F.col("x") / cell) + F.col("o.i")).alias("cx"), (F.floor(F.col("y") / cell) + F.col("o.j")).alias("cy"))
        best = n.join(g, ["line_id", "cx", "cy"]).withColumn("d", _to_segment()).groupBy("id", "line_id", "x", "y").agg(F.min(F.struct("d", "seg_id")).alias("m"))
        found = cut(best.where(F.col("m.d") <= 0.75 * cell).select("id", "line_id", "x", "y", "m"))
        done = found if done is None else done.unionByName(found)
        left = cut(left.join(found, ["id", "line_id", "x", "y"], "left_anti"))
        if left.isEmpty():
            return done.select("id", "line_id", "m.seg_id", F.col("m.d").alias("distance"))
        cell *= 2
    raise RuntimeError(f"nodes without a nearest segment after {rounds} rounds")


def off_track(nodes: DataFrame, segments: DataFrame, tolerance: dict[str, float], other: float) -> DataFrame:
    """JN-30: nodes farther from their line's tracks than their role allows."""
    limit = F.coalesce(F.create_map(*[x for k, v in tolerance.items() for x in (F.lit(k), F.lit(v))])[F.col("role")], F.lit(other))
    d = nearest_segment(nodes, segments)
    return d.join(nodes.select("id", "line_id", "role"), ["id", "line_id"]).where(F.col("distance") > limit).select("id", "line_id", "role", "distance")


def straight_lead_violations(nodes: DataFrame, segments: DataFrame, clearance: float = 6.0, reach: float = 20.0) -> DataFrame:
    """JN-30: nodes (id, line_id, x, y) whose nearest segment of the line (line_id, seg_id, kind, x0, y0, x1, y1) is a curve (NODE_ON_CURVE), or straight but shorter than the
    clearance (SHORT_LEAD): the track bends right beside the node. A node farther than `reach` from its line is another audit's (`off_track`); of several
    segments equally near the smallest id counts."""
    kind = segments.select("line_id", "seg_id", "kind", F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")).alias("length"))
    d = nearest_segment(nodes, segments).where(F.col("distance") <= reach).join(kind, ["line_id", "seg_id"])
    reason = F.when(F.col("kind") == "curve", "NODE_ON_CURVE").when(F.col("length") < clearance, "SHORT_LEAD")
    return d.select("id", "line_id", "seg_id", "length", reason.alias("reason")).where("reason IS NOT NULL")


def snap_ends(ends: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """JN-31: track ends (track, line_id, x, y) move to the nearest node of the line within the threshold, else are reported. Ends meet the
    nodes of the nine cells of the threshold's width around them."""
    cell = lambda c: F.floor(F.col(c) / threshold).cast("long")
    n = nodes.select("line_id", "id", F.col("x").alias("nx"), F.col("y").alias("ny"), cell("x").alias("cx"), cell("y").alias("cy"))
    e = ends.select("*", F.explode(_around(F.lit(1))).alias("o")).select("track", "line_id", "x", "y", (cell("x") + F.col("o.i")).alias("cx"), (cell("y") + F.col("o.j")).alias("cy"))
    d = F.hypot(F.col("x") - F.col("nx"), F.col("y") - F.col("ny"))
    near = e.join(n, ["line_id", "cx", "cy"]).withColumn("d", d).where(F.col("d") <= threshold).groupBy("track", "line_id", "x", "y").agg(F.min(F.struct("d", "id", "nx", "ny")).alias("m"))
    g = ends.select("track", "line_id", "x", "y").distinct().join(near, ["track", "line_id", "x", "y"], "left")
    ok = F.col("m").isNotNull()
    return g.select("track", F.when(ok, F.col("m.id")).alias("node"), F.when(ok, F.col("m.nx")).otherwise(F.col("x")).alias("x"), F.when(ok, F.col("m.ny")).otherwise(F.col("y")).alias("y"), ok.alias("snapped"))


def spacing_stats(lengths: DataFrame) -> DataFrame:
    """AG-17: nearest-rank p5, p25, p50, p75, p95, the largest, and p95 / p5 of `length` by line."""
    p = lambda q: F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY length)")
    g = lengths.groupBy("line_id").agg(*[p(q).alias(n) for q, n in ((0.05, "p5"), (0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.95, "p95"))], F.max("length").alias("longest"))
    return g.withColumn("spread", F.when(F.col("p5") > 0, F.round(F.col("p95") / F.col("p5"), 4)))


def distance_quantiles(rows: DataFrame, within: float) -> DataFrame:
    """AG-18: interpolated median and p90 of `distance` by line, and the share within a threshold."""
    return rows.groupBy("line_id").agg(F.round(F.percentile("distance", 0.5), 6).alias("p50"), F.round(F.percentile("distance", 0.9), 6).alias("p90"), F.round(F.avg((F.col("distance") <= within).cast("double")), 6).alias("share"))


def octolinear_shares(segments: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """AG-18: by region the segments (id, region, x0, y0, x1, y1) of some length, and the share of those within `tolerance` degrees of a multiple of 45."""
    d = segments.where("x0 <> x1 OR y0 <> y1")
    near = octolinear_deviation(d.select("*", F.struct("id", "region").alias("_k")).drop("id").withColumnRenamed("_k", "id")).select("id.region", "deviation")
    return near.groupBy("region").agg(F.count("*").alias("segments"), F.round(F.avg((F.col("deviation") <= tolerance).cast("double")), 6).alias("share"))


def interchange_spreads(points: DataFrame) -> DataFrame:
    """AG-19: stations on two or more lines: members and the largest distance between two of their positions."""
    n = points.groupBy("station_id").agg(F.count_distinct("line_id").alias("lines"), F.count("*").alias("members")).where("lines >= 2")
    return n.join(farthest(points.join(n.select("station_id"), "station_id", "left_semi"), "station_id"), "station_id")


def nearest_ranks(rows: DataFrame, key: str, value: str, shares: dict[str, float], block: int = BLOCK) -> DataFrame:
    """For each key the nearest-rank quantiles of `value`, nulls left out: the value at place ceil(share * n). Places are numbered by an ordered scan, so a key of
    any number of different values is in no one task."""
    known_ = rows.where(F.col(value).isNotNull()).select(key, value)
    placed = along(known_, [key], [value], {"_place": running(F.lit(1))}, block)
    n = known_.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    j = placed.join(n, F.col(key).eqNullSafe(F.col("_key")))
    at = lambda q: F.max(F.when(F.col("_place") == F.greatest(F.lit(1), F.ceil(F.col("_n") * q - 1e-9)), F.col(value)))
    return j.groupBy(key).agg(*(at(q).alias(name) for name, q in shares.items()))


def span_targets(spreads: DataFrame, block: int = BLOCK) -> DataFrame:
    """AG-19: the p90 of `spread` by number of lines: (lines, target)."""
    return nearest_ranks(spreads, "lines", "spread", {"target": 0.9}, block)


def displacement_tiers(spreads: DataFrame, targets: DataFrame, extreme: float = 35.0, split: float = 60.0) -> DataFrame:
    """AG-19: for each interchange (station_id, lines, spread) the target spread of its number of lines (else that of 5 lines, else 56), the displacement, half of what the
    spread is above it, its tier (mild under 4, mid under 20, large under `extreme`, else extreme), whether it is to converge, and whether the group is suspected to be two stations (a
    spread above `split`). targets are few: a row for each number of lines."""
    five = targets.where("lines = 5").agg(F.max("target").alias("five"))
    j = spreads.join(targets.select("lines", "target"), "lines", "left").crossJoin(five)  # one row
    target = F.coalesce("target", "five", F.lit(56.0))
    moved = F.greatest(F.lit(0.0), (F.col("spread") - target) / 2)
    tier = F.when(moved < 4, "mild").when(moved < 20, "mid").when(moved < extreme, "large").otherwise("extreme")
    return j.select("station_id", "lines", "spread", target.alias("target"), moved.alias("displacement"), tier.alias("tier"), (F.col("spread") > target).alias("converge"), (F.col("spread") > split).alias("suspect_split"))


def interchange_centroids(points: DataFrame) -> DataFrame:
    """AG-20: the rounded mean point of stations on two or more lines, for the nodes that it moves."""
    w = Window.partitionBy("station_id")
    lines = F.size(F.collect_set("line_id").over(w))
    r = lambda c: F.floor(F.avg(c).over(w) + 0.5).cast("long")
    p = points.select("*", lines.alias("lines"), r("x").alias("cx"), r("y").alias("cy"))
    return p.where("lines >= 2 AND (cx <> x OR cy <> y)").select("station_id", "line_id", "x", "y", "cx", "cy")


def fill_positions(rows: DataFrame, step: int = 56, block: int = BLOCK) -> DataFrame:
    """WN-14: (line_id, seq, station_id, x, y) with missing points filled along the line: between neighbours by sequence, rounded; ahead of the first
    known one next - step (clamped at 0), then between it and the next; behind the last one previous + step each; a line without any begins at (0, 0). A filled
    point counts as known for those after it, and rounding makes each depend on the one before: so a gap (the missing points before a known one) is a fold
    of its own, over the gap's sorted stations. What is known before and behind comes from `along`, so no task holds a line, only gaps."""
    order = ["seq", "station_id"]
    s = along(rows.select("line_id", "seq", "station_id", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y")), ["line_id"], order, {"_r": running(F.lit(1))}, block)
    here = F.when(F.col("x").isNotNull(), F.struct("seq", "x", "y", "_r"))
    s = along(s, ["line_id"], ["_r"], {"prev": known(here), "nxt": coming(here)}, block)
    behind = F.col("_r") - F.coalesce(F.col("prev._r"), F.lit(1))
    one = lambda c, by: F.when(F.col("x").isNotNull(), F.col(c)).otherwise(F.coalesce(F.col(f"prev.{c}"), F.lit(0)) + by * behind).cast("long")
    kind = [F.col("seq").cast("int").alias("seq"), F.col("station_id").cast("long").alias("station_id")]
    plain = s.where("x IS NOT NULL OR nxt IS NULL").select("line_id", *kind, one("x", step).alias("x"), one("y", 0).alias("y"), F.col("x").isNull().alias("filled"))
    gaps = s.where("x IS NULL AND nxt IS NOT NULL").groupBy("line_id", F.col("nxt._r").alias("gap")).agg(F.first("prev").alias("prev"), F.first("nxt").alias("nxt"), F.sort_array(F.collect_list(F.struct("seq", "station_id"))).alias("s"))
    last = "struct<seq:bigint,x:bigint,y:bigint>"
    point = "struct<seq:int,station_id:bigint,x:bigint,y:bigint,filled:boolean>"

    def put(acc: Column, r: Column) -> Column:
        was, n = acc["prev"], F.col("nxt")
        share = (r["seq"] - was["seq"]) / (n["seq"] - was["seq"])
        at = lambda c, d: F.when(was.isNotNull(), F.floor(was[c] + (n[c] - was[c]) * share + 0.5)).otherwise(F.greatest(F.lit(0), n[c] - d)).cast("long")
        new = F.struct(r["seq"].cast("int").alias("seq"), r["station_id"].cast("long").alias("station_id"), at("x", step).alias("x"), at("y", 0).alias("y"), F.lit(True).alias("filled")).cast(point)
        return F.struct(F.struct(new["seq"].alias("seq"), new["x"].alias("x"), new["y"].alias("y")).cast(last).alias("prev"), F.concat(acc["out"], F.array(new)).alias("out"))

    first = F.when(F.col("prev").isNotNull(), F.struct("prev.seq", "prev.x", "prev.y")).cast(last)
    start = F.struct(first.alias("prev"), F.array().cast(f"array<{point}>").alias("out"))
    filled = gaps.select("line_id", F.explode(F.aggregate("s", start, put, lambda acc: acc["out"])).alias("p")).select("line_id", "p.*")
    return plain.unionByName(filled)


def octolinear_deviation(segments: DataFrame) -> DataFrame:
    """WN-23: angle of each segment and its distance in degrees from the nearest multiple of 45."""
    ang = F.pmod(F.degrees(F.atan2(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"))), F.lit(360.0))
    m = F.pmod(ang, F.lit(45.0))
    return segments.select("id", F.round(ang, 6).alias("angle"), F.round(F.least(m, 45 - m), 6).alias("deviation"))


def _with_neighbours(rows: DataFrame, block: int) -> DataFrame:
    """Positions with those of the station before (px, py) and of the next one (nx, ny) on the line."""
    steps = {"px": before("x"), "py": before("y"), "nx": after("x"), "ny": after("y")}
    return along(rows.select("line_id", "station_id", "seq", "x", "y"), ["line_id"], ["seq", "station_id"], steps, block)


def label_offsets(rows: DataFrame, distance: int = 18, block: int = BLOCK) -> DataFrame:
    """WN-25: a label goes to the side across the direction to the next (else previous) node of the line: above or below flat runs, right of steep ones."""
    s = _with_neighbours(rows, block)
    dx = F.coalesce(F.col("nx") - F.col("x"), F.col("x") - F.col("px"), F.lit(0))
    dy = F.coalesce(F.col("ny") - F.col("y"), F.col("y") - F.col("py"), F.lit(0))
    d = s.select("line_id", "station_id", dx.alias("dx"), dy.alias("dy"))
    flat = F.abs("dx") >= F.abs("dy")
    return d.select("line_id", "station_id", F.when(flat, 0).otherwise(distance).alias("off_x"), F.when(~flat, 0).when(F.col("dx") >= 0, -distance).otherwise(distance).alias("off_y"))


def half_paths(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """WN-28: per station of a line the path text towards the previous and the next station."""
    to = lambda x, y: F.when(F.col(x).isNotNull(), F.concat_ws(" ", F.lit("M"), F.col("x").cast("string"), F.col("y").cast("string"), F.lit("L"), F.col(x).cast("string"), F.col(y).cast("string")))
    return _with_neighbours(rows, block).select("line_id", "station_id", to("px", "py").alias("to_previous"), to("nx", "ny").alias("to_next"))


def simplify_points(pts: np.ndarray, eps: float) -> np.ndarray:
    """Ramer-Douglas-Peucker on one (n, 2) array; the chord of a closed run has no direction, so its distance is from the point."""
    if len(pts) < 3:
        return pts
    keep = np.zeros(len(pts), bool)
    keep[[0, -1]] = True
    todo = [(0, len(pts) - 1)]
    while todo:
        i, j = todo.pop()
        if j - i < 2:
            continue
        chord, rel = pts[j] - pts[i], pts[i + 1 : j] - pts[i]
        size = np.hypot(*chord)
        d = np.hypot(rel[:, 0], rel[:, 1]) if size == 0 else np.abs(chord[0] * rel[:, 1] - chord[1] * rel[:, 0]) / size
        k = int(d.argmax())
        if d[k] > eps:
            keep[i + 1 + k] = True
            todo += [(i, i + 1 + k), (i + 1 + k, j)]
    return pts[keep]


def simplify(tracks: DataFrame, eps: float) -> DataFrame:
    """UD-1: (track, xs, ys) with the vertices that the simplification keeps."""
    shape = T.StructType([T.StructField("track", T.StringType()), T.StructField("xs", T.ArrayType(T.DoubleType())), T.StructField("ys", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [simplify_points(np.column_stack([x, y]).astype(float), eps) for x, y in zip(b["xs"], b["ys"], strict=True)]
            yield pd.DataFrame({"track": b["track"], "xs": [o[:, 0].tolist() for o in out], "ys": [o[:, 1].tolist() for o in out]})

    return tracks.select(F.col("track").cast("string").alias("track"), F.col("xs").cast("array<double>").alias("xs"), F.col("ys").cast("array<double>").alias("ys")).mapInPandas(run, shape)
