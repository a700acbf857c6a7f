"""The largest distance of two positions of a group, for groups of any size and shape."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups of up to so many positions are compared pair by pair inside one row.
FEW = 48
#: Positions that one task makes a hull of at first.
SHARE = 20_000


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull of an (n, 2) array, counter-clockwise; at most two points for points on a line."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return p
    sides = []
    for run in (p.tolist(), p[::-1].tolist()):
        side: list[list[float]] = []
        for x, y in run:
            while len(side) > 1 and (side[-1][0] - side[-2][0]) * (y - side[-2][1]) - (side[-1][1] - side[-2][1]) * (x - side[-2][0]) <= 0:
                side.pop()
            side.append([x, y])
        sides += side[:-1]
    return np.array(sides)


def diameter(corners: np.ndarray) -> float:
    """Largest distance of two corners of a convex polygon: for each edge the corner farthest from it moves on around the hull, so each is passed once."""
    n = len(corners)
    if n < 3:
        return float(np.hypot(*(corners[-1] - corners[0]))) if n else 0.0
    c = corners.tolist()

    def area(a: int, b: int, k: int) -> float:
        return abs((c[b][0] - c[a][0]) * (c[k][1] - c[a][1]) - (c[b][1] - c[a][1]) * (c[k][0] - c[a][0]))

    best, k = 0.0, 1
    for a in range(n):
        b = (a + 1) % n
        while area(a, b, (k + 1) % n) > area(a, b, k):
            k = (k + 1) % n
        for i in (a, b):
            for j in (k, (k + 1) % n):
                best = max(best, (c[i][0] - c[j][0]) ** 2 + (c[i][1] - c[j][1]) ** 2)
    return float(np.sqrt(best))


def farthest(points: DataFrame, key: str) -> DataFrame:
    """(key, spread): the largest distance of two positions (x, y) of each key; 0 for a single one. Null coordinates are left out.

    Small groups are compared in one expression. Of large ones the extremes in eight directions give a distance that is reached, and only positions that could be
    farther than that from some point of the group's box go on: shares of them to partial hulls, these to one hull, round which the farthest pair is walked. No pairs
    are listed. One task holds a group's hull, whose corners are few but for positions on a curve; there it grows with them, in linear time."""
    p = points.where("x IS NOT NULL AND y IS NOT NULL").select(key, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).distinct()
    ways = {"x": F.col("x"), "y": F.col("y"), "s": F.col("x") + F.col("y"), "t": F.col("x") - F.col("y")}
    ends = [f(F.struct("x", "y"), v).alias(f"{k}{w}") for k, v in ways.items() for f, w in ((F.min_by, 0), (F.max_by, 1))]
    gap = lambda a, b: F.hypot(F.col(f"{a}.x") - F.col(f"{b}.x"), F.col(f"{a}.y") - F.col(f"{b}.y"))
    box = p.groupBy(key).agg(F.count("*").alias("n"), *[f(c).alias(f"{c}_{w}") for c in "xy" for f, w in ((F.min, "lo"), (F.max, "hi"))], *ends)
    box = box.select(key, "n", "x_lo", "x_hi", "y_lo", "y_hi", F.greatest(*[gap(f"{k}0", f"{k}1") for k in ways]).alias("reached"))
    far = F.hypot(F.greatest(F.col("x") - F.col("x_lo"), F.col("x_hi") - F.col("x")), F.greatest(F.col("y") - F.col("y_lo"), F.col("y_hi") - F.col("y")))
    left = p.join(box, key).where(far > F.col("reached")).select(key, "x", "y", "n")
    few = left.where(F.col("n") <= FEW).groupBy(key).agg(F.collect_list(F.struct("x", "y")).alias("p"))
    d = lambda a, b: F.hypot(a["x"] - b["x"], a["y"] - b["y"])
    small = few.select(key, F.array_max(F.transform("p", lambda a: F.array_max(F.transform("p", lambda b: d(a, b))))).alias("d"))
    kind = dict(p.dtypes)[key]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Hulls of what stands in one task of each key, some rows at a time."""
        kept: dict[object, np.ndarray] = {}
        for b in batches:
            for k, rows in b.groupby(key, sort=False, dropna=False):
                own = rows[["x", "y"]].to_numpy()
                kept[k] = hull(np.concatenate([kept[k], own]) if k in kept else own)
            if sum(map(len, kept.values())) > SHARE:
                yield from (pd.DataFrame({key: k, "x": v[:, 0], "y": v[:, 1]}) for k, v in kept.items())
                kept = {}
        yield from (pd.DataFrame({key: k, "x": v[:, 0], "y": v[:, 1]}) for k, v in kept.items())

    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({key: rows[key].iloc[:1], "d": [diameter(hull(rows[["x", "y"]].to_numpy()))]})

    many = left.where((F.col("n") > FEW) & F.col(key).isNotNull()).select(key, "x", "y")
    large = many.mapInPandas(partial, f"`{key}` {kind}, x double, y double").groupBy(key).applyInPandas(whole, f"`{key}` {kind}, d double")
    return box.select(key, "reached").join(small.unionByName(large), key, "left").select(key, F.greatest("reached", F.coalesce("d", F.lit(0.0))).alias("spread"))
