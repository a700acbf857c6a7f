"""Connected components of a pair table by alternating large and small stars, all in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtable.llm.common import cut, drop_cut


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `edges` (columns a, b), component being the smallest node reachable.

    Each round hangs every node's larger neighbours on its smallest one (large star), then all its smaller ones
    (small star); the depth falls by a constant factor a round. A hub's edges are only ever aggregated by map-side
    minima and joined back as narrow rows. Rounds are cut by tables in the shared folder; only a count and a
    checksum of the edges come to the driver. Loops and nulls are left out.
    """
    e = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = cut(e, "edges")
    before = _sum(e)
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        nxt = cut(small.select("x.u", "x.v").where("u <> v").distinct(), "edges")
        drop_cut(e)
        e, now = nxt, _sum(nxt)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    own = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return own.unionByName(own.select(F.col("component").alias("node"), "component").distinct())
