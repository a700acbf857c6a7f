"""Digests of sets of any size: an order-keeping hash tree over sorted blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtable.checks import cut
from railtable.operators.ordered import BLOCK, along, longest, numbered, running
from railtable.operators.reconcile import od_matrix

#: Members of a block, and blocks that a node of the tree stands for.
FAN = 1000


def tree_digest(rows: DataFrame, keys: list[str], text: Column, fan: int = FAN, block: int = BLOCK) -> DataFrame:
    """(keys, n, digest): of each key the number of rows with a text and the root of a hash tree over their sorted texts.

    The SHA-256 of each text is a leaf. `fan` leaves in the order of the texts are a block, whose digest is the SHA-256 of its leaves' hex, one after another; so are
    blocks of blocks, until one is left (also a single block's digest is the root). Places come from an ordered scan, so neither the order nor the partitioning of the
    input counts, no task holds a set and no array more than `fan` digests. Equal texts count each: pass distinct rows for a set. Null texts are left out; null keys
    are a key; no rows give none."""
    leaves = rows.select(*keys, text.cast("string").alias("_text")).where("_text IS NOT NULL")
    if keys:
        most, _ = longest(leaves, keys)
        placed = along(leaves, keys, ["_text"], {"_at": running(F.lit(1))}, block).withColumn("_at", F.col("_at") - 1)
    else:
        most = rows.count()  # before the texts are made, so Spark reads no column for it; null texts only make it too large
        placed = numbered(leaves, most, ["_text"], "_at", block)
    return _root(placed.select(*keys, "_at", F.unhex(F.sha2("_text", 256)).alias("_h"), F.lit(1).cast("long").alias("n")), keys, most, fan)


def _root(level: DataFrame, keys: list[str], most: int, fan: int, first: bool = True) -> DataFrame:
    """The levels of the tree above `level` (keys, _at, _h as bytes, n), of which a key has at most `most` rows; `first`: these are leaves."""
    while True:
        blocks = level.groupBy(*keys, F.floor(F.col("_at") / fan).alias("_block"))
        made = blocks.agg(F.array_sort(F.collect_list(F.struct("_at", "_h"))).alias("_s"), F.sum("n").alias("n"))
        digest = F.unhex(F.sha2(F.array_join(F.transform("_s", lambda x: F.lower(F.hex(x["_h"]))), ""), 256))
        root = F.lit(not first) & (F.col("_block") == 0) & (F.size("_s") == 1)  # of a key with fewer levels: done before
        level = made.select(*keys, F.col("_block").alias("_at"), F.when(root, F.get("_s", F.lit(0))["_h"]).otherwise(digest).alias("_h"), "n")
        most, first = -(-most // fan), False
        if most <= 1:
            return level.select(*keys, "n", F.lower(F.hex("_h")).alias("digest"))


def od_digests(pairs: DataFrame, stations: DataFrame, fan: int = FAN, block: int = BLOCK) -> DataFrame:
    """JN-26: one row for an OD matrix: its stations, the expected pairs n * (n - 1), the pairs there are, whether they agree, and the digests of the stations and of
    the pairs (JSON arrays of ids in order of their texts)."""
    one = stations.select("station_id").distinct()
    s = tree_digest(one, [], F.to_json(F.array(F.col("station_id").cast("string"))), fan, block).select(F.col("n").alias("stations"), F.col("digest").alias("station_digest"))
    p = tree_digest(pairs, [], F.to_json(F.array(F.col("origin").cast("string"), F.col("destination").cast("string"))), fan, block)
    return _od_row(s, p)


def _od_row(s: DataFrame, p: DataFrame) -> DataFrame:
    p = p.select(F.col("n").alias("pairs"), F.col("digest").alias("pair_digest"))
    expected = F.col("stations") * (F.col("stations") - 1)
    return s.join(p, F.lit(True), "left").select("stations", expected.alias("expected"), F.coalesce("pairs", F.lit(0)).alias("pairs"), (expected == F.coalesce("pairs", F.lit(0))).alias("complete"), "station_digest", "pair_digest")


def od_matrix_digests(stations: DataFrame, fan: int = FAN, block: int = BLOCK) -> DataFrame:
    """JN-26: `od_digests` of the stations' own matrix, all of whose pairs are listed and hashed, but neither sorted nor sent: a pair's text is its origin's and its destination's JSON string, which ends at
    its closing quote, so the pairs stand in the order of (origin's text, destination's text) and the place of each follows from the places of its stations. A block of `fan` pairs is one row, made from its one
    or two origins and from the texts of a run of at most 2 * `fan` stations."""
    one = stations.select("station_id").distinct()
    text = F.to_json(F.array(F.col("station_id").cast("string")))
    s = tree_digest(one, [], text, fan, block).select(F.col("n").alias("stations"), F.col("digest").alias("station_digest"))
    ranked = cut(along(one.where("station_id IS NOT NULL").select(text.alias("_t")), [], ["_t"], {"_r": running(F.lit(1))}, block).select((F.col("_r").cast("long") - 1).alias("r"), "_t"))
    n = ranked.count()
    m = n - 1  # pairs of an origin
    if m < fan:  # at most fan * fan pairs; a block may have many origins
        return _od_row(s, tree_digest(od_matrix(one), [], F.to_json(F.array(F.col("origin").cast("string"), F.col("destination").cast("string"))), fan, block))
    blocks = -(-n * m // fan)
    parts = max(int(stations.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-blocks // 10_000))
    start = F.col("_at") * F.lit(fan)
    b = stations.sparkSession.range(0, blocks, 1, parts).select(F.col("id").alias("_at")).select("_at", F.floor(start / F.lit(m)).alias("r0"), F.least(F.lit(fan), F.lit(n * m) - start).alias("size"))
    b = b.withColumn("p", start - F.col("r0") * F.lit(m)).withColumn("k0", F.least(F.col("size"), F.lit(m) - F.col("p"))).withColumn("from", F.col("p") + (F.col("p") >= F.col("r0")).cast("long"))
    b = b.select("_at", "r0", (F.col("r0") + 1).alias("r1"), "from", F.floor(F.col("from") / F.lit(fan)).alias("c"), F.col("k0").cast("int").alias("k0"), (F.col("size") - F.col("k0")).cast("int").alias("k1"))
    origin = lambda k: ranked.select(F.col("r").alias(f"r{k}"), F.expr("substr(_t, 1, length(_t) - 1) || ','").alias(f"o{k}"))
    run = F.floor(F.col("r") / F.lit(fan))
    runs = ranked.select(F.explode(F.array_distinct(F.array(run, F.greatest(run - 1, F.lit(0).cast("long"))))).alias("c"), F.struct("r", F.expr("substr(_t, 2)").alias("d")).alias("s")).groupBy("c").agg(F.array_sort(F.collect_list("s")).alias("s"))
    j = b.join(origin(0), "r0").join(origin(1), "r1", "left").join(runs, "c").crossJoin(runs.where("c = 0").select(F.col("s").alias("s1")))
    own = lambda s, at, o, r, k: F.transform(F.slice(F.filter(F.slice(s, at, k + 1), lambda x: x["r"] != r), 1, k), lambda x: F.sha2(F.concat(o, x["d"]), 256))
    h0 = own(F.col("s"), (F.col("from") - F.col("c") * F.lit(fan) + 1).cast("int"), F.col("o0"), F.col("r0"), F.col("k0"))
    h1 = F.when(F.col("k1") > 0, own(F.col("s1"), F.lit(1), F.col("o1"), F.col("r1"), F.col("k1"))).otherwise(F.array().cast("array<string>"))
    level = j.select("_at", F.concat(h0, h1).alias("_s")).select("_at", F.unhex(F.sha2(F.array_join("_s", ""), 256)).alias("_h"), F.size("_s").cast("long").alias("n"))
    return _od_row(s, _root(level, [], blocks, fan, first=False))
