"""Hash trees: the same for any order, partitioning and block, as worked out plainly; no array above the fan."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from railtable.operators import digests, ordered, reconcile


def plain(texts, fan):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    level = [sha(t) for t in sorted(texts)]
    while True:
        level = [sha("".join(level[k : k + fan])) for k in range(0, len(level), fan)]
        if len(level) == 1:
            return level[0]


def test_tree(spark):
    rng = random.Random(3)
    data = [("big", str(rng.randrange(10**6))) for _ in range(1500)] + [("one", "x"), ("few", "a"), ("few", "a"), ("few", None), (None, "z"), ("none", None)]
    want = {}
    for k, t in data:
        if t is not None:
            want.setdefault(k, []).append(t)
    for order, fan, block in ((1, 7, 100), (2, 7, 10**6), (3, 40, 90), (4, 5000, 50)):
        random.Random(order).shuffle(data)
        df = spark.createDataFrame(data, "g string, t string").repartition(order + 2)
        got = {r.g: (r.n, r.digest) for r in digests.tree_digest(df, ["g"], F.col("t"), fan, block).collect()}
        assert got == {k: (len(v), plain(v, fan)) for k, v in want.items()}
    assert digests.tree_digest(df.limit(0), ["g"], F.col("t")).count() == 0


def test_od(spark):
    s = spark.createDataFrame([(k,) for k in (3, 1, 2, 10, 2)], "station_id int")
    r = digests.od_digests(reconcile.od_matrix(s), s, fan=3, block=4).first()
    ids = ["1", "10", "2", "3"]
    assert (r.stations, r.expected, r.pairs, r.complete) == (4, 12, 12, True)
    assert r.station_digest == plain([f'["{a}"]' for a in ids], 3) and r.pair_digest == plain([f'["{a}","{b}"]' for a in ids for b in ids if a != b], 3)
    assert not digests.od_digests(reconcile.od_matrix(s).where("origin > 1"), s).first().complete


def test_od_by_place(spark):
    """The digests of a matrix made from places are those of the sorted pairs: ids of one text inside another, quotes, signs that sort below them, nulls; no sort and no exchange sees the pairs."""
    names = ["1", "10", "2", "3", "a", 'a"', "a!", "a b", "ab", "é", "\\", "1,2", "", "zz"]
    for ids, kind, fan in ((names, "string", 2), (names, "string", 7), ([*range(9), None, 3], "long", 3), ([5], "int", 2)):
        s = spark.createDataFrame([(k,) for k in ids], f"station_id {kind}")
        assert digests.od_matrix_digests(s, fan).collect() == digests.od_digests(reconcile.od_matrix(s), s, fan=fan).collect(), (ids, fan)
    from test_growth import most_rows

    stations = spark.range(300).select(F.col("id").alias("station_id"))
    assert most_rows(digests.od_matrix_digests(stations, 100)) <= 10_000  # of 89,700 pairs


def test_matrix_is_dealt_out(spark):
    assert reconcile.od_matrix(spark.range(50).select(F.col("id").alias("station_id"))).rdd.getNumPartitions() >= 8


def test_one_set_is_placed_without_a_window_over_its_rows(spark):
    """Places of a set over a block come from its ranges: no window, and no exchange of the texts after the ranges; nulls are left out and equal texts count each."""
    df = spark.range(3000).select((F.col("id") % 700).cast("string").alias("t")).unionByName(spark.createDataFrame([(None,)] * 5, "t string"))
    texts = sorted(str(k % 700) for k in range(3000))
    for block in (100, 10_000):
        assert [tuple(r) for r in digests.tree_digest(df, [], F.col("t"), 10, block).collect()] == [(3000, plain(texts, 10))]
    placed = ordered.numbered(df.where("t IS NOT NULL"), 3005, ["t"], "at", 100)
    assert [r.at for r in placed.orderBy("at").collect()] == list(range(3000)) and [r.t for r in placed.orderBy("at").collect()] == texts
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"(hashpartitioning|Window \[).*\bt#", plan)
