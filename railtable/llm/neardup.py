"""Near-duplicate groups by b-bit MinHash: bands give candidates, packed low bits estimate, full sets decide."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtable.llm import vectext
from railtable.llm.common import cut, drop_cut, text_key
from railtable.llm.components import connected_components

SHINGLE, PERCENT = 5, 75
#: 32 bands of 4 minima: a pair at the threshold 0.75 shares no band with a chance of 5e-6, at 0.8 of 5e-8.
BANDS, ROWS = 32, 4
#: Low bits kept of each minimum; 16 of these lanes make a long.
BITS = 4
HASHES = BANDS * ROWS
#: Pairs whose estimate lies this many standard errors under the threshold are not confirmed on their sets.
SIGMAS = 6.0
#: Buckets of up to so many rows list their pairs across components (at most SMALL - 1 a row); larger ones meet in blocks.
SMALL = 16
_U = np.uint64
_r = np.random.default_rng(7)
_XOR = _r.integers(0, 2**63, HASHES, dtype=_U) * _U(2) + _r.integers(0, 2, HASHES, dtype=_U)
_MUL = _r.integers(0, 2**63, HASHES, dtype=_U) * _U(2) + _U(1)
_FOLD = _r.integers(0, 2**63, ROWS, dtype=_U) * _U(2) + _U(1)

_SIGNED = "doc_id long, key long, n_shingles long, set_hi long, set_lo long, bands array<long>, low array<long>"


def minima(hashes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over each (non-empty) set: one row per set."""
    out = np.empty((len(edges) - 1, HASHES), _U)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat((hashes ^ _XOR[k]) * _MUL[k], edges[:-1])
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    folded = (m.reshape(len(m), BANDS, ROWS) * _FOLD).sum(axis=2, dtype=_U)
    return vectext.mix(folded + np.arange(1, BANDS + 1, dtype=_U))


def low_bits(m: np.ndarray) -> np.ndarray:
    """The low BITS bits of each (mixed) minimum, 16 lanes of 4 bits to a long."""
    lanes = 64 // BITS
    v = (vectext.mix(m) & _U(2**BITS - 1)).reshape(len(m), HASHES // lanes, lanes)
    return (v << (np.arange(lanes, dtype=_U) * _U(BITS))).sum(axis=2, dtype=_U)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, hashes, edges in vectext.shingle_sets(batch.column(2), SHINGLE):
            n = np.diff(edges)
            full = np.flatnonzero(n)
            hi, lo = np.zeros(len(n), _U), np.zeros(len(n), _U)
            keys, low = np.zeros((0, BANDS), _U), np.zeros((0, HASHES * BITS // 64), _U)
            if len(full):
                e = np.concatenate([edges[:-1][full], edges[-1:]])
                hi[full] = np.add.reduceat(vectext.mix(hashes ^ _U(0x5851F42D4C957F2D)), e[:-1])
                lo[full] = np.add.reduceat(vectext.mix(hashes ^ _U(0x14057B7EF767814F)), e[:-1])
                m = minima(hashes, e)
                keys, low = band_keys(m), low_bits(m)
            lists = [
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, x.shape[1], 0))]).astype(np.int32)), pa.array(x.reshape(-1).view(np.int64)))
                for x in (keys, low)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(n), pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)), *lists],
                names=["doc_id", "key", "n_shingles", "set_hi", "set_lo", "bands", "low"],
            )


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (of the text), n_shingles, a 128-bit hash of the shingle set, band keys and packed low bits, for each row."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text).alias("key"), text.alias("text")).mapInArrow(_sign, _SIGNED)


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures: the share of equal lanes, freed of the 2^-BITS chance of equality."""
    ones = int("1" * 16, 16)
    def unequal(x: Column) -> Column:
        any_bit = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(any_bit, 2))
        return F.bit_count(any_bit.bitwiseAND(F.lit(ones)))
    lanes = HASHES * BITS // 64
    differ = sum((unequal(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(1, lanes)), unequal(F.get(a, F.lit(0)).bitwiseXOR(F.get(b, F.lit(0)))))
    chance = 2.0**-BITS
    return (1.0 - differ / F.lit(float(HASHES)) - F.lit(chance)) / F.lit(1.0 - chance)


def least_estimate(percent: int = PERCENT) -> float:
    chance, j = 2.0**-BITS, percent / 100
    p = chance + (1 - chance) * j
    return j - SIGMAS * math.sqrt(p * (1 - p) / HASHES) / (1 - chance)


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of sorted distinct hashes; an empty set is like nothing."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (hub, block, role): the hub's own text, then those to compare with it."""
        hub, own = None, None
        for batch in batches:
            hubs, roles, ids = (batch.column(k).to_pylist() for k in range(3))
            a, b = [], []
            for i, j, hashes, edges in vectext.shingle_sets(batch.column(3), SHINGLE):
                for k in range(i, j):
                    s = hashes[edges[k - i] : edges[k - i + 1]]
                    if roles[k] == 0:
                        hub, own = hubs[k], s.copy()
                    elif hub == hubs[k] and own is not None and similar(s, own, percent):
                        a.append(hubs[k])
                        b.append(ids[k])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def confirm(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT, block: int = 256) -> DataFrame:
    """Those of `pairs` (a, b) whose full shingle sets pass 100 * intersection >= percent * union.

    Each pair sends one text: b's, to its hub a. A hub with many partners is dealt out in blocks of about `block`,
    each with a copy of the hub's text; rows stream through sorted, so a task holds one hub's set at a time."""
    size = pairs.groupBy("a").agg(F.count("*").alias("n"))
    dealt = pairs.join(size, "a").select(F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / block)).cast("int").alias("block"), "b")
    routes = dealt.select("hub", "block", F.lit(1).alias("role"), F.col("b").alias("node")).unionByName(
        dealt.select("hub", "block").distinct().select("hub", "block", F.lit(0).alias("role"), F.col("hub").alias("node"))
    )
    sent = routes.join(texts, "node").repartition("hub", "block").sortWithinPartitions("hub", "block", "role")
    return sent.select("hub", "role", "node", "text").mapInArrow(_confirm(percent), "a long, b long")


def _likely_in_block(key: int, left: list[dict], right: list[dict], least: float, strip: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of left, row of right) across components whose estimate passes, best first. A pair counts in the first band
    that both share, and from the smaller node if both are of side 0. Looks at `strip` rows of left at a time."""
    lanes, chance = _U(int("1" * 16, 16)), 2.0**-BITS
    bands = [np.array([r["bands"] for r in x], np.int64) for x in (left, right)]
    low = [np.array([r["low"] for r in x], np.int64).view(_U) for x in (left, right)]
    ids, groups = ([np.array([r[c] for r in x], np.int64) for x in (left, right)] for c in ("node", "component"))
    minor = np.array([r["minor"] for r in right], bool)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(left), strip):
        rows = slice(at, at + strip)
        shared = bands[0][rows, None, :] == bands[1][None, :, :]
        here = bands[0][rows]
        ok = here[np.arange(len(here))[:, None], shared.argmax(axis=2)] == key
        ok &= (groups[0][rows, None] != groups[1][None, :]) & (~minor[None, :] | (ids[0][rows, None] < ids[1][None, :]))
        a, b = np.nonzero(ok)
        x = low[0][rows][a] ^ low[1][b]
        x |= x >> _U(1)
        x |= x >> _U(2)
        guess = (1.0 - np.bitwise_count(x & lanes).sum(axis=1) / HASHES - chance) / (1.0 - chance)
        passed = guess >= least
        found.append((a[passed] + at, b[passed], guess[passed]))
    a, b, guess = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(-guess, kind="stable")
    return a[order], b[order]


def _by_block(act, names: list[str]):
    """A mapInArrow function over rows sorted by (key, i, j, side): act(key, i, j, rows of side 0, of side 1) gives tuples of longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, out = None, [], []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(len(names))], names=names)

        def block() -> None:
            left, right = ([r for r in rows if r["side"] == k] for k in (0, 1))
            if left and right:
                out.extend(act(*at, left, right))

        for batch in batches:
            for row in batch.to_pylist():
                here = (row["key"], row["i"], row["j"])
                if here != at:
                    if rows:
                        block()
                    at, rows = here, []
                rows.append(row)
            yield done()
            out = []
        if rows:
            block()
            yield done()

    return run


def _survivors(least: float):
    def act(key: int, _i: int, _j: int, left: list[dict], right: list[dict]) -> set[tuple]:
        a, b = _likely_in_block(key, left, right, least)
        met = [(left[u], right[v]) for u, v in zip(a.tolist(), b.tolist(), strict=True)]
        return {(key, u["fine"], v["fine"], side, (u, v)[side]["node"]) for u, v in met for side in (0, 1)}

    return _by_block(act, ["key", "i", "j", "side", "node"])


def shared_sizes(left: list[np.ndarray], right: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of the intersections of each set of `left` with each of `right` (sorted distinct hashes). Hashes that both sides have are the columns of two
    0/1 matrices, whose product they are; `columns` of them at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    if not left or not right:
        return out.astype(np.int64)
    flat = [np.concatenate(x) for x in (left, right)]
    row = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)]
    both = np.intersect1d(*flat)
    at = [np.minimum(np.searchsorted(both, f), max(0, len(both) - 1)) for f in flat]
    hit = [both[k] == f if len(both) else np.zeros(len(f), bool) for k, f in zip(at, flat, strict=True)]
    for first in range(0, len(both), columns):
        sides = []
        for k in (0, 1):
            own = hit[k] & (at[k] >= first) & (at[k] < first + columns)
            m = np.zeros((len((left, right)[k]), min(columns, len(both) - first)), np.float32)
            m[row[k][own], at[k][own] - first] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return np.rint(out).astype(np.int64)


def _links(percent: int, least: float):
    def act(key: int, _i: int, _j: int, left: list[dict], right: list[dict]) -> list[tuple[int, int]]:
        sets: list[list[np.ndarray]] = []
        for rows in (left, right):
            mine: list[np.ndarray] = []
            for _, _, hashes, edges in vectext.shingle_sets(pa.array([r["text"] for r in rows], pa.string()), SHINGLE):
                mine += [hashes[p:q].copy() for p, q in zip(edges[:-1], edges[1:], strict=True)]
            sets.append(mine)
        u, v = _likely_in_block(key, left, right, least)
        both = shared_sizes(*sets)[u, v]
        sizes = [np.array([len(x) for x in side], np.int64) for side in sets]
        linked = 100 * both >= percent * (sizes[0][u] + sizes[1][v] - both)
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.get(c, c) != c:
                c = root[c]
            return c

        out = []
        for a, b in zip(u[linked].tolist(), v[linked].tolist(), strict=True):  # of links between the same components one is enough
            ga, gb = find(left[a]["component"]), find(right[b]["component"])
            if ga != gb:
                root[max(ga, gb)] = min(ga, gb)
                out.append((left[a]["node"], right[b]["node"]))
        return out

    return _by_block(act, ["a", "b"])


def confirm_across(mixed: DataFrame, signs: DataFrame, texts: DataFrame, percent: int, least: float, block: int = 1024, fine: int = 256, shingles: int = 2_000_000) -> DataFrame:
    """Links across components inside large buckets, without listing their pairs.

    `mixed` has (key, node, component, minor, n, m): the rows of buckets of n rows of which m are outside the largest component. Both
    are cut into blocks by hash, and each block of outsiders meets each block of the bucket in one group of about 2 * block rows.
    First only signatures meet. Their estimate says which rows meet again with their texts, in blocks of about `fine` rows or
    `shingles` shingles, whichever is less; there sets are compared, and a component once joined is not compared again. Rows are
    joined with signatures before they are dealt out, so a join gives each row of a bucket once."""
    parts = lambda size: F.ceil(F.col(size) / block).cast("int")
    place = lambda count, salt: F.pmod(F.xxhash64(F.lit(salt), "node"), count).cast("int")
    finer = lambda size, weight: F.ceil(F.greatest(F.col(size) / fine, F.col(weight) / shingles)).cast("int")
    signed = cut(mixed.join(signs, "node"), "meeting")
    weights = signed.groupBy("key").agg(F.sum("n_shingles").alias("w"), F.sum(F.when(F.col("minor"), F.col("n_shingles"))).alias("v"))
    every = lambda size, at: F.transform(F.sequence(F.lit(0), parts(size) - 1), at)
    at = lambda i, j, side, finely: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"), finely.alias("fine"))
    outside = every("n", lambda j: at(place(parts("m"), 1), j, 0, place(finer("m", "v"), 3)))
    whole = every("m", lambda i: at(i, place(parts("n"), 2), 1, place(finer("n", "w"), 4)))
    row = ["key", "node", "component", "minor", "bands", "low"]
    sides = signed.join(weights, "key").select(*row, F.explode(F.when(F.col("minor"), F.concat(outside, whole)).otherwise(whole)).alias("at")).select(*row, "at.*")
    meet = lambda d: d.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side", "node")
    left = meet(sides).mapInArrow(_survivors(least), "key long, i long, j long, side long, node long")
    left = cut(left.distinct(), "survivors")
    both = left.join(signed.select(*row), ["key", "node"]).join(texts, "node")
    return meet(both.select("key", "i", "j", "side", "node", "component", "minor", "bands", "low", "text")).mapInArrow(_links(percent, least), "a long, b long")


def near_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """near_groups() with the key of each row's text."""
    least = least_estimate(percent)
    made: list[DataFrame] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        made.append(cut(df, name))
        return made[-1]

    signed = keep(signatures(docs, id_col, text_col), "signed")
    # a node is a distinct set; its number is written with it, so it stays as it is
    reps = keep(
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_hi", "set_lo", "n_shingles")
        .agg(F.min("doc_id").alias("rep"), F.min_by(F.struct("key", "bands", "low"), F.struct("doc_id", "key")).alias("s"))
        .select(F.monotonically_increasing_id().alias("node"), "set_hi", "set_lo", "n_shingles", "rep", "s.key", "s.bands", "s.low"),
        "reps",
    )
    rows = reps.select("node", F.explode("bands").alias("key"))
    centres = rows.groupBy("key").agg(F.min("node").alias("centre"), F.count("*").alias("n")).where("n > 1").drop("n")
    buckets = keep(rows.join(centres, "key").select("key", "centre", "node"), "buckets")
    low = reps.select("node", "low")
    wanted = reps.select("node", F.col("rep").alias("doc_id"), "key").join(buckets.select("node").distinct(), "node", "left_semi")
    text = F.col(text_col).cast("string")
    owned = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text).alias("key"), text.alias("text")).join(wanted, ["doc_id", "key"])
    texts = keep(owned.groupBy("doc_id", "key", "node").agg(F.first("text").alias("text")).select("node", "text"), "texts")

    def likely(pairs: DataFrame) -> DataFrame:
        x, y = low.select(F.col("node").alias("a"), F.col("low").alias("la")), low.select(F.col("node").alias("b"), F.col("low").alias("lb"))
        return pairs.join(x, "a").join(y, "b").select("a", "b", estimate(F.col("la"), F.col("lb")).alias("e")).where(F.col("e") >= least)

    def labels(edges: DataFrame) -> DataFrame:
        found = connected_components(edges).withColumnRenamed("node", "_node")
        return buckets.join(found, buckets["node"] == found["_node"], "left").select("key", "node", F.coalesce("component", "node").alias("component"))

    first = likely(buckets.where("centre <> node").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct())
    first = keep(first.groupBy("b").agg(F.max_by("a", F.struct("e", -F.col("a"))).alias("a")).select("a", "b"), "tried")
    links = keep(confirm(first, texts, percent), "links")

    groups = labels(links).groupBy("key", "component").agg(F.count("*").alias("n"), F.min("node").alias("node"))
    main = groups.groupBy("key").agg(F.count("*").alias("k"), F.max(F.struct("n", "component", "node")).alias("m")).where("k > 1").select("key", F.col("m.component").alias("main"), F.col("m.node").alias("main_node"))
    second = groups.join(main, "key").where("component <> main").select(F.least("node", "main_node").alias("a"), F.greatest("node", "main_node").alias("b")).distinct()
    second = keep(likely(second.join(first, ["a", "b"], "left_anti")).select("a", "b"), "tried")
    links = keep(links.unionByName(confirm(second, texts, percent)), "links")

    named = keep(labels(links), "labels")
    sizes = named.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("key").agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("m")).where("k > 1")
    mixed = mixed.select("key", "n", (F.col("n") - F.col("m.n")).alias("m"), F.col("m.component").alias("main"))
    mixed = keep(named.join(mixed, "key").select("key", "node", "component", (F.col("component") != F.col("main")).alias("minor"), "n", "m"), "mixed")
    few = mixed.where(F.col("n") <= SMALL)
    minor = few.where("minor").select("key", F.col("node").alias("r1"), F.col("component").alias("c1"))
    third = minor.join(few.drop("minor", "n", "m"), "key").where("c1 <> component").select(F.least("r1", "node").alias("a"), F.greatest("r1", "node").alias("b")).distinct()
    third = keep(likely(third).select("a", "b").join(first.unionByName(second), ["a", "b"], "left_anti"), "tried")
    across = confirm_across(mixed.where(F.col("n") > SMALL), reps.select("node", "n_shingles", "bands", "low"), texts, percent, least)
    links = links.unionByName(confirm(third, texts, percent)).unionByName(across)

    found = connected_components(links).withColumnRenamed("node", "_node")
    named = reps.select("node", "set_hi", "set_lo", "n_shingles", "rep").join(found, F.col("node") == F.col("_node"), "left")
    named = named.select("set_hi", "set_lo", "n_shingles", "rep", F.coalesce("component", "node").alias("component"))
    least_id = named.groupBy("component").agg(F.min("rep").alias("group"))
    named = named.join(least_id, "component").select("set_hi", "set_lo", "n_shingles", "group")
    out = (
        signed.select("doc_id", "key", "n_shingles", "set_hi", "set_lo").join(named, ["set_hi", "set_lo", "n_shingles"], "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("group", "doc_id")))
        .select("doc_id", "key", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )
    out = cut(out, "near")
    for df in made:
        drop_cut(df)
    return out


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_shingles, component_id, kept.

    Documents are linked where 100 * |A and B| >= percent * |A or B| for their sets of 5-word shingles; component_id
    is the smallest id reachable. Steps: (1) sign every whole text; (2) equal sets (128-bit hash and size) become one
    node, combined on the map side; (3) band buckets of two or more nodes; (4) each node is
    tried against the best of its buckets' smallest members, by b-bit estimate, and confirmed on full sets; (5) where
    a bucket still holds several components, one pair for each of the smaller ones; (6) every pair of a bucket across
    components that is left, from the rows outside the bucket's largest component: listed for small buckets, compared
    block by block for large ones. After (6) no candidate pair lies across two components untried, so groups are whole
    although pairs inside a group are never listed.

    Sets are compared as 64-bit shingle hashes. Null or blank texts have no set and no link; null ids take no part
    (component_id null, kept true). Repeated rows get equal rows. Rows that share an id but not the text are judged each by its
    own text: one may be kept and the other not. Other columns are not looked at. No rows: no rows.
    """
    return near_rows(docs, id_col, text_col, percent).drop("key")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, that stay: in each group those of the smallest id. A row is known by its id and
    its text, so of several texts under one id only those go that are near copies of a smaller id's; repeated rows go or stay
    together. Rows with a null id, and null or blank texts, stay. No rows: no rows."""
    gone = near_rows(docs, id_col, text_col).where(~F.col("kept")).select(F.col("doc_id").alias("_gone"), F.col("key").alias("_key")).distinct()
    return docs.join(gone, (docs[id_col].cast("long") == gone["_gone"]) & (text_key(docs[text_col].cast("string")) == gone["_key"]), "left_anti")
