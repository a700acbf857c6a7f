"""Sharding by a hierarchical weighted hash tree: region, rack, shard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (region, rack, shard, weight)
Leaf = tuple[int, int, int, float]
BASE_SHARDS, RACKS, PER_RACK = 24, 2, 4


def tree(shards: int, base: int = BASE_SHARDS, racks: int = RACKS, per_rack: int = PER_RACK) -> list[Leaf]:
    """The first `base` shards fill regions of racks x per_rack; each later shard opens a region of its own.
    So the weights of all older subtrees stay as they are, and growing by a shard moves rows into it alone."""
    leaves = []
    for s in range(shards):
        if s < base:
            region, rest = divmod(s, racks * per_rack)
            leaves.append((region, rest // per_rack, s, 1.0))
        else:
            leaves.append((-(-base // (racks * per_rack)) + s - base, 0, s, 1.0))
    return leaves


def draw(key: Column, name: Column, weight: Column) -> Column:
    """An exponential draw with the rate `weight`, from 52 bits of the MD5 of key and node name. The child
    with the smallest draw wins, with a chance in proportion to its weight; another child's weight or presence
    does not change it."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", key, name)), 1, 13), 16, 10).cast("double")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(2**52))) / weight


def children(leaves: list[Leaf]) -> dict[str, list[tuple[str, float]]]:
    """The tree by node name: "" has the regions r0, r1, ...; a region its racks k0.0, ...; a rack its shards s0, ...
    A node weighs what its shards weigh together."""
    out: dict[str, dict[str, float]] = {}
    for region, rack, shard, weight in leaves:
        path = ["", f"r{region}", f"k{region}.{rack}", f"s{shard}"]
        for above, below in zip(path, path[1:], strict=False):
            node = out.setdefault(above, {})
            node[below] = node.get(below, 0.0) + weight
    return {k: list(v.items()) for k, v in out.items()}


def shard_of(rows: DataFrame, key: Column, leaves: list[Leaf], name: str) -> DataFrame:
    """Adds the column `name`: descends region, rack and shard by weighted draws. A weight that changes moves rows
    only between the changed node and its siblings, and below it; a subtree whose own weights stay keeps its rows
    where they are. The tree is a literal of the plan, as large as the list of shards."""
    below = F.create_map(*[x for k, v in children(leaves).items() for x in (F.lit(k), F.array(*[F.struct(F.lit(n).alias("n"), F.lit(w).alias("w")) for n, w in v]))])
    rows = rows.withColumn(name, F.lit(""))
    for _ in ("region", "rack", "shard"):
        best = F.array_min(F.transform(F.element_at(below, F.col(name)), lambda c: F.struct(draw(key, c["n"], c["w"]).alias("d"), c["n"].alias("n"))))
        rows = rows.withColumn(name, best["n"])
    return rows.withColumn(name, F.substring(name, 2, 10).cast("int"))


def assign_shards(docs: DataFrame, shards: int = 24, buckets: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, size (UTF-8 bytes plus 8; null text: 8), text_crc32, law ('key'),
    shard, slot, grown_shard (with one shard more).

    Slots are gapless from 0 in each shard. They come from `buckets` hash buckets a shard: rows are numbered
    inside their bucket, and running sums of the bucket counts (shards x buckets numbers) start each bucket, so
    no task holds a shard. Only id, size and checksum are shuffled. Equal ids share a bucket: repeated rows get
    different slots in one shard. A null id is drawn as the empty text; a null text has the checksum of none (0).
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).select(
        "doc_id", (F.octet_length("t") + 8).cast("long").alias("size"), F.crc32(F.col("t").cast("binary")).alias("text_crc32")
    )
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(":slot"))), 1, 8), 16, 10).cast("long")
    placed = shard_of(rows.withColumn("bucket", (bits % buckets).cast("int")), key, tree(shards), "shard")
    placed = shard_of(placed, key, tree(shards + 1), "grown_shard")
    counts = placed.groupBy("shard", "bucket").count()
    starts = counts.selectExpr("shard", "bucket", "sum(count) OVER (PARTITION BY shard ORDER BY bucket) - count AS start")
    numbered = placed.selectExpr("*", "row_number() OVER (PARTITION BY shard, bucket ORDER BY doc_id, size, text_crc32) - 1 AS n")
    return numbered.join(starts, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("start") + F.col("n")).alias("slot"), "grown_shard"
    )


def _sql_shard(leaves: list[Leaf], node: str = "") -> str:
    below = children(leaves).get(node)
    if below is None:
        return node[1:]
    d = ", ".join(f"-ln((('0x' || substr(md5(k || ':{n}'), 1, 13))::BIGINT + 0.5::DOUBLE) / {2**52}::DOUBLE) / {w}::DOUBLE" for n, w in below)
    return f"(CASE list_position([{d}], list_min([{d}])) " + " ".join(f"WHEN {i + 1} THEN {_sql_shard(leaves, n)}" for i, (n, _) in enumerate(below)) + " END)"


#: CRC-32 by its definition: the table of 256 remainders from the reversed polynomial, then a fold over the bytes.
SQL = f"""
WITH RECURSIVE crc(i, b, v) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL SELECT i, b + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc WHERE b < 8),
tab AS (SELECT list(v ORDER BY i) AS tab FROM crc WHERE b = 8),
d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t, coalesce(doc_id::VARCHAR, '') AS k FROM documents),
bytes AS (SELECT n, hex(encode(t)) AS x FROM d),
sums AS (SELECT n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
    lambda a, b: xor(tab[(xor(a, b) & 255) + 1], a >> 8)), 4294967295::BIGINT) AS c FROM bytes, tab),
p AS (SELECT doc_id, octet_length(encode(t))::BIGINT + 8 AS size, c AS text_crc32, ({_sql_shard(tree(24))})::INTEGER AS shard,
    ({_sql_shard(tree(25))})::INTEGER AS grown_shard, ('0x' || substr(md5(k || ':slot'), 1, 8))::BIGINT % 4096 AS bucket FROM d JOIN sums USING (n))
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, size, text_crc32) - 1 AS slot, grown_shard FROM p
"""
