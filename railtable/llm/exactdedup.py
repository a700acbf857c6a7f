"""Exact deduplication: group by a 128-bit content hash, keep the smallest stable id, compare bytes in groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtable.llm.common import cut

#: Positions of the bitmap of hashes that occur twice, as a power of two.
BITS = 27


def normalised(text: Column) -> Column:
    """Null as empty; each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def seen_twice(hashes: DataFrame) -> DataFrame:
    """(bucket, bits): a bitmap over BITS positions, with the position of each hash that several rows have. At most 2 ** (BITS - 15) rows of
    4 KB, 16 MB in all, whatever the input."""
    twice = hashes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select(position(F.col("h")).alias("p"))
    return twice.groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))


def position(h: Column) -> Column:
    return F.pmod(F.xxhash64(h), F.lit(1 << BITS)).cast("long")


def is_set(bits: Column, p: Column) -> Column:
    """Is the bit of a position set in its bucket's bitmap?"""
    at = F.bitmap_bit_position(p)
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    The 128-bit MD5 of the normalised text is the group's key. Hashes alone tell which of them several rows have; only texts that
    may be among these (a bitmap of 16 MB at most is broadcast; more positions than bits would let more texts pass, never fewer)
    are shuffled. Spark's aggregation on (hash, text) compares the bytes inside each group, so texts that only share a hash part,
    and it combines copies before the shuffle: a group of any size leaves each map task as one row. Rows then find their group by
    MD5 and SHA-256, a join of narrow rows whose hot keys adaptive execution splits. Different texts that shared both
    (none are known) would raise an error rather than be merged.

    Null text equals the empty text. Repeated rows (same id and text) count each in group_size and are all
    kept if their id is the smallest. Null ids are passed over when the smallest id is sought; a group of
    only null ids keeps them all (keep_id null). Other columns of `docs` are not looked at. No rows: no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("t")).withColumn("h", F.unhex(F.md5("t")))
    sha = F.unhex(F.sha2("t", 256)).alias("s")
    narrow = cut(rows.select("doc_id", "h", sha), "hashes")
    bits = F.broadcast(cut(seen_twice(narrow), "bits"))
    p = position(F.col("h"))
    maybe = rows.join(bits, F.bitmap_bucket_number(p) == F.col("bucket")).where(is_set(F.col("bits"), p)).select("doc_id", "h", "t")
    texts = maybe.groupBy("h", "t").agg(F.min("doc_id").alias("keep"), F.count("*").alias("size"))
    groups = texts.select("h", sha, "keep", "size").groupBy("h", "s").agg(F.max("keep").alias("keep"), F.max("size").alias("size"), F.count("*").alias("texts"))
    size = F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share MD5 and SHA-256")).cast("long")).otherwise(F.coalesce("size", F.lit(1)))
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep"))
    return narrow.join(groups, ["h", "s"], "left").select(
        "doc_id", keep.alias("keep_id"), size.alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("s")).alias("text_sha256")
    )


SQL = """
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM t
"""
