"""Small helpers that the corpus operators share: tables, cuts of lineage, crc-based splits."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, mod n: the fold of a document (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it. Only where all run in one process (local mode)
    a session without one gets a folder of its own; on a cluster that would be a folder the executors do not have."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="corpus-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def text_key(text: Column) -> Column:
    """Tells the texts of one id apart: rows of equal id and key are repeated rows."""
    return F.xxhash64(F.lit(5), text)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: later stages do not recompute
    it, and a lost executor costs no more than the tasks after it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def drop_cut(df: DataFrame) -> None:
    """Deletes a table that cut() wrote, once nothing reads it any more."""
    if path := getattr(df, "_cut_path", None):
        jvm, conf = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


def bounded_ids(rows: DataFrame, id_col: str, limit: int, by: list[str] | None = None) -> DataFrame:
    """At most `limit` ids (per group of `by`), those with the smallest hashes: a sample that does not depend on
    partitioning, and of a proven size for a bounded number of groups. Ids whose hash is far from the smallest are left
    out before the ranking (the count of a group says where), so a group of any size sends few rows to be ranked."""
    keys = by or []
    ranked = rows.select(id_col, *keys).where(F.col(id_col).isNotNull()).withColumn("_h", F.xxhash64(F.lit(17), id_col))
    counts = ranked.groupBy(*keys).agg(F.count("*").alias("_n"))
    share = F.lit(limit + 6.0 * limit**0.5) / F.col("_n")
    unit = F.shiftrightunsigned("_h", 11) / F.lit(float(2**53))
    joined = ranked
    for k in keys:
        counts = counts.withColumnRenamed(k, f"_by_{k}")
    same = [F.col(k).eqNullSafe(F.col(f"_by_{k}")) for k in keys]
    joined = ranked.join(counts, same) if keys else ranked.crossJoin(counts)  # without keys the other side is one row
    few = joined.where(unit < share).select(id_col, *keys, F.shiftrightunsigned("_h", 11).alias("_h"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_h", id_col))
    return few.withColumn("_place", place).where(F.col("_place") <= limit).drop("_h", "_place")
