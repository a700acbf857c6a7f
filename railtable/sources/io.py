"""Scans and sinks: snapshots, official CSV, typed catalog tables, components, manifest, search index."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railtable.checks import duplicate_keys, row_hash, strict, violations
from railtable.functions.scalars import station_name
from railtable.operators.versioning import ledger_hash
from railtable.schemas import TABLES


def scan_snapshots(spark: SparkSession, path: str, envelope: str, rows: str) -> DataFrame:
    """IO-1: JSON envelopes with an array `rows` (DDL of its items) to one row per item with the envelope's columns."""
    shape = T.StructType([*T.StructType.fromDDL(envelope).fields, T.StructField("rows", T.ArrayType(T.StructType.fromDDL(rows)))])
    return spark.read.schema(shape).json(path, multiLine=True).withColumn("row", F.explode("rows")).drop("rows").select("*", "row.*").drop("row")


def explode_json(df: DataFrame, column: str, item: str) -> DataFrame:
    """IO-1 on a column: JSON objects as text to their typed fields; text that is not such an object gives nulls."""
    return df.withColumn("_j", F.from_json(column, T.StructType.fromDDL(item))).select(*[c for c in df.columns if c != column], "_j.*")


def file_encodings(spark: SparkSession, path: str) -> DataFrame:
    """IO-2: (file, encoding) of text files: UTF-8 (with or without a byte order mark) where every line is valid, else EUC-KR. A scan of
    lines and an aggregation by file."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("ok"))
    return lines.groupBy("file").agg(F.when(F.every("ok"), "UTF-8").otherwise("EUC-KR").alias("encoding"))


def euc_kr(text: Column) -> Column:
    """Text of single bytes (ISO-8859-1) to the text that these bytes are in EUC-KR, with its usual extension; a wrong byte becomes U+FFFD."""

    @F.pandas_udf("string")
    def decoded(s: pd.Series) -> pd.Series:
        return s.map(lambda x: x.encode("latin-1").decode("cp949", "replace"), na_action="ignore")

    return F.when(text.rlike(r"[^\x00-\x7F]"), decoded(text)).otherwise(text)


def scan_csv(spark: SparkSession, path: str, ddl: str, encoding: str | None = None) -> tuple[DataFrame, DataFrame]:
    """IO-2: official CSV files with header: good rows, and quarantined ones (text that does not fit the columns or types). Without an
    encoding each file is read as what file_encodings() finds; only file names reach the driver."""
    shape = T.StructType([*T.StructType.fromDDL(ddl).fields, T.StructField("_corrupt", T.StringType())])
    paths: dict[str, list[str]] = {encoding: [path]} if encoding else {}
    if not encoding:
        for r in file_encodings(spark, path).collect():
            paths.setdefault(r["encoding"], []).append(r["file"])
    df = spark.createDataFrame([], shape)
    for name, files in sorted(paths.items()):
        # Spark does not read this charset; its bytes are told apart from the CSV's own signs, so they are read one by one and decoded after
        korean = name == "EUC-KR"
        one = spark.read.csv(files, header=True, schema=shape, encoding="ISO-8859-1" if korean else name, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", enforceSchema=True)
        if korean:
            one = one.select(*[euc_kr(F.col(f.name)).alias(f.name) if f.dataType == T.StringType() else F.col(f.name) for f in shape.fields])
        df = one if len(paths) == 1 else df.unionByName(one)
    # with columns pruned the parser would skip bad fields (and it refuses a scan of the corrupt column alone): both sides read all
    touched = F.xxhash64(*[c for c in df.columns if c != "_corrupt"]) >= F.lit(-(2**63))
    return df.where(F.col("_corrupt").isNull() & touched).drop("_corrupt"), df.where(F.col("_corrupt").isNotNull() & touched).select(F.col("_corrupt").alias("line"))


def parse_csv(df: DataFrame, column: str, ddl: str) -> DataFrame:
    """IO-2 on a column of lines: their typed fields, and `corrupt` (the line) where it does not fit the columns or types."""
    shape = T.StructType([*T.StructType.fromDDL(ddl).fields, T.StructField("corrupt", T.StringType())])
    return df.withColumn("_c", F.from_csv(column, shape.simpleString()[7:-1].replace(":", " ").replace(",", ", "), {"columnNameOfCorruptRecord": "corrupt", "mode": "PERMISSIVE"})).select(*[c for c in df.columns if c != column], "_c.*")


def field_inventory(df: DataFrame, json_column: str, *groups: str) -> DataFrame:
    """IO-3: per group the sorted union of keys over all its JSON objects and the fingerprint of that list."""
    keys = df.select(*groups, F.explode(F.json_object_keys(json_column)).alias("k")).distinct()
    g = keys.groupBy(*groups).agg(F.array_join(F.array_sort(F.collect_set("k")), ",").alias("fields"))
    return g.withColumn("fingerprint", F.sha2("fields", 256))


def typed(rows: DataFrame, table: str, renames: dict[str, str], defaults: dict[str, object] | None = None) -> DataFrame:
    """IO-4: rows of a catalog table: renamed (source name -> column), defaults for nulls, cast to the table's types."""
    back, defaults = {v: k for k, v in renames.items()}, defaults or {}
    out = []
    for f in T.StructType.fromDDL(TABLES[table]["ddl"]).fields:
        c = F.col(back.get(f.name, f.name)) if back.get(f.name, f.name) in rows.columns else F.lit(None)
        cast = c.try_cast(f.dataType)
        out.append((F.when(c.isNull(), F.lit(defaults[f.name]).cast(f.dataType)).otherwise(cast) if f.name in defaults else cast).alias(f.name))
    return rows.select(*out)


def range_violations(stations: DataFrame) -> DataFrame:
    """IO-4: stations with coordinates out of range."""
    return violations(stations, {"LATITUDE": ~F.col("latitude").between(-90, 90), "LONGITUDE": ~F.col("longitude").between(-180, 180)}).select("pack_id", "station_id", "reason")


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """IO-4: one Parquet table each, partitioned by pack."""
    for name, df in tables.items():
        df.write.mode("overwrite").partitionBy("pack_id").parquet(f"{path}/{name}")


def component(df: DataFrame, columns: list[str]) -> DataFrame:
    """IO-5: the owned columns of a table, ordered by all of them (a range-partitioned sort)."""
    return df.select(*columns).orderBy(*columns)


def write_components(tables: dict[str, DataFrame], path: str) -> None:
    """IO-5: each table into its component's folder."""
    for name, df in tables.items():
        component(df, df.columns).write.mode("overwrite").parquet(f"{path}/{TABLES[name]['component']}/{name}")


def camel(name: str) -> str:
    return re.sub(r"_([a-z0-9])", lambda m: m[1].upper(), name)


def export_rows(df: DataFrame, table: str | None = None) -> DataFrame:
    """IO-6: snake names to camel names; an unknown table, other columns than the table's, and rows that share its key are refused."""
    if table is not None and (table not in TABLES or set(df.columns) != set(T.StructType.fromDDL(TABLES[table]["ddl"]).names)):
        raise ValueError(f"unknown table or columns: {table}")
    if table is not None:
        strict(duplicate_keys(df, *TABLES[table]["key"]), f"duplicate keys in {table}")
    return df.toDF(*map(camel, df.columns))


def manifest(tables: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """IO-7: per table its row count and content hash (bucketed ledger hash), and whether it has the declared least number of rows."""
    out = None
    for name, (df, least) in tables.items():
        one = ledger_hash(df.select(row_hash(*df.columns).alias("row")).withColumn("g", F.lit(1)), "g")
        spine = df.sparkSession.range(1).select(F.lit(1).alias("g"), F.lit(name).alias("table_name"), F.lit(least).cast("long").alias("least"))
        m = spine.join(one, "g", "left").select("table_name", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("ledger_hash", F.sha2(F.lit(""), 256)).alias("content_hash"), (F.coalesce("n_rows", F.lit(0)) >= F.col("least")).alias("enough"))
        out = m if out is None else out.unionByName(m)
    return out


def search_index(stations: DataFrame, aliases: DataFrame) -> DataFrame:
    """IO-8: normalised names and aliases as search tokens, each (token, station_id) once; empty tokens left out."""
    t = stations.select(F.lower(station_name(F.col("name"))).alias("token"), "station_id").unionByName(aliases.select(F.lower(station_name(F.col("alias"))).alias("token"), "station_id"))
    return t.where("token <> ''").dropDuplicates(["token", "station_id"])
