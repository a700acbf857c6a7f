"""The rules that all operators keep: exactly-one matches, violations as rows, canonical hashes."""

from __future__ import annotations

import tempfile
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Violation(ValueError):
    """Raised in strict mode when a check finds rows."""


def violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Each row once for each rule whose condition holds (null: does not), with the rule's name as `reason`."""
    found = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    return rows.withColumn("reason", F.explode(found))


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds, else null."""
    return reduce(lambda rest, r: F.when(r[1], F.lit(r[0])).otherwise(rest), rules[::-1], F.lit(None).cast("string"))


def strict(found: DataFrame, what: str) -> None:
    """Raises if there is a violation; shows up to five of them."""
    if rows := found.limit(5).collect():
        raise Violation(f"{what}: {[r.asDict() for r in rows]}")


def exactly_one(left: DataFrame, candidates: DataFrame, left_key: str, candidate: str) -> DataFrame:
    """`left` with n_candidates, match_status (matched, unmatched, ambiguous) and, if matched, `candidate`.

    `candidates` has (left_key, candidate); distinct candidates are counted, so the same one found twice is one."""
    counted = candidates.where(F.col(candidate).isNotNull()).groupBy(left_key).agg(F.count_distinct(candidate).alias("n_candidates"), F.min(candidate).alias(candidate))
    out = left.join(counted, left_key, "left").withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0)))
    status = F.when(F.col("n_candidates") == 0, "unmatched").when(F.col("n_candidates") == 1, "matched").otherwise("ambiguous")
    return out.withColumn(candidate, F.when(F.col("n_candidates") == 1, F.col(candidate))).withColumn("match_status", status)


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has, with their number."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def orphans(rows: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose (non-null) reference has no parent."""
    return rows.where(F.col(column).isNotNull()).join(parents.select(F.col(key).alias("_parent")).distinct(), F.col(column) == F.col("_parent"), "left_anti")


def row_text(*columns: str) -> Column:
    """A row's canonical text: JSON of the columns in name order. Names and values are quoted, nulls written, nested values spelt out,
    so different rows of one schema have different texts."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})


def row_hash(*columns: str) -> Column:
    return F.sha2(row_text(*columns), 256)


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage in the session's checkpoint folder. Only where all run in one process (local mode) a session without one
    gets a folder of its own; on a cluster that would be a folder the executors do not have."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        found = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not found and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(found or tempfile.mkdtemp(prefix="rail-"))
    return df.checkpoint()


def ordered(*partition: str) -> Window:
    return Window.partitionBy(*partition)
