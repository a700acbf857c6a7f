"""A training-data pipeline over `documents`: five stages, each on all that the one before kept.

All stages take rows with nulls in any column, empty and very long texts, repeated rows and further columns (also of names that the
operators use), and give no rows for no rows. They judge a row by its own text; texts are never cut short. Extra columns are carried
through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from railtable.llm import decontam, mixing, neardup, quality, sharding
from railtable.llm.common import cut, drop_cut, table
from railtable.llm.queries import WEIGHTS, labelled_domains


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects: a score under the threshold. Null texts are scored as empty ones; null ids
    are judged like others; repeated rows go or stay together. Without labels all stay."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group of near copies: the smallest id (a tie cannot be; repeated rows of it all stay). Null ids and null or
    blank texts stay. Of several texts under one id only those go that copy a smaller id's."""
    return neardup.drop_near_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which a window of a benchmark item occurs. Null, empty and wordless texts stay, and so does all if the
    benchmark is empty; repeated rows go or stay together."""
    return decontam.remove(docs, table(spark, sf_dir, "benchmark"), how="documents")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents at the fitted rates (up to 1), so that the languages' tokens meet their weights. A rate is rounded by a hash of id and
    text, so repeated rows go or stay together and null ids each by their text; texts without words have the prior's rate. Without
    labels all stay."""
    return mixing.take(docs, labelled_domains(docs, table(spark, sf_dir, "labels")), WEIGHTS)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places what is left into 24 shards: doc_id, size, text_crc32, law, shard, slot, grown_shard. Null ids share a shard, null texts have
    size 8; repeated rows get slots of their own."""
    return sharding.assign_shards(docs, shards=24)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: Dictionaries, set similarity and fitted rates have no SQL form. The operators of the stages are tested against brute force or by held-out
#: accuracy; the tests of the stages check what is left and that odd rows pass.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to `documents`, each stage's rows written as a table that the next one reads; a stage's table goes when the next one's is written."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, name)
            drop_cut(before)
    return docs
