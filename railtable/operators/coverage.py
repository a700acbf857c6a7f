"""Coverage: requirements against source scopes, tallies, tiers, resolutions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtable.operators.quality import ratio


def _explode(sources: DataFrame) -> DataFrame:
    """Sources with list-valued scopes as (source_id, region_id, operator_id, line_id, domain, field)."""
    return sources.select("source_id", F.explode("region_ids").alias("region_id"), "operator_ids", "line_ids", "domain", "fields").select("source_id", "region_id", F.explode("operator_ids").alias("operator_id"), "line_ids", "domain", "fields").select(
        "source_id", "region_id", "operator_id", F.explode("line_ids").alias("line_id"), "domain", "fields").select("source_id", "region_id", "operator_id", "line_id", "domain", F.explode("fields").alias("field")).distinct()


KEY = ["region_id", "operator_id", "line_id", "domain"]


def evaluate(scopes: DataFrame, domains: DataFrame, sources: DataFrame) -> DataFrame:
    """AG-6: per (scope, domain) the required and covered fields, their ratio, and COVERED at the domain's threshold."""
    need = scopes.crossJoin(domains.select("domain", "threshold", F.explode("fields").alias("field")))
    hit = _explode(sources).select(*KEY, "field").distinct().withColumn("hit", F.lit(1))
    g = need.join(hit, [*KEY, "field"], "left").groupBy(*KEY, "threshold").agg(F.count("*").alias("required"), F.count("hit").alias("covered"))
    r = g.withColumn("ratio", ratio(F.col("covered"), F.col("required")))
    return r.select(*KEY, "required", "covered", "ratio", F.when(F.col("ratio") >= F.col("threshold"), "COVERED").otherwise("MISSING").alias("status"))


def tally(scopes: DataFrame, domains: DataFrame, sources: DataFrame) -> DataFrame:
    """AG-7: SUPPORTED when a source covers all fields of (scope, domain); else DUAL_OPERATOR_UNMATCHED when one would but for the operator;
    else NO_ADMITTED_SOURCE."""
    need = scopes.crossJoin(domains.select("domain", F.explode("fields").alias("field")))
    total = domains.select("domain", F.size("fields").alias("n"))
    x = _explode(sources)

    def full(keys: list[str], flag: str) -> DataFrame:
        per = need.join(x.select("source_id", *keys, "field").distinct(), [*keys, "field"]).groupBy(*KEY, "source_id").agg(F.count_distinct("field").alias("k"))
        return per.join(total, "domain").where("k = n").select(*KEY).distinct().withColumn(flag, F.lit(True))

    base = scopes.crossJoin(domains.select("domain")).distinct()
    j = base.join(full(KEY, "strict"), KEY, "left").join(full([k for k in KEY if k != "operator_id"], "loose"), KEY, "left")
    return j.select(*KEY, F.when(F.col("strict"), "SUPPORTED").when(F.col("loose"), "DUAL_OPERATOR_UNMATCHED").otherwise("NO_ADMITTED_SOURCE").alias("status"))


def tier_summary(rows: DataFrame) -> DataFrame:
    """AG-8: by tier, tier and domain, tier and region: requirements, supported, terminal share, earliest review date."""
    done = F.col("status").isin("SUPPORTED", "UNSUPPORTED")
    out = None
    for extra in (None, "domain", "region_id"):
        g = rows.groupBy("tier", *([extra] if extra else [])).agg(F.count("*").alias("requirements"), F.count_if(F.col("status") == "SUPPORTED").alias("supported"), ratio(F.count_if(done), F.count("*")).alias("terminal_ratio"), F.min("review_at").alias("next_review"))
        g = g.select("tier", *[(F.col(c) if c == extra else F.lit(None)).cast("string").alias(c) for c in ("domain", "region_id")], "requirements", "supported", "terminal_ratio", "next_review")
        out = g if out is None else out.unionByName(g)
    return out


def apply_resolutions(rows: DataFrame, resolutions: DataFrame, at: int) -> DataFrame:
    """AG-9: a reviewed "unsupported" decision moves a MISSING row to UNSUPPORTED unless it has expired or support has begun; a decision on a
    SUPPORTED row is a CONFLICT."""
    j = rows.join(resolutions.select("id", "expires_at", "support_from"), "id", "left")
    decided, live = F.col("expires_at").isNotNull(), (F.col("expires_at") > at) & (F.col("support_from").isNull() | (F.col("support_from") > at))
    new = F.when(decided & (F.col("status") == "SUPPORTED"), "CONFLICT").when((F.col("status") == "MISSING") & F.coalesce(live, F.lit(False)), "UNSUPPORTED").otherwise(F.col("status"))
    return j.select("id", new.alias("status"))


def orphan_resolutions(rows: DataFrame, resolutions: DataFrame) -> DataFrame:
    """AG-9: decisions on requirements that do not exist."""
    return resolutions.select("id").join(rows.select("id"), "id", "left_anti")


def evidence_support(requirements: DataFrame, records: DataFrame) -> DataFrame:
    """AG-30: official or field-verified records for each required field of a supported requirement."""
    r = requirements.where("status = 'SUPPORTED'").select("id", "line_id", F.explode("fields").alias("field"))
    p = records.where(F.col("kind").isin("OFFICIAL", "FIELD_VERIFIED")).groupBy("line_id", "field").agg(F.count("*").alias("n"))
    return r.join(p, ["line_id", "field"], "left").select("id", "field", F.coalesce("n", F.lit(0)).alias("records"))


def release_coverage(rows: DataFrame, scope: DataFrame) -> DataFrame:
    """PL-9: totals, ratio and a complete flag of the requirements inside a declared release scope, and of those outside."""
    inside = scope.select("line_id").distinct().withColumn("in_scope", F.lit(True))
    j = rows.join(inside, "line_id", "left").withColumn("in_scope", F.coalesce("in_scope", F.lit(False)))
    ok = F.count_if(F.col("status") == "SUPPORTED")
    return j.groupBy("in_scope").agg(F.count("*").alias("requirements"), ok.alias("supported"), ratio(ok, F.count("*")).alias("ratio"), (ok == F.count("*")).alias("complete"))
