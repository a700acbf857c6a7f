"""Quality metrics, facility roll-ups, ingestion coverage and consistency checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railtable.checks import row_hash


def ratio(n: Column, of: Column) -> Column:
    """Four decimals; 0 where there is nothing to count."""
    return F.when(of > 0, F.round(n / of, 4)).otherwise(F.lit(0.0))


def regional_metrics(station_lines: DataFrame, facilities: DataFrame, edges: DataFrame) -> DataFrame:
    """AG-1: one row per pack_id. station_lines (pack_id, station_line, covered, evidence), facilities (pack_id, facility_id, eligible,
    status_known, fresh), edges (pack_id, edge_id, kind, verified, access): ten numbers, ratios over distinct keys."""
    of = lambda k, cond: F.count_distinct(F.when(cond, F.col(k)))
    s = station_lines.groupBy("pack_id").agg(F.count_distinct("station_line").alias("station_lines"), of("station_line", F.col("covered")).alias("_c"), of("station_line", F.col("evidence")).alias("_e"))
    f = facilities.groupBy("pack_id").agg(F.count_distinct("facility_id").alias("facilities"), of("facility_id", F.col("eligible")).alias("_g"), of("facility_id", F.col("status_known")).alias("_k"), of("facility_id", F.col("fresh")).alias("_f"))
    path = F.col("kind") == "PATHWAY"
    e = edges.groupBy("pack_id").agg(of("edge_id", path).alias("pathways"), of("edge_id", path & F.col("verified")).alias("_v"), F.count_distinct("edge_id").alias("_n"), of("edge_id", F.col("access") == "UNKNOWN").alias("_u"))
    j = s.join(f, "pack_id", "left").join(e, "pack_id", "left").na.fill(0)
    c = F.col
    return j.select(
        "pack_id", "station_lines", "facilities", "pathways", ratio(c("_c"), c("station_lines")).alias("coverage"), ratio(c("_e"), c("station_lines")).alias("evidence"), ratio(c("_g"), c("facilities")).alias("eligible"),
        ratio(c("_k"), c("facilities")).alias("status_known"), ratio(c("_f"), c("facilities")).alias("fresh"), ratio(c("_v"), c("pathways")).alias("verified_pathways"), ratio(c("_u"), c("_n")).alias("unknown_access"),
    )


def worst_of(metrics: DataFrame, low: list[str]) -> DataFrame:
    """AG-2: the smallest of each ratio over all packs, and how many values lie outside 0..1."""
    bad = sum((F.sum(F.when(F.col(c).between(0, 1), 0).otherwise(1)) for c in low[1:]), F.sum(F.when(F.col(low[0]).between(0, 1), 0).otherwise(1)))
    return metrics.agg(*[F.min(c).alias(c) for c in low], bad.alias("out_of_bounds"))


def connector_ratio(rows: DataFrame, keys: list[str]) -> DataFrame:
    """AG-4: generated and explicit connectors and the generated share, by each of the keys and over all of them together."""
    return rows.cube(*keys).agg(F.count_if("generated").alias("generated"), F.count_if(~F.col("generated")).alias("explicit"), F.grouping_id().alias("level")).withColumn("generated_ratio", ratio(F.col("generated"), F.col("generated") + F.col("explicit")))


def route_not_found(rows: DataFrame) -> DataFrame:
    """AG-5: per reason the number of OD pairs without a route, their share of all pairs, and how many are of high priority."""
    n = rows.agg(F.count("*").alias("total"))
    r = rows.where("NOT found").groupBy(F.coalesce("reason_code", F.lit("UNKNOWN")).alias("reason")).agg(F.count("*").alias("n"), F.count_if(F.col("priority") == "HIGH").alias("high_priority"))
    return r.crossJoin(n).select("reason", "n", "high_priority", ratio(F.col("n"), F.col("total")).alias("rate"))


def facility_counts(rows: DataFrame, types: list[str]) -> DataFrame:
    """AG-10: per station and facility type the count and EXISTS or NOT_EXISTS; rows without a station are set aside."""
    wide = rows.where("station_id IS NOT NULL").groupBy("station_id").pivot("facility_type", types).count().na.fill(0)
    return wide.unpivot("station_id", types, "facility_type", "n").select("station_id", "facility_type", F.col("n").cast("long").alias("n"), F.when(F.col("n") > 0, "EXISTS").otherwise("NOT_EXISTS").alias("existence"))


def numbered_facilities(rows: DataFrame, types: list[str], columns: list[str]) -> DataFrame:
    """AG-11: facility rows, identical ones once, numbered per (station, type); an absence row (number 0) for each type not seen."""
    d = rows.withColumn("h", row_hash(*columns)).dropDuplicates(["h"])
    n = d.withColumn("no", F.row_number().over(Window.partitionBy("station_id", "facility_type").orderBy("h"))).select("station_id", "facility_type", "no", "h")
    every = rows.select("station_id").distinct().select("station_id", F.explode(F.array(*map(F.lit, types))).alias("facility_type"))
    gone = every.join(n.select("station_id", "facility_type"), ["station_id", "facility_type"], "left_anti")
    return n.unionByName(gone.select("station_id", "facility_type", F.lit(0).alias("no"), F.lit(None).cast("string").alias("h")))


def status_rollup(stations: DataFrame, facilities: DataFrame) -> DataFrame:
    """AG-12: per station: any false UNDER_MAINTENANCE, all true AVAILABLE, no row NOT_COVERED, else UNKNOWN."""
    f = facilities.groupBy("station_id").agg(F.count("*").alias("n"), F.bool_or(~F.col("operational")).alias("down"), F.count_if(F.col("operational")).alias("up"))
    j = stations.select("station_id").distinct().join(f, "station_id", "left")
    return j.select("station_id", F.when(F.col("n").isNull(), "NOT_COVERED").when(F.col("down"), "UNDER_MAINTENANCE").when(F.col("up") == F.col("n"), "AVAILABLE").otherwise("UNKNOWN").alias("status"))


def domain_matrix(station_lines: DataFrame, domains: list[str], evaluated: DataFrame) -> DataFrame:
    """AG-13: operator x domain: evaluated and all station-lines, blocking reasons, ADMITTED or BLOCKED."""
    t = station_lines.groupBy("operator_id").agg(F.count_distinct("station_line").alias("total")).select("*", F.explode(F.array(*map(F.lit, domains))).alias("domain"))
    e = evaluated.join(station_lines.select("station_line", "operator_id").distinct(), "station_line").groupBy("operator_id", "domain").agg(F.count_distinct("station_line").alias("evaluated"), F.bool_or("stale").alias("stale"))
    j = t.join(e, ["operator_id", "domain"], "left").withColumn("evaluated", F.coalesce("evaluated", F.lit(0)))
    why = F.array_compact(F.array(F.when(F.col("evaluated") == 0, "NOT_EVALUATED"), F.when((F.col("evaluated") > 0) & (F.col("evaluated") < F.col("total")), "PARTIAL"), F.when(F.col("stale"), "STALE")))
    return j.select("operator_id", "domain", "evaluated", "total", F.array_join(why, ",").alias("reasons"), F.when(F.size(why) == 0, "ADMITTED").otherwise("BLOCKED").alias("status"))


def claim_matrix(claims: DataFrame) -> DataFrame:
    """AG-14: source x domain: claims and distinct artifacts, in order."""
    return claims.groupBy("source_id", "domain").agg(F.count("*").alias("claims"), F.array_join(F.array_sort(F.collect_set("artifact")), ",").alias("artifacts"))


def edge_counts(edges: DataFrame) -> DataFrame:
    """AG-15: edges by upper-cased type, pattern and class, with defaults."""
    k = [F.upper(F.coalesce(c, F.lit(d))).alias(c) for c, d in (("edge_type", "UNKNOWN"), ("pattern", "LOCAL"), ("service_class", "SUBWAY"))]
    return edges.groupBy(*k).agg(F.count("*").alias("edges"))


def map_summary(positions: DataFrame) -> DataFrame:
    """AG-21: rows, lines, rows with a path, and stations on more than one line, over all."""
    per = positions.groupBy("station_id").agg(F.count("*").alias("n"), F.count_if(F.coalesce("path", F.lit("")) != "").alias("paths"), F.count_distinct("line_id").alias("lines"))
    a = per.agg(F.sum("n").alias("rows"), F.sum("paths").alias("with_path"), F.count_if(F.col("lines") > 1).alias("interchanges"))
    return a.crossJoin(positions.agg(F.count_distinct("line_id").alias("lines")))


def reason_histogram(quarantine: DataFrame) -> DataFrame:
    """AG-22: quarantined rows by the reason's text before the first colon."""
    return quarantine.groupBy(F.regexp_replace("reason", "(?s):.*$", "").alias("reason")).agg(F.count("*").alias("n"))


def ingestion_coverage(rows: DataFrame) -> DataFrame:
    """AG-23: per artifact: total, malformed, self loops, quarantined and admitted rows (status), and admitted stations."""
    n = lambda s: F.count_if(F.col("status") == s)
    return rows.groupBy("artifact").agg(F.count("*").alias("total"), n("MALFORMED").alias("malformed"), n("SELF_LOOP").alias("self_loops"), n("QUARANTINED").alias("quarantined"), n("ADMITTED").alias("admitted"), F.count_distinct(F.when(F.col("status") == "ADMITTED", F.col("station_id"))).alias("stations"))


def silent_sources(selected: DataFrame, *tables: DataFrame) -> DataFrame:
    """AG-24: selected sources that contribute to none of the tables."""
    used = tables[0].select("source_id")
    for t in tables[1:]:
        used = used.unionByName(t.select("source_id"))
    return selected.select("source_id").distinct().join(used.distinct(), "source_id", "left_anti")


def evidence_horizon(refs: DataFrame, evidence: DataFrame, at: int) -> DataFrame:
    """AG-25: per pack the earliest expiry of its referenced evidence, and how many references are missing or stale at the instant."""
    j = refs.join(evidence, "evidence_id", "left")
    return j.groupBy("pack_id").agg(F.min("expires_at").alias("fresh_until"), F.count_if(F.col("expires_at").isNull()).alias("missing"), F.count_if(F.col("expires_at") <= at).alias("stale"))


def time_source_check(rules: DataFrame, edges: DataFrame) -> DataFrame:
    """AG-26: per rule its failed predicates against its edge: PASS, FAIL or SKIPPED (no edge)."""
    j = rules.join(edges.select("rule_id", F.col("seconds").alias("edge_seconds"), F.col("source_id").alias("edge_source")), "rule_id", "left")
    bad = F.array_compact(F.array(F.when(F.col("edge_seconds") != F.col("seconds"), "SECONDS"), F.when(F.col("edge_source") != F.col("source_id"), "SOURCE"), F.when(F.col("edge_seconds") <= 0, "NOT_POSITIVE")))
    g = j.withColumn("bad", F.array_join(bad, ","))
    return g.select("rule_id", "bad", F.when(F.col("edge_seconds").isNull(), "SKIPPED").when(F.col("bad") == "", "PASS").otherwise("FAIL").alias("status"))


def timestamp_completeness(stops: DataFrame) -> DataFrame:
    """AG-27: required and present arrival and departure fields: the first stop needs no arrival, the last no departure."""
    w = Window.partitionBy("trip_id")
    s = stops.withColumn("no", F.row_number().over(w.orderBy("stop_no"))).withColumn("n", F.count("*").over(w))
    need = (F.col("no") > 1).cast("int") + (F.col("no") < F.col("n")).cast("int")
    have = ((F.col("no") > 1) & F.col("arrival").isNotNull()).cast("int") + ((F.col("no") < F.col("n")) & F.col("departure").isNotNull()).cast("int")
    return s.groupBy("line_id").agg(F.sum(need).alias("required"), F.sum(have).alias("present"))


def station_rollup(rows: DataFrame) -> DataFrame:
    """AG-28: facility rows nested per station in order, as text, with their hash."""
    t = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("facility_id", "status"))), lambda x: F.concat_ws("=", x["facility_id"].cast("string"), x["status"])), ";")
    return rows.groupBy("station_id").agg(F.count("*").alias("n"), t.alias("facilities")).withColumn("hash", F.sha2("facilities", 256))


def quota_conflicts(sources: DataFrame) -> DataFrame:
    """AG-29: quota stores whose sources declare different limits."""
    return sources.groupBy("store").agg(F.count_distinct("daily", "per_minute").alias("limits"), F.count("*").alias("sources")).where("limits > 1")
