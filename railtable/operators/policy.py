"""Freshness, governance, retention, selection and status overrides. The instant of evaluation is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railtable.checks import first_reason
from railtable.operators.versioning import latest_per_key

DAY = 86_400


def add_cadence(basis: Column, cadence: Column) -> Column:
    """PL-1: epoch seconds plus an ISO duration of years, months, days or seconds (P1Y, P3M, P30D, PT300S); null if malformed."""
    n = lambda p: F.nullif(F.regexp_extract(cadence, p, 1), F.lit("")).cast("long")
    months = F.coalesce(n(r"^P(\d+)Y$") * 12, n(r"^P(\d+)M$"))
    t = F.timestamp_seconds(basis)
    moved = F.unix_timestamp(F.add_months(t, months.cast("int"))) + basis % DAY
    return F.coalesce(F.when(months.isNotNull(), moved), basis + F.coalesce(n(r"^P(\d+)D$") * DAY, n(r"^PT(\d+)S$")))


def freshness(sources: DataFrame, policy: DataFrame, at: int, skew: int = 300) -> DataFrame:
    """PL-1: sources (source_id, class_id, basis_at, provider_end, stored_expiry) with expires_at = basis + cadence, capped by the provider's
    validity; FRESH or STALE at the instant. INVALID, never FRESH, with a reason where there is no policy or basis, the cadence is malformed, the
    basis lies in the future beyond the skew, or the stored value differs."""
    j = sources.join(policy.select("class_id", "cadence"), "class_id", "left")
    e = add_cadence(F.col("basis_at"), F.col("cadence"))
    j = j.withColumn("expires_at", F.when(e.isNotNull(), F.least(e, F.coalesce("provider_end", e))))
    reason = first_reason([("NO_BASIS", F.col("basis_at").isNull()), ("NO_POLICY", F.col("cadence").isNull()), ("BAD_CADENCE", F.col("expires_at").isNull()), ("FUTURE_BASIS", F.col("basis_at") > at + skew), ("STORED_EXPIRY_DIFFERS", F.col("stored_expiry") != F.col("expires_at"))])
    return j.select("source_id", "expires_at", F.when(reason.isNotNull(), "INVALID").when(F.col("expires_at") <= at, "STALE").otherwise("FRESH").alias("state"), reason.alias("reason"))


def remaining_class(snapshots: DataFrame, at: int, warn: int = 7 * DAY, critical: int = 2 * DAY) -> DataFrame:
    """PL-2: seconds left to expiry as OK, WARNING, CRITICAL or EXPIRED, and whether to refresh."""
    left = F.col("expires_at") - at
    cls = F.when(left <= 0, "EXPIRED").when(left <= critical, "CRITICAL").when(left <= warn, "WARNING").otherwise("OK")
    return snapshots.select("facility_id", "seq", left.alias("remaining"), cls.alias("class"), (left <= warn).alias("refresh"))


def governance(sources: DataFrame) -> DataFrame:
    """PL-3: per source its sorted reasons (owner, freshness, retention, licence, redistribution) and GO or NO_GO."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    why = F.array_sort(F.array_compact(F.array(
        F.when(blank("owner"), "OWNER_MISSING"), F.when(F.coalesce("state", F.lit("STALE")) != "FRESH", "STALE"), F.when(F.coalesce("retention_days", F.lit(0)) <= 0, "RETENTION_MISSING"),
        F.when(blank("licence"), "LICENCE_MISSING"), F.when(~F.coalesce("redistributable", F.lit(False)), "REDISTRIBUTION_NOT_ALLOWED"),
    )))
    return sources.select("source_id", F.array_join(why, ",").alias("reasons"), F.when(F.size(why) == 0, "GO").otherwise("NO_GO").alias("decision"))


def purge_plan(raw: DataFrame, ledger: DataFrame, heads: DataFrame, at: int) -> DataFrame:
    """PL-4: each raw object PROTECTED (a lineage head), DELETE (retention over) or NOT_EXPIRED; objects on one side only are reasons."""
    j = raw.select("snapshot_id", F.lit(True).alias("has_raw")).join(ledger.select("snapshot_id", "retrieved_at", "retention_days"), "snapshot_id", "full_outer")
    j = j.join(heads.select("snapshot_id", F.lit(True).alias("head")), "snapshot_id", "left")
    over = F.col("retrieved_at") + F.col("retention_days") * DAY <= at
    d = F.when(F.col("has_raw").isNull(), "RAW_MISSING").when(F.col("retrieved_at").isNull(), "NOT_IN_LEDGER").when(F.col("head"), "PROTECTED").when(over, "DELETE").otherwise("NOT_EXPIRED")
    return j.select("snapshot_id", d.alias("disposition"))


def override_cascade(facilities: DataFrame, updates: DataFrame, edges: DataFrame, transfers: DataFrame) -> dict[str, DataFrame]:
    """PL-8: the latest update of each facility sets its status; edges take their facility's; a transfer rule whose edge is not available
    loses its step-free link; stations are summed up; updates of unknown facilities are orphans."""
    last = latest_per_key(updates, "facility_id", "observed_at", "seq").select("facility_id", F.col("status").alias("new_status"))
    f = facilities.join(last, "facility_id", "left").select("facility_id", "station_id", F.coalesce("new_status", "status").alias("status"))
    e = edges.join(f.select("facility_id", F.col("status").alias("f_status")), "facility_id", "left").select("edge_id", "facility_id", F.coalesce("f_status", "status").alias("status"))
    t = transfers.join(e.select("edge_id", F.col("status").alias("e_status")), "edge_id", "left")
    t = t.select("rule_id", F.when(F.coalesce("e_status", F.lit("AVAILABLE")) == "AVAILABLE", F.col("edge_id")).alias("step_free_edge"))
    s = f.groupBy("station_id").agg(F.count("*").alias("facilities"), F.count_if(F.col("status") == "AVAILABLE").alias("available"))
    return {"facilities": f, "edges": e, "transfers": t, "stations": s, "orphans": last.join(facilities, "facility_id", "left_anti").select("facility_id")}


def select_snapshots(wanted: DataFrame, snapshots: DataFrame, required: DataFrame) -> DataFrame:
    """PL-10: violations of a selection (snapshot_id): unknown, twice, not a head of its source, a required source with none or several."""
    has = snapshots.select(F.col("previous_id").alias("snapshot_id")).where("snapshot_id IS NOT NULL").distinct().withColumn("old", F.lit(True))
    w = wanted.select("snapshot_id").withColumn("n", F.count("*").over(Window.partitionBy("snapshot_id"))).distinct()
    j = w.join(snapshots.select("snapshot_id", "source_id"), "snapshot_id", "left").join(has, "snapshot_id", "left")
    tag = lambda d, c, k, r: d.where(c).select(F.col(k).cast("string").alias("id"), F.lit(r).alias("reason"))
    per = required.select("source_id").distinct().join(j.where("source_id IS NOT NULL").groupBy("source_id").agg(F.count("*").alias("k")), "source_id", "left")
    return (
        tag(j, F.col("source_id").isNull(), "snapshot_id", "UNKNOWN").unionByName(tag(j, F.col("n") > 1, "snapshot_id", "TWICE")).unionByName(tag(j, F.col("old").isNotNull(), "snapshot_id", "NOT_HEAD"))
        .unionByName(tag(per, F.col("k").isNull(), "source_id", "SOURCE_MISSING")).unionByName(tag(per, F.col("k") > 1, "source_id", "SOURCE_TWICE"))
    )


def selection_freshness(wanted: DataFrame, snapshots: DataFrame, classes: DataFrame, policy: DataFrame, at: int) -> DataFrame:
    """PL-10, behind `select_snapshots`: each selected snapshot (snapshot_id; known ones, once) needs exactly one policy class for its source (classes: source_id, class_id) and has to be
    FRESH by it (PL-1): (snapshot_id, source_id, reason), reason NO_CLASS, SEVERAL_CLASSES, STALE or PL-1's reason for INVALID. snapshots: snapshot_id, source_id, basis_at, provider_end,
    stored_expiry."""
    chosen = wanted.select("snapshot_id").distinct().join(snapshots, "snapshot_id")
    one = classes.where("class_id IS NOT NULL").groupBy("source_id").agg(F.count_distinct("class_id").alias("n"), F.min("class_id").alias("class_id"))
    j = chosen.join(one, "source_id", "left")
    judged = freshness(j.where("n = 1").select(F.struct("snapshot_id", "source_id").alias("source_id"), "class_id", "basis_at", "provider_end", "stored_expiry"), policy, at)
    old = judged.where("state <> 'FRESH'").select("source_id.snapshot_id", "source_id.source_id", F.coalesce("reason", "state").alias("reason"))
    none = j.where("n IS NULL OR n > 1").select("snapshot_id", "source_id", F.when(F.col("n").isNull(), "NO_CLASS").otherwise("SEVERAL_CLASSES").alias("reason"))
    return old.unionByName(none)


def expiry_notice(items: DataFrame, at: int, notice_days: int = 30) -> DataFrame:
    """PL-11: whole days to expiry, WARNING inside the notice window (EXPIRED at or after it), and severity."""
    days = F.floor((F.col("expires_at") - at) / DAY)
    state = F.when(F.col("expires_at") <= at, "EXPIRED").when(days <= notice_days, "WARNING").otherwise("OK")
    return items.select("facility_id", "seq", days.alias("days_left"), state.alias("state"), F.when(state == "EXPIRED", 2).when(state == "WARNING", 1).otherwise(0).alias("severity"))
