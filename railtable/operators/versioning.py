"""Differences between versions, set comparisons, provenance and ledger hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railtable.checks import row_text, violations


def _hashed(rows: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    return rows.select(*keys, F.sha2(row_text(*rest) if rest else F.lit(""), 256).alias("h"))


def diff_table(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """DQ-1: keys with change REMOVED, ADDED or CHANGED; the order of columns does not count."""
    both = _hashed(old, keys).withColumnRenamed("h", "h0").join(_hashed(new, keys).withColumnRenamed("h", "h1"), keys, "full_outer")
    change = F.when(F.col("h1").isNull(), "REMOVED").when(F.col("h0").isNull(), "ADDED").when(F.col("h0") != F.col("h1"), "CHANGED")
    return both.select(*keys, change.alias("change")).where("change IS NOT NULL")


def diff_by_line(old: DataFrame, new: DataFrame, keys: list[str], line: str) -> DataFrame:
    """DQ-2: numbers of added, removed and modified edges per line."""
    d = diff_table(old, new, keys)
    n = lambda kind: F.count_if(F.col("change") == kind)
    return d.groupBy(line).agg(n("ADDED").alias("added"), n("REMOVED").alias("removed"), n("CHANGED").alias("modified"))


def diff_positions(old: DataFrame, new: DataFrame, threshold: float, top: int = 100) -> DataFrame:
    """DQ-3: (line_id, station_id) added or removed, and the `top` that moved beyond the threshold, farthest first."""
    k = ["line_id", "station_id"]
    j = old.select(*k, F.col("x").alias("x0"), F.col("y").alias("y0")).join(new.select(*k, F.col("x").alias("x1"), F.col("y").alias("y1")), k, "full_outer")
    moved = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    kind = F.when(F.col("x0").isNull(), "ADDED").when(F.col("x1").isNull(), "REMOVED").when(moved > threshold, "MOVED")
    d = j.select(*k, kind.alias("change"), moved.alias("moved")).where("change IS NOT NULL")
    return d.where("change <> 'MOVED'").unionByName(d.where("change = 'MOVED'").orderBy(F.desc("moved"), *k).limit(top))


def line_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """DQ-3: per line the positions before and after, and the change; lines of one version count 0 in the other."""
    n = lambda d, c: d.groupBy("line_id").agg(F.count("*").alias(c))
    j = n(old, "before").join(n(new, "after"), "line_id", "full_outer").na.fill(0, ["before", "after"])
    return j.select("line_id", "before", "after", (F.col("after") - F.col("before")).alias("change"))


def unequal_within(old: DataFrame, new: DataFrame, keys: list[str], values: list[str], tolerance: float = 0.0011) -> DataFrame:
    """DQ-4: keys of which one side lacks the row or a number differs by more than the tolerance."""
    j = old.select(*keys, F.lit(1).alias("l"), *[F.col(v).alias(f"{v}_0") for v in values]).join(new.select(*keys, F.lit(1).alias("r"), *[F.col(v).alias(f"{v}_1") for v in values]), keys, "full_outer")
    off = F.lit(False)
    for v in values:
        off = off | ~(F.col(f"{v}_0").eqNullSafe(F.col(f"{v}_1")) | F.coalesce(F.abs(F.col(f"{v}_0") - F.col(f"{v}_1")) <= tolerance, F.lit(False)))
    return j.where(F.col("l").isNull() | F.col("r").isNull() | off).select(*keys)


def snapshot_changes(snapshots: DataFrame) -> DataFrame:
    """DQ-5: each snapshot against its previous one: whether the marks of the raw data, the schema and the request and the source's own time changed, the differences
    of rows and of coverage, and CHANGED or NO_CHANGE. Two nulls are equal marks; a null count has no difference, and a null on one side is a change."""
    marks = {"raw_mark": "raw_changed", "schema_mark": "schema_changed", "request_mark": "request_changed", "source_time": "source_time_changed"}
    counts = {"row_count": "row_delta", "coverage_count": "coverage_delta"}
    p = snapshots.select(F.col("snapshot_id").alias("previous_id"), *(F.col(c).alias(f"{c}_0") for c in (*marks, *counts)))
    j = snapshots.join(p, "previous_id")
    flags = [(~F.col(c).eqNullSafe(F.col(f"{c}_0"))).alias(n) for c, n in marks.items()]
    deltas = [(F.col(c) - F.col(f"{c}_0")).alias(n) for c, n in counts.items()]
    changed = F.lit(False)
    for c in (*marks, *counts):
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"{c}_0"))
    return j.select("snapshot_id", *flags, *deltas, F.when(changed, "CHANGED").otherwise("NO_CHANGE").alias("status"))


def compare_sets(old: DataFrame, new: DataFrame) -> DataFrame:
    """DQ-6: per (day, set_name) the members that only one side has; equal sets give no row."""
    k = ["day", "set_name"]
    a, b = old.select(*k, "member").distinct(), new.select(*k, "member").distinct()
    d = a.join(b, [*k, "member"], "left_anti").withColumn("side", F.lit("REMOVED")).unionByName(b.join(a, [*k, "member"], "left_anti").withColumn("side", F.lit("ADDED")))
    return d.groupBy(*k).agg(F.count_if(F.col("side") == "REMOVED").alias("removed"), F.count_if(F.col("side") == "ADDED").alias("added"))


def identity_violations(stations: DataFrame, decisions: DataFrame) -> DataFrame:
    """DQ-7: names of several stations (name, station_id, line_id) need a reviewed decision (name, decision, station_ids array, and if the column is there line_ids array) whose
    ids, and lines, are the actual ones, in any order; one row for each name and reason. A null line set is not checked."""
    lines = F.array_sort(F.collect_set(F.col("line_id").cast("string")))
    sets = stations.groupBy("name").agg(F.count_distinct("station_id").alias("n"), F.array_sort(F.collect_set(F.col("station_id").cast("string"))).alias("actual"), lines.alias("actual_lines"))
    j = sets.where("n > 1").join(decisions, "name", "left")
    told = F.col("decision").isin("MERGE", "DISTINCT")
    same = lambda c, actual: F.array_sort(F.array_distinct(c)).eqNullSafe(F.col(actual))
    rules = {"NO_DECISION": F.col("decision").isNull(), "UNKNOWN_DECISION": ~told, "OTHER_STATIONS": told & ~same("station_ids", "actual")}
    if "line_ids" in decisions.columns:
        rules["OTHER_LINES"] = told & F.col("line_ids").isNotNull() & ~same("line_ids", "actual_lines")
    return violations(j, rules).select("name", "n", "reason")


def id_collisions(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """DQ-8: ids that both inputs have."""
    return a.select(key).intersect(b.select(key))


def canonical_digest(rows: DataFrame, member: str, *groups: str) -> DataFrame:
    """DQ-9: per group the number of distinct members and the sha256 of them in order, as a JSON array of texts."""
    s = F.array_sort(F.collect_set(F.col(member).cast("string")))
    return rows.groupBy(*groups).agg(F.count_distinct(member).alias("n"), F.sha2(F.to_json(s), 256).alias("digest"))


def field_provenance(entities: DataFrame, fields: list[str], scopes: DataFrame, overrides: DataFrame) -> DataFrame:
    """DQ-10: for each entity (entity_id, source_id, line_ids) and non-null field a record for each line that the source covers; an override
    (entity_id, field, source_id) of the field wins."""
    names = ", ".join(f"'{f}', CAST(`{f}` AS STRING)" for f in fields)
    long = entities.select("entity_id", F.col("source_id").alias("own"), "line_ids", F.expr(f"stack({len(fields)}, {names}) AS (field, value)")).where("value IS NOT NULL")
    o = overrides.select("entity_id", "field", F.col("source_id").alias("other"))
    s = long.join(o, ["entity_id", "field"], "left").withColumn("source_id", F.coalesce("other", "own"))
    c = scopes.select("source_id", F.col("line_ids").alias("covered"))
    return s.join(c, "source_id").select("entity_id", "field", "source_id", F.explode(F.array_intersect("line_ids", "covered")).alias("line_id"))


def scope_index(records: DataFrame) -> DataFrame:
    """DQ-11: distinct (region, operator, line, domain) of official records with list-valued scopes."""
    out = records.where("kind = 'OFFICIAL'").select(F.explode("region_ids").alias("region_id"), "operator_ids", "line_ids", "domains")
    out = out.select("region_id", F.explode("operator_ids").alias("operator_id"), "line_ids", "domains").select("region_id", "operator_id", F.explode("line_ids").alias("line_id"), "domains")
    return out.select("region_id", "operator_id", "line_id", F.explode("domains").alias("domain")).distinct()


def line_operators(lines: DataFrame, declared: DataFrame) -> DataFrame:
    """DQ-12: declared (line_id, operator_id) scopes; the line's own operator where none is declared."""
    d = declared.select("line_id", "operator_id")
    return d.unionByName(lines.select("line_id", "operator_id").join(d.select("line_id").distinct(), "line_id", "left_anti"))


def ledger_hash(rows: DataFrame, *groups: str, buckets: int = 256) -> DataFrame:
    """DQ-13: a content hash that does not depend on input order: row hashes sorted inside hash buckets, bucket digests in bucket order.
    No task holds more than a bucket of a group; the digest is another than that of one sorted list."""
    rest = [c for c in rows.columns if c not in groups]
    h = rows.select(*groups, F.sha2(row_text(*rest), 256).alias("h"))
    b = h.withColumn("b", F.pmod(F.conv(F.substring("h", 1, 8), 16, 10).cast("long"), F.lit(buckets)))
    d = b.groupBy(*groups, "b").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.sort_array(F.collect_list("h")), ""), 256).alias("d"))
    one = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("b", "d"))), lambda x: x["d"]), "")
    return d.groupBy(*groups).agg(F.sum("n").alias("n_rows"), F.sha2(one, 256).alias("ledger_hash"))


def inherited_violations(old: DataFrame, new: DataFrame) -> DataFrame:
    """DQ-14: row texts of `old` that `new` has fewer times; an append leaves none."""
    text = lambda d: d.select(row_text(*d.columns).alias("row")).groupBy("row").count()
    j = text(old).withColumnRenamed("count", "n0").join(text(new).withColumnRenamed("count", "n1"), "row", "left")
    return j.select("row", "n0", F.coalesce("n1", F.lit(0)).alias("n1")).where("n1 < n0")


def scope_transition(before: Column, declared: Column, after: Column) -> Column:
    """DQ-15: NEW (nothing before, all declared), UNCHANGED, UNDECLARED_EXTENSION (all before, more than declared), else INVALID."""
    eq = lambda a, b: F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))
    return F.when((F.size(before) == 0) & eq(after, declared), "NEW").when(eq(before, after), "UNCHANGED").when((F.size(F.array_except(before, after)) == 0) & (F.size(F.array_except(after, declared)) > 0), "UNDECLARED_EXTENSION").otherwise("INVALID")


def transition_violations(before: DataFrame, declared: DataFrame, exempt: DataFrame, after: DataFrame) -> DataFrame:
    """DQ-16: after = before and declared keys, without the exempt ones; no declared key was there before."""
    want = before.select("key").union(declared.select("key")).distinct().join(exempt.select("key"), "key", "left_anti")
    a = after.select("key").distinct()
    tag = lambda d, r: d.select("key", F.lit(r).alias("reason"))
    return tag(want.join(a, "key", "left_anti"), "MISSING").unionByName(tag(a.join(want, "key", "left_anti"), "UNDECLARED")).unionByName(tag(declared.select("key").intersect(before.select("key")), "SUPPORTED_BEFORE"))


def latest_per_key(rows: DataFrame, key: str, time: str, seq: str) -> DataFrame:
    """WN-15: the latest row of each key; a tie goes to the later in input order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(time), F.desc(seq)))).where("_n = 1").drop("_n")


def representative(rows: DataFrame, key: str, ranks: dict[str, int], state: str, order: str) -> DataFrame:
    """WN-16: per key the row with the highest rank of its state, then the first in order."""
    rank = F.coalesce(F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])[F.col(state)], F.lit(-1))
    return rows.groupBy(key).agg(F.max_by(F.struct(order, state), F.struct(rank, -F.col(order))).alias("r")).select(key, "r.*")


def keep_first(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """WN-17: each row with its place among its key's rows and the first one's order value; place 1 is kept, others are duplicates of it."""
    w = Window.partitionBy(*keys).orderBy(order)
    return rows.withColumn("place", F.row_number().over(w)).withColumn("first_seen", F.first(order).over(w))


def divergent_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """WN-18: keys whose rows are not all identical, with the number of versions."""
    return _hashed(rows, keys).groupBy(*keys).agg(F.count_distinct("h").alias("versions")).where("versions > 1")
