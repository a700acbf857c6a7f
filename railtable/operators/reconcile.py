"""Joins and reconciliation: rosters, mappings, references, coverage of scopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railtable.checks import cut, exactly_one, row_hash, violations
from railtable.functions.scalars import station_name
from railtable.operators.hulls import farthest
from railtable.operators.ordered import TILE, along, running, tiled
from railtable.operators.spatial import meet


def match_roster(rows: DataFrame, roster: DataFrame) -> DataFrame:
    """JN-1: rows (row_id, raw_name, raw_line) against a roster (station_id, name, aliases, line_id, line_name): station by normalised
    name or alias, exactly one; then the line within the matched station by name or id. Stations are counted by name, so no row meets all that share it."""
    names = roster.select("station_id", F.explode(F.array_union(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("n")).select("station_id", station_name(F.col("n")).alias("key")).distinct()
    keyed = rows.withColumn("key", station_name(F.col("raw_name")))
    found = exactly_one(keyed, names, "key", "station_id").drop("key")
    lines = roster.select("station_id", "line_id", "line_name").distinct()
    at = found.where("station_id IS NOT NULL").select("row_id", "station_id", "raw_line").join(lines, "station_id").where((F.col("raw_line") == F.col("line_name")) | (F.col("raw_line") == F.col("line_id")))
    line = at.groupBy("row_id").agg(F.count_distinct("line_id").alias("n_lines"), F.min("line_id").alias("line_id"))
    return found.join(line, "row_id", "left").withColumn("n_lines", F.coalesce("n_lines", F.lit(0))).withColumn("line_id", F.when(F.col("n_lines") == 1, F.col("line_id")))


def partition_tuples(rows: DataFrame, mapping: DataFrame, stations: DataFrame) -> DataFrame:
    """JN-2: identity tuples (operator, line, name) with their row counts, classified: JOINED, or UNMATCHED / AMBIGUOUS with a reason.
    `mapping` has (operator, line, line_id), `stations` (line_id, name, station_id)."""
    t = rows.groupBy("operator", "line", "name").agg(F.count("*").alias("n_rows"))
    m = mapping.groupBy("operator", "line").agg(F.count_distinct("line_id").alias("lines"), F.min("line_id").alias("line_id"))
    s = stations.groupBy("line_id", "name").agg(F.count_distinct("station_id").alias("stations"), F.min("station_id").alias("station_id"))
    j = t.join(m, ["operator", "line"], "left").join(s, ["line_id", "name"], "left")
    reason = F.when(F.coalesce("name", F.lit("")) == "", "NAME_MISSING").when(F.col("lines").isNull(), "LINE_UNMAPPED").when(F.col("lines") > 1, "LINE_AMBIGUOUS").when(F.col("stations").isNull(), "STATION_NOT_ON_LINE").when(F.col("stations") > 1, "STATION_AMBIGUOUS")
    status = F.when(reason.isNull(), "JOINED").when(reason.endswith("AMBIGUOUS"), "AMBIGUOUS").otherwise("UNMATCHED")
    return j.select("operator", "line", "name", "n_rows", status.alias("status"), reason.alias("reason"), F.when(reason.isNull(), F.col("station_id")).alias("station_id"))


def multi_key_match(rows: DataFrame, by_name: DataFrame, by_code: DataFrame, explicit: DataFrame) -> DataFrame:
    """JN-3: candidates by name, code and explicit mapping together, each station once; exactly one matches. A row's candidates are counted, not listed: those of its
    name and of its code, less those of both, and its explicit ones (few to a row) that neither has. row_id is a key of rows."""
    names, codes = (d.where(F.col(k).isNotNull() & F.col("station_id").isNotNull()).select(k, "station_id").distinct() for d, k in ((by_name, "name"), (by_code, "code")))
    counted = lambda d, keys, t: d.groupBy(*keys).agg(F.count("*").alias(f"n{t}"), F.min("station_id").alias(f"s{t}"))
    mapped = rows.select("row_id", "name", "code").join(explicit.where("station_id IS NOT NULL").select("row_id", "station_id").distinct(), "row_id")
    own = mapped.join(names, ["name", "station_id"], "left_anti").join(codes, ["code", "station_id"], "left_anti")
    j = rows.select("row_id", "name", "code").join(counted(names, ["name"], "_name"), "name", "left").join(counted(codes, ["code"], "_code"), "code", "left")
    j = j.join(counted(names.join(codes, "station_id"), ["name", "code"], "_both"), ["name", "code"], "left").join(counted(own, ["row_id"], "_own"), "row_id", "left")
    n = lambda t: F.coalesce(f"n_{t}", F.lit(0))
    j = j.withColumn("n_candidates", n("name") + n("code") - n("both") + n("own"))
    status = F.when(F.col("n_candidates") == 0, "unmatched").when(F.col("n_candidates") == 1, "matched").otherwise("ambiguous")
    return j.select("row_id", "n_candidates", F.when(F.col("n_candidates") == 1, F.coalesce("s_name", "s_code", "s_own")).alias("station_id"), status.alias("match_status"))


def never_covered(canonical: DataFrame, matches: DataFrame) -> DataFrame:
    """JN-3: canonical stations that no matched row covers."""
    return canonical.select("station_id").distinct().join(matches.where("match_status = 'matched'").select("station_id"), "station_id", "left_anti")


def match_labels(labels: DataFrame, stations: DataFrame, reviewed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JN-4: reviewed overrides (label_id, station_id) first, then by name, exactly one; and stations still without a label."""
    auto = labels.join(reviewed.select("label_id"), "label_id", "left_anti")
    found = exactly_one(auto, stations, "name", "station_id").select("label_id", "station_id", "match_status")
    out = reviewed.join(labels.select("label_id"), "label_id").select("label_id", "station_id", F.lit("reviewed").alias("match_status")).unionByName(found)
    return out, stations.select("station_id").distinct().join(out.where("station_id IS NOT NULL").select("station_id"), "station_id", "left_anti")


def ordinal_mapping(provider: DataFrame, canonical: DataFrame) -> DataFrame:
    """JN-5: pairs by (line_id, seq), with a reason where a side lacks the number or the normalised names differ."""
    p, c = provider.select("line_id", "seq", F.col("name").alias("p_name")), canonical.select("line_id", "seq", "station_id", F.col("name").alias("c_name"))
    j = p.join(c, ["line_id", "seq"], "full_outer")
    reason = F.when(F.col("p_name").isNull(), "NOT_AT_PROVIDER").when(F.col("c_name").isNull(), "NOT_CANONICAL").when(station_name(F.col("p_name")) != station_name(F.col("c_name")), "NAME_DIFFERS")
    return j.select("line_id", "seq", "station_id", reason.alias("reason"))


def code_lookup(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """JN-6: problems of a code mapping (code, station_id, state, evidence): duplicate codes, inactive ones without evidence, retired ids used
    by an active one, and codes of `rows` that are not mapped."""
    n = mapping.withColumn("n", F.count("*").over(Window.partitionBy("code")))
    retired = mapping.where("state = 'RETIRED'").select(F.col("station_id").alias("_r")).distinct()
    bad = violations(n.join(retired, F.col("station_id") == F.col("_r"), "left"), {
        "DUPLICATE_CODE": F.col("n") > 1, "NO_EVIDENCE": (F.col("state") != "ACTIVE") & (F.coalesce("evidence", F.lit("")) == ""), "RETIRED_ID_REUSED": (F.col("state") == "ACTIVE") & F.col("_r").isNotNull(),
    }).select("code", "reason")
    return bad.unionByName(rows.select("code").distinct().join(mapping.select("code"), "code", "left_anti").select("code", F.lit("UNMAPPED").alias("reason"))).distinct()


def assemble_edges(rows: DataFrame, mapping: DataFrame, seconds: int = 120) -> DataFrame:
    """JN-7: edges whose endpoints are resolved by code, with defaults; rows with an unresolved end are left to code_lookup()."""
    m = lambda p: mapping.select(F.col("code").alias(f"{p}_code"), F.col("station_id").alias(f"{p}_station"))
    return rows.join(m("from"), "from_code").join(m("to"), "to_code").select("edge_id", "from_station", "to_station", F.coalesce("seconds", F.lit(seconds)).alias("seconds"), F.coalesce("pattern", F.lit("LOCAL")).alias("pattern"))


def missing_evidence(required: DataFrame, kinds: DataFrame, evidence: DataFrame) -> DataFrame:
    """JN-8: (station_line, facility_type) pairs that are required and have no evidence."""
    return required.select("station_line").distinct().crossJoin(kinds.select("facility_type").distinct()).join(evidence.select("station_line", "facility_type"), ["station_line", "facility_type"], "left_anti")


def scope_differences(actual: DataFrame, scope: DataFrame, key: str) -> DataFrame:
    """JN-8: ids out of the scope, and ids of the scope without a row."""
    a, s = actual.select(key).distinct(), scope.select(key).distinct()
    return a.join(s, key, "left_anti").withColumn("reason", F.lit("OUT_OF_SCOPE")).unionByName(s.join(a, key, "left_anti").withColumn("reason", F.lit("NO_ROWS")))


def endpoint_violations(edges: DataFrame, station_lines: DataFrame) -> DataFrame:
    """JN-9: edges with an unknown end, or whose type does not fit: ENTRY is station to line, EXIT line to station of the same station; nodes
    are 'station' or 'station:line'."""
    lines = station_lines.select(F.concat_ws(":", "station_id", "line_id").alias("node"), F.lit("LINE").alias("kind")).unionByName(station_lines.select(F.col("station_id").cast("string").alias("node"), F.lit("STATION").alias("kind"))).distinct()
    side = lambda p: lines.select(F.col("node").alias(f"{p}_node"), F.col("kind").alias(f"{p}_kind"))
    e = edges.join(side("from"), "from_node", "left").join(side("to"), "to_node", "left")
    same = F.split("from_node", ":")[0] == F.split("to_node", ":")[0]
    entry = (F.col("from_kind") == "STATION") & (F.col("to_kind") == "LINE") & same
    leave = (F.col("from_kind") == "LINE") & (F.col("to_kind") == "STATION") & same
    return violations(e, {"UNKNOWN_FROM": F.col("from_kind").isNull(), "UNKNOWN_TO": F.col("to_kind").isNull(), "BAD_ENTRY": (F.col("edge_type") == "ENTRY") & ~entry, "BAD_EXIT": (F.col("edge_type") == "EXIT") & ~leave}).select("edge_id", "reason")


def accessibility_gate(edges: DataFrame, evidence: DataFrame) -> DataFrame:
    """JN-19: ENTRY and EXIT edges whose status lacks its own kind of evidence (edge_id, kind)."""
    need = F.create_map(F.lit("AVAILABLE"), F.lit("OPERATION"), F.lit("UNDER_MAINTENANCE"), F.lit("MAINTENANCE_NOTICE"), F.lit("NO_OFFICIAL_FEED"), F.lit("FEED_SEARCH"))
    e = edges.where(F.col("edge_type").isin("ENTRY", "EXIT")).withColumn("kind", need[F.col("status")])
    lacking = e.where("kind IS NOT NULL").join(evidence.select("edge_id", "kind").distinct(), ["edge_id", "kind"], "left_anti").select("edge_id", F.concat(F.lit("LACKS_"), F.col("kind")).alias("reason"))
    return lacking.unionByName(e.where("kind IS NULL").select("edge_id", F.lit("STATUS_UNPROVEN").alias("reason")))


def missing_stations(roster: DataFrame, covered: DataFrame, aliases: DataFrame, gaps: DataFrame) -> DataFrame:
    """JN-20: roster names of a line that are neither covered nor aliased nor a documented gap."""
    k = ["line_id", "name"]
    return roster.select(*k).distinct().join(covered.select(*k), k, "left_anti").join(aliases.select(*k), k, "left_anti").join(gaps.select(*k), k, "left_anti")


def name_collisions(roster: DataFrame) -> DataFrame:
    """JN-20: normalised names that several stations of a line have."""
    return roster.groupBy("line_id", station_name(F.col("name")).alias("key")).agg(F.count_distinct("station_id").alias("n")).where("n > 1")


def rename_check(renames: DataFrame, topology: DataFrame) -> DataFrame:
    """JN-21: (old_name, new_name) against the names present: ADOPTED, STALE, BOTH, NEITHER."""
    there = lambda c: topology.select(F.col("name").alias(c)).distinct().withColumn(f"has_{c}", F.lit(True))
    j = renames.join(there("old_name"), "old_name", "left").join(there("new_name"), "new_name", "left")
    o, n = (F.coalesce(c, F.lit(False)) for c in ("has_old_name", "has_new_name"))
    return j.select("old_name", "new_name", F.when(n & ~o, "ADOPTED").when(o & ~n, "STALE").when(o & n, "BOTH").otherwise("NEITHER").alias("status"))


def not_listed(found: DataFrame, allowed: DataFrame, a: str, b: str) -> DataFrame:
    """JN-22: violations whose unordered pair is not on the allow-list."""
    lo, hi = F.least(a, b), F.greatest(a, b)
    return found.withColumns({"_a": lo, "_b": hi}).join(allowed.select(lo.alias("_a"), hi.alias("_b")).distinct(), ["_a", "_b"], "left_anti").drop("_a", "_b")


def work_plan(stations: DataFrame, day_types: list[str], directions: list[str], done: DataFrame, size: int) -> DataFrame:
    """JN-23: (station_id, day_type, direction) minus what is done, numbered in batches of `size`. The number is global: counts by station
    are range-partitioned and summed inside each range; only the ranges' totals (a row each) are summed in one task."""
    full = stations.select("station_id").distinct().select("station_id", F.explode(F.array(*map(F.lit, day_types))).alias("day_type")).select("station_id", "day_type", F.explode(F.array(*map(F.lit, directions))).alias("direction"))
    left = full.join(done, ["station_id", "day_type", "direction"], "left_anti").withColumn("n", F.row_number().over(Window.partitionBy("station_id").orderBy("day_type", "direction")))
    counts = left.groupBy("station_id").agg(F.count("*").alias("c"))
    ranges = cut(counts.repartitionByRange("station_id").select("station_id", "c", F.spark_partition_id().alias("range")))
    totals = ranges.groupBy("range").agg(F.sum("c").alias("t"))
    totals = totals.select(F.collect_list(F.struct("range", "t")).alias("all")).select(F.explode(F.sort_array("all")).alias("x"), "all").select("x.range", F.aggregate(F.filter("all", lambda y: y["range"] < F.col("x.range")), F.lit(0).cast("long"), lambda a, y: a + y["t"]).alias("offset"))
    inside = F.sum("c").over(Window.partitionBy("range").orderBy("station_id")) - F.col("c")
    before = ranges.withColumn("inside", inside).join(totals, "range").select("station_id", (F.col("inside") + F.col("offset")).alias("before"))
    return left.join(before, "station_id").select("station_id", "day_type", "direction", F.ceil((F.col("before") + F.col("n")) / size).cast("long").alias("batch"))


def search_plan(scopes: DataFrame, domains: DataFrame, admitted: DataFrame, terms: DataFrame) -> DataFrame:
    """JN-24: active (line_id, domain) pairs that are not admitted, with each query term of the domain."""
    return scopes.where("active").select("line_id").distinct().crossJoin(domains.select("domain").distinct()).join(admitted.select("line_id", "domain"), ["line_id", "domain"], "left_anti").join(terms, "domain").select("line_id", "domain", "term")


def pathway_baseline(pairs: DataFrame, existing: DataFrame, platforms: DataFrame) -> DataFrame:
    """JN-25: transfer pairs (station_id, from_line, to_line, seconds) minus undirected pairs that exist, with the platform node of both
    sides; a missing one is a reason."""
    key = lambda d: d.withColumns({"a": F.least("from_line", "to_line"), "b": F.greatest("from_line", "to_line")})
    new = key(pairs).join(key(existing).select("station_id", "a", "b").distinct(), ["station_id", "a", "b"], "left_anti")
    side = lambda p: platforms.select("station_id", F.col("line_id").alias(f"{p}_line"), F.col("node").alias(f"{p}_node"))
    j = new.join(side("from"), ["station_id", "from_line"], "left").join(side("to"), ["station_id", "to_line"], "left")
    return j.select("station_id", "from_line", "to_line", "seconds", "from_node", "to_node", F.when(F.col("from_node").isNull() | F.col("to_node").isNull(), "NO_PLATFORM_NODE").alias("reason"))


def od_matrix(stations: DataFrame) -> DataFrame:
    """JN-26: all ordered pairs of distinct stations, listed by as many tasks as they need (`tiled`)."""
    s = cut(stations.select("station_id").distinct())
    n = s.count()
    return tiled(s.select(F.col("station_id").alias("origin")), s.select(F.col("station_id").alias("destination")), n, n).where("origin <> destination")


def assign_nodes(nodes: DataFrame, stations: DataFrame) -> DataFrame:
    """JN-27: node (node_id, name, line_id) to the first station of its name, one on its line before others: the first by name and line, else the first by name."""
    first = stations.groupBy("name").agg(F.min("station_id").alias("_any"))
    on = stations.where("line_id IS NOT NULL").groupBy("name", "line_id").agg(F.min("station_id").alias("_on"), F.lit(True).alias("_there"))
    j = nodes.join(on, ["name", "line_id"], "left").join(first, "name", "left")
    there = F.coalesce("_there", F.lit(False))
    station = F.when(there, F.col("_on")).otherwise(F.col("_any"))
    best = j.groupBy("node_id").agg(F.min(F.struct((~there).alias("late"), station.isNull().alias("none"), station.alias("station_id"))).alias("m"))
    return best.select("node_id", "m.station_id", (~F.col("m.late")).alias("on_line"))


def _node_fits(nodes: DataFrame, labels: DataFrame, stations: DataFrame, region: str) -> tuple[DataFrame, DataFrame]:
    """What `node_candidates` lists, unlisted: (source, node_id, name, x, y, station_id, every, single), where `every` stands for all stations of the name in the second frame (name,
    station_id), and `single` says that no other row can give the same candidate. Each node or label meets one row by its name and one by its line."""
    named = stations.groupBy("name", "station_id").agg(F.max((F.col("region") == region).cast("int")).alias("here"))
    here = named.where("here = 1 AND station_id IS NOT NULL AND name IS NOT NULL").select("name", "station_id")
    by_name = named.groupBy("name").agg(F.count("*").alias("n"), F.min("station_id").alias("only"), F.max(F.when(F.col("station_id").isNotNull(), F.col("here"))).alias("some"))
    by_line = stations.where("line_id IS NOT NULL").groupBy("name", "line_id").agg(F.min("station_id").alias("first"))
    marks = nodes.select("node_id", "name", "line_id", F.coalesce("by_line", F.lit(False)).alias("told"), "x", "y", F.lit("NODE").alias("source"))
    texts = labels.select(F.lit(None).cast(dict(nodes.dtypes)["node_id"]).alias("node_id"), "name", F.lit(None).cast(dict(nodes.dtypes)["line_id"]).alias("line_id"), F.lit(False).alias("told"), "x", "y", F.lit("LABEL").alias("source")).distinct()
    j = marks.unionByName(texts).join(by_name, "name", "left").join(by_line, ["name", "line_id"], "left")
    lost, many = F.col("told") & F.col("line_id").isNull(), F.col("n") > 1
    every = F.coalesce(many & ~F.col("told") & (F.col("some") == 1), F.lit(False))
    station = F.when(lost, None).when(F.col("n") == 1, F.col("only")).when(many & F.col("told"), F.col("first"))
    key = ["source", "node_id", "name", "x", "y"]
    # a node's rows of one name are one: the smallest station by line, and no null row beside a station
    j = j.groupBy(*key).agg(F.min(station).alias("station_id"), F.max(every).alias("every"))
    j = j.where("station_id IS NOT NULL OR every OR source = 'NODE'")
    j = j.select(*key, F.explode(F.filter(F.array(F.when(F.col("station_id").isNotNull() | ~F.col("every"), F.struct("station_id", F.lit(False).alias("every"))), F.when(F.col("every"), F.struct(F.lit(None).cast(dict(stations.dtypes)["station_id"]).alias("station_id"), F.lit(True).alias("every")))), lambda r: r.isNotNull())).alias("r")).select(*key, "r.*")
    return j.withColumn("single", F.count("*").over(Window.partitionBy("source", "node_id", "x", "y")) == 1), here


def node_candidates(nodes: DataFrame, labels: DataFrame, stations: DataFrame, region: str) -> DataFrame:
    """JN-27: which stations a map's nodes (node_id, name, line_id, by_line, x, y) stand for: distinct (station_id, source, node_id, x, y), and nodes without one as rows of a
    null station. The only station of the name; where several have it: with `by_line` the one (the smallest id) on the node's line and no other, else all of them that are on a
    line of the region, since they are one place. A node with `by_line` but no line fits none. Labels (name, x, y) do the same for stations that have no marker; they stand behind all nodes.
    stations: (station_id, name, line_id, region), a row for each line. A null name fits none. Only where several rows of a place may name one station are the listed rows made distinct.
    The stations of a name stand in arrays, each of which a row of the name meets at once; names with many rows are dealt out (`meet`)."""
    fits, here = map(cut, _node_fits(nodes, labels, stations, region))
    out = ["station_id", "source", "node_id", "x", "y"]
    placed = along(here, ["name"], ["station_id"], {"_at": running(F.lit(1))}).groupBy("name", F.ceil(F.col("_at") / TILE).alias("_tile"))
    packed = placed.agg(F.collect_list("station_id").alias("_stations")).select("name", "_stations")
    listed = meet(fits.where("single AND every").drop("station_id"), packed, ["name"]).select(F.explode("_stations").alias("station_id"), *out[1:])
    rest = fits.where("NOT single AND every").drop("station_id").join(here, "name").select(*out).unionByName(fits.where("NOT single AND NOT every").select(*out))
    return listed.unionByName(fits.where("single AND NOT every").select(*out)).unionByName(rest.distinct())


def first_assignments(nodes: DataFrame, labels: DataFrame, stations: DataFrame, region: str) -> DataFrame:
    """JN-27: `first_candidates` of `node_candidates` without listing them: of the nodes and labels that stand for all stations of a name only the first counts."""
    fits, here = _node_fits(nodes, labels, stations, region)
    order = F.struct((F.col("source") == "LABEL").alias("late"), "node_id", "x", "y")
    every = fits.where("every").groupBy("name").agg(F.min(order).alias("m")).join(here, "name").select("station_id", "m")
    single = fits.where("station_id IS NOT NULL").groupBy("station_id").agg(F.min(order).alias("m"))
    best = every.unionByName(single).groupBy("station_id").agg(F.min("m").alias("m"))
    return best.select("station_id", F.when(F.col("m.late"), "LABEL").otherwise("NODE").alias("source"), "m.node_id", "m.x", "m.y")


def first_candidates(candidates: DataFrame) -> DataFrame:
    """JN-27: each station's first candidate: nodes by id, then labels (of several labels, the smallest x and y)."""
    order = F.struct((F.col("source") == "LABEL").alias("late"), "node_id", "x", "y")
    return candidates.where("station_id IS NOT NULL").groupBy("station_id").agg(F.min(order).alias("m")).select("station_id", F.when(F.col("m.late"), "LABEL").otherwise("NODE").alias("source"), "m.node_id", "m.x", "m.y")


def spread_violations(assigned: DataFrame, limit: float, exempt: DataFrame | None = None) -> DataFrame:
    """JN-27: stations two of whose nodes (x, y) lie farther apart than the limit, or than their own limit in `exempt` (station_id, max_spread)."""
    b = farthest(assigned, "station_id")
    if exempt is None:
        return b.where(F.col("spread") > limit)
    return b.join(exempt, "station_id", "left").where(F.col("spread") > F.coalesce("max_spread", F.lit(limit))).select("station_id", "spread")


def reconcile_catalog(catalog: DataFrame, assigned: DataFrame, exceptions: DataFrame) -> DataFrame:
    """JN-28: station-lines only on one side: UNASSIGNED (catalog only), ORPHAN (assigned only), declared exceptions left out."""
    k = ["station_id", "line_id"]
    a, b = catalog.select(*k).distinct(), assigned.select(*k).distinct()
    d = a.join(b, k, "left_anti").withColumn("reason", F.lit("UNASSIGNED")).unionByName(b.join(a, k, "left_anti").withColumn("reason", F.lit("ORPHAN")))
    return d.join(exceptions.select(*k), k, "left_anti")


def positions_by_precedence(rows: DataFrame, official: DataFrame, maps: DataFrame) -> DataFrame:
    """JN-29: per (line_id, name): exact official position, then an official one of any line, then the map's, which is blocked where the
    line has an official position at all."""
    exact = official.select("line_id", "name", F.struct("x", "y").alias("exact"))
    any_line = official.groupBy("name").agg(F.min_by(F.struct("x", "y"), "line_id").alias("any_line"))
    m = maps.select("line_id", "name", F.struct("x", "y").alias("map"))
    covered = official.select("line_id").distinct().withColumn("line_is_official", F.lit(True))
    j = rows.join(exact, ["line_id", "name"], "left").join(any_line, "name", "left").join(m, ["line_id", "name"], "left").join(covered, "line_id", "left")
    usable = F.when(F.col("line_is_official").isNull(), F.col("map"))
    source = F.when(F.col("exact").isNotNull(), "OFFICIAL").when(F.col("any_line").isNotNull(), "OFFICIAL_OTHER_LINE").when(usable.isNotNull(), "MAP")
    p = F.coalesce("exact", "any_line", usable)
    return j.select("line_id", "name", p["x"].alias("x"), p["y"].alias("y"), source.alias("position_source"))


def gap_evidence(gaps: DataFrame, rows: DataFrame, scope: Column) -> DataFrame:
    """JN-32: each gap (gap_id, operator, line, name): OUT_OF_SCOPE, MATCHED or UNMATCHED by source rows, their number and hash."""
    k = ["operator", "line", "name"]
    r = rows.select(*k, row_hash(*rows.columns).alias("h"))
    j = gaps.join(r, k, "left").groupBy("gap_id", *k).agg(F.count("h").alias("n_rows"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("hash"))
    return j.select("gap_id", "n_rows", F.when(F.col("n_rows") > 0, F.col("hash")).alias("hash"), F.when(~scope, "OUT_OF_SCOPE").when(F.col("n_rows") > 0, "MATCHED").otherwise("UNMATCHED").alias("status"))


def coverage_declarations(declared: DataFrame, supported: DataFrame, keys: list[str]) -> DataFrame:
    """JN-33: declared keys twice, declared without a source, supported without being declared."""
    d, s = declared.select(*keys), supported.select(*keys).distinct()
    tag = lambda x, r: x.select(*keys, F.lit(r).alias("reason"))
    return tag(d.groupBy(*keys).count().where("count > 1"), "DUPLICATE").unionByName(tag(d.distinct().join(s, keys, "left_anti"), "UNSUPPORTED")).unionByName(tag(s.join(d, keys, "left_anti"), "MISSING"))


def scope_equality(sets: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """JN-34: members that one of the named sets has and another lacks: (keys, has, lacks)."""
    out = None
    for a, x in sets.items():
        for b, y in sets.items():
            if a != b:
                d = x.select(*keys).exceptAll(y.select(*keys)).withColumn("has", F.lit(a)).withColumn("lacks", F.lit(b))
                out = d if out is None else out.unionByName(d)
    return out
