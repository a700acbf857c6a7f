"""Edges and graphs: adjacency, audits, components, reachability, lineage."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railtable.checks import cut as _cut
from railtable.checks import violations
from railtable.operators.ordered import BLOCK, after, along, before, running, tiled


def _turns(rounds: int | None) -> Iterator[int]:
    """Counts without end; a bound that a loop meets before its fixed point is an error, never a shorter result."""
    yield from itertools.count() if rounds is None else range(rounds)
    raise RuntimeError(f"no fixed point after {rounds} rounds")


def adjacent_edges(stations: DataFrame, block: int = BLOCK) -> DataFrame:
    """WN-5: (line_id, station_id, seq) to edges between neighbours, in both directions. A line longer than `block` is walked in ranges."""
    one = along(stations.select("line_id", "station_id", "seq"), ["line_id"], ["seq", "station_id"], {"to_station": after("station_id")}, block)
    one = one.where("to_station IS NOT NULL").select("line_id", F.col("station_id").alias("from_station"), "to_station")
    return one.unionByName(one.select("line_id", F.col("to_station").alias("from_station"), F.col("from_station").alias("to_station")))


def edges_from_distances(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """WN-6: rows (line_id, seq, station_id, forward_m to the next, backward_m from the next, is_depot) to edges both ways;
    depots are set aside first; reason ASYMMETRIC where the two distances differ."""
    s = along(rows.where("NOT is_depot"), ["line_id"], ["seq"], {"next": after("station_id")}, block).where("next IS NOT NULL")
    way = lambda a, b, m: F.struct(F.col(a).alias("from_station"), F.col(b).alias("to_station"), F.col(m).alias("distance_m"))
    reason = F.when(F.col("forward_m") != F.col("backward_m"), "ASYMMETRIC")
    return s.select("line_id", F.explode(F.array(way("station_id", "next", "forward_m"), way("next", "station_id", "backward_m"))).alias("e"), reason.alias("reason")).select("line_id", "e.*", "reason")


def branch_segments(rows: DataFrame, operator: str | None = None, block: int = BLOCK) -> DataFrame:
    """WN-7: (line_id, pos, station_id): a new segment begins where a station already seen on the line appears again (a list that starts anew
    does so with its first station). With `operator`, a column, a segment also ends where it changes, and what was seen before that counts no more."""
    keys = ["line_id"]
    if operator:
        changed = lambda d: (F.col("_was").isNotNull() & ~F.col("_was.v").eqNullSafe(F.col(operator))).cast("int")
        rows = along(rows, keys, ["pos"], {"_was": before(F.struct(F.col(operator).alias("v")))}, block)
        rows = along(rows.withColumn("_border", changed(rows)), keys, ["pos"], {"_run": running("_border")}, block).drop("_was", "_border")
        keys = ["line_id", "_run"]
    def least(d: DataFrame, name: str, *by: str) -> DataFrame:
        """d with the smallest pos of the rows that are equal in `by`, nulls among them."""
        d = d.withColumn("_same", F.struct(*by))
        return d.join(d.groupBy("_same").agg(F.min("pos").alias(name)), "_same").drop("_same")

    marked = least(rows, "_first", *keys, "station_id")
    begins = (F.col("pos") > F.col("_first")).cast("int")
    if operator:
        marked = least(marked, "_head", *keys)
        begins = F.greatest(begins, (F.col("pos") == F.col("_head")).cast("int"))
    out = along(marked.withColumn("_again", begins), ["line_id"], ["pos"], {"segment": running("_again")}, block)
    out = out.withColumn("segment", F.col("segment").cast("long") - (1 if operator else 0))
    return out.drop("_first", "_again", "_head", "_run")


def segment_edges(segments: DataFrame, trailing: str | None = None, close: bool = False, block: int = BLOCK) -> DataFrame:
    """WN-7: edges between consecutive stations of one segment, with the second one's distance to the station before it; where that is not known (null; with
    `trailing` also 0 or less) the first one's `trailing` distance to its next station, if the list has such a column. Without a distance there is
    no edge. `close`: a segment of three or more also gets an edge from its last station to its first one, of the first one's own distance."""
    keys = ["line_id", "segment"]
    steps = {"to_station": after("station_id"), "to_distance": after("distance_m")}
    s = along(segments, keys, ["pos"], steps, block)
    known = lambda c: F.when(F.col(c) > 0, F.col(c))
    metres = F.coalesce(known("to_distance"), known(trailing)) if trailing else F.col("to_distance")
    out = s.where("to_station IS NOT NULL").select(*keys, F.col("station_id").alias("from_station"), "to_station", metres.alias("distance_m")).where("distance_m IS NOT NULL")
    if close:
        place = F.struct("pos", "station_id", "distance_m")
        ends = segments.groupBy(*keys).agg(F.count("*").alias("n"), F.min(place).alias("a"), F.max(place).alias("z")).where("n >= 3 AND a.distance_m > 0")
        out = out.unionByName(ends.select(*keys, F.col("z.station_id").alias("from_station"), F.col("a.station_id").alias("to_station"), F.col("a.distance_m").alias("distance_m")))
    return out


def splice_edges(rows: DataFrame, splices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """WN-7: explicit edges. splices: (line_id, from_station, to_station, anchor_station, use_trailing): an edge of the anchor's distance_m, or its
    trailing_m. Gives (edges: line_id, from_station, to_station, distance_m; violations: the splice and STATION_MISSING or DISTANCE_MISSING).
    Where a station stands several times on its line its first row (by pos) counts."""
    first = rows.groupBy("line_id", "station_id").agg(F.min_by(F.struct("distance_m", "trailing_m"), "pos").alias("r"))
    at = lambda name: first.select("line_id", F.col("station_id").alias(name), F.col("r").alias(f"_{name}"))
    s = splices
    for name in ("from_station", "to_station", "anchor_station"):
        s = s.join(at(name), ["line_id", name], "left")
    metres = F.when(F.col("use_trailing"), F.col("_anchor_station.trailing_m")).otherwise(F.col("_anchor_station.distance_m"))
    s = s.withColumn("distance_m", F.when(metres > 0, metres))
    names = ["line_id", "from_station", "to_station"]
    missing = F.col("_from_station").isNull() | F.col("_to_station").isNull()
    reason = F.when(missing, "STATION_MISSING").when(F.col("distance_m").isNull(), "DISTANCE_MISSING")
    return s.where(reason.isNull()).select(*names, "distance_m"), s.where(reason.isNotNull()).select(*names, reason.alias("reason"))


def undirected_upsert(edges: DataFrame) -> DataFrame:
    """WN-8: one row per unordered pair of a line: 0 is unknown and gives way to a positive distance; two different positives are a
    conflict; branch names are collected in order."""
    k = edges.select("line_id", F.least("from_station", "to_station").alias("a"), F.greatest("from_station", "to_station").alias("b"), F.nullif("distance_m", F.lit(0)).alias("d"), "branch")
    return k.groupBy("line_id", "a", "b").agg(F.coalesce(F.max("d"), F.lit(0)).alias("distance_m"), (F.count_distinct("d") > 1).alias("conflict"), F.array_join(F.array_sort(F.collect_set("branch")), ",").alias("branches"))


def both_ways(pairs: DataFrame) -> DataFrame:
    """WN-8: an undirected table back to directed edges."""
    return pairs.select("*", F.explode(F.array(F.struct(F.col("a").alias("from_station"), F.col("b").alias("to_station")), F.struct(F.col("b").alias("from_station"), F.col("a").alias("to_station")))).alias("e")).select("line_id", "e.*", "distance_m")


def direction_pairs(records: DataFrame) -> DataFrame:
    """WN-19: per station and unordered line pair the forward seconds, the reverse seconds and whether they differ. Repeats: the smallest."""
    one = records.groupBy("station_id", "from_line", "to_line").agg(F.min("seconds").alias("seconds"))
    back = one.select("station_id", F.col("to_line").alias("from_line"), F.col("from_line").alias("to_line"), F.col("seconds").alias("reverse_seconds"))
    j = one.join(back, ["station_id", "from_line", "to_line"], "left")
    return j.where("from_line < to_line OR reverse_seconds IS NULL").withColumnRenamed("seconds", "forward_seconds").withColumn("mismatch", F.coalesce(F.col("forward_seconds") != F.col("reverse_seconds"), F.lit(False)))


def insert_at(stations: DataFrame, line: str, at: int, new_id: int) -> DataFrame:
    """WN-20: puts a station into a line's sequence; later members move by one."""
    later = (F.col("line_id") == line) & (F.col("seq") >= at)
    new = stations.sparkSession.range(1).select(F.lit(line).alias("line_id"), F.lit(new_id).cast("long").alias("station_id"), F.lit(at).alias("seq"))
    return stations.select("line_id", F.col("station_id").cast("long").alias("station_id"), F.when(later, F.col("seq") + 1).otherwise(F.col("seq")).alias("seq")).unionByName(new)


def same_neighbours(old: DataFrame, new: DataFrame, block: int = BLOCK) -> DataFrame:
    """WN-21: stations (line_id, station_id, name, seq) of both versions: are the names before and after equal, in either direction?"""
    side = lambda d, p: along(d, ["line_id"], ["seq"], {f"{p}0": before("name"), f"{p}1": after("name")}, block).select("line_id", "station_id", f"{p}0", f"{p}1")
    j = side(old, "o").join(side(new, "n"), ["line_id", "station_id"])
    eq = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    return j.select("line_id", "station_id", ((eq("o0", "n0") & eq("o1", "n1")) | (eq("o0", "n1") & eq("o1", "n0"))).alias("same"))


def edge_audit(edges: DataFrame, positions: DataFrame, low: float = 15.0, high: float = 110.0) -> DataFrame:
    """GR-1: ride edges (edge_id, line_id, from_station, to_station, seconds, metres, pattern): speed outside low..high km/h; a LOCAL ride
    with an endpoint off its line or between stations not next to each other; an EXPRESS one between neighbours is noted as well."""
    side = lambda p: positions.select("line_id", F.col("station_id").alias(f"{p}_station"), F.col("seq").alias(f"{p}_seq"))
    e = edges.join(side("from"), ["line_id", "from_station"], "left").join(side("to"), ["line_id", "to_station"], "left")
    speed = F.col("metres") / F.col("seconds") * 3.6
    step = F.abs(F.col("from_seq") - F.col("to_seq"))
    return violations(e, {
        "SPEED_OUT_OF_RANGE": (F.col("seconds") > 0) & ~speed.between(low, high), "LOCAL_OFF_LINE": (F.col("pattern") == "LOCAL") & (F.col("from_seq").isNull() | F.col("to_seq").isNull()),
        "LOCAL_NOT_ADJACENT": (F.col("pattern") == "LOCAL") & (step != 1), "EXPRESS_ADJACENT": (F.col("pattern") == "EXPRESS") & (step == 1),
    }).select("edge_id", "reason")


def generated_transfers(station_lines: DataFrame) -> DataFrame:
    """GR-2: all ordered pairs of line nodes at one station, of lines with more than one station."""
    big = station_lines.select("line_id", "station_id").distinct().withColumn("n", F.count("*").over(Window.partitionBy("line_id"))).where("n > 1").drop("n")
    return big.alias("a").join(big.alias("b"), "station_id").where("a.line_id <> b.line_id").select("station_id", F.col("a.line_id").alias("from_line"), F.col("b.line_id").alias("to_line"))


def isolated_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """GR-3: nodes without an edge at either end."""
    ends = edges.select(F.explode(F.array("from_node", "to_node")).alias("node")).distinct()
    return nodes.select("node").distinct().join(ends, "node", "left_anti")


def reachable(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """GR-4: all (source, node) with a directed path, the source itself left out unless on a cycle. A frontier loop: each round extends the
    pairs found last by one edge and keeps the new ones; lineage is cut each round and only their number comes back."""
    e = edges.select("from_node", "to_node").distinct()
    seen = _cut(e.select(F.col("from_node").alias("source"), F.col("to_node").alias("node")))
    frontier = seen
    for _ in _turns(rounds):
        nxt = frontier.join(e, F.col("node") == F.col("from_node")).select("source", F.col("to_node").alias("node")).distinct().join(seen, ["source", "node"], "left_anti")
        frontier = _cut(nxt)
        if frontier.isEmpty():
            return seen
        seen = _cut(seen.unionByName(frontier))


def _strong(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, root) of nodes found to lie on a cycle with their root, and the edges (from_node, to_node) between roots, or nodes without one, that are left. Each turn takes the smallest node that leads to
    a node as its colour and finds what also leads back to it inside the colour: nodes that reach each other. A turn that leaves over half of the edges is the last, since what is left is as right, only less short."""
    left = _cut(edges.select("from_node", "to_node").where("from_node <> to_node").distinct())
    member, n = left.select(F.col("from_node").alias("node"), F.col("from_node").alias("root")).limit(0), left.count()
    while n:
        colour = _cut(left.select(F.explode(F.array("from_node", "to_node")).alias("node")).distinct().select("node", F.col("node").alias("colour")))
        while True:
            near = left.join(colour, F.col("from_node") == F.col("node")).groupBy("to_node").agg(F.min("colour").alias("c"))
            step = _cut(colour.join(near, F.col("node") == F.col("to_node"), "left").select("node", F.least("colour", F.coalesce("c", "colour")).alias("colour"), (F.col("c") < F.col("colour")).alias("new")))
            colour = step.select("node", "colour")
            if step.where("new").isEmpty():
                break
        inside = left
        for end, name in (("from_node", "a"), ("to_node", "b")):
            inside = inside.join(colour.select(F.col("node").alias(end), F.col("colour").alias(name)), end)
        inside = _cut(inside.where("a = b").select("from_node", "to_node", "a"))
        back = frontier = _cut(colour.where("node = colour"))
        while not frontier.isEmpty():
            into = inside.join(frontier.select(F.col("node").alias("to_node"), F.col("colour").alias("a")), ["to_node", "a"])
            frontier = _cut(into.select(F.col("from_node").alias("node"), F.col("a").alias("colour")).distinct().join(back, ["node", "colour"], "left_anti"))
            back = _cut(back.unionByName(frontier))
        found = back.where("node <> colour").select("node", F.col("colour").alias("root"))
        higher = found.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        member = _cut(member.join(higher, "root", "left").select("node", F.coalesce("_up", "root").alias("root")).unionByName(found))
        for end in ("from_node", "to_node"):
            left = left.join(found.select(F.col("node").alias(end), "root"), end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
        left = _cut(left.where("from_node <> to_node").distinct())
        now = left.count()
        if 2 * now > n:
            break
        n = now
    return member, left


def unreachable_pairs(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """GR-4: ordered pairs of different nodes without a path. The output can have n * n rows and is a table like any other, listed by as many tasks as it needs (`tiled`). Nodes that reach each
    other are one node for `reachable`; where its pairs are none, or a pair's source leads to no other or nothing leads to its node, nothing is looked up."""
    member, left = _strong(edges)
    paths = reachable(left).where("source <> node").select(F.col("source").alias("_from"), F.col("node").alias("_to"))
    at = nodes.select("node").distinct().join(member, "node", "left").select("node", F.coalesce("root", "node").alias("_c"))
    leads, led = (paths.select(F.col(c).alias("_c")).distinct().withColumn(name, F.lit(True)) for c, name in (("_from", "_leads"), ("_to", "_led")))
    at = _cut(at.join(leads, "_c", "left").join(led, "_c", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("_leads", "_led")}))
    n, leading, reached = at.agg(F.count("*"), F.count_if("_leads"), F.count_if("_led")).first()

    def apart(which_a: str, n_a: int, which_b: str, n_b: int) -> DataFrame:
        a, b = at.where(which_a).select(F.col("node").alias("source"), F.col("_c").alias("_from")), at.where(which_b).select("node", F.col("_c").alias("_to"))
        return tiled(a, b, n_a, n_b).where("_from <> _to")

    if not leading or not reached:
        return apart("true", n, "true", n).select("source", "node")
    asked = apart("_leads", leading, "_led", reached).join(paths, ["_from", "_to"], "left_anti")
    sure = apart("NOT _leads", n - leading, "true", n).unionByName(apart("_leads", leading, "NOT _led", n - reached))
    return sure.unionByName(asked).select("source", "node")


def components(edges: DataFrame, nodes: DataFrame, rounds: int | None = None) -> DataFrame:
    """GR-5: (node, component): the smallest node reachable, directions ignored. Labels spread to neighbours and then jump to their
    label's label, so long chains take few rounds."""
    both = edges.select("from_node", "to_node").unionByName(edges.select(F.col("to_node").alias("from_node"), F.col("from_node").alias("to_node"))).distinct()
    both = _cut(both)
    labels = _cut(nodes.select("node", F.col("node").alias("component")).distinct())
    for _ in _turns(rounds):
        near = both.join(labels, F.col("from_node") == F.col("node")).groupBy("to_node").agg(F.min("component").alias("c"))
        step = labels.join(near, F.col("node") == F.col("to_node"), "left").select("node", F.least("component", F.coalesce("c", "component")).alias("component"), F.col("component").alias("old"))
        up = step.select(F.col("node").alias("component"), F.col("component").alias("above"))
        nxt = _cut(step.join(up, "component", "left").select("node", F.least("component", F.coalesce("above", "component")).alias("component"), "old"))
        labels = nxt.select("node", "component")
        if nxt.where("component <> old").isEmpty():
            return labels


def service_edges(stops: DataFrame) -> DataFrame:
    """GR-6: distinct consecutive stops of all trips, each with whether its reverse is served too."""
    w = Window.partitionBy("trip_id").orderBy("stop_no")
    e = stops.select(F.col("station_id").alias("from_node"), F.lead("station_id").over(w).alias("to_node")).where("to_node IS NOT NULL AND to_node <> from_node").distinct()
    back = e.select(F.col("to_node").alias("from_node"), F.col("from_node").alias("to_node"), F.lit(True).alias("has_reverse"))
    return e.join(back, ["from_node", "to_node"], "left").withColumn("has_reverse", F.coalesce("has_reverse", F.lit(False)))


def corridor_steps(stops: DataFrame, corridor: DataFrame) -> DataFrame:
    """GR-6: each step between consecutive stops of a trip (trip_id, stop_no, station_id, line_id, direction up or down, seq as the trip states it) against the corridor (station_id, line_id,
    seq): (trip_id, stop_no of the first stop, reason), reason null for a step that agrees, else UNKNOWN_DIRECTION, NOT_ON_CORRIDOR, OTHER_SEQUENCE (a stated number is not the
    corridor's) or AGAINST_DIRECTION. A station that stands on the corridor more than once counts by its smallest number, on branches by line."""
    c = corridor.groupBy("station_id", "line_id").agg(F.min("seq").alias("_seq"))
    w = Window.partitionBy("trip_id").orderBy("stop_no")
    s = stops.join(c, ["station_id", "line_id"], "left").withColumns({"_next": F.lead("_seq").over(w), "_said": F.lead("seq").over(w), "_more": F.lead("stop_no").over(w).isNotNull()}).where("_more")
    on = F.col("_seq").isNotNull() & F.col("_next").isNotNull()
    right = F.when(F.col("direction") == "up", F.col("_seq") < F.col("_next")).otherwise(F.col("_seq") > F.col("_next"))
    agrees = F.col("seq").eqNullSafe(F.col("_seq")) & F.col("_said").eqNullSafe(F.col("_next"))
    reason = F.when(~F.coalesce(F.col("direction").isin("up", "down"), F.lit(False)), "UNKNOWN_DIRECTION").when(~on, "NOT_ON_CORRIDOR").when(~agrees, "OTHER_SEQUENCE").when(~right, "AGAINST_DIRECTION")
    return s.select("trip_id", "stop_no", reason.alias("reason"))


def corridor_agreement(steps: DataFrame) -> DataFrame:
    """GR-6: of `corridor_steps` per trip the steps, those that agree, and the longest run of agreeing ones.

    All are running numbers along a trip, so they take the steps' own order and the trip's last row has them: no hash table of trips or runs beside the sort."""
    w = Window.partitionBy("trip_id").orderBy("stop_no")
    good = F.col("reason").isNull().cast("int")
    along = steps.withColumns({"_steps": F.count("*").over(w), "_good": F.sum(good).over(w), "_last": F.lead(F.lit(True)).over(w).isNull()})
    along = along.withColumn("_here", F.sum(good).over(Window.partitionBy("trip_id", "stop_no")))
    # agreeing steps before the last one that does not
    gone = F.coalesce(F.max(F.when(F.col("reason").isNotNull(), F.col("_good") - F.col("_here"))).over(w), F.lit(0))
    along = along.withColumn("_run", F.col("_good") - gone).withColumn("_longest", F.max("_run").over(w))
    return along.where("_last").select("trip_id", F.col("_steps").alias("steps"), F.col("_good").alias("agreeing"), F.col("_longest").alias("longest"))


def expand_bidirectional(links: DataFrame, explicit: DataFrame) -> DataFrame:
    """GR-7: links, the swapped ones of those that are bidirectional, and explicit edges."""
    swapped = links.where("bidirectional").select(F.col("to_node").alias("from_node"), F.col("from_node").alias("to_node"))
    return links.select("from_node", "to_node").unionByName(swapped).unionByName(explicit.select("from_node", "to_node"))


def replace_edges(edges: DataFrame, line: str, new: DataFrame) -> DataFrame:
    """GR-8: the line's LOCAL rides go and the new ones come; all other edges stay."""
    gone = (F.col("line_id") == line) & (F.col("pattern") == "LOCAL")
    return edges.where(~F.coalesce(gone, F.lit(False))).unionByName(new)


def remap_ids(rows: DataFrame, id_map: DataFrame, *columns: str) -> DataFrame:
    """GR-9: rewrites each id column by the map (old_id, new_id); ids that are not in it stay."""
    for c in columns:
        m = id_map.select(F.col("old_id").alias(c), F.col("new_id").alias("_new"))
        rows = rows.join(m, c, "left").withColumn(c, F.coalesce("_new", c)).drop("_new")
    return rows


def remap_conflicts(id_map: DataFrame) -> DataFrame:
    """GR-9: old ids with two targets, or that are themselves a target."""
    two = id_map.groupBy("old_id").agg(F.count_distinct("new_id").alias("n")).where("n > 1").select("old_id", F.lit("TWO_TARGETS").alias("reason"))
    chained = id_map.join(id_map.select(F.col("new_id").alias("t")).distinct(), F.col("old_id") == F.col("t"), "left_semi").select("old_id", F.lit("IS_TARGET").alias("reason")).distinct()
    return two.unionByName(chained)


def merged_ids(id_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """GR-9: the closure of an id map (old_id, new_id): (resolved: old_id and the id that it ends at, however many merges lie between; refused: old_id, reason). An id with
    two targets is refused (TWO_TARGETS), and so are ids that lead into a cycle (CYCLE) and ids that lead to a refused one (LEADS_TO_REFUSED). Equal rows count once."""
    pairs = _cut(id_map.select("old_id", "new_id").where("old_id IS NOT NULL AND new_id IS NOT NULL").distinct())
    two = _cut(pairs.groupBy("old_id").agg(F.count("*").alias("n")).where("n > 1").select("old_id"))
    one = pairs.join(two, "old_id", "left_anti")
    found = ranked(one.select(F.col("old_id").alias("node"), F.col("new_id").alias("parent")))
    last = one.select(F.col("old_id").alias("top"), F.col("new_id").alias("end"))
    ends = _cut(found.join(last, "top", "left").join(two.select(F.col("old_id").alias("end"), F.lit(True).alias("_two")), "end", "left").select(F.col("node").alias("old_id"), F.col("end").alias("new_id"), F.col("top").isNull().alias("ring"), "_two"))
    reason = F.when(F.col("ring"), "CYCLE").when(F.col("_two"), "LEADS_TO_REFUSED")
    refused = two.select("old_id", F.lit("TWO_TARGETS").alias("reason")).unionByName(ends.where(reason.isNotNull()).select("old_id", reason.alias("reason")))
    return ends.where(reason.isNull()).select("old_id", "new_id"), refused


def rewrite_ids(tables: dict[str, DataFrame], resolved: DataFrame, ids: dict[str, list[str]], prefixed: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """GR-9: every table with its referencing columns rewritten: `ids` names columns that hold an id, `prefixed` those of the form id:rest, of which the id is. Other columns and rows
    stay as they are; no named column keeps a retired id. The map's old ids are unique, so no row is lost or doubled."""
    out = {}
    for name, rows in tables.items():
        for c in ids.get(name, []):
            rows = remap_ids(rows, resolved, c)
        for c in (prefixed or {}).get(name, []):
            m = resolved.select(F.col("old_id").cast("string").alias("_old"), F.col("new_id").cast("string").alias("_new"))
            head = F.substring_index(c, ":", 1)
            rows = rows.join(m, head == F.col("_old"), "left").withColumn(c, F.when(F.col("_new").isNotNull() & F.contains(c, F.lit(":")), F.concat("_new", F.expr(f"substr(`{c}`, length(_old) + 1)"))).otherwise(F.col(c))).drop("_old", "_new")
        out[name] = rows.select(*tables[name].columns)
    return out


def alias_rows(resolved: DataFrame, aliases: DataFrame) -> DataFrame:
    """GR-9: aliases (station_id, alias) after a merge: those of a retired id go to the one that it ends at, and its old id is kept as one more; none twice."""
    moved = remap_ids(aliases.select("station_id", "alias"), resolved, "station_id")
    return moved.unionByName(resolved.select(F.col("new_id").alias("station_id"), F.col("old_id").cast("string").alias("alias"))).distinct()


def lineage(snapshots: DataFrame) -> DataFrame:
    """GR-10: per source: violations of a lineage chain (an id twice, several roots, fork, unknown previous, time that does not increase). An id that several
    rows have is named once, as DUPLICATE_ID; for the rest its first row (by time) stands for it."""
    rows = snapshots.select("snapshot_id", "source_id", "previous_id", "retrieved_at")
    one = rows.groupBy("snapshot_id").agg(F.count("*").alias("n"), F.min(F.struct("retrieved_at", "source_id", "previous_id")).alias("r"))
    rows = one.select("snapshot_id", "r.source_id", "r.previous_id", "r.retrieved_at", "n")
    prev = rows.select(F.col("snapshot_id").alias("previous_id"), F.col("retrieved_at").alias("before"), F.col("source_id").alias("prev_source"))
    s = rows.join(prev, "previous_id", "left")
    children = rows.where("previous_id IS NOT NULL").groupBy("source_id", "previous_id").agg(F.count("*").alias("children"))
    roots = rows.groupBy("source_id").agg(F.count_if(F.col("previous_id").isNull()).alias("roots"))
    s = s.join(children, ["source_id", "previous_id"], "left").join(roots, "source_id", "left")
    return violations(s, {
        "DUPLICATE_ID": F.col("n") > 1, "SEVERAL_ROOTS": (F.col("roots") > 1) & F.col("previous_id").isNull(), "FORK": F.col("children") > 1,
        "UNKNOWN_PREVIOUS": F.col("previous_id").isNotNull() & F.col("prev_source").isNull(),
        "OTHER_SOURCE": F.col("prev_source") != F.col("source_id"), "TIME_NOT_INCREASING": F.col("before") >= F.col("retrieved_at"),
    }).select("source_id", "snapshot_id", "reason")


def ranked(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """Each node of a parent table (node, parent; a null parent, or one that is no node, ends a chain) with the end that it leads to and its distance:
    (node, top, distance), both null for nodes on a cycle or behind one. Pointer doubling: every open node takes over its pointer's pointer and adds the distances, so
    round k settles all nodes nearer than 2^k to their end. While an open node leads to an end, some open node is so near that the next round settles it; a round
    that settles none has met cycles alone and ends the loop. Node ids are unique."""
    known = links.select(F.col("node").alias("parent"), F.lit(True).alias("_is"))
    first = links.select("node", "parent").join(known, "parent", "left")
    up = F.when(F.col("_is"), F.col("parent")).otherwise(F.col("node"))
    state = _cut(first.select("node", up.alias("top"), F.col("_is").isNotNull().cast("long").alias("distance"), F.col("_is").isNotNull().alias("open")))
    left = state.where("open").count()
    for _ in _turns(rounds):
        if not left:
            break
        via = state.select(F.col("node").alias("top"), F.col("top").alias("_top"), F.col("distance").alias("_more"), F.col("open").alias("_open"))
        moved = state.where("open").join(via, "top").select("node", F.col("_top").alias("top"), (F.col("distance") + F.col("_more")).alias("distance"), F.col("_open").alias("open"))
        state = _cut(state.where("NOT open").unionByName(moved))
        now = state.where("open").count()
        if now == left:
            break
        left = now
    return state.select("node", F.when(~F.col("open"), F.col("top")).alias("top"), F.when(~F.col("open"), F.col("distance")).alias("distance"))


def lineage_chain(snapshots: DataFrame) -> DataFrame:
    """GR-10: the ordered chain: (source_id, snapshot_id, position, status). Position counts from the source's root, which has 0; status is ON_CHAIN, or
    DISCONNECTED (what it leads to has an unknown previous snapshot or one of another source; position null) or CYCLE. At a fork both branches have positions
    (`lineage` names the fork). Rows of an id that comes twice give one row."""
    one = snapshots.groupBy("snapshot_id").agg(F.min(F.struct("retrieved_at", "source_id", "previous_id")).alias("r")).select("snapshot_id", "r.source_id", "r.previous_id")
    owner = one.select(F.col("snapshot_id").alias("previous_id"), F.col("source_id").alias("_owner"))
    linked = one.join(owner, "previous_id", "left").select("snapshot_id", "source_id", F.col("previous_id").isNull().alias("root"), F.when(F.col("_owner") == F.col("source_id"), F.col("previous_id")).alias("parent"))
    linked = _cut(linked)
    found = ranked(linked.select(F.col("snapshot_id").alias("node"), "parent"))
    tops = linked.where("root").select(F.col("snapshot_id").alias("top"), F.lit(True).alias("_root"))
    out = linked.join(found, F.col("snapshot_id") == F.col("node")).join(tops, "top", "left")
    status = F.when(F.col("top").isNull(), "CYCLE").when(F.col("_root"), "ON_CHAIN").otherwise("DISCONNECTED")
    return out.select("source_id", "snapshot_id", F.when(F.col("_root"), F.col("distance")).alias("position"), status.alias("status"))


def sources_without_root(snapshots: DataFrame) -> DataFrame:
    """GR-10: sources of which no snapshot is without a previous one."""
    return snapshots.groupBy("source_id").agg(F.count_if(F.col("previous_id").isNull()).alias("roots")).where("roots = 0").select("source_id")


def stored_diffs(changes: DataFrame, snapshots: DataFrame, stored: DataFrame) -> DataFrame:
    """GR-10: stored diffs (snapshot_id and DQ-5's columns) against the ones worked out (`changes`): DIFF_MISSING where a snapshot with a previous one has none,
    DIFF_DIFFERS, ROOT_HAS_DIFF where one without a previous snapshot has one."""
    values = [c for c in changes.columns if c != "snapshot_id"]
    s = stored.select("snapshot_id", F.struct(*values).alias("_stored"))
    made = changes.select("snapshot_id", F.struct(*values).alias("_made")).join(s, "snapshot_id", "left")
    bad = violations(made, {"DIFF_MISSING": F.col("_stored").isNull(), "DIFF_DIFFERS": F.col("_stored") != F.col("_made")}).select("snapshot_id", "reason")
    roots = snapshots.where("previous_id IS NULL").select("snapshot_id").join(s, "snapshot_id").select("snapshot_id", F.lit("ROOT_HAS_DIFF").alias("reason"))
    return bad.unionByName(roots)


def lineage_heads(snapshots: DataFrame) -> DataFrame:
    """GR-10: snapshots that no other names as its previous one."""
    return snapshots.join(snapshots.select(F.col("previous_id").alias("p")).where("p IS NOT NULL").distinct(), F.col("snapshot_id") == F.col("p"), "left_anti").select("source_id", "snapshot_id")


def ancestors(snapshots: DataFrame, used: DataFrame, rounds: int | None = None) -> DataFrame:
    """GR-11: the used snapshots and all that lead to them. Links are joined with themselves, so round k reaches 2^k links back and
    rounds grow with the logarithm of the longest chain; a round that finds nothing new ends it, also on a cycle."""
    links = _cut(snapshots.select("snapshot_id", "previous_id").where("previous_id IS NOT NULL").distinct())
    seen = _cut(used.select("snapshot_id").distinct())
    for _ in _turns(rounds):
        new = _cut(seen.join(links, "snapshot_id").select(F.col("previous_id").alias("snapshot_id")).distinct().join(seen, "snapshot_id", "left_anti"))
        if new.isEmpty():
            return seen
        seen = _cut(seen.unionByName(new))
        far = links.select(F.col("snapshot_id").alias("previous_id"), F.col("previous_id").alias("far"))
        links = _cut(links.join(far, "previous_id").select("snapshot_id", F.col("far").alias("previous_id")).distinct())


def node_degrees(edges: DataFrame, limit: int = 8) -> DataFrame:
    """GR-12: degree of each node over undirected edges, and whether it is above the limit."""
    return edges.select(F.explode(F.array("from_node", "to_node")).alias("node")).groupBy("node").agg(F.count("*").alias("degree")).withColumn("over", F.col("degree") > limit)


def physical_graph(positions: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """GR-13: nodes at the mean of their line positions; one undirected edge per adjacent pair with the lines on it."""
    nodes = positions.groupBy("station_id").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    e = adjacent_edges(positions, block).where("from_station < to_station")
    return nodes, e.groupBy("from_station", "to_station").agg(F.array_join(F.array_sort(F.collect_set("line_id")), ",").alias("lines"))
