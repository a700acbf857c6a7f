"""Timetables: trips and stop times from rows, headways, segment times, calendars."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railtable.checks import violations

DAY = 86_400


def headways(departures: DataFrame) -> DataFrame:
    """AG-3: distinct departures per (line_id, direction, station_id, stop_line) without pickup_type 1 and frequency trips;
    groups of two or more with their number, smallest and largest gap."""
    keys = ["line_id", "direction", "station_id", "stop_line"]
    rows = departures.where("coalesce(pickup_type, 0) <> 1 AND NOT coalesce(by_frequency, false)").select(*keys, "seconds").distinct()
    gaps = rows.withColumn("gap", F.col("seconds") - F.lag("seconds").over(Window.partitionBy(*keys).orderBy("seconds")))
    return gaps.groupBy(*keys).agg(F.count("*").alias("departures"), F.min("gap").alias("min_headway"), F.max("gap").alias("max_headway")).where("departures >= 2")


def segment_times(stops: DataFrame) -> DataFrame:
    """AG-16: next arrival minus departure for adjacent stops of a trip, positives only: rounded median and sample size per
    (from_station, to_station, line_id). Stops need trip_id, stop_no, station_id, line_id, arrival, departure."""
    w = Window.partitionBy("trip_id").orderBy("stop_no")
    s = stops.select("line_id", F.col("station_id").alias("from_station"), F.lead("station_id").over(w).alias("to_station"), (F.lead("arrival").over(w) - F.col("departure")).alias("seconds"))
    return s.where("seconds > 0").groupBy("from_station", "to_station", "line_id").agg(F.floor(F.median("seconds") + 0.5).cast("long").alias("median_seconds"), F.count("*").alias("samples"))


def reconstruct_trips(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """WN-1: rows (line_id, train_no, day, station_id, seq, time) to trips (direction by the first and last sequence, headsign
    the last station, number of stops) and stop times numbered from 1 in the order of time, then sequence."""
    key = ["line_id", "train_no", "day"]
    w = Window.partitionBy(*key).orderBy("time", "seq", "station_id")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stops = rows.withColumn("stop_no", F.row_number().over(w))
    # one sort serves all columns and the first row stands for its trip: no hash table of trips beside it
    ends = {"s0": F.first("seq", ignorenulls=False).over(whole), "s1": F.last("seq", ignorenulls=False).over(whole), "headsign": F.last("station_id", ignorenulls=False).over(whole), "stops": F.count("*").over(whole)}
    trips = stops.withColumns(ends).where("stop_no = 1")
    return trips.select(*key, F.when(F.col("s1") >= F.col("s0"), "UP").otherwise("DOWN").alias("direction"), "headsign", "stops"), stops.select(*key, "station_id", "time", "stop_no")


def direction_violations(rows: DataFrame) -> DataFrame:
    """WN-2: per trip, deltas of consecutive sequences are never 0 and keep one sign, and the pattern is one; one row per reason."""
    w = Window.partitionBy("trip_id").orderBy("stop_no")
    d = rows.withColumn("delta", F.signum(F.col("seq") - F.lag("seq").over(w)))
    trips = d.groupBy("trip_id").agg(F.min("delta").alias("lo"), F.max("delta").alias("hi"), F.max((F.col("delta") == 0).cast("int")).alias("zero"), (F.min("pattern") != F.max("pattern")).alias("mixed"))
    return violations(trips, {"REPEATED_SEQUENCE": F.col("zero") == 1, "MIXED_DIRECTION": (F.col("lo") < 0) & (F.col("hi") > 0), "MIXED_PATTERN": F.col("mixed")}).select("trip_id", "reason")


def sequence_wrap_violations(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """WN-3: as WN-2, but a loop line (lines: line_id, lo, hi, stations >= 4) may step once between its smallest and largest
    sequence; a change of line starts anew. Returns trips that break it. A fold over each trip's sorted stops."""
    s = rows.join(lines, "line_id").groupBy("trip_id").agg(F.sort_array(F.collect_list(F.struct("stop_no", "line_id", "seq", "lo", "hi", "stations"))).alias("s"))
    start = F.struct(F.lit(None).cast("string").alias("line"), F.lit(None).cast("int").alias("seq"), F.lit(0).alias("sign"), F.lit(0).alias("wraps"), F.lit(False).alias("bad"))

    def step(a, x):
        same = a["line"].eqNullSafe(x["line_id"])
        wrap = same & (x["stations"] >= 4) & (((a["seq"] == x["hi"]) & (x["seq"] == x["lo"])) | ((a["seq"] == x["lo"]) & (x["seq"] == x["hi"])))
        sign = F.when(~same | wrap, F.when(~same, 0).otherwise(a["sign"])).otherwise(F.signum(x["seq"] - a["seq"]).cast("int"))
        wraps = F.when(same, a["wraps"] + wrap.cast("int")).otherwise(0)
        turned = same & ~wrap & ((sign == 0) | ((a["sign"] != 0) & (sign != a["sign"])))
        return F.struct(x["line_id"].alias("line"), x["seq"].cast("int").alias("seq"), sign.cast("int").alias("sign"), wraps.cast("int").alias("wraps"), (a["bad"] | turned | (wraps > 1)).alias("bad"))

    return s.select("trip_id", F.aggregate("s", start, step, lambda a: a["bad"]).alias("bad")).where("bad").select("trip_id")


def stop_time_violations(stops: DataFrame, limit: int = 108_000) -> DataFrame:
    """WN-4: stop numbers contiguous from 1, arrival <= departure <= next arrival, times within the service day."""
    w = Window.partitionBy("trip_id").orderBy("stop_no", "station_id")
    s = stops.select("*", F.row_number().over(w).alias("rank"), F.lag("departure").over(w).alias("before"))
    return violations(s, {
        "NOT_CONTIGUOUS": F.col("rank") != F.col("stop_no"), "DEPARTS_BEFORE_ARRIVAL": F.col("departure") < F.col("arrival"),
        "ARRIVES_BEFORE_PREVIOUS": F.col("arrival") < F.col("before"), "OUT_OF_DAY": (F.col("arrival") < 0) | (F.col("departure") >= limit),
    }).select("trip_id", "stop_no", "station_id", "reason")


def stop_row_violations(stops: DataFrame, trips: DataFrame) -> DataFrame:
    """WN-4: what no single trip's times show: (trip_id, stop_no, reason) of stop rows (trip_id, stop_no, pickup_type, drop_off_type) against trips (trip_id, pattern): a key
    twice, a trip that is not there, a number below 1, a pickup or drop-off type other than 0 or 1 (null is 0), an EXPRESS stop that is passed through in one of
    the two only (the first may refuse drop-offs, the last pickups), and trips without a stop (stop_no null)."""
    null = lambda c: F.lit(None).cast(dict(stops.dtypes)[c]).alias(c)
    named = ["stop_no", "pickup_type", "drop_off_type"]
    listed = trips.select("trip_id", *map(null, named), "pattern", F.lit(True).alias("listed"))
    both = stops.select("trip_id", *named, F.lit(None).cast(dict(trips.dtypes)["pattern"]).alias("pattern"), F.lit(False).alias("listed")).unionByName(listed)
    # a trip's rows of both tables meet in one exchange, and one sort serves both windows
    trip = Window.partitionBy("trip_id").orderBy("stop_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stop = F.when(~F.col("listed"), 1)
    rows = both.withColumns({"first": F.min("stop_no").over(trip), "last": F.max("stop_no").over(trip), "pattern": F.min("pattern").over(trip), "known": F.max("listed").over(trip) & F.col("trip_id").isNotNull(), "stops": F.count(stop).over(trip)})
    rows = rows.withColumn("n", F.count(stop).over(Window.partitionBy("trip_id", "stop_no")))
    pick, drop = F.coalesce("pickup_type", F.lit(0)), F.coalesce("drop_off_type", F.lit(0))
    terminal = ((F.col("stop_no") == F.col("first")) & (pick == 0) & (drop == 1)) | ((F.col("stop_no") == F.col("last")) & (pick == 1) & (drop == 0))
    of_stops = {
        "DUPLICATE_KEY": F.col("n") > 1, "UNKNOWN_TRIP": ~F.col("known"), "STOP_NO_BELOW_1": F.col("stop_no") < 1, "BAD_PICKUP_TYPE": ~pick.isin(0, 1), "BAD_DROP_OFF_TYPE": ~drop.isin(0, 1),
        "EXPRESS_PASS_THROUGH": F.col("known") & (F.col("pattern") == "EXPRESS") & (pick != drop) & ~terminal,
    }
    rules = {name: ~F.col("listed") & cond for name, cond in of_stops.items()} | {"TRIP_WITHOUT_STOPS": F.col("listed") & ((F.col("stops") == 0) | F.col("trip_id").isNull())}
    return violations(rows, rules).select("trip_id", "stop_no", "reason").distinct()


def terminal_violations(stops: DataFrame) -> DataFrame:
    """WN-2: stops (trip_id, stop_no, role) of role ORIGIN that are not their trip's first, and of role TERMINAL that are not its last."""
    ends = stops.groupBy("trip_id").agg(F.min("stop_no").alias("first"), F.max("stop_no").alias("last"))
    return violations(stops.join(ends, "trip_id"), {
        "ORIGIN_NOT_FIRST": (F.col("role") == "ORIGIN") & (F.col("stop_no") != F.col("first")), "TERMINAL_NOT_LAST": (F.col("role") == "TERMINAL") & (F.col("stop_no") != F.col("last")),
    }).select("trip_id", "stop_no", "reason")


def midnight_rollover(stops: DataFrame, time: str = "departure") -> DataFrame:
    """WN-9: adds a day after each decrease of the raw clock along a trip. Exact while raw times are under 24:00:00."""
    w = Window.partitionBy("trip_id").orderBy("stop_no")
    fell = F.coalesce((F.col(time) < F.lag(time).over(w)).cast("int"), F.lit(0))
    return stops.withColumn("_fell", fell).withColumn("service_seconds", F.col(time) + F.sum("_fell").over(w.rowsBetween(Window.unboundedPreceding, 0)) * DAY).drop("_fell")


def wide_to_stops(wide: DataFrame, trains: list[str]) -> DataFrame:
    """WN-10: one column per train to (train, station_id, seq, arrival, departure): the smallest and largest of a station's
    times; `gap` marks stops whose previous station with a time is not the one before."""
    long = wide.select("station_id", "seq", F.expr("stack(%d, %s) AS (train, time)" % (len(trains), ", ".join(f"'{t}', `{t}`" for t in trains)))).where("time IS NOT NULL")
    s = long.groupBy("train", "station_id", "seq").agg(F.min("time").alias("arrival"), F.max("time").alias("departure"))
    return s.withColumn("gap", F.coalesce(F.col("seq") - F.lag("seq").over(Window.partitionBy("train").orderBy("seq")) > 1, F.lit(False)))


def adjacency_violations(stops: DataFrame, topology: DataFrame) -> DataFrame:
    """WN-11: consecutive stop pairs of trips that the topology (from_station, to_station) does not have."""
    w = Window.partitionBy("trip_id").orderBy("stop_no")
    pairs = stops.select("trip_id", "stop_no", F.col("station_id").alias("from_station"), F.lead("station_id").over(w).alias("to_station")).where("to_station IS NOT NULL")
    return pairs.join(topology.select("from_station", "to_station").distinct(), ["from_station", "to_station"], "left_anti")


class _Open:
    """The departures of one station, by time, of which the taken ones are skipped (the next open one is found by path halving)."""

    def __init__(self, times: list[int], rows: list[int]):
        self.times, self.rows = times, rows
        self.up, self.down = list(range(len(rows) + 1)), list(range(len(rows) + 1))

    @staticmethod
    def _find(link: list[int], k: int) -> int:
        while link[k] != k:
            link[k] = link[link[k]]
            k = link[k]
        return k

    def after(self, k: int) -> int:
        """The first open place at or behind k; the number of places if there is none."""
        return self._find(self.up, k)

    def before(self, k: int) -> int:
        """The last open place before k, or -1."""
        return self._find(self.down, k) - 1

    def take(self, k: int) -> int:
        self.up[k], self.down[k + 1] = k + 1, k
        return self.rows[k]

    def within(self, low: int, high: int) -> tuple[int, int]:
        """The first open place with a time of low to high, and how many there are (2: two or more); (-1, 0) without one."""
        k = self.after(bisect_left(self.times, low))
        if k == len(self.times) or self.times[k] > high:
            return -1, 0
        more = self.after(k + 1)
        return k, 2 if more < len(self.times) and self.times[more] <= high else 1

    def nearest(self, at: int, reach: int) -> tuple[int, int]:
        """The open place nearest to a time (the earlier one of two, then the first), at most `reach` off, and how many lie in reach."""
        first, n = self.within(at - reach, at + reach)
        if first < 0:
            return -1, 0
        hi = self.after(bisect_left(self.times, at))
        lo = self.before(bisect_left(self.times, at))
        if hi < len(self.times) and (lo < 0 or self.times[hi] - at < at - self.times[lo]):
            return hi, n
        while self.before(lo) >= 0 and self.times[self.before(lo)] == self.times[lo]:
            lo = self.before(lo)
        return lo, n


def _chain(seqs: list[int], secs: list[int], ids: list[int], ends: list[str], pick: Callable[[_Open, int, int], tuple[int, int]], skip: Callable[[_Open, int, int], tuple[int, int]] | None = None) -> tuple[list[int], list[int], list[bool]]:
    """Of one group's departures, sorted by station, time and id: the trip of each, how many choices there had been by then, and whether it was reached past a missing station.
    Links each open trip to a departure at the next station, station by station in order of time: pick(open departures, seconds,
    station number) gives a place and how many were eligible. Where it finds none, skip() may try the station after next.
    A look-up is a binary search."""
    listed: dict[tuple, tuple[list[int], list[int]]] = {}
    for i, (q, t, d) in enumerate(zip(seqs, secs, ends, strict=True)):
        times, at = listed.setdefault((q, d), ([], []))
        times.append(t)
        at.append(i)
    ready = {k: _Open(*v) for k, v in listed.items()}
    trip, choices, repaired = [-1] * len(ids), 0, [False] * len(ids)
    for i, (q, t, d) in enumerate(zip(seqs, secs, ends, strict=True)):
        if trip[i] < 0:
            trip[i] = ids[i]
        there, k, n = ready.get((q + 1, d)), -1, 0
        if there:
            k, n = pick(there, t, q)
        choices += n > 1
        far = k < 0 and n == 0 and skip is not None
        if far and (there := ready.get((q + 2, d))):
            k, n = skip(there, t, q)
        if k >= 0:
            j = there.take(k)
            trip[j], repaired[j] = trip[i], far
    return trip, [choices] * len(ids), repaired


CHAINED = "grp string, event_id long, seq int, seconds int, trip_id long, choices long, repaired boolean"


def _chained(events: DataFrame, pick: Callable, skip: Callable | None = None) -> DataFrame:
    """Groups stand one after another in sorted partitions; a task holds one group at a time, however many small ones it works off."""
    end = F.col("destination").cast("string") if "destination" in events.columns else F.lit("")
    rows = events.select("grp", F.col("seq").cast("int").alias("seq"), F.col("seconds").cast("int").alias("seconds"), F.col("event_id").cast("long").alias("event_id"), F.coalesce(end, F.lit("")).alias("destination"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(5)]

        def close(n: int) -> pa.RecordBatch:
            """The first n held rows, which are whole groups."""
            grp, seqs, secs, ids, ends = (c[:n] for c in held)
            out: list[list] = [[], [], []]
            i = 0
            for _, own in groupby(grp):
                j = i + sum(1 for _ in own)
                for to, got in zip(out, _chain(seqs[i:j], secs[i:j], ids[i:j], ends[i:j], pick, skip), strict=True):
                    to += got
                i = j
            for c in held:
                del c[:n]
            types = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((grp, ids, seqs, secs, *out), types, strict=True)], names=["grp", "event_id", "seq", "seconds", "trip_id", "choices", "repaired"])

        for batch in batches:
            for c, new in zip(held, batch.columns, strict=True):
                c += new.to_pylist()
            whole = len(held[0])
            while whole and held[0][whole - 1] == held[0][-1]:  # the last group may go on
                whole -= 1
            if whole:
                yield close(whole)
        if held[0]:
            yield close(len(held[0]))

    return rows.repartition("grp").sortWithinPartitions("grp", "seq", "seconds", "event_id").mapInArrow(run, CHAINED)


def chain_departures(events: DataFrame, low: int = 60, high: int = 300) -> DataFrame:
    """WN-12: per group (service day, line and direction), each departure joins the trip whose last one, at the station before and with the
    same destination (if there is such a column), left low to high seconds earlier, if exactly one is open to it; unmatched departures start
    trips. `choices` counts how often several were eligible. Greedy with a used set, one group at a time, whose
    size the timetable of a day bounds; n log n in it."""

    def only(there: _Open, t: int, _: int) -> tuple[int, int]:
        k, n = there.within(t + low, t + high)
        return (k if n == 1 else -1), n

    return _chained(events, only)


def last_stops(chained: DataFrame, durations: DataFrame) -> DataFrame:
    """WN-12: the stop behind each trip's last departure: its time plus the topology's seconds from that station (seq, seconds) to the next."""
    last = chained.groupBy("grp", "trip_id").agg(F.max(F.struct("seq", "seconds")).alias("l")).select("grp", "trip_id", "l.seq", "l.seconds")
    return last.join(durations.select("seq", F.col("seconds").alias("ride")), "seq").select("grp", "trip_id", (F.col("seq") + 1).alias("seq"), (F.col("seconds") + F.col("ride")).alias("seconds"))


def chain_nearest(events: DataFrame, within: int = 120, expected: int = 180) -> DataFrame:
    """WN-13: as WN-12 with the departure nearest to the expected time, at most `within` seconds off. Where none is open at the next
    station, one at the station after next, twice the expected time later, continues the trip (`repaired`: one station is missing)."""
    return _chained(events, lambda there, t, _: there.nearest(t + expected, within), lambda there, t, _: there.nearest(t + 2 * expected, within))


def leftovers(chained: DataFrame) -> DataFrame:
    """WN-13: departures that no other one continues or precedes, for quarantine."""
    n = F.count("*").over(Window.partitionBy("grp", "trip_id"))
    return chained.withColumn("_n", n).where("_n = 1").drop("_n")


def accounting(events: DataFrame, chained: DataFrame) -> DataFrame:
    """WN-13: per group the departures read, those in trips and those left over; `balanced` where the last two make up the first."""
    left = leftovers(chained).groupBy("grp").agg(F.count("*").alias("left_over"))
    j = events.groupBy("grp").agg(F.count("*").alias("read")).join(chained.groupBy("grp").agg(F.count("*").alias("out")), "grp", "left").join(left, "grp", "left").na.fill(0, ["out", "left_over"])
    return j.select("grp", "read", (F.col("out") - F.col("left_over")).alias("in_trips"), "left_over", (F.col("read") == F.col("out")).alias("balanced"))


def stop_patterns(stops: DataFrame) -> DataFrame:
    """WN-22: per trip its ordered stations as text, their hash, and how many stations."""
    s = stops.groupBy("trip_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("stop_no", "station_id"))), lambda x: x["station_id"].cast("string")).alias("s"))
    return s.select("trip_id", F.array_join("s", ">").alias("pattern"), F.sha2(F.array_join("s", ">"), 256).alias("pattern_hash"), F.size("s").cast("long").alias("stops"))


def passed_through(stops: DataFrame, corridor: DataFrame) -> DataFrame:
    """WN-22: stations of the corridor (station_id, whole-numbered seq) between a trip's first and last one where it does not stop.
    The numbers between are listed by trip, so the corridor is found by equality."""
    at = stops.join(corridor, "station_id").select("trip_id", "seq").distinct()
    ends = at.groupBy("trip_id").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    inside = ends.select("trip_id", F.explode(F.sequence("lo", "hi")).alias("seq")).join(corridor, "seq").select("trip_id", "station_id", "seq")
    return inside.join(at, ["trip_id", "seq"], "left_anti").select("trip_id", "station_id")


def run_lines(stops: DataFrame, preferred: str) -> DataFrame:
    """WN-24: the line of each trip: memberships (line_ids array) of all its stops intersected; the preferred line, else the only
    one, else null with a reason."""
    lists = stops.groupBy("trip_id").agg(F.collect_set("line_ids").alias("l"))
    common = lists.select("trip_id", F.array_sort(F.aggregate(F.slice("l", 2, 1_000_000), F.get("l", F.lit(0)), lambda a, b: F.array_intersect(a, b))).alias("common"))
    line = F.when(F.array_contains("common", preferred), F.lit(preferred)).when(F.size("common") == 1, F.get("common", F.lit(0)))
    return common.select("trip_id", line.alias("line_id"), F.when(line.isNull(), F.when(F.size("common") == 0, "NO_COMMON_LINE").otherwise("SEVERAL_LINES")).alias("reason"))


def trips_from_pairs(pairs: DataFrame) -> DataFrame:
    """WN-26: stop times from OD rows (train, origin, origin_seq, departs, destination, destination_seq, arrives): each train's
    stops in the direction of travel (by falling sequence where destinations lie below origins) with one arrival and one departure, and flags: times_agree,
    all_pairs (n(n-1)/2 present). `pair_violations` says what is wrong with a train."""
    ends = pairs.select("train", F.explode(F.array(
        F.struct(F.col("origin").alias("station"), F.col("origin_seq").alias("seq"), F.lit(None).cast("long").alias("a"), F.col("departs").cast("long").alias("d")),
        F.struct(F.col("destination").alias("station"), F.col("destination_seq").alias("seq"), F.col("arrives").cast("long").alias("a"), F.lit(None).cast("long").alias("d")),
    )).alias("e")).select("train", "e.*")
    stops = ends.groupBy("train", "station", "seq").agg(F.min("a").alias("arrival"), F.min("d").alias("departure"), (F.min("a").eqNullSafe(F.max("a")) & F.min("d").eqNullSafe(F.max("d"))).alias("times_agree"))
    n = stops.groupBy("train").agg(F.count("*").alias("n"))
    have = pairs.select("train", "origin", "destination").distinct().groupBy("train").agg(F.count("*").alias("pairs"))
    full = n.join(have, "train").select("train", (F.col("pairs") == F.col("n") * (F.col("n") - 1) / 2).alias("all_pairs"))
    way = pairs.groupBy("train").agg(F.when(F.max("destination_seq") - F.max("origin_seq") < 0, -1).otherwise(1).alias("_way"))
    placed = stops.join(full, "train").join(way, "train")
    return placed.withColumn("stop_no", F.row_number().over(Window.partitionBy("train").orderBy(F.col("seq") * F.col("_way"), "station"))).drop("_way")


def pair_violations(pairs: DataFrame) -> DataFrame:
    """WN-26: (train, reason) for OD rows that make no trip: MIXED_DIRECTION (sequences rise in some pairs and fall in others, or stand still), PAIR_TWICE, PAIRS_MISSING (not every
    ordered pair of its stops in the direction of travel is there), TIMES_DISAGREE (a stop has two arrivals or two departures), SEVERAL_SEQUENCES (a station has two) and
    TIMES_NOT_INCREASING (an arrival not behind the departure before it, or a departure ahead of its arrival)."""
    way = F.signum(F.col("destination_seq") - F.col("origin_seq"))
    trains = pairs.groupBy("train").agg(F.min(way).alias("lo"), F.max(way).alias("hi"), F.count("*").alias("rows"), F.count_distinct("origin", "destination").alias("pairs"))
    stops = trips_from_pairs(pairs)
    w = Window.partitionBy("train").orderBy("stop_no")
    late = (F.col("arrival") <= F.lag("departure").over(w)) | (F.col("departure") < F.col("arrival"))
    found = stops.withColumn("late", F.coalesce(late, F.lit(False))).groupBy("train").agg(F.bool_and("times_agree").alias("agree"), F.bool_and("all_pairs").alias("all_pairs"), F.bool_or("late").alias("late"), F.count("*").alias("stops"), F.count_distinct("station").alias("stations"))
    return violations(trains.join(found, "train"), {
        "MIXED_DIRECTION": (F.col("lo") != F.col("hi")) | (F.col("lo") == 0), "PAIR_TWICE": F.col("rows") > F.col("pairs"), "PAIRS_MISSING": ~F.col("all_pairs"), "TIMES_DISAGREE": ~F.col("agree"),
        "SEVERAL_SEQUENCES": F.col("stops") > F.col("stations"), "TIMES_NOT_INCREASING": F.col("late"),
    }).select("train", "reason")


def trips_from_arrays(trips: DataFrame) -> DataFrame:
    """WN-27: (trip_id, stops array of station, time) to numbered stop times with first and last flags."""
    return trips.select("trip_id", F.size("stops").alias("n"), F.posexplode("stops").alias("i", "s")).select(
        "trip_id", (F.col("i") + 1).alias("stop_no"), "s.station", "s.time", (F.col("i") == 0).alias("is_first"), (F.col("i") == F.col("n") - 1).alias("is_last")
    )


def ride_consistency(segments: DataFrame, edges: DataFrame, seconds: int = 60, share: float = 0.25) -> DataFrame:
    """JN-10: full outer join on (from, to, line): MATCHED, VIOLATION (over `seconds` and over `share` of the edge), EDGE_ONLY, TIMETABLE_ONLY."""
    k = ["from_station", "to_station", "line_id"]
    both = segments.join(edges, k, "full_outer")
    off = F.abs(F.col("median_seconds") - F.col("duration_seconds"))
    status = F.when(F.col("median_seconds").isNull(), "EDGE_ONLY").when(F.col("duration_seconds").isNull(), "TIMETABLE_ONLY").when((off > seconds) & (off > F.col("duration_seconds") * share), "VIOLATION").otherwise("MATCHED")
    return both.select(*k, "median_seconds", "duration_seconds", status.alias("status"))


def attach_fares(stops: DataFrame, quotes: DataFrame) -> DataFrame:
    """JN-11: (trip, quote) where the quote's origin precedes its destination in the trip; the first stop at each station counts. A trip's own pairs look up
    their quotes, so a quote does not meet all trips through its origin."""
    first = stops.groupBy("trip_id", "station_id").agg(F.min("stop_no").alias("no"))
    o = first.select("trip_id", F.col("station_id").alias("origin"), F.col("no").alias("o_no"))
    d = first.select("trip_id", F.col("station_id").alias("destination"), F.col("no").alias("d_no"))
    return o.join(d, "trip_id").where("d_no > o_no").join(quotes, ["origin", "destination"]).select("trip_id", "origin", "destination", "fare")


def endpoint_conflicts(itineraries: DataFrame, stops: DataFrame) -> DataFrame:
    """JN-12: itineraries whose origin or destination does not occur exactly once in the trip at the stated time."""
    at = stops.groupBy("trip_id", "station_id").agg(F.count("*").alias("n"), F.min("departure").alias("t"))
    side = lambda p: at.select("trip_id", F.col("station_id").alias(p), F.col("n").alias(f"{p}_n"), F.col("t").alias(f"{p}_t"))
    j = itineraries.join(side("origin"), ["trip_id", "origin"], "left").join(side("destination"), ["trip_id", "destination"], "left")
    once = F.coalesce(F.col("origin_n") == 1, F.lit(False)) & F.coalesce(F.col("destination_n") == 1, F.lit(False))
    reason = F.when(~once, "ENDPOINT_NOT_UNIQUE").when((F.col("origin_t") != F.col("departs")) | (F.col("destination_t") != F.col("arrives")), "TIME_CONFLICT")
    return j.select("trip_id", "origin", "destination", reason.alias("reason")).where("reason IS NOT NULL")


def calendars(trips: DataFrame, days: dict[str, str], holidays: list[str], holiday_service: str, weekday_service: str) -> tuple[DataFrame, DataFrame]:
    """PL-5: calendars (service_id, days) of the day codes that trips use, and exceptions: on each holiday the holiday service
    is added (1) and the weekday service removed (2)."""
    names = F.create_map(*[F.lit(x) for kv in days.items() for x in kv])
    found = trips.select(F.col("day").alias("service_id")).distinct().select("service_id", names[F.col("service_id")].alias("days"))
    spark = trips.sparkSession
    one = spark.range(1).select(F.explode(F.array(*[F.lit(h) for h in holidays])).alias("date"))
    return found, one.select("date", F.explode(F.array(F.struct(F.lit(holiday_service).alias("service_id"), F.lit(1).alias("exception_type")), F.struct(F.lit(weekday_service).alias("service_id"), F.lit(2).alias("exception_type")))).alias("e")).select("date", "e.*")


def next_service_dates(instants: DataFrame, zone: str) -> DataFrame:
    """PL-6: for each (key, now as UTC epoch seconds) the next service date of WEEKDAY, SATURDAY and SUNDAY within 7 days, local time."""
    today = F.to_date(F.from_utc_timestamp(F.timestamp_seconds("now"), zone))
    days = instants.select("key", F.explode(F.sequence(today, F.date_add(today, 6))).alias("date"))
    kind = F.when(F.dayofweek("date") == 7, "SATURDAY").when(F.dayofweek("date") == 1, "SUNDAY").otherwise("WEEKDAY")
    return days.groupBy("key", kind.alias("day_type")).agg(F.min("date").alias("date"))


def routes(trips: DataFrame, declared: DataFrame, pattern: str = r"^([A-Z]+)-") -> DataFrame:
    """PL-7: distinct route ids of trips with declared names, else the line taken from the id's pattern."""
    found = trips.select("route_id").distinct().join(declared, "route_id", "left")
    line = F.regexp_extract("route_id", pattern, 1)
    return found.select("route_id", F.coalesce("name", F.when(line != "", line)).alias("name"), F.col("name").isNotNull().alias("is_declared"))
