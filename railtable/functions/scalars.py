"""SC-1 to SC-26: scalar functions Column -> Column, and the row filters that are made of them."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railtable.checks import first_reason, row_hash

#: Clock limits of a service day, and the closed direction and facility codes.
LAST_HOUR, SMALL_HOURS, DAY = 29, 3 * 3600, 86_400
DIRECTIONS = {"상행": "UP", "하행": "DOWN", "내선": "INNER", "외선": "OUTER"}
FACILITY_KEYWORDS = [("계단", "STAIR"), ("엘리베이터", "ELEVATOR"), ("승강기", "ELEVATOR"), ("에스컬레이터", "ESCALATOR"), ("환승", "TRANSFER")]
UNKNOWN_STATUSES = ("UNKNOWN", "CHECK_REQUIRED", "")
OPERATING_STATUSES = ("NORMAL", "AVAILABLE", "IN_SERVICE", "OPERATING", "OPEN", "ADMIN_VERIFIED")
PROVEN_MEANINGS = ("REALTIME_OPERATION", "OPERATOR_CONFIRMED", "FIELD_SURVEY")


def station_name(name: Column) -> Column:
    """SC-1: drops (…) and […], the middle dot, full stop and white space, then the suffix 역."""
    bare = F.regexp_replace(F.regexp_replace(name, r"\([^)]*\)|\[[^\]]*\]", ""), r"[·.\s]", "")
    return F.regexp_replace(bare, "역$", "")


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """SC-2: compatibility composition, which Spark has no function for."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def station_name_strong(name: Column, aliases: dict[str, str] | None = None) -> Column:
    """SC-2: NFKC, SC-1, trailing digits dropped, then a (small, literal) alias table."""
    bare = F.regexp_replace(station_name(nfkc(name)), r"\d+$", "")
    if not aliases:
        return bare
    return F.coalesce(F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])[bare], bare)


def line_name(name: Column) -> Column:
    """SC-3: middle dots, full stops and white space dropped."""
    return F.regexp_replace(name, r"[·.\s]", "")


def clock(value: Column) -> Column:
    """SC-4: HHMMSS to service seconds; blank, malformed or over hour 29: null; before 03:00 the next day's."""
    ok = value.rlike(r"^\d{6}$")
    h, m, s = (F.substring(value, k, 2).cast("int") for k in (1, 3, 5))
    raw = h * 3600 + m * 60 + s
    good = ok & (h <= LAST_HOUR) & (m < 60) & (s < 60)
    return F.when(good, F.when(raw < SMALL_HOURS, raw + DAY).otherwise(raw))


def clock_or_missing(value: Column) -> Column:
    """SC-5: as SC-4, where a value of zeros alone means missing."""
    return F.when(~value.rlike("^0+$"), clock(value))


def transfer_rows(rows: DataFrame) -> DataFrame:
    """SC-6: line (N or N호선) and duration (MM:SS, both at most 59) to line_name and duration_seconds; bad rows carry a reason."""
    line, time = F.trim(F.col("line").cast("string")), F.trim("duration")
    reason = first_reason([("LINE", ~F.coalesce(line.rlike("^[1-9][0-9]*(호선)?$"), F.lit(False))), ("DURATION", ~F.coalesce(time.rlike("^[0-5][0-9]:[0-5][0-9]$"), F.lit(False)))])
    fine = F.col("reason").isNull()
    return rows.withColumn("reason", reason).withColumn("line_name", F.when(fine, F.concat(F.regexp_replace(line, "호선$", ""), F.lit("호선")))).withColumn(
        "duration_seconds", F.when(fine, F.substring(time, 1, 2).cast("int") * 60 + F.substring(time, 4, 2).cast("int"))
    )


def stop_role(arrival: Column, departure: Column) -> Column:
    """SC-7: ORIGIN without arrival, TERMINAL without departure, THROUGH with both, null with none."""
    return F.when(arrival.isNull() & departure.isNotNull(), "ORIGIN").when(arrival.isNotNull() & departure.isNull(), "TERMINAL").when(arrival.isNotNull() & departure.isNotNull(), "THROUGH")


def car_door(value: Column) -> Column:
    """SC-8: 'car-door' to a struct, car 1 to 10 and door 1 to 4, else null."""
    car, door = (F.regexp_extract(value, r"^\s*(\d{1,2})\s*-\s*(\d)\s*$", k) for k in (1, 2))
    ok = (car != "") & car.cast("int").between(1, 10) & door.cast("int").between(1, 4)
    return F.when(ok, F.struct(car.cast("int").alias("car"), door.cast("int").alias("door")))


def direction(code: Column, codes: dict[str, str] | None = None) -> Column:
    """SC-9: a closed code map; unknown codes are null."""
    return F.create_map(*[F.lit(x) for kv in (codes or DIRECTIONS).items() for x in kv])[code]


def facility_type(*texts: Column, keywords: list[tuple[str, str]] | None = None) -> Column:
    """SC-9: in the first text that holds a keyword, the first keyword of the list decides."""
    one = lambda t: reduce(lambda rest, k: F.when(F.contains(F.regexp_replace(t, r"\s+", ""), F.lit(k[0])), k[1]).otherwise(rest), (keywords or FACILITY_KEYWORDS)[::-1], F.lit(None).cast("string"))
    return F.coalesce(*map(one, texts))


def js_round(x: Column) -> Column:
    return F.floor(x + F.lit(0.5))


def metres(kilometres: Column) -> Column:
    """SC-10: kilometres to whole metres."""
    return js_round(kilometres * 1000)


def canvas(lat: Column, lon: Column, origin: tuple[float, float], scale: float) -> Column:
    """SC-10: latitude and longitude to positive whole canvas points, y downwards."""
    return F.struct(
        F.greatest(F.lit(1), js_round((lon - F.lit(origin[1])) * scale)).cast("long").alias("x"), F.greatest(F.lit(1), js_round((F.lit(origin[0]) - lat) * scale)).cast("long").alias("y")
    )


def station_line_of(node: Column) -> Column:
    """SC-11: 'station:line[:suffix]' to 'station:line', null when a part is missing or empty."""
    parts = F.split(node, ":")
    a, b = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    return F.when((F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != ""), F.concat_ws(":", a, b))


def record_hash(*columns: str) -> Column:
    """SC-12: sha256 of the row in canonical column order."""
    return row_hash(*columns)


def holds_credential(text: Column) -> Column:
    """SC-13: text with something like serviceKey=…"""
    return F.coalesce(text.rlike("(?i)(serviceKey|apiKey|access[_-]?token|secret)[=:][^\\s&\"']+"), F.lit(False))


def search_rows(rows: DataFrame, text: str, groups: list[list[str]], limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    """SC-14: rows whose normalised text has at least one term of every group; at most `limit`, in the given order."""
    flat = F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}]+", "")
    cond = reduce(lambda a, b: a & b, [reduce(lambda a, b: a | b, [F.contains(flat, F.lit("".join(c for c in t.lower() if c.isalnum()))) for t in g]) for g in groups])
    found = rows.where(cond)
    return found.orderBy(*order).limit(limit) if limit is not None and order else found


def is_abbreviation(short: Column, long: Column) -> Column:
    """SC-15: short is a subsequence of long, and shorter."""
    done = F.aggregate(F.split(long, ""), F.lit(0), lambda n, c: F.when((n < F.char_length(short)) & (F.substr(short, n + 1, F.lit(1)) == c), n + 1).otherwise(n))
    return (F.char_length(short) < F.char_length(long)) & (done == F.char_length(short))


def parenthetical_names(raw: Column) -> Column:
    """SC-16: the texts inside parentheses, trimmed, blanks left out."""
    found = F.regexp_extract_all(raw, F.lit(r"\(([^()]*)\)"), F.lit(1))
    return F.filter(F.transform(found, lambda x: F.trim(x)), lambda x: x != "")


def standard_seconds(seconds: Column, percent: Column | int) -> Column:
    """SC-17: floor((seconds * percent + 99) / 100): whole seconds, rounded up."""
    percent = percent if isinstance(percent, Column) else F.lit(percent)
    return F.floor((seconds * percent + 99) / 100).cast("long")


def mobility_parity(rows: DataFrame, percent: int, tolerance: float = 10.0) -> DataFrame:
    """SC-17: rows (base_seconds) with the preset's seconds, its deviation in percent (0 for a base of 0), and within."""
    std = standard_seconds(F.col("base_seconds"), percent)
    off = F.when(F.col("base_seconds") == 0, 0.0).otherwise((std - F.col("base_seconds")) * 100.0 / F.col("base_seconds"))
    return rows.withColumn("standard_seconds", std).withColumn("deviation_percent", F.round(off, 4)).withColumn("within", F.abs(off) <= tolerance)


def strict_eligibility(operational: Column, meaning: Column) -> Column:
    """SC-18: may a strict route use the facility: (eligible, reason), decided by the first rule that holds."""
    status, means = F.upper(F.coalesce(operational, F.lit(""))), F.upper(F.coalesce(meaning, F.lit("")))
    reason = first_reason([("OPERATION_STATUS_UNKNOWN", status.isin(*UNKNOWN_STATUSES)), ("OPERATION_STATUS_NOT_AVAILABLE", ~status.isin(*OPERATING_STATUSES)), ("OPERATION_EVIDENCE_MISSING", ~means.isin(*PROVEN_MEANINGS))])
    return F.struct(reason.isNull().alias("eligible"), F.coalesce(reason, F.lit("FACILITY_OPERATION_VERIFIED")).alias("reason"))


def unverified_unknown(edges: DataFrame, states: list[str], reviewed: Column | None = None) -> DataFrame:
    """SC-19: unless VERIFIED (or the reviewed exception), an edge's states are UNKNOWN."""
    keep = F.coalesce(F.col("verification") == "VERIFIED", F.lit(False)) | (reviewed if reviewed is not None else F.lit(False))
    return edges.withColumns({s: F.when(keep, F.col(s)).otherwise("UNKNOWN") for s in states})


def vertices(path: Column) -> Column:
    """SC-20: 'M x y L x y …' to an array of (x, y)."""
    number = r"[ML]\s*(-?\d+(?:\.\d+)?)[\s,]+(-?\d+(?:\.\d+)?)"
    xs, ys = (F.regexp_extract_all(path, F.lit(number), F.lit(k)) for k in (1, 2))
    return F.transform(F.arrays_zip(xs.alias("a"), ys.alias("b")), lambda p: F.struct(p["a"].cast("double").alias("x"), p["b"].cast("double").alias("y")))


def path_text(points: Column) -> Column:
    """SC-20: back to text; whole numbers without decimals."""
    number = lambda v: F.when(v == F.floor(v), F.floor(v).cast("string")).otherwise(v.cast("string"))
    return F.array_join(F.transform(points, lambda p, i: F.concat(F.when(i == 0, "M ").otherwise("L "), number(p["x"]), F.lit(" "), number(p["y"]))), " ")


def segments(points: Column) -> Column:
    """Consecutive pairs of a vertex array, with their lengths."""
    n = F.greatest(F.size(points) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(points, F.lit(1), n), F.slice(points, F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.transform(pairs, lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"), F.hypot(s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]).alias("len")))


def polyline_length(points: Column) -> Column:
    """SC-21: the sum of segment lengths; 0 below two vertices."""
    return F.aggregate(segments(points), F.lit(0.0), lambda s, x: s + x["len"])


def _once(value: Column, use) -> Column:
    """use(value), with the value worked out once for each row however often it is named."""
    return F.transform(F.array(value), use)[0]


def _at(segs: Column, first: Column, distance: Column) -> Column:
    start = F.struct(F.lit(0.0).alias("done"), first.alias("p"))
    step = lambda acc, s: F.when((acc["done"] >= distance) | (s["len"] == 0), acc).otherwise(
        F.struct(
            (acc["done"] + s["len"]).alias("done"),
            F.struct(
                (s["a"]["x"] + (s["b"]["x"] - s["a"]["x"]) * F.least(F.lit(1.0), (distance - acc["done"]) / s["len"])).alias("x"),
                (s["a"]["y"] + (s["b"]["y"] - s["a"]["y"]) * F.least(F.lit(1.0), (distance - acc["done"]) / s["len"])).alias("y"),
            ).alias("p"),
        )
    )
    return F.aggregate(segs, start, step, lambda acc: acc["p"])


def point_at(points: Column, distance: Column) -> Column:
    """SC-21: the point at an arc length (clamped to both ends)."""
    return _at(segments(points), points[0], distance)


def interior_points(points: Column, n: int) -> Column:
    """SC-21: n points that cut the line into n + 1 equal parts."""
    length = lambda segs: F.aggregate(segs, F.lit(0.0), lambda s, x: s + x["len"])
    at = lambda v: F.array(*[_at(v["s"], v["p"], v["t"] * (k / (n + 1))) for k in range(1, n + 1)])
    both = lambda q: F.struct(q["p"][0].alias("p"), q["s"].alias("s"), length(q["s"]).alias("t"))
    return _once(points, lambda p: _once(F.struct(p.alias("p"), segments(p).alias("s")), lambda q: _once(both(q), at)))


def label_box(name: Column, x: Column, y: Column, char_width: int = 14, least: int = 28, height: int = 22, rise: int = 34) -> Column:
    """SC-22: four corners of a label as wide as its characters, over the point and clamped at 0."""
    width = F.greatest(F.lit(least), F.char_length(name) * char_width)
    left, top = F.greatest(F.lit(0), x - F.floor(width / 2)), F.greatest(F.lit(0), y - rise)
    right, bottom = left + width, top + height
    return F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in ((left, top), (right, top), (right, bottom), (left, bottom))])


def service_seconds(value: Column, service_date: Column) -> Column:
    """SC-23: 'YYYY-MM-DDTHH:MM:SS+09:00' to service seconds: same date, or the next in the small hours (+24 h); else null."""
    day = F.to_date(F.substring(value, 1, 10))
    raw = F.substring(value, 12, 2).cast("int") * 3600 + F.substring(value, 15, 2).cast("int") * 60 + F.substring(value, 18, 2).cast("int")
    after = F.datediff(day, service_date)
    ok = value.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}[+-]\d{2}:\d{2}$")
    return F.when(ok & (after == 0), raw).when(ok & (after == 1) & (raw < SMALL_HOURS), raw + DAY)


def mercator(lat: Column, lon: Column, scale: float, x0: float, y0: float) -> Column:
    """SC-24: longitude and latitude into design space."""
    s = F.sin(F.radians(lat))
    return F.struct((F.lit(x0) + F.radians(lon) * scale).alias("x"), (F.lit(y0) - F.log((1 + s) / (1 - s)) / 2 * scale).alias("y"))


#: Provider codes of an operating situation (available, under repair, stopped, inspected, under construction).
SITUATIONS = {"M": (True, "사용가능"), "S": (False, "보수중"), "T": (False, "중지"), "I": (False, "점검중"), "B": (False, "공사중")}
REMOVED = "D"


def provider_status(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """SC-25: removed rows go; a blank code has situation PROVIDER_STATUS_MISSING and no state; others take (operational,
    situation) of the code table; an unknown code is a violation (reason UNKNOWN_CODE)."""
    code = F.trim(F.coalesce("code", F.lit("")))
    out = rows.withColumn("code", code).where(F.col("code") != REMOVED).join(codes, "code", "left")
    blank = F.col("code") == ""
    return out.withColumn("reason", F.when(~blank & F.col("situation").isNull(), "UNKNOWN_CODE")).withColumn(
        "situation", F.when(blank, "PROVIDER_STATUS_MISSING").otherwise(F.col("situation"))
    )


def demote_unproven(rows: DataFrame, claim: str, allowed: list[str] | None = None) -> DataFrame:
    """SC-26: rows whose source, snapshot or hashes are incomplete, or whose source is not allowed, lose their claim."""
    hashed = lambda c: F.coalesce(F.col(c).rlike("^[0-9a-f]{64}$"), F.lit(False))
    whole = (F.trim(F.coalesce("source_id", F.lit(""))) != "") & (F.trim(F.coalesce("snapshot_id", F.lit(""))) != "") & hashed("raw_sha256") & hashed("mapping_sha256")
    if allowed is not None:
        whole = whole & F.coalesce(F.col("source_id").isin(allowed), F.lit(False))
    return rows.withColumn("incomplete", ~whole).withColumn(claim, F.when(whole, F.col(claim)).otherwise("UNKNOWN"))
