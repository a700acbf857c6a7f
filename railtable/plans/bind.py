"""Binds operators to the driver's tables: views written once, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: @name(column) tokens: (Spark, DuckDB).
MACROS = {
    "secs": (r"unix_timestamp(\1)", r"floor(epoch(\1))::BIGINT"),
    "days": (r"div(unix_timestamp(\1), 86400L)", r"(floor(epoch(\1))::BIGINT // 86400)"),
    "str": (r"CAST(\1 AS STRING)", r"CAST(\1 AS VARCHAR)"),
    "at0": (r"get(\1, 0)", r"(\1)[1]"),
    "at1": (r"get(\1, 1)", r"(\1)[2]"),
    "single": (r"CAST(\1 AS FLOAT)", r"\1"),  # a number that leaves a product with floats a float; in Spark one with a whole number is a double
}

VIEWS: dict[str, str] = {
    # stop events of trips: lines are return flags, stations are suppliers, a stop is a lineitem
    "v_stops": """SELECT concat(l_returnflag, '-', @str(l_orderkey)) AS trip_id, l_returnflag AS line_id, l_suppkey AS station_id,
        CAST((@days(l_shipdate) * 37 + l_partkey * 13 + l_linenumber * 601) % 72000 + 14400 AS INT) AS departure,
        CAST(row_number() OVER (PARTITION BY l_returnflag, l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS INT) AS stop_no
        FROM lineitem""",
    "v_departures": """SELECT event_id AS trip_id, event_type AS line_id, user_id % 40 AS station_id, CAST(user_id % 2 AS INT) AS direction, event_type AS stop_line,
        CAST(@secs(ts) % 86400 AS INT) AS seconds, CAST(event_id % 11 AS INT) AS pickup_type, event_id % 13 = 0 AS by_frequency FROM events""",
    "v_status": """SELECT user_id AS facility_id, event_type AS status, @secs(ts) AS observed_at, event_id AS seq, @secs(ts) + 86400 * (1 + event_id % 9) AS expires_at FROM events""",
    "v_positions": """SELECT vec_id AS station_id, label AS line_id, CAST(round(@at0(embedding) * @single(2000)) AS BIGINT) AS x, CAST(round(@at1(embedding) * @single(2000)) AS BIGINT) AS y FROM embeddings""",
    "v_roster": """SELECT p_partkey AS station_id, p_name AS name, p_brand AS line_id, p_type AS kind, p_size AS seq FROM part""",
    # platforms are stations by line code, edges the consecutive stops of trips; a trip keeps to its line, so other lines' platforms are out of reach
    "v_nodes": """SELECT s_suppkey * 5 + r_regionkey AS node FROM supplier CROSS JOIN region""",
    "v_edges": """SELECT DISTINCT from_node, to_node FROM (SELECT node AS from_node, lead(node) OVER (PARTITION BY trip_id ORDER BY stop_no) AS to_node
        FROM (SELECT trip_id, stop_no, station_id * 5 + CASE line_id WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS node FROM v_stops) AS s) AS e WHERE from_node <> to_node""",
    "v_snapshots": """SELECT o_orderkey AS snapshot_id, o_custkey AS source_id, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous_id,
        @secs(o_orderdate) AS retrieved_at, o_orderstatus AS schema_mark, CAST(floor(o_totalprice) AS BIGINT) AS row_count, o_orderpriority AS raw_mark FROM orders""",
}


def canonical(*columns: str, **named: str) -> str:
    """DuckDB SQL of a row's canonical text: compact JSON of (column or name=expression) in name order."""
    parts = {c: c for c in columns} | named
    return "to_json({" + ", ".join(f"'{c}': {parts[c]}" for c in sorted(parts)) + "})::VARCHAR"


def _expand(sql: str, engine: int) -> str:
    for name, both in MACROS.items():
        sql = re.sub(rf"@{name}\(([^()]*)\)", both[engine], sql)
    return sql


def _used(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{n}\b", sql)]


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A DataFrame of portable SQL over the tables (and VIEWS) of a folder. No name is left in the session's catalog."""
    sql = _expand(sql, 0)
    frames = {n: view(spark, sf_dir, VIEWS[n]) for n in _used(sql, VIEWS)}
    frames |= {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _used(sql, TABLES) if re.search(rf"(?i)(from|join|,)\s+{t}\b", sql)}
    for n in frames:
        sql = re.sub(rf"(?i)\b(from|join|,)(\s+){n}\b", rf"\1\2{{{n}}}", sql)
    return spark.sql(sql, **frames)


def duck(sql: str) -> str:
    """The same SQL for DuckDB, with the views it names as common table expressions."""
    sql = _expand(sql, 1)
    need: list[str] = []

    def add(text: str) -> None:
        for n in _used(text, VIEWS):
            if n not in need:
                add(_expand(VIEWS[n], 1))
                need.append(n)

    add(sql)
    if not need:
        return sql
    ctes = ", ".join(f"{n} AS ({_expand(VIEWS[n], 1)})" for n in need)
    body = sql.strip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes}, {body[15:]}"
    return f"WITH {ctes}, {body[5:]}" if body[:5].upper() == "WITH " else f"WITH {ctes} {body}"


class Book:
    """Collects a module's queries and oracles."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, make: Callable[..., DataFrame], views: list[str], oracle: str | None) -> None:
        """make gets a DataFrame for each of `views` (names of VIEWS or portable SELECTs); the oracle may name VIEWS."""
        sqls = [v if " " in v else f"SELECT * FROM {v}" for v in views]
        self.queries[name] = lambda spark, sf_dir: make(*[view(spark, sf_dir, s) for s in sqls])
        if oracle is not None:
            self.oracles[name] = duck(oracle)
