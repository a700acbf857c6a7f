"""Windows along lines of any length.

A window by line puts a whole line into one task. Here a line longer than a block is cut into ranges of its order first: each range keeps its
first and last rows, sums and known values as one carry row, a window over the carry rows (a row for each range) says what each range gets from
those before and behind it, and the window proper runs inside ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railtable.checks import cut

#: Rows of a line that one task may hold. Shorter lines get the plain window.
BLOCK = 1_000_000
#: Pairs that one task lists where all pairs are the output.
PAIRS = 50_000_000
#: Rows of one side that a task meets with its share of the other side's, before it takes the next: written pairs that repeat so few values are small.
TILE = 512


@dataclass(frozen=True)
class Step:
    """What a row gets from its line: see the functions below."""

    kind: str
    column: Column


def before(column: Column | str) -> Step:
    """The value of the row before; null for the first."""
    return Step("before", _col(column))


def after(column: Column | str) -> Step:
    """The value of the next row; null for the last."""
    return Step("after", _col(column))


def running(column: Column | str) -> Step:
    """The sum from the line's first row to this one, nulls left out (0 where all are null)."""
    return Step("running", _col(column))


def known(column: Column | str) -> Step:
    """The last value that is not null up to this row."""
    return Step("known", _col(column))


def coming(column: Column | str) -> Step:
    """The first value that is not null from this row on."""
    return Step("coming", _col(column))


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def longest(rows: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Rows of the longest line, and of all."""
    found = rows.groupBy(*keys).agg(F.count("*").alias("_n")).agg(F.max("_n"), F.sum("_n")).first()
    return (found[0] or 0), (found[1] or 0)


def ranges(rows: DataFrame, keys: list[str], order: list[str], total: int, block: int) -> DataFrame:
    """`rows` with `_part`, which grows along each line: ranges of (keys, order) of about half a block each. Written once, since ranges found
    anew from a sample need not be the same."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(rows.repartitionByRange(max(least, -(-2 * total // block)), *keys, *order).withColumn("_part", F.spark_partition_id()))


def numbered(rows: DataFrame, most: int, order: list[str], name: str, block: int = BLOCK) -> DataFrame:
    """`rows`, which are at most `most`, with their place from 0 in the order `order` as `name`. Rows of equal order stand in any order among themselves. More than `block` rows are dealt to ranges
    and sorted there: a row's place is its number in its range, as it was written, and the sizes of the ranges before, so nothing is exchanged after the ranges."""
    if most <= block:
        return rows.withColumn(name, (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = cut(rows.repartitionByRange(max(least, -(-2 * most // block)), *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    part, own = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = parts.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return parts.withColumn("_part", part).join(sizes, "_part").select(*rows.columns, (F.col("_before") + own).alias(name))


def tiled(a: DataFrame, b: DataFrame, n_a: int, n_b: int, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """All pairs of `a`'s n_a rows and `b`'s n_b (column names differ), listed by tasks of about PAIRS pairs, whichever side is smaller: b's rows stand in arrays of `tile`, and a task has one of
    these for a share of a's rows. So a file's columns are runs, and cycles that pages repeat; listed row by row against all of b they would be b's whole table again for each row of a."""
    blocks = max(1, -(-n_b // tile))
    least = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = max(1, -(-n_a * tile // PAIRS), -(-least // blocks))
    placed = numbered(b, n_b, b.columns, "_at", block).groupBy(F.floor(F.col("_at") / tile).alias("_tile"))
    packed = placed.agg(F.collect_list(F.struct(*b.columns)).alias("_b")).repartitionByRange(blocks, "_tile").select("_b")
    return a.repartition(shares).hint("shuffle_replicate_nl").crossJoin(packed).select(*a.columns, F.explode("_b").alias("_b")).select(*a.columns, *(F.col("_b")[c].alias(c) for c in b.columns))


def along(rows: DataFrame, keys: list[str], order: list[str], steps: dict[str, Step], block: int = BLOCK) -> DataFrame:
    """`rows` with a column for each of `steps`, as windows by `keys` in the order `order` (nulls first) give them.

    Rows of equal order stand in any order among themselves, as in a window; `coming` may see them in another one. Null keys are a line like others. If no line has more than `block` rows these are plain windows;
    else no task holds more than a range of a line (rows that are equal in all of keys and order stay together)."""
    most, total = longest(rows, keys)
    if most <= block:
        w = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumns({name: _window(s, w, _back(keys, order), None) for name, s in steps.items()})
    parts = ranges(rows.withColumns({f"_v{k}": s.column for k, s in enumerate(steps.values())}), keys, order, total, block).withColumn("_line", F.struct(*keys))
    place = F.struct(*order)
    made, sent = [], {}
    w = Window.partitionBy("_line").orderBy("_part")
    for k, s in enumerate(steps.values()):
        v, got = F.col(f"_v{k}"), F.col(f"_c{k}")
        seen = F.when(v.isNotNull(), place)
        if s.kind == "before":
            one, over = F.max_by(F.struct(v.alias("v")), place), F.lag(got).over(w)
        elif s.kind == "after":
            one, over = F.min_by(F.struct(v.alias("v")), place), F.lead(got).over(w)
        elif s.kind == "running":
            one, over = F.coalesce(F.sum(v), F.lit(0)), F.coalesce(F.sum(got).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        elif s.kind == "known":
            one, over = F.max_by(v, seen), F.last(got, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        else:
            one, over = F.min_by(v, seen), F.last(got, ignorenulls=True).over(Window.partitionBy("_line").orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1))
        made.append(one.alias(f"_c{k}"))
        sent[f"_c{k}"] = over
    carry = parts.groupBy("_line", "_part").agg(*made).withColumns(sent)
    local = Window.partitionBy("_line", "_part").orderBy(*order)
    both = parts.join(carry, ["_line", "_part"])
    out = {name: _window(Step(s.kind, F.col(f"_v{k}")), local, _back(["_line", "_part"], order), F.col(f"_c{k}")) for k, (name, s) in enumerate(steps.items())}
    return both.select(*rows.columns, *(c.alias(name) for name, c in out.items()))


def _back(keys: list[str], order: list[str]):
    """The window by `keys` from its last row to its first. A frame that ends with the last row is worked out anew for each row in Spark, a frame that begins with the first is not."""
    return Window.partitionBy(*keys).orderBy(*(F.col(o).desc_nulls_last() for o in order))


def _window(s: Step, w, back, carry: Column | None) -> Column:
    """A step inside the window w (`back` is w the other way), going on from `carry`, what the rows outside it give."""
    if s.kind in ("before", "after"):
        row = F.struct(s.column.alias("v"))
        got = (F.lag if s.kind == "before" else F.lead)(row).over(w)
        return (got if carry is None else F.coalesce(got, carry))["v"]
    if s.kind == "running":
        own = F.coalesce(F.sum(s.column).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
        return own if carry is None else own + carry
    if s.kind == "known":
        own = F.last(s.column, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    else:
        own = F.last(s.column, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0))
    return own if carry is None else F.coalesce(own, carry)
