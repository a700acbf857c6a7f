"""Benchmark decontamination: a broadcast hash set of test windows, scanned over every window of the training texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railtable.llm import vectext
from railtable.llm.common import cut

WINDOW = 10
#: Windows (of an item) and bytes of their words in one broadcast. A larger benchmark is scanned block by block, a block at a time
#: on the driver and in a broadcast of its own.
MOST_WINDOWS, MOST_BYTES = 200_000, 40_000_000
_U = np.uint64

#: One hit: the document's words start to start + length, its bytes a to b, are a window of the item.
HITS = "row long, words long, start long, length long, a long, b long, item_id long"


def item_windows(benchmark: DataFrame, n: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, length, hash (64 bits), words (joined by a space) of every window; null texts and ids have none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = vectext.buffer_of(batch.column(1))
            out: list[tuple] = []
            for i, j in vectext.blocks(off):
                buf, starts, ends, edge = vectext.words(data, off, i, j, vectext.ALNUM)
                hashes = vectext.word_hashes(buf, starts, ends)
                for k in range(i, j):
                    a, b = int(edge[k - i]), int(edge[k - i + 1])
                    length = min(n, b - a)
                    if not length:
                        continue
                    keys = vectext.window_hashes(hashes[a:b], length).view(np.int64)
                    said = [buf[x:y].tobytes() for x, y in zip(starts[a:b], ends[a:b], strict=True)]
                    item = batch.column(0)[k].as_py()
                    out += [(item, length, int(h), b" ".join(said[p : p + length])) for p, h in enumerate(keys)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.binary())],
                names=["item_id", "length", "hash", "words"],
            )

    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).where("item_id IS NOT NULL")
    return rows.mapInArrow(cut, "item_id long, length int, hash long, words binary").distinct()


class WindowSet:
    """The broadcast side: for each window length a bitmap, the sorted hashes, and the windows' words and items."""

    def __init__(self, rows: pd.DataFrame):
        self.by_length = {}
        for length, part in rows.groupby("length"):
            keys = np.unique(part["hash"].to_numpy().view(_U))
            bits = max(16, int(len(keys)).bit_length() + 5)
            bitmap = np.zeros(1 << bits, bool)
            bitmap[keys >> _U(64 - bits)] = True
            items: dict[bytes, list[int]] = {}
            for words, item in zip(part["words"], part["item_id"], strict=True):
                items.setdefault(bytes(words), []).append(int(item))
            self.by_length[int(length)] = (bits, bitmap, keys, items)

    def hits(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, edge: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row of the block, first word, length, item) of each verified occurrence."""
        out = []
        hashes = vectext.word_hashes(buf, starts, ends)
        for length, (bits, bitmap, keys, items) in self.by_length.items():
            windows = vectext.window_hashes(hashes, length)
            near = np.flatnonzero(bitmap[windows >> _U(64 - bits)])
            if len(near):
                found = keys[np.minimum(np.searchsorted(keys, windows[near]), len(keys) - 1)]
                near = near[found == windows[near]]
            for w in near.tolist():
                row = int(np.searchsorted(edge, w, "right")) - 1
                if w + length > edge[row + 1]:
                    continue  # it runs over the end of its text
                said = b" ".join(buf[x:y].tobytes() for x, y in zip(starts[w : w + length], ends[w : w + length], strict=True))
                out += [(row, w - int(edge[row]), length, item) for item in items.get(said, ())]
        return out


def block_count(windows: DataFrame, most: int = MOST_WINDOWS) -> int:
    """How many blocks keep each at most about `most` windows and MOST_BYTES bytes of words."""
    n, size = windows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()
    return max(1, -(-n // most), -(-size // MOST_BYTES))


def window_set(windows: DataFrame, block: int = 0, blocks: int = 1) -> WindowSet:
    """One block of the benchmark. Blocks are dealt by window and item, so a window that many items share is dealt out too."""
    return WindowSet((windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("words", "item_id"), F.lit(blocks)) == block)).toArrow().to_pandas())


def _scan(sent: Broadcast, at: int, act):
    """A mapInArrow function: for each batch, act(batch, [(words, hits by row)]) with the texts of column `at` scanned whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = vectext.buffer_of(batch.column(at).cast(pa.string()))
            rows: list[tuple] = []
            for i, j in vectext.blocks(off):
                buf, starts, ends, edge = vectext.words(data, off, i, j, vectext.ALNUM)
                found: dict[int, list] = {}
                for row, start, length, item in sent.value.hits(buf, starts, ends, edge):
                    found.setdefault(row, []).append((start, length, item))
                for k in range(j - i):
                    a, b = int(edge[k]), int(edge[k + 1])
                    base = int(off[i + k] - off[i])
                    rows.append((b - a, [(int(starts[a + s]) - base, int(ends[a + s + m - 1]) - base, s, m, item) for s, m, item in found.get(k, ())]))
            yield act(batch, rows)

    return run


def hits_in_blocks(rows: DataFrame, windows: DataFrame, blocks: int) -> DataFrame:
    """All hits (HITS) in `rows` (row, text), from one pass over the texts for each block of the benchmark; a row without hits gives
    one with null start in the first pass. Only one block is on the driver, and in a broadcast, at a time."""
    out = None
    for block in range(blocks):
        sent = rows.sparkSession.sparkContext.broadcast(window_set(windows, block, blocks))

        def act(batch: pa.RecordBatch, found: list[tuple], first: bool = block == 0) -> pa.RecordBatch:
            ids, got = batch.column(0).to_pylist(), []
            for row, (n, hits) in zip(ids, found, strict=True):
                got += [(row, n, s, m, a, b, item) for a, b, s, m, item in hits]
                if first:
                    got.append((row, n, None, None, None, None, None))
            names = ["row", "words", "start", "length", "a", "b", "item_id"]
            return pa.RecordBatch.from_arrays([pa.array([g[k] for g in got], pa.int64()) for k in range(7)], names=names)

        one = cut(rows.select("row", "text").mapInArrow(_scan(sent, 1, act), HITS), "hits")
        sent.destroy()
        out = one if out is None else out.unionByName(one)
    return out


def _covered(hits: list[tuple]) -> int:
    """Words inside any occurrence."""
    total = reach = 0
    for s, m in sorted({(h[2], h[3]) for h in hits}):
        total += max(0, s + m - max(reach, s))
        reach = max(reach, s + m)
    return total


def _merged(hits: DataFrame) -> DataFrame:
    """report() of the hits of several passes, by row: words covered by a running furthest end, items as a sorted list."""
    before = Window.partitionBy("row").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.where("start IS NOT NULL").select("row", "start", "length").distinct().withColumn("reach", F.coalesce(F.max(F.col("start") + F.col("length")).over(before), F.lit(0)))
    covered = spans.groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("start") + F.col("length") - F.greatest("reach", "start"))).alias("n_hit"))
    items = hits.where("start IS NOT NULL").select("row", F.col("item_id").cast("string").alias("s")).distinct().groupBy("row").agg(F.array_sort(F.collect_list("s")).alias("items"))
    out = hits.where("start IS NULL").select("row", "words").join(covered, "row", "left").join(items, "row", "left")
    n, listed = F.coalesce("n_hit", F.lit(0)), F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "row", F.col("words").alias("n_words"), n.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (n > 0).alias("contaminated"),
    )


def report(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_WINDOWS) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z. A window is n consecutive words of an
    item; an item of fewer words, but some, is one window. Every window of every text is looked up in a broadcast
    set by hash and then compared word by word: one pass over the texts, without a shuffle. A benchmark of over `most` windows (or
    MOST_BYTES bytes) is broadcast in blocks, one after the other, with a pass over the texts (written once with row numbers) for
    each; the hits, not the texts, are then merged by row.

    Null, empty or wordless texts: no words, no hits. Items without words, and null items, never occur; an empty benchmark hits
    nothing. Of several occurrences that overlap each word counts once; repeated items count by their id. Repeated rows and null ids
    are reported as they come, long texts whole. Other columns are not looked at. No rows: no rows.
    """
    spark = docs.sparkSession
    windows = cut(item_windows(benchmark, n), "windows")
    blocks = block_count(windows, most)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if blocks > 1:
        rows = cut(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "rows")
        return rows.select("row", "doc_id").join(_merged(hits_in_blocks(rows, windows, blocks)), "row").drop("row")
    sent = spark.sparkContext.broadcast(window_set(windows))

    def act(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        items = [sorted({str(h[4]) for h in hits}) for _, hits in rows]
        hit = [_covered(hits) for _, hits in rows]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array([w for w, _ in rows], pa.int64()), pa.array(hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()), pa.array([h > 0 for h in hit], pa.bool_()),
            ],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )

    return rows.mapInArrow(_scan(sent, 1, act), "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without its bytes a to b of each span."""
    raw, out, reach = text.encode(), [], 0
    for a, b in sorted(spans):
        out.append(raw[reach:a] if a > reach else b"")
        reach = max(reach, b)
    return (b"".join(out) + raw[reach:]).decode()


def remove(docs: DataFrame, benchmark: DataFrame, how: str = "documents", n: int = WINDOW, text_col: str = "text", most: int = MOST_WINDOWS) -> DataFrame:
    """`docs` with all its columns, decontaminated: how="documents" drops the rows with a hit; how="spans" keeps them and
    cuts each hit from its first word to its last out of the text. Rows without a hit stay byte for byte, null and empty texts and
    null ids among them; each row is judged by its own text, so repeated rows fare alike. No rows: no rows. A large benchmark is
    scanned in blocks as in report()."""
    if how not in ("documents", "spans"):
        raise ValueError(f"how: {how}")
    windows = cut(item_windows(benchmark, n), "windows")
    blocks = block_count(windows, most)
    at = docs.columns.index(text_col)
    if blocks > 1:
        rows = cut(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text")), "rows")
        hits = hits_in_blocks(rows, windows, blocks).where("start IS NOT NULL")
        if how == "documents":
            return rows.join(hits.select("row").distinct(), "row", "left_anti").select("doc.*")
        spans = hits.groupBy("row").agg(F.collect_set(F.struct("a", "b")).alias("spans"))

        def clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, cuts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                made = [t if c is None else _without(t, [(x["a"], x["b"]) for x in c]) for t, c in zip(texts, cuts, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.string()), batch.column(2)], names=["text", "doc"])

        out = rows.join(spans, "row", "left").select("text", "spans", "doc")
        out = out.mapInArrow(clear, T.StructType([T.StructField("text", T.StringType()), out.schema["doc"]]))
        return out.select(*[F.col("text").cast(docs.schema[c].dataType).alias(c) if k == at else F.col("doc")[c].alias(c) for k, c in enumerate(docs.columns)])
    sent = docs.sparkSession.sparkContext.broadcast(window_set(windows))

    def act(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        if how == "documents":
            return batch.filter(pa.array([not hits for _, hits in rows], pa.bool_()))
        texts = batch.column(at).to_pylist()
        texts = [_without(t, [(h[0], h[1]) for h in hits]) if hits else t for t, (_, hits) in zip(texts, rows, strict=True)]
        return batch.set_column(at, batch.schema.field(at).name, pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(_scan(sent, at, act), docs.schema)


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
m AS (SELECT *, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS x FROM m, unnest(range(1, (len(w) - n + 2)::BIGINT)) u(p)),
dw AS (SELECT doc_id, p, l.n, array_to_string(w[p : p + l.n - 1], ' ') AS x FROM w, (SELECT DISTINCT n FROM bw) l, unnest(range(1, (len(w) - l.n + 2)::BIGINT)) u(p) WHERE len(w) >= l.n),
h AS (SELECT doc_id, p, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.x = bw.x),
c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM h, unnest(range(p, p + n)) u(q) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM h) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)
"""
