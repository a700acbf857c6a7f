"""LM scoring by a probabilistic suffix tree over bytes, beside an add-one unigram base over words."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtable.llm import vectext
from railtable.llm.common import crc_mod, cut, drop_cut

#: Longest context in bytes. With the next byte it fits seven bytes of a long.
DEPTH = 6
#: A context is kept if it occurs so often, and if its own next symbols, against what its suffix predicts for them, save so many bits
#: over all its occurrences (the divergence test). Both are absolute, so the tree grows with the corpus.
LEAST, BITS_SAVED = 8, 12.0
#: Weight of the suffix's distribution in a context's own: so much for each distinct next symbol seen, plus one.
BACKOFF = 3.0
#: (context, next) pairs of the most frequent contexts in each task's broadcast tree: about 50 MB. Deeper states beyond it are found by joins.
HOT_PAIRS = 3_000_000
#: Positions of the bitmap (16 MB at most) that tells which texts' contexts may be kept beyond the broadcast tree, as a power of two.
COLD_BITS = 27
#: Words counted by each task's broadcast table; all others are looked up by a join. 65,536 words are about 2 MB.
HOT_WORDS = 65_536
FOLDS, HELD_OUT = 7, 2
END = 10
CHUNK = 1 << 19
#: A task sends counts once it holds so many words, or so many grams after merging.
MOST_WORDS, MOST_GRAMS = 400_000, 2_000_000
#: Counts of words and grams travel in so many parts a task: enough for any number of partitions, and with at most 3 million grams a row has a few KB.
PARTS = 8192
_U = np.uint64


def words_of(text: pa.StringScalar | None) -> list[bytes]:
    """[^\\x20\\x09-\\x0D]+ after lower-casing A-Z: what bytes.lower() and bytes.split() do."""
    return text.as_buffer().to_pybytes().lower().split() if text is not None and text.is_valid else []


def grams(tokens: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """For each symbol of the texts (words joined by a space, then an end symbol) the long made of DEPTH bytes before
    it and itself, and where each text starts. A text's start is seen as ends before it."""
    pad = bytes([END]) * DEPTH
    parts = [b" ".join(t) for t in tokens]
    buf = np.frombuffer(b"".join(pad + p + bytes([END]) for p in parts), np.uint8)
    sizes = np.array([len(p) + 1 for p in parts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    keep = np.ones(len(buf), bool)
    at = starts[:-1] + DEPTH * np.arange(len(parts))
    for k in range(DEPTH):
        keep[at + k] = False
    wide = buf.astype(_U)
    out = wide.copy()
    for k in range(1, DEPTH + 1):
        out[k:] |= wide[:-k] << _U(8 * k)
    return out[keep], starts


def _chunks(batch: pa.Array) -> Iterator[tuple[int, int, list[list[bytes]]]]:
    _, off = vectext.buffer_of(batch)
    for i, j in vectext.blocks(off, CHUNK):
        yield i, j, [words_of(batch[k]) for k in range(i, j)]


def _summed(seen: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One sorted list of keys with counts from several."""
    if len(seen) == 1:
        return seen[0]
    keys = np.concatenate([k for k, _ in seen])
    order = np.argsort(keys, kind="stable")  # which merges the sorted runs
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(np.concatenate([c for _, c in seen])[order], first)


class Counts:
    """A task's counts of words and grams. Lists of grams are merged when they grow long; what is then still long is full."""

    def __init__(self):
        self.words: Counter[bytes] = Counter()
        self.seen: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.seen.append((keys, n))
        self.held += len(keys)
        if self.held > 1.5 * MOST_GRAMS:
            self.seen = [_summed(self.seen)]
            self.held = len(self.seen[0][0])

    def full(self) -> bool:
        return len(self.words) > MOST_WORDS or (len(self.seen) == 1 and self.held > MOST_GRAMS)

    def taken(self) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """(words, their counts, grams, their counts); nothing is held after it."""
        words, n = list(self.words), np.fromiter(self.words.values(), np.int64, len(self.words))
        keys, times = _summed(self.seen) if self.seen else (np.zeros(0, _U), np.zeros(0, np.int64))
        self.__init__()
        return words, n, keys, times


def _distinct(raw: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The grams of the lists, which are emptied, with their counts."""
    keys = np.concatenate(raw)
    raw.clear()
    return np.unique(keys, return_counts=True)


def _binaries(of: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary for each range of an array's values."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * of.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(of))])


def _dealt(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by part, the parts that occur and where each starts in it."""
    order = np.argsort(parts, kind="stable")
    found, starts = np.unique(parts[order], return_index=True)
    return order, found, np.append(starts, len(parts))


def _count_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, said, keys, n): counts of a task's words (`said`) and grams, sent when they grow large: a row for each part of them, its
    words (joined by the end symbol) or its grams, sorted, as one binary, and their counts as another."""
    counts = Counts()

    def sent() -> Iterator[pa.RecordBatch]:
        words, n, keys, times = counts.taken()
        for said in (True, False):
            if not len(n if said else times):
                continue
            if said:
                order, found, ends = _dealt((np.fromiter(map(crc32, words), np.uint32, len(words)) % PARTS).astype(np.uint16))
                words = [words[k] for k in order.tolist()]
                lists = pa.array([bytes([END]).join(words[i:j]) for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())
                n = n[order]
            else:
                order, found, ends = _dealt((vectext.mix(keys) % _U(PARTS)).astype(np.uint16))
                lists, n = _binaries(keys[order], ends), times[order]
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(np.full(len(found), said)), lists, _binaries(n, ends)], names=["part", "said", "keys", "n"])

    raw, long = [], 0
    for batch in batches:
        for _, _, tokens in _chunks(batch.column(0)):
            for t in tokens:
                counts.words.update(t)
            raw.append(grams(tokens)[0])
            long += len(raw[-1])
            if long > 2_000_000:  # sorting some at once is cheaper than merging
                counts.add(*_distinct(raw))
                long = 0
                if counts.full():
                    yield from sent()
    if raw:
        counts.add(*_distinct(raw))
    yield from sent()


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, gram, n, partial) from rows of _count_packed. A row has a word or a gram. What a task can hold is summed: as a part is in
    one task, that is all there is of its words and grams. A task that has to send some before its end calls all its rows partial."""
    counts, partial = Counts(), False

    def sent() -> Iterator[pa.RecordBatch]:
        words, n, keys, times = counts.taken()
        names = ["word", "gram", "n", "partial"]
        if words:
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.nulls(len(words), pa.int64()), pa.array(n), pa.array(np.full(len(n), partial))], names=names)
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.nulls(len(keys), pa.binary()), pa.array(keys.view(np.int64)), pa.array(times), pa.array(np.full(len(keys), partial))], names=names)

    for batch in batches:
        for said, keys, n in zip(batch.column("said").to_pylist(), batch.column("keys"), batch.column("n"), strict=True):
            times = np.frombuffer(n.as_buffer(), np.int64)
            if said:
                for w, c in zip(keys.as_py().split(bytes([END])), times.tolist(), strict=True):
                    counts.words[w] += c
            else:
                counts.add(np.frombuffer(keys.as_buffer(), _U), times)
            if counts.full():
                partial = True
                yield from sent()
    yield from sent()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, gram, n): counts of the words and grams of one task's texts."""
    for batch in _unpacked(_count_packed(batches)):
        yield batch.select(["word", "gram", "n"])


def counted(texts: DataFrame) -> DataFrame:
    """(word, gram, n): how often each word and each gram stands in the texts (one column). A task's counts travel as few long rows, and
    those of one part meet in a task; only what such a task did not hold at once is summed by row."""
    packed = texts.mapInArrow(_count_packed, "part int, said boolean, keys binary, n binary").repartition("part")
    rows = cut(packed.mapInArrow(_unpacked, "word binary, gram long, n long, partial boolean"), "counts")
    whole, rest = rows.where("NOT partial").drop("partial"), rows.where("partial")
    if rest.isEmpty():
        return whole
    return whole.unionByName(cut(rest.groupBy("word", "gram").agg(F.sum("n").alias("n")), "counts"))


def _listed(owner: np.ndarray, keys: np.ndarray, logs: np.ndarray, rows: int) -> pa.ListArray:
    """For each of `rows` rows its distinct grams with their log and how often they stand there: (g, h, c), in the order of g. `owner` is the row of each."""
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(keys)))
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner[first], minlength=rows))])
    made = pa.StructArray.from_arrays([pa.array(keys[first].view(np.int64)), pa.array(logs[order][first]), pa.array(times, pa.int64())], names=["g", "h", "c"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), made)


@dataclass(frozen=True)
class Tree:
    """For each depth k: kept contexts (sorted, the last k bytes as a long), log10 of the weight their suffix keeps, and
    (context << 8 | next) with its log10 probability, sorted. Depth 0 has the 256 symbols. `cold` is a bitmap of the kept contexts
    that are not among them (None: there are none)."""

    root: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    cold: np.ndarray | None = None

    def score(self, grams: np.ndarray) -> np.ndarray:
        """log10 P of each gram's last byte, from the longest kept suffix of its context. Going up from the longest, a gram that has
        its pair is through; else what its context, if kept, leaves to the suffix is added. Sorted grams are found faster."""
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        for k in range(len(self.levels), 0, -1):
            contexts, lost, pairs, logs = self.levels[k - 1]
            if not len(contexts) or not len(left):
                continue  # a longer context may be kept without its suffix
            pair = grams & _U((1 << (8 * k + 8)) - 1)
            where = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
            found = pairs[where] == pair
            out[left[found]] += logs[where[found]]
            left, grams, pair = left[~found], grams[~found], pair[~found]
            context = pair >> _U(8)
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            out[left] += np.where(contexts[at] == context, lost[at], 0.0)
        out[left] += self.root[(grams & _U(255)).astype(np.int64)]
        return out

    def may_be_cold(self, grams: np.ndarray) -> np.ndarray:
        """Could a suffix of the gram's context be kept beyond this tree?"""
        found = np.zeros(len(grams), bool)
        if self.cold is not None:
            for k in range(1, DEPTH + 1):
                at = cold_place((grams >> _U(8)) & _U((1 << (8 * k)) - 1), k)
                found |= (self.cold[at >> 3] >> (at & 7)) & 1 > 0
        return found


def cold_place(contexts: np.ndarray, k: int) -> np.ndarray:
    return (vectext.mix(contexts * _U(8) + _U(k)) >> _U(64 - COLD_BITS)).astype(np.int64)


class Cached:
    """Tree.score() and may_be_cold() behind a direct-mapped table: most grams of a text were looked up a moment ago. A gram that is not
    in its slot is looked up in the tree and takes the slot. A slot has the gram and, beside it in memory, the bits of its log, whose
    sign tells whether it may be cold (a log10 of a probability needs none)."""

    BITS = 21
    STEP = 1 << 17  # grams looked up at once, so that what is made on the way stays small

    def __init__(self, tree: Tree):
        self.tree = tree
        self.slots = np.full((1 << self.BITS, 2), 2**64 - 1, _U)

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        return ((grams * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.BITS)).view(np.int64)

    def score(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out, misses = np.empty(len(grams)), []
        for i in range(0, len(grams), self.STEP):
            part = grams[i : i + self.STEP]
            got = np.take(self.slots, self._slot(part), axis=0, mode="clip")
            out[i : i + self.STEP] = got[:, 1].view(np.float64)
            misses.append(np.flatnonzero(got[:, 0] != part) + i)
        miss = np.concatenate(misses) if misses else np.zeros(0, np.int64)
        if len(miss):
            keys, back = np.unique(grams[miss], return_inverse=True)
            logs = np.copysign(self.tree.score(keys), np.where(self.tree.may_be_cold(keys), 1.0, -1.0))
            out[miss] = logs[back.reshape(-1)]
            at = self._slot(keys)
            # of several grams that want a slot the last one gets it, with its own log
            self.slots[at] = np.stack([keys, logs.view(_U)], axis=1)
        cold = ~np.signbit(out)
        return -np.abs(out), cold

def _low(c: Column | str, symbols: int) -> Column:
    """The last so many bytes of a gram."""
    return (F.col(c) if isinstance(c, str) else c).bitwiseAND(F.lit((1 << (8 * symbols)) - 1))


def grow(counts: DataFrame, least: int = LEAST, saved: float = BITS_SAVED) -> tuple[np.ndarray, list[DataFrame]]:
    """The tree of the counts (gram, n) of all training text: the root's 256 probabilities, and for each depth a table (context, pair,
    m, log, lost) of its kept contexts, all grown in Spark.

    Counts of a depth's (context, next) pairs are sums of the next depth's. Going down, a pair's probability is mixed with the one
    that its suffix predicts, from the suffix's own or, where that was not kept, from a shorter one; a context is kept where
    its symbols, weighed by their counts, gain `saved` bits by it, whether or not its suffix is kept. Joins hash the side whose keys are
    unique, a partition of it at a time, so the long sides are not sorted."""
    sums: list[DataFrame] = [counts.select(F.col("gram").alias("pair"), "n")]
    for k in range(DEPTH - 1, -1, -1):
        sums.insert(0, cut(sums[0].groupBy(_low("pair", k + 1).alias("pair")).agg(F.sum("n").alias("n")), "sums"))
    root = np.full(256, 1.0)
    for pair, n in sums[0].collect():
        root[pair] += n
    root = root / root.sum()
    listed = F.from_json(F.lit(json.dumps(root.tolist())), "array<double>")
    before, kept, used = None, [], []
    for k in range(1, DEPTH + 1):
        rows = sums[k].withColumn("context", F.shiftrightunsigned("pair", 8))
        own = rows.groupBy("context").agg(F.sum("n").alias("m"), F.count("*").alias("kinds")).where(F.col("m") >= least)
        rows = rows.join(own.hint("shuffle_hash"), "context").withColumn("weight", F.col("kinds") * BACKOFF + 1.0)
        if before is None:
            rows = rows.withColumn("given", F.get(listed, _low("pair", 1).cast("int")))
        else:
            rows = rows.withColumn("suffix", _low("pair", k)).join(before.select(F.col("pair").alias("suffix"), F.col("p").alias("given")).hint("shuffle_hash"), "suffix").drop("suffix")
        rows = cut(rows.withColumn("p", (F.col("n") + F.col("weight") * F.col("given")) / (F.col("m") + F.col("weight"))), "level")
        tested = rows.groupBy("context").agg(F.sum(F.col("n") * F.log2(F.col("p") / F.col("given"))).alias("bits")).where(F.col("bits") >= saved).select("context", F.lit(True).alias("kept"))
        judged = cut(rows.join(tested.hint("shuffle_hash"), "context", "left").select("context", "pair", "m", "kinds", "p", "given", "weight", F.coalesce("kept", F.lit(False)).alias("kept")), "judged")
        kept.append(judged.where("kept").select("context", "pair", "m", "kinds", F.log10("p").alias("log"), F.log10(F.col("weight") / (F.col("m") + F.col("weight"))).alias("lost")))
        before = judged.select("pair", F.when(F.col("kept"), F.col("p")).otherwise(F.col("given")).alias("p"))
        used.append(rows)
    for df in used + sums[:-1]:
        drop_cut(df)
    return np.log10(root), kept


def hot_tree(root: np.ndarray, kept: list[DataFrame], most: int = HOT_PAIRS) -> tuple[Tree, int]:
    """The tree of the most frequent kept contexts, with at most `most` pairs, and the count from which a context is in it. As a
    context is at most as frequent as its suffix, what is not in it lies below what is. Only it and the bitmap of the rest reach the driver."""
    sizes = None
    for level in kept:
        one = level.groupBy(F.floor(F.log2("m")).cast("int").alias("b")).agg(F.count("*").alias("pairs"))
        sizes = one if sizes is None else sizes.unionByName(one)
    room, floor = most, 0
    for b, pairs in sorted(((r["b"], r["pairs"]) for r in sizes.groupBy("b").agg(F.sum("pairs").alias("pairs")).collect()), reverse=True):
        room -= pairs
        if room < 0:
            floor = 1 << (b + 1)
            break
    levels = []
    for level in kept:
        # a pair has its context in it, and what the suffix keeps is sent once a context
        hot = level.where(F.col("m") >= floor)
        got = hot.groupBy("context").agg(F.max("lost").alias("lost")).toArrow()
        keys, lost = got.column("context").to_numpy().view(_U), got.column("lost").to_numpy()
        order = np.argsort(keys)
        keys, lost = keys[order], lost[order]
        got = hot.select("pair", "log").toArrow()
        pairs, logs = got.column("pair").to_numpy().view(_U), got.column("log").to_numpy()
        del got
        order = np.argsort(pairs)
        levels.append((keys, lost, pairs[order], logs[order]))
    if not floor:
        return Tree(root, levels), 0

    def places(k: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(cold_place(batch.column(0).to_numpy().view(_U), k)))], names=["p"])

        return run

    bits = np.zeros(1 << (COLD_BITS - 3), np.uint8)
    for k, level in enumerate(kept, 1):
        p = level.where(F.col("m") < floor).select("context").distinct().mapInArrow(places(k), "p long")
        # (p >> 3) is the byte and (p & 7) the bit; the map of 4 KB parts is made in Spark
        parts = p.groupBy(F.shiftright("p", 15).alias("b")).agg(F.bitmap_construct_agg(_low("p", 2).bitwiseAND(F.lit(32767))).alias("bits"))
        for b, part in parts.collect():  # at most 4,096 rows
            bits[b * 4096 : (b + 1) * 4096] |= np.frombuffer(bytes(part), np.uint8)
    return Tree(root, levels, bits), floor


def cold_logs(grams: DataFrame, kept: list[DataFrame], floor: int) -> DataFrame:
    """(gram, log): `grams` (gram, hot), each scored on from what the broadcast tree gives by the kept contexts beyond it. A context is a
    row with its at most 256 next symbols, so a depth is one join."""
    out = grams.select("gram", F.col("hot").alias("log"))
    for k, level in enumerate(kept, 1):
        rest = level.where(F.col("m") < floor).groupBy("context").agg(F.first("lost").alias("lost"), F.map_from_entries(F.collect_list(F.struct(_low("pair", 1).alias("s"), "log"))).alias("next"))
        j = out.withColumn("context", _low(F.shiftrightunsigned("gram", 8), k)).join(rest, "context", "left")
        out = j.select("gram", F.when(F.col("lost").isNull(), F.col("log")).otherwise(F.coalesce(F.try_element_at("next", _low("gram", 1)), F.col("log") + F.col("lost"))).alias("log"))
    return out


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_words: int = HOT_WORDS, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """One row for each row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words of the lower-cased text and one end. Learned from all texts outside the held-out fold: word
    counts, and counts of all byte grams for the tree (contexts of up to DEPTH bytes, kept by a divergence test against
    their suffix and smoothed by it; every text is scored by its longest kept suffix states, so `score` is the log10
    probability of its words, one space between them, and the end). `base_score` is the add-one unigram over tokens.
    Words beyond the most frequent `hot_words`, and states beyond the most frequent `hot_pairs` pairs of the tree, are found by joins
    of what a document has of them, summed by document.

    Null and blank texts have the end alone; long texts are scored whole. A null id is in no fold: it is scored and not learned from.
    Repeated rows get equal rows, and ties of counts do not matter. Other columns are not looked at. Without training text every token is
    unknown (N and V are 0) and bytes are equally likely. No rows: no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    fold = crc_mod(F.col("doc_id"), FOLDS)
    learned = rows.where(fold != HELD_OUT)
    counts = counted(learned.select("text"))
    words, found = counts.where("word IS NOT NULL").select("word", "n"), counts.where("gram IS NOT NULL").select("gram", "n")
    ends = learned.count()
    said, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = said + ends, kinds + (1 if ends else 0)
    hot = {bytes(r["word"]): r["n"] for r in words.orderBy(F.desc("n"), "word").limit(hot_words).collect()}
    whole = kinds <= hot_words
    root, kept = grow(found)
    tree, floor = hot_tree(root, kept, hot_pairs)
    sent = spark.sparkContext.broadcast((hot, tree))
    base = float(np.log10(total + distinct + (0 if total else 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text with what the broadcast tables know of it, and its other words as (word, times)."""
        hot, tree = sent.value
        known = {w: np.log10(c + 1.0) for w, c in hot.items()}
        quick = Cached(tree)
        for batch in batches:
            for i, j, tokens in _chunks(batch.column(2)):
                g, starts = grams(tokens)
                one, cold = quick.score(g)
                far_at = np.flatnonzero(cold)
                hots = one[far_at]
                one[far_at] = 0.0
                logs = np.add.reduceat(one, starts[:-1])
                beyond = _listed(np.searchsorted(starts, far_at, "right") - 1, g[far_at], hots, len(tokens))
                n, k, b = [], [], []
                other, often, ends_at = [], [], [0]
                for t in tokens:
                    # a known word's log10(c + 1) is positive, so 0 marks the others
                    logs_of = np.fromiter(map(known.get, t, repeat(0.0)), np.float64, len(t))
                    far, near = float(logs_of.sum()), int(np.count_nonzero(logs_of))
                    if not whole:
                        found = Counter(t[x] for x in np.flatnonzero(logs_of == 0).tolist())
                        other.extend(found)
                        often.extend(found.values())
                    ends_at.append(len(other))
                    mine = len(t) + 1
                    n.append(mine)
                    k.append(near + (1 if ends else 0))
                    b.append(far + float(np.log10(ends + 1.0)) - mine * base)
                rest = pa.ListArray.from_arrays(pa.array(ends_at, pa.int32()), pa.StructArray.from_arrays([pa.array(other, pa.binary()), pa.array(often, pa.int64())], names=["w", "c"]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.array(b, pa.float64()), pa.array(logs, pa.float64()),
                        rest, beyond,
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rest", "beyond"],
                )

    kind = dict(rows.dtypes)["doc_id"]
    shape = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, rest array<struct<w:binary,c:bigint>>, beyond array<struct<g:bigint,h:double,c:bigint>>"
    out = rows.select("doc_id", (fold == HELD_OUT).alias("held_out"), "text").mapInArrow(run, shape)
    if not whole or floor:
        # row numbers are written with the rows, so they stay as they are
        first = cut(out.withColumn("row", F.monotonically_increasing_id()), "scored")
        out = first
        if not whole:
            rare = first.selectExpr("row", "explode(rest) AS r").select("row", F.col("r.w").alias("word"), F.col("r.c").alias("c"))
            sums = rare.join(words.hint("shuffle_hash"), "word").groupBy("row").agg(F.sum("c").alias("more"), F.sum(F.col("c") * F.log10(F.col("n") + 1.0)).alias("far"))
            out = out.join(sums, "row", "left").withColumns({"n_known": F.col("n_known") + F.coalesce("more", F.lit(0)), "base_score": F.col("base_score") + F.coalesce("far", F.lit(0.0))})
        if floor:
            said = first.selectExpr("row", "explode(beyond) AS r").select("row", F.col("r.g").alias("gram"), F.col("r.h").alias("hot"), F.col("r.c").alias("c"))
            logs = cold_logs(said.groupBy("gram").agg(F.first("hot").alias("hot")), kept, floor)
            sums = said.join(logs.hint("shuffle_hash"), "gram").groupBy("row").agg(F.sum(F.col("c") * F.col("log")).alias("deep"))
            out = out.join(sums, "row", "left").withColumn("score", F.col("score") + F.coalesce("deep", F.lit(0.0)))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
