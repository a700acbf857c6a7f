"""Two tokenizers' tokens of the same text, aligned by byte offsets in windows between anchors.

A is a byte-level BPE file of the tokenizers library, B a sentencepiece model. A text is taken with a space before it (A is given that text, B
adds the space itself). No token of either goes from a character that is not white space into a space behind it (for B the vocabulary is asked, for A it is how
the file splits text), so a text is cut into pieces at such places, and each distinct piece is tokenised once a task: the tokens are those of the whole text.

When all tokens are there, an anchor is a place where a token of A and a token of B both end and the next token of both begins with a space.
Between two anchors lies a window of token ids; how its tokens overlap depends on the ids alone and is remembered by them.
"""

from __future__ import annotations

import gc
import itertools
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtable.llm.bpe import Bpe
from railtable.llm.common import cut
from railtable.llm.vocab import sent_bytes, vocabulary_file

BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Pieces and windows, and links of windows, that a task remembers before it starts anew.
REMEMBERED, REMEMBERED_LINKS = 300_000, 4 << 20
#: Id pairs whose counts are broadcast: 17 bytes each, 17 MB in all; the counts of further pairs are joined.
BROADCAST_PAIRS = 1_000_000
#: Bytes of text that make up one batch of results.
BATCH = 2 << 20
_BAR = b"\xff\xff"
SHIFT = 20  # a pair of ids is one long: a * 2^20 + b
#: A space behind a character that is not white space, where both tokenizers begin a token.
_ODD = re.compile(r"\s ")
_PRINTABLE = re.compile("[ -~]+").fullmatch
#: How byte-level files cut text into words where they name no pattern of their own (fixed value).
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT = re.compile(r"(?<=\S)(?= )")


class Pair:
    """Both tokenizers, the bytes of their tokens, and what is remembered of pieces and windows.

    A window's results stand in lists, at a number that its ids are remembered by; a piece is remembered as the numbers of its windows."""

    def __init__(self, spec_a: bytes, spec_b: bytes, quick: bool = False):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(spec_a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=spec_b)
        if json.loads(spec_a)["pre_tokenizer"]["type"] != "ByteLevel" or json.loads(spec_a)["normalizer"] is not None:
            raise ValueError("A has to be a byte-level file without normaliser")
        plain = _byte_level()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for t, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(plain[c] for c in t) if all(c in plain for c in t) else t.encode()
        names = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(t[3:5], 16)]) if self.b.is_byte(k) else t.replace("▁", " ").encode() for k, t in enumerate(names)]
        #: No piece has a word mark behind another character: then pieces of text can be tokenised by themselves.
        self.separable = not any("▁" in t.lstrip("▁") for t in names)
        self.sizes = [np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b)]
        self.flat = [np.frombuffer(b"".join(x), np.uint8) for x in (self.bytes_a, self.bytes_b)]
        self.begins = [np.cumsum(x) - x for x in self.sizes]
        self.space = [np.array([t[:1] == b" " for t in x], bool) for x in (self.bytes_a, self.bytes_b)]
        self.quick = self._by_ranks() if quick else None
        #: Each id as text with each mark that may follow it: the id's place in the table is 3 * id + the mark's.
        marked = [f"{i}{m}".encode() for i in range(max(len(self.bytes_a), len(self.bytes_b))) for m in ",|;"]
        self.marked, self.marked_size = np.frombuffer(b"".join(marked), np.uint8), np.array(list(map(len, marked)), np.int64)
        self.marked_begin = np.cumsum(self.marked_size) - self.marked_size
        if max(len(self.bytes_a), len(self.bytes_b)) > 0xFFFF:
            raise ValueError("ids have to fit two bytes")
        self.pieces: dict[str, int | tuple[int, ...] | None] = {}  # the number of its window, or of several
        self.forget()

    def forget(self) -> None:
        """Empties what is remembered; numbers of windows given out before mean nothing any more."""
        self.pieces.clear()
        self.windows: dict[bytes, int] = {}
        self.texts: list[str] = []
        self.counts = array("q")  # tokens of A, of B, groups and links of each window
        self.links = array("q")

    def full(self) -> bool:
        return len(self.windows) > REMEMBERED or len(self.pieces) > REMEMBERED or len(self.links) > REMEMBERED_LINKS

    def tokens(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of A and B of a text that begins with a space, tokenised as it stands (B puts that space back)."""
        return self.a.encode(text, add_special_tokens=False).ids, self.b.encode(text[1:], num_threads=1)

    def split(self, text: str) -> list[str]:
        """The pieces of " " + text; each begins with a space."""
        if not self.separable:
            return [" " + text]
        if _ODD.search(text) or text[:1] == " ":
            return _CUT.split(" " + text)
        return [" " + x for x in text.split(" ")] if text[-1:] != " " else _CUT.split(" " + text)

    def tokens_a(self, pieces: list[str]) -> list[list[int]]:
        """A's ids of each piece. Pieces of printable ASCII go through `quick`, which gives the same ids, where there is one."""
        if self.quick is None:
            return [x.ids for x in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        out = [self.quick(x) if _PRINTABLE(x) else None for x in pieces]
        rest = [k for k, x in enumerate(out) if x is None]
        for k, x in zip(rest, self.a.encode_batch_fast([pieces[k] for k in rest], add_special_tokens=False), strict=True):
            out[k] = x.ids
        return out

    def _by_ranks(self):
        """A's encoder for printable ASCII where `in_merge_order` says that ranks give the same."""
        import tiktoken

        ranks = {self.bytes_a[i]: i for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        return tiktoken.Encoding("a", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def learn(self, pieces: list[str]) -> None:
        """Tokenises pieces that are not remembered, verifies that the joined bytes of both are theirs (None for those whose are not), cuts them at their anchors
        and aligns the windows that are new."""
        ids = [self.tokens_a(pieces), self.b.encode([x[1:] for x in pieces], num_threads=1)]
        raw = [x.encode() for x in pieces]
        edge = np.concatenate([[0], np.cumsum(list(map(len, raw)))])
        whole = np.frombuffer(b"".join(raw), np.uint8)
        fine = np.ones(len(pieces), bool)
        flats = [_flat(x) for x in ids]
        for side in (0, 1):
            flat, edges = flats[side]
            total = np.concatenate([[0], np.cumsum(self.sizes[side][flat])])[edges]
            fine &= np.diff(total) == np.diff(edge)
            if (total == edge).all():  # all as long as they should be: compared in one go
                wrong = np.concatenate([[0], np.cumsum(_gather(self.flat[side], self.begins[side][flat], self.sizes[side][flat]) != whole)])
                fine &= np.diff(wrong[edge]) == 0
            else:
                table = (self.bytes_a, self.bytes_b)[side]
                fine &= np.array([b"".join(map(table.__getitem__, x)) == r for x, r in zip(ids[side], raw, strict=True)])
        packed = [(x.astype("<u2").tobytes(), (2 * e).tolist()) for x, e in flats]
        (a, p), (b, r) = packed
        plain: list[bytes] = [a[i:j] + _BAR + b[k:m] for i, j, k, m in zip(p[:-1], p[1:], r[:-1], r[1:], strict=True)]
        odd = {k: self.cut(ids[0][k], ids[1][k]) if fine[k] else None for k in np.flatnonzero(~fine | np.array([" " in x[1:] for x in pieces])).tolist()}
        self.align([key for k, key in enumerate(plain) if k not in odd] + [key for x in odd.values() if x for key in x])
        number = self.windows.__getitem__
        for k, piece in enumerate(pieces):
            if k not in odd:
                self.pieces[piece] = number(plain[k])
            else:
                own = odd[k]
                self.pieces[piece] = None if own is None else tuple(map(number, own))

    def texts_of(self, texts: list[str]) -> list[list[int]]:
        """The windows of each whole text; none if the joined bytes of either tokenizer are not those of " " + text. Pieces that are not remembered are learned first, all at once.
        Where a piece's bytes are not the tokens', the whole text decides, since pieces could make up for each other."""
        parts = [self.split(t) if t else [] for t in texts]
        if new := set(itertools.chain.from_iterable(parts)).difference(self.pieces):
            self.learn(list(new))
        look, out = self.pieces.__getitem__, []
        for text, own in zip(texts, parts, strict=True):
            found = list(map(look, own))
            if None in found:
                found = self._whole(text)
            elif tuple in set(map(type, found)):
                found = [n for x in found for n in (x if type(x) is tuple else (x,))]
            out.append(found)
        return out

    def _whole(self, text: str) -> list[int]:
        ids_a, ids_b = self.tokens(" " + text)
        raw = (" " + text).encode()
        if b"".join(map(self.bytes_a.__getitem__, ids_a)) != raw or b"".join(map(self.bytes_b.__getitem__, ids_b)) != raw:
            return []
        keys = self.cut(ids_a, ids_b)
        self.align(keys)
        return list(map(self.windows.__getitem__, keys))

    def cut(self, ids_a: list[int], ids_b: list[int]) -> list[bytes]:
        """Windows of tokens of the same bytes, cut at their anchors: places where a token of both ends and the next of both begins
        with a space."""
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        _, i, j = np.intersect1d(np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b]), assume_unique=True, return_indices=True)
        i, j = i[:-1] + 1, j[:-1] + 1  # the tokens behind each shared end but the last
        anchor = self.space[0][a[i]] & self.space[1][b[j]]
        at_a, at_b = [0, *i[anchor].tolist(), len(ids_a)], [0, *j[anchor].tolist(), len(ids_b)]
        return [window_key(ids_a[p:q], ids_b[r:s]) for p, q, r, s in zip(at_a[:-1], at_a[1:], at_b[:-1], at_b[1:], strict=True)]

    def align(self, keys: list[bytes]) -> None:
        """Aligns those windows that are not remembered by their ids, all at once: they stand one after another, with the same bytes in A and in B. Between two neighbouring
        ends (of either) lies the overlap of one token of A with one of B, and each overlap is such a stretch: these are the links; where both end, a group does."""
        new = list(dict.fromkeys(k for k in keys if k not in self.windows))
        if not new:
            return
        ids = np.frombuffer(b"".join(new), "<u2").astype(np.int64)
        size = np.fromiter(map(len, new), np.int64, len(new)) // 2
        bar, edge, at = np.flatnonzero(ids == 0xFFFF), np.concatenate([[0], np.cumsum(size)]), np.arange(len(ids))
        a, b = ids[at < np.repeat(bar, size)], ids[at > np.repeat(bar, size)]
        edge_a = np.concatenate([[0], np.cumsum(bar - edge[:-1])])
        edge_b = np.concatenate([[0], np.cumsum(edge[1:] - bar - 1)])
        end_a, end_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        ends = np.union1d(end_a, end_b)
        links = a[np.searchsorted(end_a, ends)] << SHIFT | b[np.searchsorted(end_b, ends)]
        last = end_a[edge_a[1:] - 1]
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        link_edge, group_edge = np.searchsorted(ends, np.concatenate([[0], last]), "right"), np.searchsorted(shared, np.concatenate([[0], last]), "right")
        # the text: group by group the ids of A, then those of B; a comma, a bar or a semicolon behind each
        group = np.concatenate([2 * np.searchsorted(shared, end_a), 2 * np.searchsorted(shared, end_b) + 1])
        mark = np.concatenate([np.isin(end_a, shared, assume_unique=True) * 1, np.isin(end_b, shared, assume_unique=True) * 2])
        order = np.argsort(group, kind="stable")
        cell = (3 * np.concatenate([a, b]) + mark)[order]
        size = self.marked_size[cell]
        text = _gather(self.marked, self.marked_begin[cell], size).tobytes().decode()
        stops = np.concatenate([[0], np.cumsum(size)])[edge_a + edge_b].tolist()
        first = len(self.texts)
        self.texts += [text[p : q - 1] for p, q in zip(stops[:-1], stops[1:], strict=True)]
        self.counts.frombytes(np.stack([np.diff(edge_a), np.diff(edge_b), np.diff(group_edge), np.diff(link_edge)], axis=1).astype(np.int64).tobytes())
        self.links.frombytes(links.tobytes())
        self.windows.update(zip(new, range(first, first + len(new)), strict=True))


def window_key(ids_a: list[int], ids_b: list[int]) -> bytes:
    """The ids of A and of B as one key, two bytes each, with a bar (no id) between them."""
    return np.array(ids_a, "<u2").tobytes() + _BAR + np.array(ids_b, "<u2").tobytes()


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all lists, and where each list begins and ends."""
    edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))])
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(edges[-1])), edges


def _gather(table: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs table[begin:begin + size], one after another."""
    to = np.concatenate([[0], np.cumsum(size)])
    return table[np.repeat(begin - to[:-1], size) + np.arange(to[-1])]


def _byte_level() -> dict[str, int]:
    """The character that a byte-level file writes for each byte: itself if it is printable, else one from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def in_merge_order(spec: bytes) -> bool:
    """Are the file's ids in the order of its merges, and do the merges make every token of its own bytes? Then encoding by ranks, where a word that is a token is that
    token, gives the merges' ids."""
    own = Bpe(spec)
    base = sum(own.born[i] < 0 for i in own.ids.values())
    return all(own.born[i] == max(-1, i - base) and own.length[i] for i in own.ids.values())


_made: dict[int, Pair] = {}


def _pair(spec_a: bytes, spec_b: bytes, quick: bool) -> Pair:
    """Both tokenizers, made once a worker."""
    key = hash((spec_a, spec_b))
    if key not in _made:
        _made.clear()
        _made[key] = Pair(spec_a, spec_b, quick)
    return _made[key]


def align(docs: DataFrame, byte_bpe: str | None = None, pieces: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, n_a, n_b (tokens of A and B), n_groups, n_links, groups (text a1,a2|b1;a3|b2,b3 of decimal ids in
    order: groups end where tokens of both end) and the links of overlapping tokens as pairs (packed ids, see SHIFT) with their counts.

    Whole texts are tokenised; special tokens' strings inside them are plain text. Null and empty texts, and texts whose joined bytes in A or B are
    not those of the text with a space before it, have no tokens: zeros, the empty text and no pairs. Very long texts are aligned window by window.
    Repeated rows and null ids give a row each, no rows none; other columns are not looked at."""
    spark = docs.sparkSession
    sent = [sent_bytes(spark, byte_bpe or vocabulary_file(spark, BYTE_BPE)), sent_bytes(spark, pieces or vocabulary_file(spark, PIECES))]

    quick = in_merge_order(sent[0].value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # what is remembered holds no cycles, and searching it for some takes a fifth of the time
        pair = _pair(sent[0].value, sent[1].value, quick)
        for batch in batches:
            texts = batch.column(1)
            size = np.cumsum([0, *(x or 0 for x in pc.binary_length(texts).to_pylist())])
            i = 0
            while i < len(batch):
                j = max(i + 1, int(np.searchsorted(size, size[i] + BATCH, "right")) - 1)
                some = [t or "" for t in texts.slice(i, j - i).to_pylist()]
                yield _aligned(pair, batch.column(0).slice(i, j - i), pair.texts_of(some))
                if pair.full():
                    pair.forget()
                i = j
        gc.enable()

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, counts array<long>")


def _aligned(pair: Pair, ids: pa.Array, windows: list[list[int]]) -> pa.RecordBatch:
    """The rows of some texts' windows."""
    counts = np.frombuffer(pair.counts, np.int64).reshape(-1, 4) if pair.counts else np.zeros((0, 4), np.int64)
    at = np.concatenate([[0], np.cumsum(counts[:, 3])])
    links = np.frombuffer(pair.links, np.int64)
    flat = np.fromiter(itertools.chain.from_iterable(windows), np.int64)
    edges = np.concatenate([[0], np.cumsum([len(w) for w in windows])]).astype(np.int64)
    totals = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(counts[flat], axis=0)])[edges]
    n_a, n_b, n_groups, n_links = np.diff(totals, axis=0).T
    spread = _gather(links, at[flat], counts[flat, 3])
    ends = totals[:, 3].tolist()
    found = [np.unique(spread[p:q], return_counts=True) for p, q in zip(ends[:-1], ends[1:], strict=True)]
    edge = pa.array(np.concatenate([[0], np.cumsum([len(x) for x, _ in found])]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(edge, pa.array(np.concatenate([x[k] for x in found]).astype(np.int64))) for k in (0, 1)]
    joined = [";".join(map(pair.texts.__getitem__, w)) for w in windows]
    del counts, links  # the arrays that they look at are to grow again
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(n_links), pa.array(joined, pa.string()), *lists],
        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "counts"],
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): the links of each id pair in all rows, and whether no pair of its B id has more."""
    each = cut(aligned.select(F.inline(F.arrays_zip("pairs", "counts"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("n")), "pairs")
    b = F.col("pair") % F.lit(1 << SHIFT)
    most = each.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return each.join(most, b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def frequent(counted: DataFrame, limit: int) -> tuple[DataFrame, bool]:
    """The pairs of the highest counts, at most `limit`, and whether these are all. The bound is a power of two of the count, found from how many
    pairs each has: no sort."""
    power = F.floor(F.log2(F.col("n"))).cast("int")
    sizes = sorted(((r["p"], r["count"]) for r in counted.groupBy(power.alias("p")).count().collect()), reverse=True)
    least, total = None, 0
    for p, size in sizes:
        if total + size > limit:
            return (counted.where(power >= F.lit(least)) if least is not None else counted.limit(0)), False
        least, total = p, total + size
    return counted, True


def with_scores(aligned: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Rows of `align` (with whatever columns beside pairs and counts) without their pairs, with n_best (links whose pair's count is its B id's highest,
    ties included) and count_sum (the pairs' counts, added up over the links); counts are over all rows.

    The rows are written once and read for the counts and for the scores. Up to `broadcast_pairs` frequent pairs are sent to all tasks;
    links of other pairs, if there are any, are joined to their counts and added up by row."""
    spark = aligned.sparkSession
    aligned = cut(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counted = cut(pair_counts(aligned), "counts")
    top, all_sent = frequent(counted, broadcast_pairs)
    got = top.orderBy("pair").toArrow()
    sent = spark.sparkContext.broadcast([got.column(k).to_numpy() for k in range(3)])
    kept = [c for c in aligned.columns if c not in ("pairs", "counts")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ns, bests = sent.value
        if not len(keys):
            keys, ns, bests = np.array([-1]), np.array([0]), np.array([False])
        for batch in batches:
            lists = batch.column("pairs")
            flat, weights = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
            edge = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy().astype(np.int64))])
            at = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
            hit = keys[at] == flat
            best, total, cold = (np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[edge] for x in (weights * (hit & bests[at]), weights * ns[at] * hit, ~hit))
            left = pa.array(cold.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(np.diff(best)), pa.array(np.diff(total)), *(pa.ListArray.from_arrays(left, pa.array(x[~hit])) for x in (flat, weights))],
                names=[*kept, "n_best", "count_sum", "pairs", "counts"],
            )

    types = dict(aligned.dtypes)
    scored = aligned.mapInArrow(run, ", ".join(f"`{c}` {types[c]}" for c in kept) + ", n_best long, count_sum long, pairs array<long>, counts array<long>")
    if all_sent:
        return scored.drop("row", "pairs", "counts")
    scored = cut(scored, "scored")
    cold = scored.select("row", F.inline(F.arrays_zip("pairs", "counts"))).withColumnRenamed("pairs", "pair")
    added = cold.join(counted, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("counts")).otherwise(0)).alias("more_best"), F.sum(F.col("counts") * F.col("n")).alias("more"))
    plus = [(F.col(c) + F.coalesce(F.col(m), F.lit(0))).alias(c) for c, m in (("n_best", "more_best"), ("count_sum", "more"))]
    return scored.drop("pairs", "counts").join(added, "row", "left").select(*(c for c in kept if c != "row"), *plus)


def digest(aligned: DataFrame) -> DataFrame:
    """Rows of `align` with groups_sha256 (empty without tokens) in place of the groups."""
    return aligned.withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")).drop("groups")
