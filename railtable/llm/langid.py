"""Language by unigrams with every segmentation summed: piece probabilities per language over a public vocabulary."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtable.llm import vectext
from railtable.llm.common import bounded_ids, crc_mod

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Texts of each language that piece counts are taken from (those with the smallest hashes).
TEXTS = 1500
#: Weight of the pooled distribution in each language's.
POOLED = 2000.0
#: Words of up to so many bytes share one array of plain probabilities, each byte of which is far above 1e-18; longer ones are rescaled step by step.
PLAIN = 16
BLOCK = 4 << 20
FOLDS, HELD_OUT = 4, 2
_U = np.uint64


def pieces(model_file: str = VOCABULARY) -> dict[bytes, list[int]]:
    """The vocabulary as bytes -> ids: the word mark is a leading space, byte pieces are their byte. Pieces with a
    space elsewhere and control pieces never occur in a word and are left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    out: dict[bytes, list[int]] = {}
    for k in range(sp.get_piece_size()):
        if sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k):
            continue
        raw = bytes([int(sp.id_to_piece(k)[3:5], 16)]) if sp.is_byte(k) else sp.id_to_piece(k).replace("▁", " ").encode()
        if raw and b" " not in raw[1:]:
            out.setdefault(raw, []).append(k)
    for b in range(256):
        out.setdefault(bytes([b]), [])
    return out


@dataclass(frozen=True)
class Model:
    langs: list[str]
    prior: np.ndarray  # log
    keys: list[bytes]
    probs: np.ndarray  # a row for each key, a column for each language


class Scorer:
    """Piece lookup by hash (two tables, every key in one of them) and the forward algorithm over unique words."""

    def __init__(self, model: Model):
        self.model = model
        self.lengths = sorted({len(k) for k in model.keys})
        raw = b"".join(model.keys)
        off = np.concatenate([[0], np.cumsum([len(k) for k in model.keys])])
        hashes = vectext.word_hashes(np.frombuffer(raw, np.uint8), off[:-1], off[1:])
        self.probs = np.vstack([model.probs, np.zeros((1, len(model.langs)))])
        none = len(model.keys)
        for bits in range(18, 26):
            self.shifts = (_U(64 - bits), _U(64 - 2 * bits))
            self.mask = _U((1 << bits) - 1)
            self.tables = [(np.zeros(1 << bits, _U), np.full(1 << bits, none)) for _ in range(2)]
            left = np.arange(none)
            for shift, (table, ids) in zip(self.shifts, self.tables, strict=True):
                at = (hashes[left] >> shift) & self.mask
                table[at], ids[at] = hashes[left], left
                left = left[ids[at] != left]
            if not len(left):
                return
        raise ValueError("the vocabulary's hashes do not fit")

    def find(self, hashes: np.ndarray) -> np.ndarray:
        none = len(self.model.keys)
        out = np.full(len(hashes), none)
        for shift, (table, ids) in zip(self.shifts, self.tables, strict=True):
            at = ((hashes >> shift) & self.mask).astype(np.int64)
            out = np.where(table[at] == hashes, ids[at], out)
        return out

    def words(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log P of each word in each language: the sum over all its segmentations, by the forward algorithm."""
        out = np.zeros((len(starts), len(self.model.langs)))
        sizes, longest = ends - starts, max(self.lengths, default=0)
        sums = np.zeros(len(buf) + 1, _U)
        up, down = vectext._power(len(buf) + 1)
        np.cumsum(vectext._BYTE[buf] * up[: len(buf)], out=sums[1:], dtype=_U)
        for n in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == n)
            step = max(1, (1 << 20) // max(1, n))
            for part in (own[i : i + step] for i in range(0, len(own), step)):
                at = starts[part]
                alpha = [np.ones((len(part), len(self.model.langs)))]
                shift = np.zeros((len(part), 1))
                for e in range(1, n + 1):
                    total = np.zeros_like(alpha[0])
                    for length in (k for k in self.lengths if k <= e):
                        i = at + (e - length)
                        h = vectext.mix((sums[i + length] - sums[i]) * down[i] + _U(length))
                        p = self.find(h)
                        hit = np.flatnonzero(p != len(self.model.keys))
                        if len(hit):
                            total[hit] += alpha[-length][hit] * self.probs[p[hit]]
                    alpha.append(total)
                    if len(alpha) > longest:
                        alpha.pop(0)
                    if n > PLAIN:
                        top = total.max(axis=1, keepdims=True)
                        top[top == 0] = 1.0
                        shift += np.log(top)
                        alpha = [a / top for a in alpha]
                out[part] = np.log(np.maximum(alpha[-1], 1e-300)) + shift
        return out

    def texts(self, texts: pa.Array) -> np.ndarray:
        """log P of each whole text in each language, without the prior."""
        data, off = vectext.buffer_of(pc.utf8_lower(texts))
        out = np.zeros((len(texts), len(self.model.langs)))
        for i, j in vectext.blocks(off, BLOCK):
            buf, starts, ends, edge = vectext.words(data, off, i, j)
            if not len(starts):
                continue
            _, first, back = np.unique(vectext.word_hashes(buf, starts, ends), return_index=True, return_inverse=True)
            # the unique words, each behind a space, in one buffer
            a, b = starts[first], ends[first]
            size = b - a + 1
            to = np.concatenate([[0], np.cumsum(size)])
            spread = np.full(to[-1], 32, np.uint8)
            inner = np.ones(to[-1], bool)
            inner[to[:-1]] = False
            spread[inner] = buf[np.repeat(a - to[:-1] - 1, size)[inner] + np.flatnonzero(inner)]
            logs = self.words(spread, to[:-1], to[1:])
            full = np.flatnonzero(edge[:-1] < edge[1:])
            out[i + full] = np.add.reduceat(logs[back.reshape(-1)], edge[:-1][full], axis=0)
        return out


def train(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", texts: int = TEXTS) -> Model:
    """Counts pieces in up to `texts` texts of each language outside the held-out fold (priors: in all of them), each
    text cut by the public tokenizer. A language's distribution is its counts plus POOLED times the distribution over
    all languages, which is smoothed by one half a piece. Null languages, texts and ids teach nothing; repeated rows and several texts of
    a chosen id count each; empty texts count for the priors alone. Without rows nothing is learned."""
    import sentencepiece

    vocab = pieces(vocabulary)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where((crc_mod(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    shares = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(shares)
    ids = bounded_ids(rows, "doc_id", texts, by=["lang"]).select("doc_id").distinct()
    # executors get the vocabulary with the job, not from a path of theirs
    sent = docs.sparkSession.sparkContext.broadcast(sentencepiece.SentencePieceProcessor(model_file=vocabulary).serialized_model_proto())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = sentencepiece.SentencePieceProcessor(model_proto=sent.value)
        for batch in batches:
            got = []
            for lang, text in zip(batch.column(0).to_pylist(), pc.utf8_lower(batch.column(1)).to_pylist(), strict=True):
                got += [(lang, k, n) for k, n in zip(*(x.tolist() for x in np.unique(np.asarray(sp.encode(text, num_threads=1), np.int64), return_counts=True)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in got], t) for k, t in ((0, pa.string()), (1, pa.int64()), (2, pa.int64()))], names=["lang", "piece", "n"])

    counted = rows.join(F.broadcast(ids), "doc_id").select("lang", "text").mapInArrow(cut, "lang string, piece long, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    keys = sorted(vocab)
    place = {k: i for i, key in enumerate(keys) for k in vocab[key]}
    counts = np.zeros((len(keys), len(langs)))
    for lang, piece, n in counted.itertuples(index=False):
        if piece in place:
            counts[place[piece], langs.index(lang)] += n
    pooled = counts.sum(axis=1) + 0.5
    probs = counts + POOLED * (pooled / pooled.sum())[:, None]
    total = sum(shares.values())
    return Model(langs, np.log(np.array([shares[x] / total for x in langs])), keys, probs / probs.sum(axis=0))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, held_out, lang_pred, score (posterior of that language).

    The text alone decides. Letters are lower-cased; words are cut at ASCII white space, where no piece crosses, so a
    text's probability is the product of its words' and each distinct word of a block is summed once. A null text, or
    one without a letter, is `und` with score 0, as are all texts if nothing was learned. A tie goes to the first
    language by name. Repeated rows get equal rows, no rows none; a null id is held out null.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        scorer = Scorer(m) if m.langs else None
        for batch in batches:
            said = np.array([t is not None and any(map(str.isalpha, t)) for t in batch.column(2).to_pylist()], bool)
            if scorer:
                logs = scorer.texts(batch.column(2)) + m.prior
                best = logs.argmax(axis=1)
                top = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            else:
                said[:] = False
                best, top = np.zeros(len(said), int), np.zeros(len(said))
            names = [m.langs[k] if s else "und" for k, s in zip(best.tolist(), said.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(np.where(said, top, 0.0))], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), (crc_mod(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double")
