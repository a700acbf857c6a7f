"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

Encoding. A sequence of tokens is what the merges give exactly if each token is what they make of its own symbols and each two neighbours are
compatible: no merge would have crossed the border between them before it came to be. So an Aho-Corasick automaton finds the longest token at
each place of a word; tokens are taken from left to right, a shorter prefix where the pair table says no, a step back where none is left. A
place that was given up once is not tried again, so the work is linear in the word.

Whole texts are worked on. They are cut at ASCII white space, which no token crosses, and each distinct piece is encoded once a task, up to a
bound on what is remembered.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtable.llm.vocab import Memo, sent_bytes, vocabulary_file

VOCABULARY = "word_bpe_49k.json"
#: Pieces and words, and bytes of them, that a task remembers before it starts anew; pairs of tokens likewise.
PIECES, PIECE_BYTES, PAIRS = 500_000, 8 << 20, 500_000
#: Bytes of text, or token ids, that make up one batch of results.
BATCH = 4 << 20
LAST = 0x1000  # added to the code of a word's last symbol, which has tokens of its own
NEVER = 1 << 60


class Bpe:
    """Merges, pair table and automaton of a byte-level BPE file of the tokenizers library, with or without word ends.

    The file must make each token by one merge, of tokens made before it; otherwise this method cannot tell what the merges would give, and
    a ValueError says so."""

    def __init__(self, spec: bytes):
        from tokenizers import Tokenizer

        model = json.loads(spec)["model"]
        self.lib = Tokenizer.from_str(spec.decode())
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.added = {t.content.encode(): i for i, t in self.lib.get_added_tokens_decoder().items()}
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in self.lib.get_added_tokens_decoder().values()):
            raise ValueError("added tokens that look at their neighbours or at normalised text are not handled")
        self.cut = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + b")").split if self.added else lambda piece: [piece]
        size = max([*self.ids.values(), *self.added.values()]) + 1
        self.born = [-1] * size  # when the merges make a token; base symbols are there from the start
        self.left, self.right = list(range(size)), list(range(size))
        self.merged: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            x, y, z = self.ids[a], self.ids[b], self.ids[a + b]
            if self.born[z] >= 0 or max(self.born[x], self.born[y]) >= rank:
                raise ValueError(f"token {z} is made twice or before its parts")
            self.born[z], self.left[z], self.right[z] = rank, x, y
            self.merged[x, y] = rank
        self.fits: dict[tuple[int, int], bool] = {}
        self.words = Memo(lambda word: array("i", self.encode_symbols(self.word(word))).tobytes())
        self.pieces = Memo(self.encode_piece)
        self.ascii_words = self._ascii_words(json.loads(spec))
        self._find_tokens()
        self._offset_table(size)

    def spelled(self, token: str) -> str:
        """A token's symbols: one character a byte, the last of a word marked by LAST."""
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            token = token[: -len(self.end)]
            return token[:-1] + chr(ord(token[-1]) + LAST)
        return token

    def word(self, word: str) -> str:
        return word[:-1] + chr(ord(word[-1]) + LAST) if self.end else word

    @staticmethod
    def _ascii_words(spec: dict):
        """How a file of the usual form (compose, white space, lower case; one split pattern, byte level) cuts a piece of printable ASCII into words,
        without the library; None for other files."""
        import regex

        parts = (spec["normalizer"] or {}).get("normalizers", [])
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if [x["type"] for x in parts] != ["NFC", "Replace", "Lowercase"] or parts[1]["pattern"] != {"Regex": "\\s+"} or [x["type"] for x in splits] != ["Split", "ByteLevel"]:
            return None
        if splits[0]["behavior"] != "Removed" or not splits[0]["invert"] or splits[1]["add_prefix_space"] or splits[1]["use_regex"]:
            return None
        find = regex.compile(splits[0]["pattern"]["Regex"]).findall
        printable = re.compile(b"[!-~]+").fullmatch
        return lambda piece: find(piece.lower().decode()) if printable(piece) else None

    def _find_tokens(self) -> None:
        """The automaton of the tokens that the merges make of their own symbols, and for each of them its longest shorter prefix."""
        made = [False] * len(self.born)
        for z in sorted(self.ids.values(), key=self.born.__getitem__):
            r = self.born[z]
            made[z] = r < 0 or made[self.left[z]] and made[self.right[z]] and self.apart(self.left[z], self.right[z], r, r)
        self.whole = by_symbols = {self.spelled(t): i for t, i in self.ids.items() if made[i]}
        self.find = ahocorasick.Automaton()
        self.length, self.shorter = [0] * len(self.born), [-1] * len(self.born)
        for s, i in by_symbols.items():
            self.find.add_word(s, i)
            self.length[i] = len(s)
            self.shorter[i] = next((by_symbols[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in by_symbols), -1)
        self.find.make_automaton()

    def apart(self, x: int, y: int, until_x: int = NEVER, until_y: int = NEVER) -> bool:
        """Does no merge cross the border between x and y? Walks back through the tokens that met at the border: of the two the younger is undone.
        until_x, until_y: when the merges use the two up. A merge across comes first if it is earlier than x's next one and no later than
        y's (of equal merges the left one comes first)."""
        while True:
            across = self.merged.get((x, y), NEVER)
            if across < until_x and across <= until_y:
                return False
            born_x, born_y = self.born[x], self.born[y]
            if born_x < 0 and born_y < 0:
                return True
            if born_x > born_y:
                x, until_x = self.right[x], born_x
            else:
                y, until_y = self.left[y], born_y

    def compatible(self, x: int, y: int) -> bool:
        """The pair table, filled as pairs turn up."""
        got = self.fits.get((x, y))
        if got is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            got = self.fits[x, y] = self.apart(x, y)
        return got

    def encode_symbols(self, symbols: str) -> list[int]:
        """Token ids of one word's symbols, as the merges give them."""
        whole = self.whole.get(symbols)
        if whole is not None:
            return [whole]
        longest, length, shorter = [-1] * (len(symbols) + 1), self.length, self.shorter
        for end, token in self.find.iter(symbols):
            longest[end + 1 - length[token]] = token  # matches come by their ends, so the longest of a start comes last
        out: list[int] = []
        dead = bytearray(len(symbols) + 1)
        fits, end, last = self.fits, len(symbols), -1
        at, token = 0, longest[0]
        while at < end:
            if token < 0:  # nothing fits here: give the place up and shorten the token before it
                if not out:
                    raise ValueError("the vocabulary lacks a byte")
                dead[at] = 1
                at -= length[last]
                token = shorter[out.pop()]
                last = out[-1] if out else -1
                continue
            to = at + length[token]
            if not dead[to] and (last < 0 or (self.compatible(last, token) if (fit := fits.get((last, token))) is None else fit)):
                out.append(token)
                at, last, token = to, token, longest[to]
            else:
                token = shorter[token]
        return out

    def encode_piece(self, piece: bytes) -> bytes:
        """Token ids (int32) of a piece without ASCII white space. Added tokens are looked for in the raw text; what is between them is normalised and
        split into words as the file says."""
        out: list[bytes] = []
        for part in self.cut(piece) if b"<" in piece or not self.ascii_words else (piece,):
            if part in self.added:
                out.append(np.int32(self.added[part]).tobytes())
            elif part:
                words = self.ascii_words(part) if self.ascii_words else None
                if words is None:
                    text = part.decode()
                    if self.lib.normalizer is not None:
                        text = self.lib.normalizer.normalize_str(text)
                    words = [word for word, _ in self.lib.pre_tokenizer.pre_tokenize_str(text)]
                out += map(self.words.__getitem__, words)
        self.words.forget(PIECES // 2, PIECE_BYTES)
        return b"".join(out)

    def _offset_table(self, size: int) -> None:
        """All tokens' texts, each with the blank that follows it, in one array of bytes, and where each begins."""
        texts = [b""] * size
        for t, i in [*self.ids.items(), *((t.decode(), i) for t, i in self.added.items())]:
            texts[i] = t.encode() + b" "
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)

    def decode(self, ids: np.ndarray, edges: np.ndarray) -> list[str]:
        """Texts of the runs ids[edges[k]:edges[k + 1]]: tokens with a blank between them, as a file without decoder is decoded."""
        begin = self.starts[ids]
        size = self.starts[ids + 1] - begin
        to = np.concatenate([[0], np.cumsum(size)])
        raw = self.bytes[np.repeat(begin - to[:-1], size) + np.arange(to[-1])].tobytes()
        ends = to[edges].tolist()
        return [raw[a : max(a, b - 1)].decode() for a, b in zip(ends[:-1], ends[1:], strict=True)]


_made: dict[int, Bpe] = {}


def _bpe(spec: bytes) -> Bpe:
    """The tables of a file, made once a worker."""
    key = hash(spec)
    if key not in _made:
        _made.clear()
        _made[key] = Bpe(spec)
    return _made[key]


def encode(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, ids (array of int), as the tokenizers library encodes the whole text with the file
    `vocabulary` (default: VOCABULARY in the session's folder) without special tokens around it; their strings inside a text are those tokens.

    Null and empty texts, and texts of white space, have no ids; very long texts and words are encoded whole in linear time. Repeated rows and ids
    (also null ids) give a row each, no rows none; other columns are not looked at."""
    spark = docs.sparkSession
    sent = sent_bytes(spark, vocabulary or vocabulary_file(spark, VOCABULARY))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(sent.value)
        memo = bpe.pieces
        for batch in batches:
            begun, got, size = 0, [], 0
            for k, text in enumerate(batch.column(1)):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                got.append(np.frombuffer(b"".join(map(memo.__getitem__, raw.split())), np.int32))
                size += len(raw)
                memo.forget(PIECES, PIECE_BYTES)
                if size > BATCH or k == len(batch) - 1:
                    edges = np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(got)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begun, len(got)), ids], names=["doc_id", "ids"])
                    begun, got, size = k + 1, [], 0

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """`encode`'s rows (doc_id, ids) with the text `decoded` of the ids, special tokens included. No ids and null ids give the empty text."""
    spark = encoded.sparkSession
    sent = sent_bytes(spark, vocabulary or vocabulary_file(spark, VOCABULARY))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(sent.value)
        for batch in batches:
            lists = batch.column(1)
            sizes = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], np.int64)
            edges = np.concatenate([[0], np.cumsum(sizes)])
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            i = 0
            while i < len(batch):
                j = max(i + 1, int(np.searchsorted(edges, edges[i] + BATCH // 8, "right")) - 1)
                texts = bpe.decode(ids[edges[i] : edges[j]], edges[i : j + 1] - edges[i])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lists.slice(i, j - i), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])
                i = j

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, ids array<int>, decoded string")


def digest(decoded: DataFrame) -> DataFrame:
    """Of `decode`'s rows: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by one space), decoded_sha256."""
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
