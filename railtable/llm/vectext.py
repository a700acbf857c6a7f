"""Whole Arrow string columns as numpy bytes: words, windows of words and their hashes, in bounded blocks.

Everything here runs inside a task on the batches Spark hands it; no text is copied as a Python string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

BLOCK = 1 << 20  # bytes of text that are worked on at once (a longer single text makes a block alone)
LONG = 256  # bytes of a word that the sums are trusted for
_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=_U) * _U(2) + _U(1)
_BASE, _STEP = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
_INV = _U(pow(int(_BASE), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
NOT_SPACE = ~_SPACE  # the words [^\x20\x09-\x0D]+
ALNUM = np.zeros(256, bool)  # the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
_powers = [np.ones(1, _U), np.ones(1, _U)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, BLOCK + 1)
        made = []
        for base in (_BASE, _INV):
            p = np.full(size, base, _U)
            p[0] = 1
            made.append(np.cumprod(p, dtype=_U))
        if size > 4 * BLOCK:  # one very long text: not kept
            return made[0][:n], made[1][:n]
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string or binary array; a null has length 0."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, off


def blocks(off: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have at most `limit` bytes together, or one row."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j
        i = j


def words(data: np.ndarray, off: np.ndarray, i: int, j: int, kind: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of rows i to j: lower-cased bytes, word starts and ends in them, and each row's range of words."""
    base = off[i]
    buf = _LOWER[data[base : off[j]]]
    edge = off[i : j + 1] - base
    inside = kind[buf]
    before = np.zeros(len(buf), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(buf), bool)
    after[:-1] = inside[1:]
    full = edge[:-1] < edge[1:]
    before[edge[:-1][full]] = False
    after[edge[1:][full] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return buf, starts, ends, np.searchsorted(starts, edge)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of each word, from prefix sums of byte codes times powers of an odd base. Words of over LONG bytes, for
    which two with equal sums could be built, are hashed by themselves."""
    if not len(starts):
        return np.zeros(0, _U)
    up, down = _power(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, _U)
    np.cumsum(_BYTE[buf] * up[: len(buf)], out=sums[1:], dtype=_U)
    out = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))
    for k in np.flatnonzero(ends - starts > LONG).tolist():
        out[k] = xxhash.xxh3_64_intdigest(buf[starts[k] : ends[k]].tobytes())
    return out


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words (rows' edges are not looked at)."""
    if len(hashes) < n:
        return np.zeros(0, _U)
    m = len(hashes) - n + 1
    out, factor = np.zeros(m, _U), _U(1)
    for k in range(n):
        out += hashes[k : k + m] * factor
        factor = _U((int(factor) * int(_STEP)) % 2**64)
    return mix(out + _U(n))


def shingle_sets(texts: pa.Array, n: int = 5) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(i, j, hashes, edges) by block: row i+k has the sorted distinct hashes[edges[k]:edges[k+1]] of its
    n-word shingles; fewer words count as one shingle, no word as none."""
    data, off = buffer_of(texts)
    for i, j in blocks(off):
        buf, starts, ends, edge = words(data, off, i, j)
        w = word_hashes(buf, starts, ends)
        s = window_hashes(w, n)
        sets = []
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            if b - a >= n:
                sets.append(np.unique(s[a : b - n + 1]))
            else:
                sets.append(window_hashes(w[a:b], b - a) if b > a else s[:0])
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        yield i, j, np.concatenate(sets) if sets else s[:0], np.concatenate([[0], np.cumsum(sizes)])
