"""Whitening of embeddings from an exact covariance: squared centred values of each dimension and of each sum of two dimensions.

Entries become longs x = floor(64 * entry) + 1,000,000. A first pass adds them up exactly; a second takes the whole part m of each dimension's
mean off, y = x - m, and adds up the squares of y_a and of y_a + y_b, again exactly. Sums stay right when the mean is not whole: with
r = sum(y), n * sum(y^2) - r^2 is n^2 times the variance, to the last digit. The covariance of two dimensions is half of what is left of the
variance of their sum without their own variances. What reaches the driver is a row for each pair of dimensions, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtable.llm.common import cut, drop_cut

SCALE, SHIFT = 64.0, 1_000_000
#: An entry whose long would be beyond this is held there.
BOUND = float(1 << 62)
COMPONENTS = 32
#: Rows of vectors that are worked on at once.
BLOCK = 4096
#: Whole sums travel as longs of so many bits each, lowest first, so that Spark adds up 2^23 of them without overflow.
BITS, LIMBS = 40, 4
_I64 = 1 << 62


@dataclass(frozen=True)
class Whitening:
    n: int
    mean: list[int]  # whole part m of each dimension's mean
    rest: list[int]  # r = sum of x - m, at least 0 and less than n
    values: np.ndarray  # eigenvalues e, falling
    vectors: np.ndarray  # a column for each component
    trace: float
    identity_error: float | None = None


def _longs(vectors: pa.Array, dims: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, x) of the usable vectors by length, or of those of `dims` entries, BLOCK rows at a time: neither null nor with a null or
    non-finite entry."""
    sizes = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    first = np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))])
    flat = vectors.flatten()
    entries = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False)
    for d in np.unique(sizes[sizes > 0]).tolist() if dims is None else [dims]:
        own = np.flatnonzero(sizes == d)
        for k in range(0, len(own), BLOCK):
            some = own[k : k + BLOCK]
            c = entries[first[some][:, None] + np.arange(d)]
            fine = np.isfinite(c).all(axis=1)
            with np.errstate(over="ignore"):
                yield some[fine], np.clip(np.floor(SCALE * c[fine]), -BOUND, BOUND).astype(np.int64) + SHIFT


def _centred(x: np.ndarray, mean: list[int]) -> np.ndarray:
    """x - m as longs, or as Python integers where longs are too short for what follows."""
    if max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))), *map(abs, mean)) >= _I64 // 2:
        return x.astype(object) - np.array(mean, object)
    return x - np.array(mean, np.int64)


def _largest(y: np.ndarray) -> int:
    return max((abs(int(y.min())), abs(int(y.max()))), default=0) if y.size else 0


def _pieces(v: int) -> list[int]:
    """A whole number that is not negative, in LIMBS pieces."""
    return [(v >> (BITS * k)) & ((1 << BITS) - 1) for k in range(LIMBS - 1)] + [v >> (BITS * (LIMBS - 1))]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each length and dimension: rows and the exact sum of x."""
    n: dict[int, int] = {}
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for _, x in _longs(batch.column(0)):
            if len(x):
                d = x.shape[1]
                n[d] = n.get(d, 0) + len(x)
                small = _largest(x) < _I64 // BLOCK
                total[d] = total.get(d, np.zeros(d, object)) + (x.sum(axis=0).astype(object) if small else x.astype(object).sum(axis=0))
    for d in sorted(n):
        yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n[d]] * d, pa.int64()), pa.array([Decimal(int(s)) for s in total[d]], pa.decimal128(38, 0))], names=["dims", "dim", "n", "total"])


def squares(y: np.ndarray) -> np.ndarray:
    """Exact sums over the rows of y_a^2 (on the diagonal) and of (y_a + y_b)^2, for a < b; Python integers."""
    d = y.shape[1]
    step = len(y) if y.dtype == object else min(len(y), _I64 // max(1, 4 * _largest(y) ** 2))
    if y.dtype != object and step < 1:
        y, step = y.astype(object), len(y)
    out = np.zeros((d, d), object)
    for k in range(0, len(y), max(1, step)):
        part = y[k : k + step]
        for a in range(d):
            z = part[:, a:].copy()
            z[:, 1:] += part[:, a : a + 1]
            out[a, a:] += (z * z).sum(axis=0).astype(object)
    return out


def fit(rows: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Means, exact covariance and its eigenvectors over all usable vectors of `rows`.

    A vector is usable if it is neither null nor holds null or non-finite entries, and has the length that most of these have (a tie goes to the
    longest; other lengths share no covariance with it and, like the empty vector, are left out). Equal rows count each. Components of no variance
    (below the rounding of the largest eigenvalue) have no whitened form and are left out; the covariance is exact, but eigh works in doubles, so
    an eigenvalue has a relative error of about 1e-16 times the largest over it: identity_error shows it where entries are of very unlike sizes. No usable row gives n = 0 and no component.
    """
    vectors = rows.select(F.col(vec_col).cast("array<double>").alias("v"))
    sums = cut(vectors.mapInArrow(_sums, "dims int, dim int, n long, total decimal(38,0)").groupBy("dims", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "sums")
    most = sums.where("dim = 0").orderBy(F.desc("n"), F.desc("dims")).limit(1).select("dims")
    found = sorted((r["dim"], r["n"], int(r["total"])) for r in sums.join(F.broadcast(most), "dims").collect())
    drop_cut(sums)
    if not found:
        return Whitening(0, [], [], np.zeros(0), np.zeros((0, 0)), 0.0)
    n, d = found[0][1], len(found)
    mean = [total // n for *_, total in found]
    rest = [total - n * m for (*_, total), m in zip(found, mean, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        some = False
        for batch in batches:
            for _, x in _longs(batch.column(0), d):
                if len(x):
                    total, some = total + squares(_centred(x, mean)), True
        a, b = np.triu_indices(d) if some else (np.zeros(0, int), np.zeros(0, int))
        limbs = np.array([_pieces(v) for v in total[a, b]], np.int64).reshape(-1, LIMBS)
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), *(pa.array(limbs[:, k]) for k in range(LIMBS))], names=["a", "b", *(f"q{k}" for k in range(LIMBS))])

    schema = "a int, b int, " + ", ".join(f"q{k} long" for k in range(LIMBS))
    parts = vectors.mapInArrow(run, schema).groupBy("a", "b").agg(*(F.sum(f"q{k}").alias(f"q{k}") for k in range(LIMBS)))
    q = {(r["a"], r["b"]): sum(r[f"q{k}"] << (BITS * k) for k in range(LIMBS)) for r in parts.collect()}
    own = [n * q[a, a] - rest[a] ** 2 for a in range(d)]  # n^2 times the variance
    cov = np.zeros((d, d))
    for (a, b), v in q.items():
        both = own[a] if a == b else (n * v - (rest[a] + rest[b]) ** 2 - own[a] - own[b])
        cov[a, b] = cov[b, a] = both / (n * n * (1 if a == b else 2))
    values, vectors_ = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > max(values.max(), 0.0) * d * np.finfo(float).eps]
    e, found_vectors = values[order], vectors_[:, order]
    found_vectors = found_vectors * np.sign(found_vectors[np.abs(found_vectors).argmax(axis=0), np.arange(len(order))])
    return Whitening(n, mean, rest, e, found_vectors, sum(own) / (n * n))


def _project(model: Whitening, y: np.ndarray) -> np.ndarray:
    return (y.astype(float) - np.array(model.rest, float) / model.n) @ (model.vectors / np.sqrt(model.values))


def _deviations(model: Whitening, y: np.ndarray) -> list[int]:
    """Exact sum over the dimensions of (n * x - S)^2 = (n * y - r)^2, for each row."""
    n, d, top = model.n, y.shape[1], _largest(y)
    if y.dtype != object and d * (n * (top + 1)) ** 2 < _I64:
        z = n * y - np.array(model.rest, np.int64)
        return (z * z).sum(axis=1).tolist()
    if y.dtype == object or d * (top + 1) * max(top, n) >= _I64:
        y = y.astype(object)
    squared, crossed = (y * y).sum(axis=1).tolist(), (y * np.array(model.rest, y.dtype)).sum(axis=1).tolist()
    left = sum(r * r for r in model.rest)
    return [n * n * a - 2 * n * b + left for a, b in zip(squared, crossed, strict=True)]


def with_identity_error(rows: DataFrame, model: Whitening, vec_col: str = "embedding") -> Whitening:
    """The model with the largest absolute entry of the whitened rows' covariance minus the identity, measured over all rows."""
    k, d = len(model.values), len(model.mean)
    if not k:
        return model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, cross = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, x in _longs(batch.column(0), d):
                w = _project(model, _centred(x, model.mean))
                total += w.sum(axis=0)
                cross += w.T @ w
        a, b = np.triu_indices(k)
        a, b, v = np.concatenate([a, np.arange(k)]), np.concatenate([b, np.full(k, -1)]), np.concatenate([cross[a, b], total])
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(v)], names=["a", "b", "v"])

    vectors = rows.select(F.col(vec_col).cast("array<double>").alias("v"))
    found = {(r["a"], r["b"]): r["v"] / model.n for r in vectors.mapInArrow(run, "a int, b int, v double").groupBy("a", "b").agg(F.sum("v").alias("v")).collect()}
    error = max(abs(v - found[a, -1] * found[b, -1] - (a == b)) for (a, b), v in found.items() if b >= 0)
    return Whitening(model.n, model.mean, model.rest, model.values, model.vectors, model.trace, float(error))


def whiten(rows: DataFrame, model: Whitening, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row for each usable row of `rows` (see `fit`): vec_id, whitened (array of a value for each component), deviation (the exact sum of
    squares of n * x - S; null beyond a long) and deviation_exact (the same as decimal; null beyond 38 digits). Repeated and null ids give a row
    each; other columns are not looked at; no usable rows give none."""
    d = len(model.mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, x in _longs(batch.column(1), d) if d else ():
                y = _centred(x, model.mean)
                w = _project(model, y)
                exact = _deviations(model, y) if len(y) else []
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own)), lists, pa.array([v if v < 1 << 63 else None for v in exact], pa.int64()), pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))],
                    names=["vec_id", "whitened", "deviation", "deviation_exact"],
                )

    got = rows.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    return got.mapInArrow(run, f"vec_id {dict(got.dtypes)['vec_id']}, whitened array<double>, deviation long, deviation_exact decimal(38,0)")


def report(rows: DataFrame, model: Whitening, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row for each usable row and component: vec_id, component (from 1), n, deviation, deviation_exact, whitened, explained, identity_error."""
    shares = F.array(*(F.lit(float(e / model.trace)) for e in model.values)) if len(model.values) else F.array().cast("array<double>")
    each = whiten(rows, model, id_col, vec_col).select("vec_id", "deviation", "deviation_exact", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "deviation_exact", "whitened",
        F.get(shares, F.col("place")).alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
