"""op12 against exact fractions and numpy, on the given vectors and on odd ones."""

import math
import os
from fractions import Fraction

import numpy as np
import pytest

from railtable.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, v double, n string, whitened int"


def brute(vectors):
    """n, S, covariance as fractions, of the usable vectors."""
    x = [[math.floor(64 * Fraction(c)) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(col) for col in zip(*x, strict=True)]
    cov = [[Fraction(sum((n * r[a] - sums[a]) * (n * r[b] - sums[b]) for r in x), n**3) for b in range(d)] for a in range(d)]
    return x, n, sums, cov


def frame(spark, vectors):
    return spark.createDataFrame([(k, v, 0.5, "x", 1) for k, v in enumerate(vectors)], SCHEMA)


def usable(vectors, d):
    return [(k, v) for k, v in enumerate(vectors) if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]


def check(spark, vectors, d):
    df = frame(spark, vectors)
    model = whitening.fit(df)
    own = usable(vectors, d)
    x, n, sums, cov = brute([v for _, v in own])
    assert (model.n, len(model.mean)) == (n, d)
    assert [n * m + r for m, r in zip(model.mean, model.rest, strict=True)] == sums
    exact = np.array([[float(c) for c in row] for row in cov])
    e, vec = model.values, model.vectors
    assert np.allclose(vec.T @ vec, np.eye(len(e)), atol=1e-12) and (np.diff(e) <= 0).all()
    assert np.allclose(exact @ vec, vec * e, rtol=0, atol=1e-12 * max(1.0, abs(exact).max()) * d)
    got = whitening.report(df, whitening.with_identity_error(df, model)).collect()
    assert len(got) == len(own) * len(e)
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(r, sums, strict=True)] for r in x])
    want = centred @ vec / np.sqrt(e)
    at = {k: i for i, (k, _) in enumerate(own)}
    for r in got:
        i = at[r.vec_id]
        deviation = sum((n * a - s) ** 2 for a, s in zip(x[i], sums, strict=True))
        assert r.deviation == (deviation if deviation < 2**63 else None) and (r.deviation_exact is None or int(r.deviation_exact) == deviation) and r.n == n
        assert abs(r.whitened - want[i, r.component - 1]) < 1e-9 * max(1, abs(want[i, r.component - 1]))
        assert abs(r.explained / (e[r.component - 1] / np.trace(exact)) - 1) < 1e-9 and r.identity_error < 1e-4
    return model


def test_plain(spark):
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(9, 9))
    vectors = (rng.normal(size=(700, 9)) @ mix).astype(np.float32).tolist()
    vectors[5] = vectors[6] = vectors[7]
    check(spark, vectors, 9)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(60, 4)).astype(np.float32).tolist()
    vectors += [None, [], [1.0, None, 2.0, 3.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0], [0.0] * 5]
    check(spark, vectors, 4)


def test_large_values_stay_exact(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(80, 3)) * [1e9, 1e11, 1e12] + [1e7, -1e9, 1e13]).astype(np.float32).tolist()
    check(spark, vectors, 3)
    model = whitening.fit(frame(spark, [[3e38, 1.0], [-3e38, 2.0], [0.0, 4.0]]))  # beyond a long: held at the bound
    assert model.n == 3 and np.isfinite(model.values).all()


def test_more_dimensions_than_rows_and_no_variance(spark):
    rng = np.random.default_rng(4)
    model = check(spark, rng.normal(size=(6, 20)).astype(np.float32).tolist(), 20)
    assert len(model.values) == 5
    for vectors in ([], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5):
        df = frame(spark, vectors)
        assert whitening.report(df, whitening.with_identity_error(df, whitening.fit(df))).count() == 0


def test_squares_switch_to_whole_numbers():
    y = np.array([[3, -(1 << 33), 5], [1, 1 << 33, -7]], np.int64)
    z = y.astype(object)
    want = [[sum((r[a] + (r[b] if b != a else 0)) ** 2 for r in z.tolist()) if a <= b else 0 for b in range(3)] for a in range(3)]
    assert whitening.squares(y).tolist() == whitening.squares(z).tolist() == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_query(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in df.collect()}
    x, n, sums, cov = brute(vectors.values())
    e, vec = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    e, vec = e[::-1][:32], vec[:, ::-1][:, :32]
    white = (np.array([[float(Fraction(n * a - s, n)) for a, s in zip(r, sums, strict=True)] for r in x]) @ vec) / np.sqrt(e)
    at = {k: i for i, k in enumerate(vectors)}
    got = queries.op12_embedding_whitening(spark, SF).collect()
    assert len(got) == n * 32 and max(r.identity_error for r in got) < 1e-10
    assert max(abs(abs(r.whitened) - abs(white[at[r.vec_id], r.component - 1])) for r in got) < 1e-8
    assert all(r.deviation == sum((n * a - s) ** 2 for a, s in zip(x[at[r.vec_id]], sums, strict=True)) for r in got if r.component == 1)
