"""Whitening against numpy's eigenvectors and exact integers."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import whitening
from corpusprep.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"


def floored(v):
    return tuple(math.floor(256 * c) + 0 for c in v)


def brute(rows, k=4):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} of rows with complete vectors."""
    good = [(i, floored(v)) for i, v in rows]
    x = np.array(sorted({v for _, v in good}), object)
    n, sums = len(x), x.sum(0)
    centred = lambda v: [float(Fraction(n * c - s, n)) for c, s in zip(v, sums)]
    y = np.array([centred(v) for v in x])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    out = []
    for i, v in good:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        z = np.array(centred(v)) @ u
        out += [(i, c + 1, n, deviation, abs(z[c] / math.sqrt(e[c])), e[c] / e.sum()) for c in range(k)]
    return out


def held(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3]))


def compare(df, rows):
    got, want = held(df), sorted(brute(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3]))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert tuple(g[:4]) == w[:4]
        assert abs(g[4]) == pytest.approx(w[4], rel=1e-8, abs=1e-10) and g[5] == pytest.approx(w[5], rel=1e-10)
        assert g[6] < 1e-9


def vectors(seed=3, n=80, d=6):
    rng = random.Random(seed)
    return [(i, [rng.gauss(j, 1 + j) for j in range(d)]) for i in range(n)]


def test_against_numpy(spark):
    rows = vectors()
    rows += [(100 + i, rows[0][1]) for i in range(300)] + [(5, rows[5][1]), (None, rows[6][1])]
    bad = [(900, None), (901, [None] * 6), (902, [math.nan] + [0.0] * 5), (903, [math.inf] + [0.0] * 5), (904, []), (905, [1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + bad], SCHEMA).repartition(7)
    df = df.withColumns({c: F.lit(1) for c in ("x", "key", "component", "n", "whitened", "i", "v")})
    out = whitening.whiten(df)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(out, rows)


def test_sign_is_the_same_for_all_rows(spark):
    rows = vectors(4)
    got = {(r[0], r[1]): r[4] for r in held(whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)))}
    z = np.array([[got[i, c] for c in range(1, 5)] for i, _ in rows])
    assert np.allclose(np.cov(z.T, bias=True), np.eye(4), atol=1e-10)


def test_far_from_the_origin(spark):
    rows = [(i, [c + 1e9 for c in v]) for i, v in vectors(5, 40, 4)]
    compare(whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)), rows)


def test_large_sums_are_exact(spark):
    rows = [(i, [c * 1e7 for c in v]) for i, v in vectors(6, 30, 4)]
    out = held(whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)))
    for g, w in zip(out, sorted(brute(rows))):
        assert g[3] == (w[3] if w[3] < 2**63 else None)


def test_without_variance(spark):
    # Two dimensions in proportion and a constant one: rank 1 of 3.
    rows = [(i, [i / 256, 2 * i / 256, 7.0], 0) for i in range(5)]
    got = held(whitening.whiten(spark.createDataFrame(rows, SCHEMA)))
    assert [r[1] for r in got] == [1, 2, 3] * 5
    assert [r[4] is None for r in got] == [False, True, True] * 5
    assert [r[5] for r in got] == [pytest.approx(1.0), 0.0, 0.0] * 5
    one = held(whitening.whiten(spark.createDataFrame(rows[:1], SCHEMA)))
    assert [(r[4], r[5], r[6]) for r in one] == [(None, None, None)] * 3


def test_empty(spark):
    out = whitening.whiten(spark.createDataFrame([], SCHEMA))
    assert out.collect() == [] and dict(out.dtypes)["deviation"] == "bigint"


def test_factor_and_rotations():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 9)) @ np.diag(10.0 ** (np.arange(-4, 5) / 2))
    v = x.T @ x / 50
    factor, order = whitening.pivoted_cholesky(v)
    assert np.allclose(factor @ factor.T, v[np.ix_(order, order)], rtol=1e-12) and np.allclose(factor, np.tril(factor))
    assert np.all(np.diff(np.diag(factor)) <= 0)
    e, u = whitening.one_sided_jacobi(factor)
    # The factor is accurate for small eigenvalues as well: the singular values of x say so.
    assert np.allclose(np.sqrt(e), np.linalg.svd(x / math.sqrt(50), compute_uv=False), rtol=1e-9)
    assert np.allclose(u.T @ u, np.eye(9), atol=1e-12)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    out = QUERIES["op11_embedding_whitening"](spark, sf)
    assert out.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
                          ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    compare(out, [(r[0], r[1]) for r in rows])
