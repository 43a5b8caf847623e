"""Whitening against a plain eigendecomposition of the whole covariance."""

import math
from fractions import Fraction

import numpy as np
import pytest

from perilscope.llm import queries, whitening

VECTORS = "vec_id bigint, embedding array<float>, label int"


def plain(vectors):
    """n, S, eigenvalues (falling), vectors and trace over the distinct x."""
    x = np.array(sorted({tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for v in vectors}), dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    y = (n * x - s) / n
    values, columns = np.linalg.eigh(y.T @ y / n)
    return n, s, values[::-1], columns[:, ::-1], (y * y).sum() / n


def check_rows(rows, vectors, components=16):
    n, s, values, columns, trace = plain([v for _, v in vectors])
    assert len(rows) == len(vectors) * components
    by_key = {(r["vec_id"], r["component"]): r for r in rows}
    for k in range(components):
        signs = set()
        for i, v in vectors:
            r = by_key[(i, k + 1)]
            x = np.array([math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v])
            want = ((n * x - s) / n) @ columns[:, k] / math.sqrt(values[k])
            sign = 1 if want * r["whitened"] >= 0 else -1
            assert r["whitened"] == pytest.approx(sign * want, rel=1e-7, abs=1e-7)
            if abs(want) > 1e-3:
                signs.add(sign)
            assert r["deviation"] == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, s)) and r["n"] == n
            assert r["explained"] == pytest.approx(values[k] / trace, rel=1e-9) and r["identity_error"] < 1e-9
        assert len(signs) == 1


def test_components_match_plain_decomposition(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 20)) @ np.diag(np.linspace(3, 0.2, 20)) @ rng.standard_normal((20, 20))
    vectors = [(n, v.astype(np.float32).tolist()) for n, v in enumerate(base)]
    copies = [(1000 + n, vectors[7][1]) for n in range(200)]
    rows = spark.createDataFrame([(i, v, 0) for i, v in vectors + copies], VECTORS)
    check_rows(whitening.whiten(rows).collect(), vectors + copies)


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    rows = queries.op13_whitening(spark, sf)
    assert rows.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_rows(rows.collect(), vectors)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.1, 0.2, 0.3]), (1, [0.5, 0.1, -0.3]), (None, [0.0, -0.9, 0.3]), (4, [0.5, 0.1, -0.3]), (5, [1.0, 1.0, 0.3])]
    odd = [(10, None), (11, []), (12, [0.1, None, 0.2]), (13, [nan, 0.0, 0.0]), (14, [inf, 0.0, 0.0]), (15, [0.0, -inf, 0.0]), (16, [1e30, 0.0, 0.0])]
    odd += [(17, [0.1, 0.2]), (18, [0.1, 0.2, 0.3, 0.4])]
    rows = spark.createDataFrame([(i, v, 0) for i, v in good + odd], VECTORS)
    found = whitening.whiten(rows).collect()
    assert len(found) == 5 * 3 and {r["vec_id"] for r in found} == {1, None, 4, 5} and {r["n"] for r in found} == {4}
    assert {(r["vec_id"], r["component"]) for r in found} == {(i, k) for i, _ in good for k in (1, 2, 3)}
    assert max(r["identity_error"] for r in found) < 1e-9
    more = rows.withColumnsRenamed({"label": "x"}).selectExpr("*", "1 AS n", "2 AS component", "3 AS _vector", "4 AS data")
    key = lambda r: (r["vec_id"] or 0, r["component"], r["whitened"])
    assert [tuple(r)[:4] for r in sorted(whitening.whiten(more).collect(), key=key)] == [tuple(r)[:4] for r in sorted(found, key=key)]


def test_no_variance_no_rows(spark):
    same = spark.createDataFrame([(n, [0.5, 0.25], 0) for n in range(9)], VECTORS)
    for rows in (same, same.limit(0), spark.createDataFrame([(1, None, 0), (2, [], 0)], VECTORS)):
        assert whitening.whiten(rows).count() == 0
    line = spark.createDataFrame([(n, [n / 4, n / 2, 0.0], 0) for n in range(9)], VECTORS)
    found = whitening.whiten(line).collect()
    assert {r["component"] for r in found} == {1} and found[0]["explained"] == pytest.approx(1.0, rel=1e-12)
    assert sum(r["whitened"] ** 2 for r in found) / 9 == pytest.approx(1.0, rel=1e-12)


def test_deviation_is_exact_or_missing():
    v = np.array([[3_000_000_000, 5, -7], [0, 0, 0], [2_000_000_000, -2_000_000_000, 3]], dtype=np.int64)
    found = whitening.squared_lengths(v)
    assert found.tolist() == [9 * 10**18 + 74, 0, 8 * 10**18 + 9]
    assert whitening.squared_lengths(np.array([[3_100_000_000, 0]])).tolist() == [None]
    assert Fraction(int(found[0])) == sum(Fraction(int(a)) ** 2 for a in v[0])


@pytest.mark.parametrize("spectrum", ["even", "clustered", "steep", "equal", "low rank"])
@pytest.mark.parametrize("dimension", [5, 64, 400])
def test_pairs_of_known_matrices(spectrum, dimension):
    rng = np.random.default_rng(dimension)
    turn = np.linalg.qr(rng.standard_normal((dimension, dimension)))[0]
    at = np.arange(dimension)
    values = {
        "even": np.linspace(1, 0.01, dimension),
        "clustered": np.where(at < 10, 5 + at / 1e4, 1 / (1 + at)),
        "steep": 10.0 ** (-at / 4),
        "equal": np.where(at < 7, 3.0, 1.0),
        "low rank": np.where(at < 6, 1.0 + at, 0.0),
    }[spectrum]
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    passes = []
    found, vectors = whitening.leading_pairs(lambda u: passes.append(u.shape) or matrix @ u, dimension, 16)
    wanted = min(16, dimension)
    assert found == pytest.approx(np.sort(values)[::-1][:wanted], rel=1e-11, abs=1e-13)
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-13
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() <= 8 * math.sqrt(dimension) * 2.3e-16 * values.max()
    assert len(passes) <= 120, len(passes)


def test_minres_solves():
    rng = np.random.default_rng(1)
    half = rng.standard_normal((30, 30))
    matrix, right = half + half.T, rng.standard_normal((30, 4))
    right[:, 2] = 0
    found = whitening.minres(lambda t: matrix @ t, right, 60, 1e-13)
    assert np.abs(matrix @ found - right).max() < 1e-8 and not found[:, 2].any()
