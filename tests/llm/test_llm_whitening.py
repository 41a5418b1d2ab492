"""Whitening against dense eigenvectors and exact sums in plain Python."""

import math

import numpy as np
import pytest

from vitalgrid.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, x string, n long"


def table(spark, vectors):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 0, "x", 1) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def dense(vectors):
    """n, sums, eigenvalues (falling) and eigenvectors of the distinct whole vectors."""
    x = sorted({tuple(math.floor(256 * c) for c in v) for v in vectors})
    x = np.array(x, float)
    centred = x - x.mean(axis=0)
    values, basis = np.linalg.eigh(centred.T @ centred / len(x))
    return len(x), x.sum(axis=0), values[::-1], basis[:, ::-1]


def equals_dense(found, vectors, components=4):
    """Every row against the dense answer; signs may differ by component."""
    good = [(i, v) for i, v in vectors if v is not None]
    n, total, values, basis = dense([v for _, v in good])
    assert len(found) == components * len(good)
    signs = {}
    by_id = {i: np.array([math.floor(256 * c) for c in v]) for i, v in good}
    for row in found:
        k = row["component"] - 1
        x = by_id[row["vec_id"]]
        assert row["n"] == n
        assert row["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, total))
        assert row["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
        assert row["identity_error"] < 1e-9
        want = (x - total / n) @ basis[:, k] / math.sqrt(values[k])
        if abs(want) > 1e-6:
            sign = signs.setdefault(k, np.sign(want * row["whitened"]))
            assert row["whitened"] == pytest.approx(sign * want, rel=1e-6, abs=1e-8)


def test_components_equal_dense_ones(spark):
    r = np.random.default_rng(5)
    vectors = list(enumerate(r.standard_normal((400, 24)) * np.linspace(2, 0.3, 24) @ r.standard_normal((24, 24))))
    vectors += [(1000 + i, vectors[0][1]) for i in range(300)]  # copies count once
    equals_dense(whitening.whitened_components(table(spark, vectors)).collect(), vectors)


@pytest.mark.parametrize("ratio", [1, 1e3, 1e6])
def test_bidiagonal_values_and_vectors(ratio):
    """Also with equal values: a chain that ends early starts again."""
    r = np.random.default_rng(3)
    left = np.linalg.qr(r.standard_normal((60, 12)))[0]
    right = np.linalg.qr(r.standard_normal((12, 12)))[0]
    true = np.array([ratio, ratio, ratio, 5, 5, 4, 3, 2, 1, 1, 0, 0], float)
    x = left * true @ right.T

    def multiply(g, others):
        u = x @ g
        return u @ u, (x @ others).T @ u, x.T @ u

    values, vectors, steps = whitening.bidiagonalised(multiply, 12, float((x**2).sum()), 12)
    assert steps == 12
    assert np.allclose(values, np.sort(true)[::-1], atol=1e-9 * max(true))
    assert np.allclose(vectors.T @ vectors, np.eye(12), atol=1e-12)
    assert np.allclose(np.linalg.norm(x @ vectors, axis=0), values, atol=1e-9 * max(true))


def test_few_steps_when_little_variance_is_left():
    r = np.random.default_rng(4)
    scales = np.array([100, 50, 20, 10, *[0.01] * 60])
    x = r.standard_normal((500, 64)) * scales
    calls = []

    def multiply(g, others):
        calls.append(1)
        u = x @ g
        return u @ u, (x @ others).T @ u, x.T @ u

    values, vectors, steps = whitening.bidiagonalised(multiply, 64, float((x**2).sum()), 4)
    assert steps < 30 and len(calls) < 2 * steps
    dense_values, dense_vectors = np.linalg.eigh(x.T @ x)
    assert np.allclose(values[:4] ** 2, dense_values[::-1][:4], rtol=1e-12)
    assert np.allclose(np.abs((vectors[:, :4] * dense_vectors[:, ::-1][:, :4]).sum(axis=0)), 1, atol=1e-12)


def test_rows_that_are_left_out(spark):
    r = np.random.default_rng(6)
    vectors = [(i, v) for i, v in enumerate(r.standard_normal((50, 5)))]
    odd = [
        (None, vectors[3][1]), (7, vectors[7][1]), (90, None), (91, [1, 2, None, 3, 4]), (92, [1, 2, float("nan"), 3, 4]),
        (93, [float("inf"), 0, 0, 0, 0]), (94, [1e300, 0, 0, 0, 0]), (95, []), (96, [1, 2]),
    ]
    found = whitening.whitened_components(table(spark, vectors + odd)).collect()
    assert sorted({r["vec_id"] for r in found if r["vec_id"] is not None}) == list(range(50))
    assert len(found) == 4 * 52
    once = {(r["vec_id"], r["component"]): r for r in found if r["vec_id"] is not None}
    equals_dense(list(once.values()), vectors)


def test_fewer_dimensions_than_components(spark):
    vectors = [(i, [i, 2 * i, 0.5]) for i in range(20)]  # one dimension varies
    found = whitening.whitened_components(table(spark, vectors)).collect()
    assert {r["component"] for r in found} == {1}
    assert all(r["explained"] == pytest.approx(1) for r in found)


@pytest.mark.parametrize("vectors", [[], [(1, [0.5, 1])], [(1, [0.5, 1]), (2, [0.5, 1])], [(1, None), (2, [])]])
def test_nothing_to_whiten(spark, vectors):
    found = whitening.whitened_components(table(spark, vectors))
    assert found.count() == 0 and found.columns[:2] == ["vec_id", "component"]


def test_large_numbers(spark):
    vectors = [(1, [1e10, 0]), (2, [0, 1]), (3, [-1e10, 5])]
    found = whitening.whitened_components(table(spark, vectors)).collect()
    assert {r["deviation"] for r in found if r["vec_id"] == 1} == {None}  # (3 * 2.56e12)**2 is beyond a long
    assert all(math.isfinite(r["whitened"]) for r in found)


def test_query_equals_dense(spark, smoke_dir):
    rows = spark.read.parquet(f"{smoke_dir}/embeddings.parquet").collect()
    found = queries.QUERIES["op13_embedding_whitening"](spark, smoke_dir).collect()
    equals_dense(found, [(r["vec_id"], r["embedding"]) for r in rows])
