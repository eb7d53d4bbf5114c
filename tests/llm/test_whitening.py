"""Whitening against NumPy's eigenvalue solver and plain integers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoprank.llm.whitening import components_of, fit, qdwh, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("n", [1, 2, 7, 64, 130])
def test_components_are_those_of_eigh(n):
    rng = np.random.default_rng(n)
    a = rng.standard_normal((n, n))
    a = a @ a.T
    values, vectors = np.linalg.eigh(a)
    found = components_of(a, 8)
    want = vectors[:, ::-1][:, :8]
    assert found.shape == want.shape
    assert np.abs(found * np.sign((found * want).sum(axis=0)) - want).max() < 1e-10


@pytest.mark.parametrize("values", [[5, 5, 5, 1, 1], [3] * 6, [0] * 4, [1, 0, 0, 0], [1e9, 1, 1e-3], [2, 2 - 1e-12, 1], [4, 1, 1, -2]])
def test_components_of_repeated_and_close_eigenvalues(values):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((len(values),) * 2))[0]
    a = q @ np.diag(np.array(values, float)) @ q.T
    found = components_of((a + a.T) / 2, len(values))
    assert np.abs(found.T @ found - np.eye(len(values))).max() < 1e-13
    own = found.T @ a @ found
    assert np.abs(own - np.diag(sorted(values, reverse=True))).max() < 1e-13 * max(1, np.abs(values).max()) * 10


def test_qdwh_is_the_polar_factor():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    values, vectors = np.linalg.eigh(a)
    assert np.abs(qdwh(a) - vectors @ np.diag(np.sign(values)) @ vectors.T).max() < 1e-12


def rows_of(n, d, seed=0):
    rng = np.random.default_rng(seed)
    mixing = rng.standard_normal((d, d)) * np.linspace(2, 0.1, d)
    return [(k, [float(v) for v in (rng.standard_normal(d) @ mixing.T).astype(np.float32)], 1) for k in range(n)]


def test_whitening_equals_plain_numbers(spark):
    rows = rows_of(300, 12)
    rows += [rows[0], (None, rows[1][1], None)]
    bad = [(900, None, 1), (901, [float("nan")] + [0.0] * 11, 1), (902, [float("inf")] + [0.0] * 11, 1), (903, [1.0] * 5, 1), (904, [], 1),
           (905, [None] + [0.0] * 11, 1), (906, [3e38] + [0.0] * 11, 1)]
    given = spark.createDataFrame(rows + bad, SCHEMA).withColumns({"id": F.lit("x"), "vector": F.lit(1), "n": F.lit(2)})
    out = whiten(given.repartition(5)).collect()
    x = np.array([[int(np.floor(1024 * v)) + 100_000 for v in r[1]] for r in rows], np.int64)
    n, s = len(x), x.sum(axis=0)
    deviation = ((n * x - s) ** 2).sum(axis=1)
    cov = np.cov(x.T, bias=True)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    white = (x - s / n) @ vectors / np.sqrt(values)
    assert len(out) == 8 * n and {r["n"] for r in out} == {n}
    sign = {}
    by_id = {r[0]: k for k, r in enumerate(rows) if k != 300}
    for r in out:
        k, c = by_id[r["vec_id"]], r["component"] - 1
        assert r["deviation"] == deviation[k]
        assert r["explained"] == pytest.approx(values[c] / np.trace(cov), rel=1e-10)
        sign.setdefault(c, np.sign(r["whitened"] * white[k, c]))
        assert r["whitened"] * sign[c] == pytest.approx(white[k, c], abs=1e-8)
        assert r["identity_error"] < 1e-10
    assert sum(r["vec_id"] == 0 for r in out) == 16 and sum(r["vec_id"] is None for r in out) == 8


def test_fit_is_exact_for_large_offsets_and_entries(spark):
    rows = [(k, [1e9 + k, float(k % 3), 2.0 ** 40 * (k % 2)], 1) for k in range(50)]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    model = fit(given)
    x = [[int(np.floor(1024 * v)) + 100_000 for v in r[1]] for r in rows]
    sums = [sum(c) for c in zip(*x)]
    trace = sum((50 * v - s) ** 2 for r in x for v, s in zip(r, sums)) / 50 ** 3
    assert model.n == 50 and model.sums == sums and model.trace == pytest.approx(trace, rel=1e-15)
    assert model.deviations(np.array(x, np.int64)[:1]) == [None]  # beyond a long


def test_no_variance_and_empty_tables(spark):
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0], 1)] * 3, SCHEMA)).count() == 0
    flat = whiten(spark.createDataFrame([(k, [float(k), 1.0], 1) for k in range(4)], SCHEMA)).collect()
    assert len(flat) == 4 and {r["component"] for r in flat} == {1}
