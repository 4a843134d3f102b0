"""Components against numpy's eigenvectors, exact deviations, and the cases that take no part."""

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridgate.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def data(spark, n=500, width=12, seed=2):
    r = np.random.default_rng(seed)
    base = (r.normal(0, 1, (n, width)) * np.linspace(1.5, 0.05, width)) @ r.normal(0, 1, (width, width)) + r.normal(0, 3, width)
    base[50:200] = base[50]
    rows = [(k, [float(np.float32(c)) for c in v], 1) for k, v in enumerate(base)]
    rows += [(None, rows[3][1], 1), (7, rows[7][1], 1)]
    odd = [(900, None, 1), (901, [None] + [0.0] * (width - 1), 1), (902, [float("nan")] * width, 1), (903, [float("inf")] * width, 1), (904, [0.5], 1), (905, [], 1)]
    return rows, spark.createDataFrame(rows + odd, SCHEMA).withColumn("x", F.lit("y")).withColumn("whitened", F.lit(2)).repartition(3)


def whole(rows):
    return np.array([[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v, *_ in rows], dtype=object)


def test_components_equal_eigenvectors(spark):
    rows, df = data(spark)
    got = whitening.components(df).collect()
    assert len(got) == 8 * len(rows)
    x = whole(rows)
    n, s = len(x), x.sum(0)
    centred = (x * n - s).astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    want = centred @ vectors[:, :8] / np.sqrt(values[:8])
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append((r["vec_id"] if r["vec_id"] is not None else -1, r["whitened"]))
    for k in range(8):
        mine = [v for _, v in sorted(by[k + 1])]
        theirs = [v for _, v in sorted((-1 if row[0] is None else row[0], v) for row, v in zip(rows, want[:, k]))]
        sign = np.sign(np.dot(mine, theirs))
        assert np.allclose(mine, sign * np.array(theirs), atol=1e-9)
    assert all(abs(r["explained"] / (values[r["component"] - 1] / values.sum()) - 1) < 1e-9 for r in got)
    assert all(0 <= r["identity_error"] < 1e-9 and r["n"] == n for r in got)
    deviations = {(row[0], int(((v * n - s) ** 2).sum())) for row, v in zip(rows, x)}
    assert {(r["vec_id"], int(r["deviation"])) for r in got} == deviations


def test_dependent_and_constant_dimensions(spark):
    r = np.random.default_rng(1)
    rows = [(k, [float(a), float(2 * a), 1.0, float(b)], 0) for k, (a, b) in enumerate(np.round(r.normal(0, 1, (60, 2)) * 64) / 64)]
    got = whitening.components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["component"] for r in got} == {1, 2} and len(got) == 120
    assert all(r["identity_error"] < 1e-9 for r in got)


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [], 0)], [(1, [0.5, 0.25], 0)], [(1, [0.5], 0), (2, [0.5], 0)]])
def test_nothing_to_whiten(spark, rows):
    out = whitening.components(spark.createDataFrame(rows, SCHEMA))
    assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_wide_values_stay_exact(spark):
    r = np.random.default_rng(5)
    rows = [(k, [float(v) for v in row], 0) for k, row in enumerate(r.normal(0, 3e9, (40, 3)))]
    got = whitening.components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    x = whole(rows)
    n, s = len(x), x.sum(0)
    assert {(r["vec_id"], r["deviation"]) for r in got} == {(row[0], Decimal(int(((v * n - s) ** 2).sum()))) for row, v in zip(rows, x)}
    assert all(r["identity_error"] < 1e-9 for r in got)


def test_more_dimensions_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 5)
    rows, df = data(spark, n=120)
    x = whitening.integers(df)
    model = whitening.fit(x)
    a = whole(rows).astype(float)
    assert np.allclose(np.sort(np.linalg.eigvalsh(np.cov(a.T, bias=True)))[::-1], model.values, rtol=1e-8)


def test_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        whitening.components(spark.createDataFrame([(1, [1e30], 0), (2, [1.0], 0)], SCHEMA)).collect()


def test_factor_and_rotation():
    r = np.random.default_rng(0)
    half = r.normal(0, 1, (9, 6))
    v = half @ half.T
    factor = whitening.pivoted_cholesky(v)
    assert factor.shape == (9, 6) and np.allclose(factor @ factor.T, v)
    turned = whitening.one_sided_jacobi(factor)
    gram = turned.T @ turned
    assert np.allclose(gram, np.diag(np.diag(gram)), atol=1e-12)
    assert np.allclose(turned @ turned.T, v)
