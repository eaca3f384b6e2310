"""Cross products of many columns, and linear grids solved from them."""

from __future__ import annotations

import numpy as np
import pytest

from tarmac.operators.features import assemble
from tarmac.operators.moments import cross_products
from tarmac.operators.profile import correlation_matrix
from tarmac.plans import models as M
from tarmac.plans.linear_grid import coordinate_descent, grid_points, linear_grid
from tarmac.plans.tuning import cross_validate, param_grid


def _frame(spark, x, names, extra=""):
    rows = [tuple(None if v is None or (isinstance(v, float) and np.isnan(v)) else v for v in r) for r in x]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + extra).repartition(5)


def test_a_hundred_columns_with_nulls(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(1e6, 3, (400, 100)) + rng.normal(0, 2, (400, 1))
    x[rng.random(x.shape) < 0.2] = np.nan
    names = [f"c{i}" for i in range(100)]
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in correlation_matrix(_frame(spark, x.tolist(), names), names).collect()}
    assert len(got) == 10_000
    for i in range(0, 100, 7):
        for j in range(100):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            want = np.corrcoef(x[both, i], x[both, j])[0, 1]
            assert got[f"c{i}", f"c{j}"] == pytest.approx(want, abs=1e-9)


def test_correlation_of_constant_empty_and_nan(spark):
    rows = [(1.0, 5.0, None, float("nan")), (2.0, 5.0, None, 1.0), (4.0, 5.0, None, 2.0)]
    df = spark.createDataFrame(rows, "a double, k double, n double, z double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in correlation_matrix(df).collect()}
    assert got["a", "a"] == 1 and got["a", "k"] is None and got["a", "n"] is None and got["k", "k"] is None
    assert np.isnan(got["a", "z"]) and np.isnan(got["z", "z"])
    assert {r["corr"] for r in correlation_matrix(df.limit(0)).collect()} == {None}


def test_groups(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (200, 3))
    fold = np.arange(200) % 4
    df = _frame(spark, [(*r, int(f)) for r, f in zip(x.tolist(), fold, strict=True)], ["a", "b", "c"], ", f int")
    got = cross_products(df, ["a", "b", "c"], [0.5, 0, 0], "f")
    for k in range(4):
        n, mean, c = got[str(k)].comoments()
        own = x[fold == k]
        assert n == 50 and np.allclose(mean, own.mean(axis=0)) and np.allclose(c, np.cov(own.T, bias=True) * 50)


def test_grid_equals_the_cross_validator(spark):
    """Six points and a plain one, correlated columns, one constant, one without effect."""
    rng = np.random.default_rng(3)
    n = 900
    a, b, c = rng.normal(0, 1, n), rng.normal(5, 20, n), rng.normal(0, 0.1, n)
    d = 0.7 * a + rng.normal(0, 0.5, n)
    y = 3 * a - 0.2 * b + 4 * d + rng.normal(0, 2, n)
    rows = [(*map(float, r), 7.0, int(i % 3)) for i, r in enumerate(zip(a, b, c, d, y, strict=True))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y double, k double, fold int").repartition(4)
    features = ["a", "b", "c", "d", "k"]
    lr = M.linear_regression("features", "y", max_iter=1000)
    lr.setTol(1e-12)
    for grid in ({"regParam": [2.0, 0.1, 0.01], "elasticNetParam": [0.0, 0.5, 1.0]}, {"regParam": [0.0]}):
        _, want = cross_validate(lr, param_grid(lr, grid), assemble(df, features), "y", fold_col="fold", num_folds=3)
        best, got = linear_grid(df, features, "y", grid, fold_col="fold")
        want, got = [tuple(r) for r in want.collect()], [tuple(r) for r in got.collect()]
        assert [p for p, _ in want] == [p for p, _ in got]
        assert np.allclose([e for _, e in want], [e for _, e in got], rtol=1e-6)
        assert best == grid_points(grid)[int(np.argmin([e for _, e in want]))]


def test_coordinate_descent_meets_its_conditions():
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (60, 8))
    x[:, 7] = x[:, 0]
    gram, target = x.T @ x / 60, x.T @ rng.normal(0, 1, 60) / 60
    b = coordinate_descent(gram, target, 0.05, 0.02, np.zeros(8))
    slope = gram @ b - target + 0.02 * b
    assert np.all(np.abs(slope[b == 0]) <= 0.05 + 1e-9) and np.allclose(slope[b != 0], -0.05 * np.sign(b[b != 0]), atol=1e-9)


def test_refused(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0)], "a double, y double, fold int")
    with pytest.raises(ValueError):
        linear_grid(df, ["a"], "y", {"maxIter": [1]}, "fold")
    with pytest.raises(ValueError):
        linear_grid(df, ["a"], "y", {"regParam": [1.0]}, "fold")
