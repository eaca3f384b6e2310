"""Models: OLS vs closed form, k-fold OLS vs per-fold fits, stump vs brute force,
tree ensembles beat the mean on a known signal, seeds reproduce."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.operators.features import assemble
from tarmac.operators.metrics import regression_metrics
from tarmac.plans import models as M
from tarmac.plans.tuning import cross_validate, kfold_ols, param_grid


@pytest.fixture(scope="module")
def signal(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        a, b = rnd.uniform(-3, 3), rnd.uniform(0, 10)
        y = 4.0 + 2.5 * a - 1.5 * b + (6.0 if a > 1 else 0.0) + rnd.gauss(0, 0.5)
        rows.append((i, a, b, y, i % 5))
    return spark.createDataFrame(rows, "id int, a double, b double, y double, fold int").cache()


def test_ols_matches_numpy(spark, signal):
    pdf = signal.toPandas()
    X = np.column_stack([np.ones(len(pdf)), pdf.a, pdf.b])
    want, *_ = np.linalg.lstsq(X, pdf.y.to_numpy(), rcond=None)
    model = M.ols("features", "y").fit(assemble(signal, ["a", "b"]))
    got = [model.intercept, *model.coefficients.toArray()]
    assert np.allclose(got, want, rtol=1e-9)


def test_kfold_ols_matches_per_fold_fits(spark, signal):
    res = {r.fold: r for r in kfold_ols(signal, ["a", "b"], "y").collect()}
    pdf = signal.toPandas()
    rmses = []
    for f in range(5):
        tr, te = pdf[pdf.fold != f], pdf[pdf.fold == f]
        X = np.column_stack([np.ones(len(tr)), tr.a, tr.b])
        beta, *_ = np.linalg.lstsq(X, tr.y.to_numpy(), rcond=None)
        pred = beta[0] + beta[1] * te.a + beta[2] * te.b
        rmse = float(np.sqrt(np.mean((te.y - pred) ** 2)))
        rmses.append(rmse)
        assert np.isclose(res[f].rmse, rmse, rtol=1e-9)
        assert res[f].n_train == len(tr) and res[f].n_test == len(te)
    assert np.isclose(res[0].mean_rmse, np.mean(rmses), rtol=1e-9)


def test_stump_matches_brute_force(spark):
    rnd = random.Random(5)
    rows = [(float(m), rnd.gauss(10 if m > 6 else 0, 1)) for m in [rnd.randint(1, 12) for _ in range(2000)]]
    df = spark.createDataFrame(rows, "m double, y double")
    model = M.stump("features", "y").fit(assemble(df, ["m"]))
    s = M.root_split(model)
    vals = sorted({m for m, _ in rows})
    best = None
    for lo, hi in zip(vals, vals[1:]):
        t = (lo + hi) / 2
        left = [y for m, y in rows if m <= t]
        right = [y for m, y in rows if m > t]
        score = sum(left) ** 2 / len(left) + sum(right) ** 2 / len(right)
        if best is None or score > best[0]:
            best = (score, t, np.mean(left), np.mean(right))
    assert s["threshold"] == best[1]
    assert np.isclose(s["left"], best[2]) and np.isclose(s["right"], best[3])


@pytest.mark.parametrize("make", [
    lambda: M.random_forest("features", "y", num_trees=10, max_depth=4),
    lambda: M.gbt("features", "y", max_depth=2, max_iter=10),
])
def test_trees_beat_mean_and_reproduce(spark, signal, make):
    data = assemble(signal, ["a", "b"])
    train, test = data.where("fold < 4"), data.where("fold = 4")
    m1 = make().fit(train)
    m2 = make().fit(train)
    r = regression_metrics(m1.transform(test), "y").first()
    assert r.r2 > 0.8
    p1 = sorted((x.id, x.prediction) for x in m1.transform(test).select("id", "prediction").collect())
    p2 = sorted((x.id, x.prediction) for x in m2.transform(test).select("id", "prediction").collect())
    assert p1 == p2


def test_cross_validate_with_hash_folds(spark, signal):
    data = assemble(signal, ["a", "b"]).withColumn("fold", F.col("fold") % 3)
    lr = M.linear_regression("features", "y")
    grid = param_grid(lr, {"regParam": [0.01, 1.0], "elasticNetParam": [0.0, 0.5]})
    model, table = cross_validate(lr, grid, data, "y", fold_col="fold", num_folds=3, parallelism=2)
    rows = table.collect()
    assert len(rows) == 4
    best = min(rows, key=lambda r: r.avg_rmse)
    assert "regParam=0.01" in best.params
    assert model.bestModel.getRegParam() == 0.01


def test_metrics_one_aggregate(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (3.0, 3.5)], "label double, prediction double")
    r = regression_metrics(df).first()
    err = np.array([-0.5, 1.0, -0.5])
    assert np.isclose(r.mse, np.mean(err ** 2)) and np.isclose(r.mae, np.mean(np.abs(err)))
    assert np.isclose(r.r2, 1 - np.mean(err ** 2) / np.var([1.0, 2.0, 3.0]))


def test_kfold_evaluate_sizes_and_fold_metrics(spark, signal):
    from tarmac.plans.tuning import kfold_evaluate
    data = assemble(signal, ["a", "b"])
    out = {r.fold: r for r in kfold_evaluate(lambda: M.ols("features", "y"), data, "features", "y",
                                             num_folds=5).collect()}
    assert sorted(out) == [0, 1, 2, 3, 4]
    assert all(r.n_test == 600 and r.n_train == 2400 for r in out.values())
    # fold 0 against a fit on the other folds
    model = M.ols("features", "y").fit(data.where(F.col("fold") != 0))
    ref = regression_metrics(model.transform(data.where(F.col("fold") == 0)), "y").first()
    assert out[0].rmse == pytest.approx(ref.rmse, rel=1e-9)
    assert out[0].mean_rmse == pytest.approx(sum(r.rmse for r in out.values()) / 5, rel=1e-9)
