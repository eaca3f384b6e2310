"""Pipelines that were saved and loaded score as before, in batch and as a restarted stream."""

from __future__ import annotations

import random

import pytest

from tarmac.operators.encode import fit_index
from tarmac.plans.pipeline import PipelineConfig, fit_pipeline
from tarmac.plans.stored import load_pipeline, save_pipeline
from tarmac.session import scratch_path
from tarmac.streaming.score import stream_score

KEYS = ["id"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    data = [(i, None if i % 11 == 0 else rng.gauss(0, 1), None if i % 3 == 0 else rng.gauss(5, 2), rng.choice(["a", "b", "é", None]), f"t{i % 20}", rng.gauss(0, 3)) for i in range(600)]
    return spark.createDataFrame(data, "id long, x double, z double, kind string, tail string, y double").repartition(3)


def scores(pipeline, df):
    return sorted(tuple(r) for r in pipeline.transform(df).select("id", "prediction").collect())


@pytest.mark.parametrize("cfg", [
    dict(model="linreg", grid={"regParam": [0.0, 0.1]}, handle_invalid="keep"),
    dict(model="rf", model_params={"num_trees": 3}, null_policy="ratio"),
    dict(model="gbt", model_params={"max_iter": 2}, outlier_columns=["y"], outlier_exact=True),
    dict(model="regularized", model_params={"n_estimators": 2}, handle_invalid="keep"),
    dict(model="boosted", model_params={"n_estimators": 2}, scale=False, null_policy="dropna", index_order="alphabetAsc"),
])
def test_saved_scores_as_before(spark, rows, cfg):
    fitted, train, _ = fit_pipeline(rows, PipelineConfig(target="y", keys=KEYS, **cfg))
    path = save_pipeline(spark, fitted, scratch_path(spark, "stored"))
    loaded = load_pipeline(spark, path)
    train.unpersist()
    assert scores(loaded, rows) == scores(fitted, rows) and scores(loaded, rows)
    assert loaded.outlier_bounds == fitted.outlier_bounds and loaded.features == fitted.features
    with pytest.raises(FileExistsError):
        save_pipeline(spark, fitted, path)


def test_distributed_dictionary(spark, rows):
    fitted, train, _ = fit_pipeline(rows, PipelineConfig(target="y", keys=KEYS))
    train.unpersist()
    clean = fitted.policy.transform(rows)
    fitted.index = fit_index(clean, fitted.index.cols, method="distributed")
    loaded = load_pipeline(spark, save_pipeline(spark, fitted, scratch_path(spark, "stored")))
    assert loaded.index.distributed and scores(loaded, rows) == scores(fitted, rows)


def test_unfinished_is_refused(spark, rows):
    path = scratch_path(spark, "stored")
    rows.write.parquet(f"{path}/labels")  # a save that stopped before its last step
    with pytest.raises(FileNotFoundError):
        load_pipeline(spark, path)


def test_restarted_stream_goes_on_with_the_same_fit(spark, rows):
    fitted, train, _ = fit_pipeline(rows, PipelineConfig(target="y", keys=KEYS))
    train.unpersist()
    path = save_pipeline(spark, fitted, scratch_path(spark, "stored"))
    src, sink = scratch_path(spark, "src"), scratch_path(spark, "sink")
    for part in (rows.where("id < 300"), rows.where("id >= 300")):
        part.write.mode("append").parquet(src)
        out = stream_score(spark, load_pipeline(spark, path), src, rows.schema, sink_dir=sink)  # a new object each time
    assert sorted(tuple(r) for r in out.select("id", "prediction").collect()) == scores(fitted, rows)
