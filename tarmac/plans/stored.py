"""Fitted pipelines on disk: save in the shared folder, load in another session.

A stored pipeline is a folder with the label tables (Parquet, of any size: the distributed
dictionary is written as it is), the scaler and the model in the built-in format, and ``pipeline`` (one JSON
line: configuration, null policy, bounds, columns). That line is written last, so a folder without it
was not finished and is refused. The grid-search table is not kept.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml.feature import StandardScalerModel
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.clean import ColumnAction, IqrBound, NullPolicyModel
from tarmac.operators.encode import IndexModel
from tarmac.plans.boosting import BoostingModel
from tarmac.plans.pipeline import FittedPipeline, PipelineConfig
from tarmac.plans.regularized import RegularizedModel
from tarmac.sources.readers import path_exists

FORMAT = 1
MODELS = {"ols": LinearRegressionModel, "linreg": LinearRegressionModel, "rf": RandomForestRegressionModel,
          "gbt": GBTRegressionModel, "boosted": GBTRegressionModel}


def _labels(spark: SparkSession, index: IndexModel) -> DataFrame:
    if index.distributed:
        return index.codes.select("column", "value", "idx", "cnt")
    rows = [(c, v, float(i), None) for c in index.cols for i, v in enumerate(index.labels[c])]
    return spark.createDataFrame(rows, "column string, value string, idx double, cnt long")


def save_pipeline(spark: SparkSession, fitted: FittedPipeline, path: str) -> str:
    """Write ``fitted`` to a folder that does not exist yet; returns the path."""
    if path_exists(spark, path):
        raise FileExistsError(f"{path} is there already")
    _labels(spark, fitted.index).write.parquet(f"{path}/labels")
    if fitted.scaler is not None:
        fitted.scaler.write().save(f"{path}/scaler")
    trees = isinstance(fitted.model, (BoostingModel, RegularizedModel))
    if not trees:
        fitted.model.write().save(f"{path}/model")
    policy = fitted.policy
    state = {
        "format": FORMAT,
        "config": asdict(fitted.config),
        "policy": {"actions": [asdict(a) for a in policy.actions], "n_rows": policy.n_rows,
                   "drop_any_null": policy.drop_any_null, "row_filter_cols": list(policy.row_filter_cols)},
        "index": {"cols": list(fitted.index.cols), "order": fitted.index.order, "handle_invalid": fitted.index.handle_invalid,
                  "out_type": fitted.index.out_type, "distributed": fitted.index.distributed},
        "features": list(fitted.features),
        "scaler": fitted.scaler is not None,
        "bounds": [asdict(b) for b in fitted.outlier_bounds],
        "trees": fitted.model.state() if trees else None,
    }
    spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.text(f"{path}/pipeline")
    return path


def load_pipeline(spark: SparkSession, path: str) -> FittedPipeline:
    """The pipeline stored at ``path``; it scores as the saved one did."""
    if not path_exists(spark, f"{path}/pipeline/_SUCCESS"):
        raise FileNotFoundError(f"{path} holds no finished pipeline")
    state = json.loads(spark.read.text(f"{path}/pipeline").first()["value"])
    if state["format"] != FORMAT:
        raise ValueError(f"unknown format {state['format']}")
    config = PipelineConfig(**state["config"])
    policy = NullPolicyModel(**{**state["policy"], "actions": [ColumnAction(**a) for a in state["policy"]["actions"]]})
    own = dict(state["index"])
    table = spark.read.parquet(f"{path}/labels")
    if own.pop("distributed"):
        index = IndexModel(**own, codes=table)
    else:  # it was small enough for the driver when it was fitted
        labels: dict[str, list[str]] = {c: [] for c in own["cols"]}
        for r in table.orderBy("column", F.col("idx")).collect():
            labels[r["column"]].append(r["value"])
        index = IndexModel(**own, labels=labels)
    scaler = StandardScalerModel.load(f"{path}/scaler") if state["scaler"] else None
    own_trees = RegularizedModel if config.model == "regularized" else BoostingModel
    model = own_trees.of(state["trees"]) if state["trees"] else MODELS[config.model].load(f"{path}/model")
    return FittedPipeline(config, policy, index, state["features"], scaler, model, [IqrBound(**b) for b in state["bounds"]])
