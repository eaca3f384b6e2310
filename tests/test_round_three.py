"""Queries with many passes over the shipment table make it once, whatever the number of passes."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tarmac.operators.clean import iqr_filter
from tarmac.plans import queries as Q
from tarmac.plans.tuning import cross_validate, param_grid
from tarmac.sources.shipments import shipments

LINES = 600


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng, day = random.Random(3), datetime.date(2001, 1, 1)
    orders = [(k, rng.choice("FOP"), 100.0 + rng.randrange(10**5), day + datetime.timedelta(rng.randrange(900)), rng.choice(["1-URGENT", "5-LOW"])) for k in range(LINES // 3)]
    lines = [(k, n, float(rng.randrange(1, 51)), 10.0 + rng.randrange(10**5), rng.randrange(11) / 100, rng.randrange(9) / 100,
              rng.choice("ANR"), rng.choice("FO"), orders[k][3] + datetime.timedelta(rng.randrange(1, 120))) for k in range(LINES // 3) for n in (1, 2, 3)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                                 "l_returnflag string, l_linestatus string, l_shipdate date").write.parquet(f"{path}/lineitem.parquet")
    return path


def counted(spark):
    """(a filter that keeps all rows, the number of rows it has seen)"""
    seen = spark.sparkContext.accumulator(0)

    def see(_):
        seen.add(1)
        return True

    return F.udf(see, "boolean").asNondeterministic(), seen


@pytest.mark.parametrize("name", ["cv_grid", "cv_grid_ridge", "stream_score", "stream_resume", "gbt_predict", "iqr_filter", "iqr_filter_apply",
                                  "dictionary_large", "sweep_records", "lr_flow"])
def test_rows_are_joined_once(spark, tables, monkeypatch, name):
    keep, seen = counted(spark)
    monkeypatch.setattr(Q, "shipments", lambda s, d: shipments(s, d).where(keep("l_orderkey")))
    assert Q.registry()[name](spark, tables).count() > 0
    assert seen.value == LINES


def test_iqr_filter_makes_its_input_once_for_all_bounds(spark):
    keep, seen = counted(spark)
    df = spark.range(200).select((F.col("id") % 50).cast("double").alias("a"), (F.col("id") % 70).cast("double").alias("b")).where(keep("id"))
    out, bounds = iqr_filter(df, ["a", "b"], factor=0.1, exact=True, count_rows=True)
    assert seen.value == 200
    assert bounds[-1].rows_after == out.count() < bounds[0].rows_after < 200


def test_cross_validation_keeps_only_what_a_fit_reads(spark, monkeypatch):
    from pyspark.ml.tuning import CrossValidator

    from tarmac.operators.features import assemble
    from tarmac.plans.models import linear_regression

    df = spark.range(60).select("id", F.col("id").cast("double").alias("a"), (2.0 * F.col("id")).alias("y"), F.lit("wide").alias("other"), (F.col("id") % 3).cast("int").alias("fold"))
    given, fit = [], CrossValidator.fit
    monkeypatch.setattr(CrossValidator, "fit", lambda self, d: given.append(d.columns) or fit(self, d))
    lr = linear_regression("features", "y")
    _, table = cross_validate(lr, param_grid(lr, {"regParam": [0.0, 1.0]}), assemble(df, ["a"]), "y", fold_col="fold")
    assert given == [["features", "y", "fold"]] and table.count() == 2
