"""Split, folds and scaling."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tarmac.operators import features as FE


def test_split_and_folds_disjoint_cover_and_layout_free(spark, ship_small):
    keys = ["l_orderkey", "l_linenumber"]
    n = ship_small.count()
    a = FE.hash_split(ship_small, keys).groupBy("is_train").count().collect()
    assert sum(r["count"] for r in a) == n
    one = sorted(tuple(r) for r in FE.hash_split(ship_small.coalesce(1), keys).select(*keys, "is_train").collect())
    many = sorted(tuple(r) for r in FE.hash_split(ship_small.repartition(7), keys).select(*keys, "is_train").collect())
    assert one == many
    folds = FE.assign_folds(ship_small, keys, 5)
    counts = {r["fold"]: r["count"] for r in folds.groupBy("fold").count().collect()}
    assert set(counts) == set(range(5)) and sum(counts.values()) == n
    # repeated keys land on the same side
    dup = (FE.hash_split(ship_small, keys).groupBy(*keys)
           .agg(F.countDistinct("is_train").alias("sides")).where("sides > 1").count())
    assert dup == 0


def test_split_share_close_to_80(spark, ship_small):
    train, test = FE.split_frames(ship_small, ["l_orderkey", "l_linenumber"])
    share = train.count() / (train.count() + test.count())
    assert 0.75 < share < 0.85


def test_standard_scale_sample_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0)], "x double, k double")
    out = FE.standard_scale(df, ["x", "k"]).orderBy("x").collect()
    xs = np.array([1.0, 2.0, 3.0, 4.0])
    want = (xs - xs.mean()) / xs.std(ddof=1)
    assert np.allclose([r.z_x for r in out], want)
    assert [r.z_k for r in out] == [0.0] * 4


def test_fold_scale_uses_other_folds_population_std(spark):
    rows = [(float(i), i % 3) for i in range(30)]
    df = spark.createDataFrame(rows, "x double, fold int")
    out = {(r.x, r.fold): r.z_x for r in FE.fold_scale(df, ["x"]).collect()}
    for f in range(3):
        train = np.array([x for x, g in rows if g != f])
        for x, g in rows:
            if g == f:
                assert np.isclose(out[(x, g)], (x - train.mean()) / train.std(ddof=0))


def test_xxhash_split_is_layout_free_and_balanced(spark, ship_small):
    keys = ["l_orderkey", "l_linenumber"]
    a = sorted(tuple(r) for r in FE.hash_split(ship_small.coalesce(1), keys, method="xxhash64")
               .select(*keys, "is_train").collect())
    b = sorted(tuple(r) for r in FE.hash_split(ship_small.repartition(5), keys, method="xxhash64")
               .select(*keys, "is_train").collect())
    assert a == b
    share = sum(1 for r in a if r[2]) / len(a)
    assert 0.75 < share < 0.85
