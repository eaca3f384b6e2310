"""Encoders: ordering, ties, NULL/unseen handling, driver vs distributed paths."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tarmac.operators import encode as E


@pytest.fixture(scope="module")
def cats(spark):
    rows = [("b",), ("a",), ("b",), ("c",), ("a",), ("d",), (None,), ("10",), ("9",)]
    return spark.createDataFrame(rows, "v string")


def test_frequency_desc_ties_alphabetical(spark, cats):
    m = E.fit_index(cats, ["v"], E.FREQUENCY_DESC, "skip")
    # a and b twice (tie -> alphabetical), then singles in byte order: '10' < '9' < 'c' < 'd'
    assert m.labels["v"] == ["a", "b", "10", "9", "c", "d"]
    out = m.transform(cats)
    assert out.count() == 8                       # NULL row skipped
    assert {r.v for r in out.where(F.col("v") == 0.0).collect()} == {0.0}


def test_distributed_path_matches_driver_path(spark, cats):
    small = E.fit_index(cats, ["v"], E.FREQUENCY_DESC, "skip")
    big = E.fit_index(cats, ["v"], E.FREQUENCY_DESC, "skip", method="distributed")
    assert big.distributed
    a = sorted(small.labels_frame(spark).collect())
    b = sorted(big.labels_frame(spark).collect())
    assert a == b
    ta = sorted(tuple(r) for r in small.transform(cats).collect())
    tb = sorted(tuple(r) for r in big.transform(cats).collect())
    assert ta == tb


def test_auto_switches_to_distributed_when_labels_exceed_limit(spark, cats):
    m = E.fit_index(cats, ["v"], E.ALPHABET_ASC, "keep", max_driver_labels=3)
    assert m.distributed
    with pytest.raises(ValueError):
        E.fit_index(cats, ["v"], method="driver", max_driver_labels=3)


def test_numeric_calendar_values_sort_as_text(spark):
    df = spark.createDataFrame([(9,), (10,), (9,), (10,), (1,)], "m int")
    m = E.fit_index(df, ["m"])
    assert m.labels["m"] == ["10", "9", "1"]


def test_unseen_label_handling(spark):
    train = spark.createDataFrame([("x",), ("y",), ("y",)], "c string")
    score = spark.createDataFrame([("x",), ("z",)], "c string")
    keep = E.fit_index(train, ["c"], handle_invalid="keep")
    assert sorted(r.c for r in keep.transform(score).collect()) == [1.0, 2.0]   # y=0, x=1, unseen=2
    skip = E.fit_index(train, ["c"], handle_invalid="skip")
    assert [r.c for r in skip.transform(score).collect()] == [1.0]
    err = E.fit_index(train, ["c"], handle_invalid="error")
    with pytest.raises(Exception):
        err.transform(score).collect()


def test_keep_index_per_column_with_different_cardinalities(spark):
    train = spark.createDataFrame([("a", "p"), ("b", "p"), ("c", "p")], "x string, y string")
    score = spark.createDataFrame([("zz", "zz")], "x string, y string")
    m = E.fit_index(train, ["x", "y"], handle_invalid="keep")
    r = m.transform(score).first()
    assert (r.x, r.y) == (3.0, 1.0)


def test_label_encode_nan_and_int(spark):
    df = spark.createDataFrame([("b",), (None,), ("A",)], "s string")
    out, m = E.label_encode(df, ["s"])
    assert dict(out.dtypes)["s"] == "int"
    assert m.labels["s"] == ["A", "b", "nan"]
    assert sorted(r.s for r in out.collect()) == [0, 1, 2]


def test_dictionary_encode_missing_column(spark):
    df = spark.createDataFrame([("a",)], "s string")
    with pytest.raises(ValueError):
        E.dictionary_encode(df, ["nope"])


def test_categorize_roundtrip(spark, cats):
    df = cats.na.drop()
    coded, m = E.categorize(df, ["v"])
    back = E.decode(coded, m, ["v"])
    assert back.where(F.col("v") != F.col("v_decoded")).count() == 0
    coded2, m2 = E.fit_index(df, ["v"], E.ALPHABET_ASC, "keep", method="distributed"), None
    back2 = E.decode(coded2.transform(df, suffix="_code"), coded2, ["v"])
    assert back2.where(F.col("v") != F.col("v_decoded")).count() == 0


def test_distributed_join_with_hot_value_matches_driver(spark):
    rows = [("hot",)] * 600 + [(f"v{i:04d}",) for i in range(500)] + [(None,)] * 100
    df = spark.createDataFrame(rows, "v string")
    for how in ("keep", "skip"):
        a = E.fit_index(df, ["v"], E.FREQUENCY_DESC, how)
        b = E.fit_index(df, ["v"], E.FREQUENCY_DESC, how, method="distributed")
        ta = sorted(r.v for r in a.transform(df).collect())
        tb = sorted(r.v for r in b.transform(df).collect())
        assert ta == tb, how


@pytest.mark.parametrize("how", ["keep", "skip"])
def test_large_dictionaries_share_one_exchange_of_the_table(spark, how):
    rows = [(i, "hot" if i % 3 else f"v{i}", f"w{i % 50}" if i % 7 else None, "p" if i % 2 else "q", "payload") for i in range(600)]
    df = spark.createDataFrame(rows, "n long, a string, b string, c string, __row string")
    small = E.fit_index(df, ["a", "b", "c"], E.FREQUENCY_DESC, how)
    large = E.fit_index(df, ["a", "b", "c"], E.FREQUENCY_DESC, how, method="distributed", broadcast_labels=2)
    got = large.transform(df, suffix="_code")
    # planned, not yet run: the plan of a finished query shows its first form too
    plan = got._jdf.queryExecution().explainString(got.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    nodes = [p for p in plan.split("\n\n") if ") Exchange\n" in p]
    assert len([p for p in nodes if "__row#" in p.split("Arguments")[0] and "n#" in p.split("Arguments")[0]]) == 1, plan
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, small.transform(df, suffix="_code").collect()))
    back = E.decode(got, large)
    assert back.count() == got.count()
    assert back.where("not (a <=> a_decoded) or not (b <=> b_decoded) or not (c <=> c_decoded)").count() == 0


def test_unseen_labels_of_large_dictionaries(spark):
    train = spark.createDataFrame([(f"k{i}", f"m{i}") for i in range(20)], "a string, b string")
    rows = spark.createDataFrame([("k1", "m2"), ("new", "m3"), (None, None)], "a string, b string")
    args = {"order": E.ALPHABET_ASC, "method": "distributed", "broadcast_labels": 1}
    keep = E.fit_index(train, ["a", "b"], handle_invalid="keep", **args).transform(rows)
    assert sorted(map(tuple, keep.collect())) == [(1.0, 12.0), (20.0, 13.0), (20.0, 20.0)]
    assert E.fit_index(train, ["a", "b"], handle_invalid="skip", **args).transform(rows).count() == 1
    with pytest.raises(Exception, match="unseen or NULL"):
        E.fit_index(train, ["a", "b"], handle_invalid="error", **args).transform(rows).collect()
