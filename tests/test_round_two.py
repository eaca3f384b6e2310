"""Restarted streams, exact shares, untouched keys, decoding of NULL, CSV headers, one-pass writes."""

from __future__ import annotations

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tarmac.operators import clean, encode, features
from tarmac.session import scratch_path
from tarmac.sources import readers
from tarmac.sources.tables import materialize
from tarmac.streaming.score import stream_score


@pytest.fixture(scope="module")
def line_model(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + 1).alias("y"))
    return LinearRegression(featuresCol="f", labelCol="y").fit(VectorAssembler(inputCols=["x"], outputCol="f").transform(df))


def test_second_run_scores_only_what_is_new(spark, line_model):
    src, sink = scratch_path(spark, "src"), scratch_path(spark, "sink")
    rows = spark.range(150).select("id", F.col("id").cast("double").alias("x"))
    rows.where("id < 100").write.parquet(src)
    assert stream_score(spark, line_model, src, rows.schema, ["x"], sink_dir=sink).count() == 100
    rows.where("id >= 100").write.mode("append").parquet(src)
    out = stream_score(spark, line_model, src, rows.schema, ["x"], sink_dir=sink)
    assert sorted(r["id"] for r in out.collect()) == list(range(150))


def test_sink_without_its_checkpoint_is_refused(spark, line_model):
    src, sink = scratch_path(spark, "src"), scratch_path(spark, "sink")
    rows = spark.range(5).select(F.col("id").cast("double").alias("x"))
    rows.write.parquet(src)
    rows.write.parquet(sink)
    with pytest.raises(ValueError, match="checkpoint"):
        stream_score(spark, line_model, src, rows.schema, ["x"], sink_dir=sink)


def test_null_features_fail_in_a_stream_as_in_batch(spark, line_model):
    src = scratch_path(spark, "src")
    rows = spark.range(10).select(F.when(F.col("id") != 3, F.col("id").cast("double")).alias("x"))
    rows.write.parquet(src)
    with pytest.raises(Exception):  # noqa: B017  Spark's own error, wrapped by the stream
        stream_score(spark, line_model, src, rows.schema, ["x"])
    kept = stream_score(spark, line_model, src, rows.schema, ["x"], handle_invalid="keep")
    assert kept.count() == 10


@pytest.mark.parametrize("share", [0.75, 0.8, 0.85, 0.95, 0.97])
def test_split_share(spark, share):
    got = features.hash_split(spark.range(20_000), ["id"], share).agg(F.avg(F.col("is_train").cast("int")).alias("s")).first()["s"]
    assert abs(got - share) < 0.01


def test_split_refuses_shares_it_cannot_express(spark):
    with pytest.raises(ValueError):
        features.hash_split(spark.range(5), ["id"], 0.97, buckets=10)


def test_threshold_policy_leaves_keys_and_types(spark):
    big = 2**53
    df = spark.createDataFrame([(big + i, i, None if i == 2 else float(i)) for i in range(6)], "key long, whole int, part double")
    model = clean.fit_null_policy_threshold(df, exclude=["key"])
    out = model.transform(df)
    assert dict(out.dtypes) == {"key": "bigint", "whole": "int", "part": "double"}
    assert sorted(r["key"] for r in out.collect()) == [big + i for i in range(6)]
    assert out.where("part is null").count() == 0


@pytest.mark.parametrize("method", ["driver", "distributed"])
def test_decode_gives_null_for_null(spark, method):
    df = spark.createDataFrame([("a",), (None,), ("b",), ("a",)], "c string")
    model = encode.fit_index(df, ["c"], encode.ALPHABET_ASC, "keep", method=method)
    back = encode.decode(model.transform(df, suffix="_code"), model)
    assert sorted((r["c"] or "", r["c_decoded"] or "") for r in back.collect()) == [("", ""), ("a", "a"), ("a", "a"), ("b", "b")]


def test_csv_header_in_another_order_is_not_swapped(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, str(tmp_path / "x.csv"), schema="a int, b int").collect()


def test_split_size_stays_out_of_the_session(spark, tmp_path):
    (tmp_path / "y.csv").write_text("a\n" + "1\n" * 2000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    df = readers.read_csv(spark, str(tmp_path / "y.csv"), schema="a int", max_partition_bytes=1000)
    assert df.count() == 2000 and df.rdd.getNumPartitions() > 1
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_materialize_runs_the_plan_once(spark):
    tracker = spark.sparkContext.statusTracker()
    left = spark.range(1000).repartition(3, "id")
    joined = left.join(spark.range(1000).repartition(3, "id").hint("merge"), "id")

    def jobs(group, work):
        spark.sparkContext.setJobGroup(group, group)
        work()
        return len(tracker.getJobIdsForGroup(group))

    plain = jobs("plain", lambda: joined.hint("rebalance").write.parquet(scratch_path(spark, "plain")))
    own = jobs("own", lambda: materialize(joined, "own"))
    assert own <= plain + 1  # the read of the schema


def test_correlation_skips_nulls_by_pair_and_never_multiplies_rows(spark):
    import pandas as pd

    from tarmac.operators.profile import correlation_matrix

    rows = [(float(i), None if i % 3 == 0 else float(i * i % 17), 0.1, None if i % 5 == 0 else -2.0 * i) for i in range(60)]
    names = ["a", "b", "same", "c"]
    out = correlation_matrix(spark.createDataFrame(rows, "a double, b double, same double, c double"))
    want = pd.DataFrame(rows, columns=names).astype(float).corr()
    for r in out.collect():
        if "same" in (r["col_a"], r["col_b"]):
            assert r["corr"] is None
        else:
            assert r["corr"] == pytest.approx(want.loc[r["col_a"], r["col_b"]], abs=1e-12)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan  # the sums come as matrices, no row is multiplied anywhere


def test_correlation_of_no_rows(spark):
    from tarmac.operators.profile import correlation_matrix

    out = correlation_matrix(spark.createDataFrame([], "a double, b double")).collect()
    assert len(out) == 4 and all(r["corr"] is None for r in out)
