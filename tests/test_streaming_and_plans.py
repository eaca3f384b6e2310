"""Stream scoring equals batch scoring; job counts of a clean do not grow with columns;
the end-to-end pipeline and the sweep run."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from tarmac.operators.clean import fit_null_policy
from tarmac.operators.features import assemble, split_frames
from tarmac.plans import models as M
from tarmac.plans.pipeline import PipelineConfig, fit_pipeline, run_pipeline
from tarmac.plans.sweep import read_run_records, speedup_table, sweep, write_run_records
from tarmac.session import scratch_path
from tarmac.sources.shipments import KEYS, TARGET
from tarmac.streaming.score import stream_score

FEATS = ["l_extendedprice", "o_totalprice"]


def test_stream_score_equals_batch(spark, ship_small):
    df = ship_small.select(*KEYS, TARGET, *FEATS)
    train, test = split_frames(df, KEYS)
    model = M.ols("features", TARGET).fit(assemble(train, FEATS))
    batch = sorted(tuple(r) for r in model.transform(assemble(test, FEATS))
                   .select(*KEYS, "prediction").collect())
    src = scratch_path(spark, "stream-in")
    test.write.parquet(src)
    streamed = stream_score(spark, model, src, test.schema, FEATS)
    got = sorted(tuple(r) for r in streamed.select(*KEYS, "prediction").collect())
    assert got == batch


def test_stream_micro_batches_equal_batch(spark, ship_small):
    from tarmac.streaming.score import scoring_stream
    df = ship_small.select(*KEYS, TARGET, *FEATS)
    train, test = split_frames(df, KEYS)
    model = M.ols("features", TARGET).fit(assemble(train, FEATS))
    src = scratch_path(spark, "stream-multi")
    test.repartition(4).write.parquet(src)                     # several files
    sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    q = (scoring_stream(spark, model, src, test.schema, FEATS, max_files_per_trigger=1)
         .writeStream.format("parquet").option("path", sink).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.read.parquet(sink).select(*KEYS, "prediction").collect())
    want = sorted(tuple(r) for r in model.transform(assemble(test, FEATS)).select(*KEYS, "prediction").collect())
    assert got == want and q.recentProgress and len(q.recentProgress) >= 2


def test_flight_shaped_pipeline(spark):
    """The reference's gradient-boosting flow on a flight-shaped frame with a known signal."""
    import random
    from tarmac.plans.pipeline import fit_pipeline, gbt_flow
    from tarmac.sources.readers import FLIGHT_KEYS
    rnd = random.Random(2)
    rows = []
    for i in range(1500):
        dep = rnd.uniform(500, 2300)
        carrier = rnd.choice(["WN", "AA", "DL"])
        arr_delay = rnd.gauss(10, 30)
        rows.append((2008, 1 + i % 12, 1 + i % 28, 1 + i % 7, carrier, 100 + i, rnd.choice(["IAD", "SFO"]),
                     dep, arr_delay, None if i % 3 else rnd.uniform(0, 50),
                     0.8 * arr_delay + (15.0 if carrier == "WN" else 0.0) + rnd.gauss(0, 3)))
    df = spark.createDataFrame(rows, "Year int, Month int, DayofMonth int, DayOfWeek int, UniqueCarrier string, "
                                     "FlightNum int, Origin string, DepTime double, ArrDelay double, "
                                     "LateAircraftDelay double, DepDelay double")
    cfg = gbt_flow("DepDelay", FLIGHT_KEYS,
                   columns=["UniqueCarrier", "Origin", "Month", "DayOfWeek", "DepTime", "ArrDelay",
                            "LateAircraftDelay", "DepDelay"],
                   categorical=["UniqueCarrier", "Origin", "Month", "DayOfWeek"],
                   model_params={"max_depth": 2, "max_iter": 10})
    fitted, train, test = fit_pipeline(df, cfg)
    assert fitted.policy.action_of("LateAircraftDelay") == "drop_column"     # 2/3 missing > 40%
    from tarmac.operators.metrics import regression_metrics
    r = regression_metrics(fitted.model.transform(test), "DepDelay").first()
    assert r.r2 > 0.8


def test_run_records_csv_roundtrip_and_summary(spark, ship_small):
    from tarmac.operators.profile import describe
    from tarmac.plans.pipeline import lr_flow
    runs = sweep(spark, lambda: ship_small, partition_sizes=[3], parallelism=[1, 2],
                 make_config=lambda par: lr_flow(TARGET, KEYS, parallelism=par,
                                                 grid={"regParam": [0.1], "elasticNetParam": [0.0]}))
    path = write_run_records(runs, scratch_path(spark, "runs"))
    back = read_run_records(spark, path)
    assert sorted((r.partition_size, r.parallelism) for r in back.collect()) == [(3, 1), (3, 2)]
    summary = {r.column_name: r for r in describe(back, ["cleaning_time", "training_time"]).collect()}
    assert summary["training_time"]["count"] == 2


def _jobs_for(spark, fn) -> int:
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    fn()
    return len(set(tracker.getJobIdsForGroup(None)) - before)


def test_clean_job_count_constant_in_columns(spark):
    def frame(k):
        rows = [tuple(None if (i + j) % (j + 3) == 0 else float(i) for j in range(k)) for i in range(200)]
        return spark.createDataFrame(rows, ", ".join(f"c{j} double" for j in range(k)))
    small, large = frame(3), frame(12)
    j3 = _jobs_for(spark, lambda: fit_null_policy(small))
    j12 = _jobs_for(spark, lambda: fit_null_policy(large))
    assert j3 == j12


def test_pipeline_end_to_end(spark, ship_small):
    m = run_pipeline(ship_small).first()
    assert m.n > 0 and m.rmse > 0
    fitted, train, test = fit_pipeline(ship_small, PipelineConfig(scale_scope="all"))
    scored = fitted.transform(ship_small)
    assert scored.where(F.col("prediction").isNull()).count() == 0


def test_sweep_and_speedup(spark, ship_small):
    runs = sweep(spark, lambda: ship_small, partition_sizes=[2, 4]).collect()
    assert [r.partition_size for r in runs] == [2, 4]
    assert all(r.training_time >= 0 and r.rows_clean > 0 for r in runs)
    table = {(r.model, r.cores): r.speedup for r in
             speedup_table(spark, [("lr", 1, 10.0), ("lr", 2, 5.0)]).collect()}
    assert table[("lr", 2)] == 2.0


def test_sweep_splits_cleaning_from_training(spark, ship_small):
    # cleaning stops when the encoded table is written; the grid search lands in training
    from tarmac.plans.pipeline import lr_flow
    from tarmac.plans.sweep import run_once
    grid = {"regParam": [0.1, 0.01], "elasticNetParam": [0.0, 0.5, 1.0]}
    t0 = time.time()
    cleaning, training, rows, rmse = run_once(
        spark, lambda: ship_small, make_config=lambda par: lr_flow(TARGET, KEYS, grid=grid, parallelism=par))
    total = time.time() - t0
    assert cleaning > 0 and training > 0 and cleaning + training <= total
    assert rows > 0 and rmse > 0


def test_boosted_flow_options(spark, ship_small):
    from tarmac.plans.pipeline import boosted_flow
    cfg = boosted_flow(TARGET, KEYS, drop_columns=["l_discount"], prune_columns=["o_orderstatus"],
                       model_params={"n_estimators": 3})
    fitted, train, test = fit_pipeline(ship_small, cfg)
    assert fitted.scaler is None and fitted.policy.action_of("l_discount") == "drop_column"
    assert "o_orderstatus" not in fitted.features and "l_discount" not in fitted.features
    assert fitted.model.getMaxIter() == 3 and fitted.model.getMaxDepth() == 3
    # dictionary codes are alphabetical; no NULL survives the policy
    labels = fitted.index.labels["l_returnflag"]
    assert labels == sorted(labels)
    r = train.select(F.count_if(F.col("features") != F.col("scaled")).alias("diff")).first()
    assert r.diff == 0
    kept = ship_small.drop("l_discount").na.drop(how="any").count()
    assert train.count() + test.count() == kept
