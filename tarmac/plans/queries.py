"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

All read the driver's tables through ``shipments`` (lineitem JOIN orders), so their
work grows with the data. Floating results are rounded with ``round_dp`` /
``round_sig`` so that another engine's exact SQL can be compared value by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.hashing import key_bucket
from tarmac.functions.rounding import round_dp, round_sig
from tarmac.operators import clean as C
from tarmac.operators import encode as E
from tarmac.operators import features as FE
from tarmac.operators import profile as P
from tarmac.operators.metrics import regression_metrics
from tarmac.plans import models as M
from tarmac.plans.deep_forest import DeepForest
from tarmac.plans.tuning import cross_validate, kfold_evaluate, kfold_ols, param_grid
from tarmac.session import scratch_path
from tarmac.sources import readers as R
from tarmac.sources import writers as W
from tarmac.sources.shipments import CATEGORICAL, KEYS, TARGET, shipments
from tarmac.sources.tables import materialize

# Fixed choices of the registered queries (columns and parameters).
PROFILE_NUMERIC = ["delay", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice"]
POLICY_NUMERIC = ["delay", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice",
                  "order_year", "order_month"]
DESCRIBE_COLS = ["delay", "l_quantity", "l_extendedprice", "l_tax", "o_totalprice"]
IQR_COLS = ["delay", "l_extendedprice"]
IQR_FACTOR = 0.5
OLS_FEATURES = ["l_extendedprice", "o_totalprice"]
SCALE_COLS = ["l_extendedprice", "o_totalprice", "l_quantity"]
# the vector scaler needs non-NULL inputs (VectorAssembler rejects NULL)
VECTOR_SCALE_COLS = ["l_extendedprice", "o_totalprice", "order_month"]
STUMP_FEATURES = ["order_year", "order_month"]
PROJECTED = ["l_orderkey", "l_linenumber", "delay", "l_quantity", "l_extendedprice", "o_totalprice",
             "l_returnflag", "order_month"]
DROPPED = ["l_discount", "l_returnflag", "CancellationCode"]
N_FOLDS = 5
CV_FOLDS = 3


def _ship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shipments(spark, sf_dir)


def _ship_rows(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """The table (or these columns of it) joined once and written, for what passes over it many times."""
    df = _ship(spark, sf_dir)
    return materialize(df.select(*cols) if cols else df, "shipments", spread=False)


# ---------------------------------------------------------------- sources / sinks

def q_csv_roundtrip(spark, sf_dir):
    df = _ship(spark, sf_dir)
    path = scratch_path(spark, "csv-roundtrip")
    W.write_csv(df, path)
    return R.read_csv(spark, path, schema=df.schema, null_value="")


def q_convert_once(spark, sf_dir):
    """CSV converted once: after a first write that failed half-way, and with files that arrive later."""
    df = _ship(spark, sf_dir)
    src, target = scratch_path(spark, "csv-source"), scratch_path(spark, "converted")
    first = F.pmod(F.xxhash64(*KEYS), F.lit(2)) == 0
    W.write_csv(df.where(first), src)
    # what a conversion leaves that stopped before it was recorded
    W.write_parquet(df.where(first & (F.col("order_month") < 6)), f"{target}/batch-000000")
    R.convert_once(spark, src, target, schema=df.schema, null_value="")
    W.write_csv(df.where(~first), src, mode="append")
    return R.convert_once(spark, src, target, schema=df.schema, null_value="")


def q_parquet_roundtrip(spark, sf_dir):
    df = _ship(spark, sf_dir)
    path = scratch_path(spark, "parquet-roundtrip")
    W.write_parquet(df, path)
    return R.read_parquet(spark, path)


UNION_PART_COLUMNS = [
    list(PROJECTED) + ["l_tax", "o_orderpriority"],
    list(reversed(PROJECTED + ["l_tax", "o_orderpriority"])),
    list(PROJECTED),
]


def q_union_sources(spark, sf_dir):
    """Three CSV parts with different headers -> one table matched by column name."""
    df = _ship(spark, sf_dir)
    base = scratch_path(spark, "union-sources")
    part = key_bucket(KEYS, 3, window=2)
    for i, cols in enumerate(UNION_PART_COLUMNS):
        W.write_csv(df.where(part == i).select(*cols), f"{base}/part{i}")
    schema = df.select(*UNION_PART_COLUMNS[0]).schema
    return R.read_csv_directory(spark, base, schema=schema, null_value="", recursive=True)


def q_preview(spark, sf_dir):
    df = _ship(spark, sf_dir)
    return df.orderBy("l_orderkey", "l_linenumber", "delay", "l_extendedprice", "o_totalprice").limit(5)


# ---------------------------------------------------------------- projections / casts

def q_project_features(spark, sf_dir):
    return C.project(_ship(spark, sf_dir), PROJECTED)


def q_drop_columns(spark, sf_dir):
    out, _missing = C.drop_columns(_ship(spark, sf_dir), DROPPED)
    return out


def q_bulk_cast(spark, sf_dir):
    return C.narrow_doubles(_ship(spark, sf_dir))


def q_dropna_any(spark, sf_dir):
    out, _ = C.drop_columns(_ship(spark, sf_dir), ["l_discount"])
    return C.dropna_any(out)


def q_column_kinds(spark, sf_dir):
    """Kind and type of every column, with the number of its values."""
    df = _ship(spark, sf_dir)
    present = P.null_profile(df).select("column_name", (F.col("n_rows") - F.col("n_null")).alias("n_present"))
    return P.column_kinds_frame(df).join(present, "column_name")


# ---------------------------------------------------------------- profiling

def q_null_profile(spark, sf_dir):
    out = P.null_profile(_ship(spark, sf_dir))
    return out.withColumn("null_ratio", round_dp("null_ratio", 6))


def q_distinct_counts(spark, sf_dir):
    return P.distinct_counts(_ship(spark, sf_dir))


def q_distinct_values(spark, sf_dir):
    return P.distinct_values(_ship(spark, sf_dir), "o_orderpriority")


def q_correlation_matrix(spark, sf_dir):
    out = P.correlation_matrix(_ship(spark, sf_dir), PROFILE_NUMERIC)
    return out.withColumn("corr", round_dp("corr", 9))


def q_describe(spark, sf_dir):
    out = P.describe(_ship(spark, sf_dir), DESCRIBE_COLS)
    return out.select("column_name", "count", *[round_sig(c, 9).alias(c) for c in
                                                 ["mean", "std", "min", "q25", "q50", "q75", "max"]])


def q_quartiles(spark, sf_dir):
    df = _ship(spark, sf_dir)
    from tarmac.operators.quantiles import exact_quantiles
    q = exact_quantiles(df, PROFILE_NUMERIC, [0.25, 0.75])
    return spark.createDataFrame(
        [(c, q[c][0], q[c][1], q[c][1] - q[c][0]) for c in PROFILE_NUMERIC],
        "column_name string, q1 double, q3 double, iqr double",
    ).select("column_name", "q1", "q3", round_sig("iqr", 9).alias("iqr"))


# ---------------------------------------------------------------- cleaning

def _policy_report(spark, model):
    return model.report(spark).withColumn("mean_value", round_sig("mean_value", 9))


def q_null_policy_60_5(spark, sf_dir):
    df = _ship(spark, sf_dir)
    return _policy_report(spark, C.fit_null_policy(df, POLICY_NUMERIC, 0.6, 0.05))


def q_null_policy_60_5_apply(spark, sf_dir):
    df = _ship(spark, sf_dir)
    out = C.fit_null_policy(df, POLICY_NUMERIC, 0.6, 0.05).transform(df)
    return out.select("l_orderkey", "l_linenumber", "l_quantity", round_dp("l_tax", 9).alias("l_tax"))


def q_null_policy_40_10(spark, sf_dir):
    df = _ship(spark, sf_dir)
    model = C.fit_null_policy_ratio(df, POLICY_NUMERIC, 0.4, 0.1)
    rows_after = model.transform(df).count()
    return _policy_report(spark, model).withColumn("rows_after", F.lit(rows_after).cast("bigint"))


# Columns whose applied values the 40/10 key returns.
RATIO_APPLIED = ["delay", "l_quantity", "l_extendedprice", "l_tax", "o_totalprice"]


def q_null_policy_40_10_apply(spark, sf_dir):
    df = _ship(spark, sf_dir)
    out = C.fit_null_policy_ratio(df, POLICY_NUMERIC, 0.4, 0.1).transform(df)
    return out.select(*KEYS, *[round_dp(c, 6).alias(c) for c in RATIO_APPLIED])


def q_null_policy_thresh(spark, sf_dir):
    return _policy_report(spark, C.fit_null_policy_threshold(_ship(spark, sf_dir), 0.6))


def q_null_policy_thresh_apply(spark, sf_dir):
    """The threshold policy's rows: keys untouched, the sparse column gone, means filled in."""
    df = _ship(spark, sf_dir)
    out = C.fit_null_policy_threshold(df, 0.6, exclude=KEYS).transform(df)
    return out.select(*[round_dp(c, 6).alias(c) if t == "double" else c for c, t in out.dtypes])


def q_mean_impute(spark, sf_dir):
    out = C.mean_impute(_ship(spark, sf_dir), ["l_tax", "l_quantity"])
    return out.select("l_orderkey", "l_linenumber", round_dp("l_tax", 9).alias("l_tax"),
                      round_dp("l_quantity", 6).alias("l_quantity"))


def q_iqr_filter(spark, sf_dir):
    df = _ship(spark, sf_dir).select(*IQR_COLS)
    _, bounds = C.iqr_filter(df, IQR_COLS, factor=IQR_FACTOR, exact=True, count_rows=True)
    return spark.createDataFrame(
        [(b.column, b.q1, b.q3, b.lower, b.upper, b.rows_after) for b in bounds],
        "column_name string, q1 double, q3 double, lower double, upper double, rows_after bigint",
    ).select("column_name", "q1", "q3", round_sig("lower", 9).alias("lower"),
             round_sig("upper", 9).alias("upper"), "rows_after")


def q_iqr_filter_apply(spark, sf_dir):
    out, _ = C.iqr_filter(_ship_rows(spark, sf_dir, *KEYS, *IQR_COLS), IQR_COLS, factor=IQR_FACTOR, exact=True)
    return out


# ---------------------------------------------------------------- encoding

def q_string_index(spark, sf_dir):
    out, _ = E.string_index(_ship(spark, sf_dir), CATEGORICAL, handle_invalid="skip")
    return out.select(*KEYS, *CATEGORICAL)


def q_string_index_labels(spark, sf_dir):
    model = E.fit_index(_ship(spark, sf_dir), CATEGORICAL, E.FREQUENCY_DESC, "skip")
    return model.labels_frame(spark)


def q_string_index_numeric(spark, sf_dir):
    out, _ = E.string_index(_ship(spark, sf_dir), ["order_year", "order_month"], handle_invalid="skip")
    return out.select(*KEYS, "order_year", "order_month")


def q_label_encode(spark, sf_dir):
    out, _ = E.label_encode(_ship(spark, sf_dir), ["l_returnflag", "o_orderpriority"])
    return out.select(*KEYS, "l_returnflag", "o_orderpriority")


def q_dictionary_encode(spark, sf_dir):
    cols = ["o_orderpriority", "o_orderstatus", "l_linestatus"]
    out, _ = E.dictionary_encode(_ship(spark, sf_dir), cols, method="distributed")
    return out.select(*KEYS, *cols)


# Dictionaries over this many entries are joined (together) in the query, not broadcast.
LARGE_DICTIONARY = 5
LARGE_CODED = ["l_orderkey", "order_month", "l_returnflag"]


def q_dictionary_large(spark, sf_dir):
    """Codes of large dictionaries (one exchange of the table for all of them) and back."""
    df = _ship_rows(spark, sf_dir, *dict.fromkeys([*KEYS, *LARGE_CODED]))
    model = E.fit_index(df, LARGE_CODED, E.ALPHABET_ASC, "keep", method="distributed",
                        out_type="int", broadcast_labels=LARGE_DICTIONARY)
    back = E.decode(model.transform(df, suffix="_code"), model)
    return back.select(*KEYS, *[c + s for c in LARGE_CODED for s in ("_code", "_decoded")])


def q_categorize_roundtrip(spark, sf_dir):
    df = _ship(spark, sf_dir)
    coded, model = E.categorize(df, ["o_orderpriority"])
    back = E.decode(coded, model, ["o_orderpriority"])
    return back.select(*KEYS, F.col("o_orderpriority_code").cast("int").alias("o_orderpriority_code"),
                       "o_orderpriority_decoded")


def q_categorize_nulls(spark, sf_dir):
    """Codes and back for a column with NULLs: they come back as NULL."""
    df = _ship(spark, sf_dir)
    model = E.fit_index(df, ["l_returnflag"], E.ALPHABET_ASC, "keep")
    back = E.decode(model.transform(df, suffix="_code"), model, ["l_returnflag"])
    return back.select(*KEYS, "l_returnflag", "l_returnflag_decoded")


# ---------------------------------------------------------------- features / split

def q_hash_split(spark, sf_dir):
    return FE.hash_split(_ship(spark, sf_dir), KEYS).select(*KEYS, FE.SPLIT_COL)


def q_fold_assign(spark, sf_dir):
    return FE.assign_folds(_ship(spark, sf_dir), KEYS, N_FOLDS).select(*KEYS, FE.FOLD_COL)


def q_standard_scale(spark, sf_dir):
    df = FE.hash_split(_ship(spark, sf_dir), KEYS)
    out = FE.standard_scale(df, VECTOR_SCALE_COLS, fit_on=df.where(F.col(FE.SPLIT_COL)))
    return out.select(*KEYS, FE.SPLIT_COL, *[round_dp("z_" + c, 6).alias("z_" + c) for c in VECTOR_SCALE_COLS])


def q_kfold_scale(spark, sf_dir):
    df = FE.assign_folds(_ship(spark, sf_dir), KEYS, N_FOLDS)
    out = FE.fold_scale(df, SCALE_COLS)
    return out.select(*KEYS, FE.FOLD_COL, *[round_dp("z_" + c, 6).alias("z_" + c) for c in SCALE_COLS])


# ---------------------------------------------------------------- models

def _train_test(spark, sf_dir, cols):
    df = _ship_rows(spark, sf_dir, *KEYS, TARGET, *cols).na.drop(subset=[TARGET, *cols])
    train, test = FE.split_frames(df, KEYS)
    return FE.assemble(train, cols), FE.assemble(test, cols)


def _ols_fit(spark, sf_dir):
    train, test = _train_test(spark, sf_dir, OLS_FEATURES)
    return M.ols("features", TARGET).fit(train), train, test


def q_linreg_coeffs(spark, sf_dir):
    model, _, _ = _ols_fit(spark, sf_dir)
    return M.coefficients_frame(spark, model, OLS_FEATURES).select("term", round_sig("value", 9).alias("value"))


def _predictions(model, test):
    return model.transform(test).select(*KEYS, F.col(TARGET).alias("label"), "prediction")


def q_linreg_predict(spark, sf_dir):
    model, _, test = _ols_fit(spark, sf_dir)
    return _predictions(model, test).withColumn("prediction", round_dp("prediction", 4))


def q_regression_metrics(spark, sf_dir):
    model, _, test = _ols_fit(spark, sf_dir)
    m = regression_metrics(_predictions(model, test), "label", "prediction")
    return m.select("n", *[round_sig(c, 9).alias(c) for c in ["mse", "rmse", "mae", "r2"]])


def q_kfold_ols(spark, sf_dir):
    df = FE.assign_folds(_ship(spark, sf_dir), KEYS, N_FOLDS)
    out = kfold_ols(df, OLS_FEATURES, TARGET)
    return out.select(FE.FOLD_COL, "n_train", "n_test",
                      *[round_sig(c, 9).alias(c) for c in ["rmse", "mae", "mean_rmse"]])


def q_tree_stump(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir, STUMP_FEATURES)
    model = M.stump("features", TARGET).fit(train)
    s = M.root_split(model)
    feat = STUMP_FEATURES[s["feature"]]
    side = F.col(feat) <= F.lit(s["threshold"])
    counts = train.agg(F.count_if(side).alias("n_left"), F.count_if(~side).alias("n_right"))
    return counts.select(
        F.lit(feat).alias("feature"),
        F.lit(s["threshold"]).alias("threshold"),
        round_sig(F.lit(s["left"]), 9).alias("left_mean"),
        round_sig(F.lit(s["right"]), 9).alias("right_mean"),
        F.col("n_left").cast("bigint").alias("n_left"),
        F.col("n_right").cast("bigint").alias("n_right"),
    )


def q_linreg_elastic(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir, OLS_FEATURES)
    model = M.linear_regression("features", TARGET, reg_param=0.1, elastic_net=0.5).fit(train)
    return M.coefficients_frame(spark, model, OLS_FEATURES)


RIDGE = 0.1


def q_linreg_ridge(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir, OLS_FEATURES)
    model = M.linear_regression("features", TARGET, reg_param=RIDGE, elastic_net=0.0).fit(train)
    return M.coefficients_frame(spark, model, OLS_FEATURES).select("term", round_sig("value", 9).alias("value"))


RIDGE_GRID = [0.1, 5.0]


def q_cv_grid_ridge(spark, sf_dir):
    """Grid search over ridge strengths with hash folds: mean RMSE of each point."""
    train, _ = _train_test(spark, sf_dir, OLS_FEATURES)
    train = FE.assign_folds(train, KEYS, CV_FOLDS)
    lr = M.linear_regression("features", TARGET)
    _, table = cross_validate(lr, param_grid(lr, {"regParam": RIDGE_GRID}), train, TARGET,
                              fold_col=FE.FOLD_COL, num_folds=CV_FOLDS)
    return table.select("params", round_sig("avg_rmse", 9).alias("avg_rmse"))


def q_rf_exact(spark, sf_dir):
    """A forest without bootstrap over all features: equal trees of depth 2, checked in SQL."""
    train, test = _train_test(spark, sf_dir, STUMP_FEATURES)
    model = M.random_forest("features", TARGET, num_trees=3, max_depth=2, feature_subset="all", bootstrap=False)
    return _predictions(model.fit(train), test).withColumn("prediction", round_dp("prediction", 6))


def q_gbt_exact(spark, sf_dir):
    """Two boosting rounds of depth 1, checked in SQL."""
    train, test = _train_test(spark, sf_dir, STUMP_FEATURES)
    model = M.gbt("features", TARGET, max_depth=1, max_iter=2).fit(train)
    return _predictions(model, test).withColumn("prediction", round_dp("prediction", 6))


TREE_FEATURES = ["l_extendedprice", "o_totalprice", "order_year", "order_month"]


def q_rf_predict(spark, sf_dir):
    train, test = _train_test(spark, sf_dir, TREE_FEATURES)
    model = M.random_forest("features", TARGET, num_trees=20, max_depth=5).fit(train)
    return _predictions(model, test)


def q_gbt_predict(spark, sf_dir):
    train, test = _train_test(spark, sf_dir, TREE_FEATURES)
    model = M.gbt("features", TARGET, max_depth=2, max_iter=20).fit(train)
    return _predictions(model, test)


GRID = {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]}
# The six-point grid.
GRID_SIX = {"regParam": [0.1, 0.01], "elasticNetParam": [0.0, 0.5, 1.0]}


def q_cv_grid(spark, sf_dir):
    """Linear grid search by the built-in cross-validator, a fit per point and fold."""
    train, _ = _train_test(spark, sf_dir, OLS_FEATURES)
    train = FE.assign_folds(train, KEYS, CV_FOLDS)
    lr = M.linear_regression("features", TARGET)
    _, table = cross_validate(lr, param_grid(lr, GRID), train, TARGET, fold_col=FE.FOLD_COL, num_folds=CV_FOLDS)
    return table


def q_cv_grid_moments(spark, sf_dir):
    """The six-point linear grid, all points and folds from one scan."""
    from tarmac.plans.linear_grid import linear_grid
    train, _ = _train_test(spark, sf_dir, OLS_FEATURES)
    train = FE.assign_folds(train, KEYS, CV_FOLDS)
    _, table = linear_grid(train, OLS_FEATURES, TARGET, GRID_SIX)
    return table.select("params", round_sig("avg_rmse", 9).alias("avg_rmse"))


def q_stream_score(spark, sf_dir):
    from tarmac.streaming.score import stream_score
    model, _, test = _ols_fit(spark, sf_dir)
    src = scratch_path(spark, "stream-src")
    test.drop("features").write.parquet(src)
    scored = stream_score(spark, model, src, test.drop("features").schema, OLS_FEATURES)
    return scored.select(*KEYS, F.col(TARGET).alias("label"), round_dp("prediction", 4).alias("prediction"))


def q_stream_resume(spark, sf_dir):
    """Two scoring runs into one sink, with files added in between."""
    from tarmac.streaming.score import stream_score
    model, _, test = _ols_fit(spark, sf_dir)
    rows = test.drop("features")
    src, sink = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-sink")
    first = F.pmod(F.xxhash64(*KEYS), F.lit(2)) == 0
    for part in (rows.where(first), rows.where(~first)):
        part.write.mode("append").parquet(src)
        scored = stream_score(spark, model, src, rows.schema, OLS_FEATURES, sink_dir=sink)
    return scored.select(*KEYS, F.col(TARGET).alias("label"), round_dp("prediction", 4).alias("prediction"))


def q_stored_pipeline(spark, sf_dir):
    """Fit, save, load in a new object, and score the test rows as a file stream with what was loaded."""
    from tarmac.plans.pipeline import PipelineConfig, fit_pipeline
    from tarmac.plans.stored import load_pipeline, save_pipeline
    from tarmac.streaming.score import stream_score
    df = _ship_rows(spark, sf_dir, *KEYS, TARGET, *OLS_FEATURES)
    cfg = PipelineConfig(TARGET, KEYS, columns=OLS_FEATURES, null_policy="dropna", model="ols")
    fitted, train, _ = fit_pipeline(df, cfg)
    stored = save_pipeline(spark, fitted, scratch_path(spark, "pipeline"))
    train.unpersist()
    loaded = load_pipeline(spark, stored)
    rows = FE.split_frames(df.select(*KEYS, TARGET, *OLS_FEATURES), KEYS)[1]
    src = W.write_parquet(rows, scratch_path(spark, "stream-src"))
    scored = stream_score(spark, loaded, src, rows.schema)
    return scored.select(*KEYS, F.col(TARGET).alias("label"), round_dp("prediction", 4).alias("prediction"))


def q_boosted_predict(spark, sf_dir):
    """Boosting with 100 rounds of depth-3 trees on squared error."""
    train, test = _train_test(spark, sf_dir, TREE_FEATURES)
    model = M.boosted_trees("features", TARGET, n_estimators=100, max_depth=3).fit(train)
    return _predictions(model, test)


def q_boosted_regularized(spark, sf_dir):
    """Two rounds of depth 1 of the regularised objective (lambda 1, rate 0.3), checked in SQL."""
    from tarmac.plans.regularized import RegularizedBoosting
    train, test = _train_test(spark, sf_dir, STUMP_FEATURES)
    model = RegularizedBoosting(n_estimators=2, max_depth=1).fit(train, STUMP_FEATURES, TARGET)
    return _predictions(model, test).withColumn("prediction", round_dp("prediction", 6))


def q_kfold_rf(spark, sf_dir):
    """Hand-written 5-fold loop with a 100-tree random forest of unlimited depth; per-fold
    RMSE/MAE and their mean."""
    df = FE.assign_folds(_ship(spark, sf_dir), KEYS, N_FOLDS).select(*KEYS, TARGET, FE.FOLD_COL, *TREE_FEATURES)
    data = materialize(df.na.drop(), "kfold_rf")
    return kfold_evaluate(lambda: DeepForest(TREE_FEATURES, TARGET), data, "features", TARGET, num_folds=N_FOLDS)


DEEP_FEATURES = ["l_quantity", "o_totalprice"]


def q_deep_tree(spark, sf_dir):
    """A tree of unlimited depth without bootstrap, its upper levels grown by aggregates: each row's own
    prediction is the mean label of the rows with its features, checked in SQL."""
    data = _ship(spark, sf_dir).select(*KEYS, TARGET, *DEEP_FEATURES).na.drop()
    model = DeepForest(DEEP_FEATURES, TARGET, num_trees=1, bootstrap=False, max_group=20_000).fit(data)
    return model.transform(data).select(*KEYS, round_dp("prediction", 6).alias("prediction"))


EVENT_FEATURES = ["event_type", "hour"]


def _events_features(df):
    return df.select("event_id", "event_type", F.hour("ts").cast("double").alias("hour"),
                     F.col("value").alias("label"))


def q_stream_score_events(spark, sf_dir):
    """Fit index + OLS on the training events (hash split on event_id), then score the
    events table read as a file stream with the batch schema."""
    from tarmac.streaming.score import file_stream_path, stream_score
    path = f"{sf_dir}/events.parquet"
    events = spark.read.parquet(path)
    feats = FE.hash_split(_events_features(events), ["event_id"])
    train = feats.where(F.col(FE.SPLIT_COL)).drop(FE.SPLIT_COL)
    index = E.fit_index(train, ["event_type"], E.FREQUENCY_DESC, "keep")
    model = M.ols("features", "label").fit(FE.assemble(index.transform(train), EVENT_FEATURES))
    scored = stream_score(spark, model, file_stream_path(path), events.schema, EVENT_FEATURES,
                          prepare=lambda s: index.transform(_events_features(s)))
    return scored.select("event_id", "label", round_dp("prediction", 4).alias("prediction"))


def _flow_metrics(fitted, test):
    m = regression_metrics(fitted.model.transform(test), fitted.config.target, "prediction")
    return m.select("n", "rmse", "mae", "r2")


def q_lr_flow(spark, sf_dir):
    """60/5 policy -> index -> scale -> split -> linear-regression 2x2 grid, 3-fold CV."""
    from tarmac.plans.pipeline import fit_pipeline, lr_flow
    fitted, _, test = fit_pipeline(_ship_rows(spark, sf_dir), lr_flow(TARGET, KEYS))
    return _flow_metrics(fitted, test)


def q_gbt_flow(spark, sf_dir):
    """IQR filter on the target (factor 3) -> projection -> 40/10 policy + dropna -> index
    -> scale -> split -> boosted trees (depth 2) with 2-fold CV."""
    from tarmac.plans.pipeline import fit_pipeline, gbt_flow
    cols = ["l_returnflag", "l_linestatus", "o_orderpriority", "order_year", "order_month",
            "l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice", TARGET]
    cfg = gbt_flow(TARGET, KEYS, columns=cols,
                   categorical=["l_returnflag", "l_linestatus", "o_orderpriority", "order_year", "order_month"])
    fitted, _, test = fit_pipeline(_ship_rows(spark, sf_dir), cfg)
    return _flow_metrics(fitted, test)


def q_rf_flow(spark, sf_dir):
    """60/5 policy -> index -> scale -> split -> random-forest grid (depth 5/10 x 20/50
    trees), 3-fold CV, refit on all training rows."""
    from tarmac.plans.pipeline import fit_pipeline, rf_flow
    fitted, _, test = fit_pipeline(_ship_rows(spark, sf_dir), rf_flow(TARGET, KEYS))
    return _flow_metrics(fitted, test)


def q_boosted_flow(spark, sf_dir):
    """Drop the sparse column (l_discount, about 70% NULL) -> drop rows with any NULL ->
    alphabetical dictionary codes -> prune fixed columns -> split -> boosted trees
    (100 rounds, depth 3, unscaled) -> MSE and R2 on the test rows."""
    from tarmac.plans.pipeline import boosted_flow, fit_pipeline
    cfg = boosted_flow(TARGET, KEYS, drop_columns=["l_discount"],
                       prune_columns=["o_orderstatus", "order_month"])
    fitted, _, test = fit_pipeline(_ship_rows(spark, sf_dir), cfg)
    m = regression_metrics(fitted.model.transform(test), TARGET, "prediction")
    return m.select("n", "mse", "r2")


# The partition sweep's settings (partition sizes; LR grid, 3 folds, CV
# parallelism 1).
SWEEP_PARTITIONS = [10, 50, 100, 150, 200, 300]
SWEEP_GRID = {"regParam": [0.1, 0.01], "elasticNetParam": [0.0, 0.5, 1.0]}


def q_sweep_partitions(spark, sf_dir):
    """One run record per shuffle-partition setting: 60/5 cleaning + encoded table
    written (cleaning time), then LR grid search with 3-fold CV and test RMSE
    (training time)."""
    from tarmac.plans.pipeline import lr_flow
    from tarmac.plans.sweep import sweep
    df = _ship_rows(spark, sf_dir)
    return sweep(spark, lambda: df, partition_sizes=SWEEP_PARTITIONS,
                 make_config=lambda par: lr_flow(TARGET, KEYS, grid=SWEEP_GRID, parallelism=par))


# Settings of the sweep whose rows are stated in SQL.
SWEEP_EXACT = [4, 16]


def q_sweep_records(spark, sf_dir):
    """The fixed columns of run records: a setting each, with the rows that its cleaning kept."""
    from tarmac.plans.sweep import read_run_records, sweep, write_run_records
    df = _ship_rows(spark, sf_dir)
    runs = sweep(spark, lambda: df, partition_sizes=SWEEP_EXACT)
    path = write_run_records(runs, scratch_path(spark, "run-records"))
    back = read_run_records(spark, path)
    return back.select("partition_size", "parallelism", "rows_clean", "task_cpus")


def q_csv_overridden(spark, sf_dir):
    """CSV read with types inferred but for chosen columns, in splits of a set size."""
    from pyspark.sql import types as T
    path = scratch_path(spark, "csv-overridden")
    W.write_csv(_ship(spark, sf_dir).select(*KEYS, "o_orderpriority", "order_month"), path)
    return R.read_csv(spark, path, null_value="", infer=True, overrides={"order_month": T.StringType()},
                      max_partition_bytes=256 * 1024).select(
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"), F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        "o_orderpriority", "order_month")


def q_compacted(spark, sf_dir):
    """The table exported in few files of a set size."""
    path = scratch_path(spark, "compacted")
    W.write_compacted(_ship(spark, sf_dir), path, target_file_bytes=1 << 20)
    return R.read_parquet(spark, path)


def registry() -> dict:
    return {
        "null_profile": q_null_profile,
        "column_kinds": q_column_kinds,
        "distinct_counts": q_distinct_counts,
        "distinct_values": q_distinct_values,
        "correlation_matrix": q_correlation_matrix,
        "describe": q_describe,
        "quartiles": q_quartiles,
        "null_policy_60_5": q_null_policy_60_5,
        "null_policy_60_5_apply": q_null_policy_60_5_apply,
        "null_policy_40_10": q_null_policy_40_10,
        "null_policy_40_10_apply": q_null_policy_40_10_apply,
        "null_policy_thresh": q_null_policy_thresh,
        "null_policy_thresh_apply": q_null_policy_thresh_apply,
        "mean_impute": q_mean_impute,
        "iqr_filter": q_iqr_filter,
        "iqr_filter_apply": q_iqr_filter_apply,
        "string_index": q_string_index,
        "string_index_labels": q_string_index_labels,
        "string_index_numeric": q_string_index_numeric,
        "label_encode": q_label_encode,
        "dictionary_encode": q_dictionary_encode,
        "dictionary_large": q_dictionary_large,
        "categorize_roundtrip": q_categorize_roundtrip,
        "categorize_nulls": q_categorize_nulls,
        "hash_split": q_hash_split,
        "fold_assign": q_fold_assign,
        "standard_scale": q_standard_scale,
        "kfold_scale": q_kfold_scale,
        "linreg_coeffs": q_linreg_coeffs,
        "linreg_predict": q_linreg_predict,
        "regression_metrics": q_regression_metrics,
        "kfold_ols": q_kfold_ols,
        "tree_stump": q_tree_stump,
        "linreg_elastic": q_linreg_elastic,
        "linreg_ridge": q_linreg_ridge,
        "rf_exact": q_rf_exact,
        "gbt_exact": q_gbt_exact,
        "cv_grid_ridge": q_cv_grid_ridge,
        "rf_predict": q_rf_predict,
        "gbt_predict": q_gbt_predict,
        "cv_grid": q_cv_grid,
        "cv_grid_moments": q_cv_grid_moments,
        "stream_score": q_stream_score,
        "stream_resume": q_stream_resume,
        "stored_pipeline": q_stored_pipeline,
        "stream_score_events": q_stream_score_events,
        "boosted_predict": q_boosted_predict,
        "boosted_regularized": q_boosted_regularized,
        "kfold_rf": q_kfold_rf,
        "deep_tree": q_deep_tree,
        "sweep_partitions": q_sweep_partitions,
        "sweep_records": q_sweep_records,
        "csv_overridden": q_csv_overridden,
        "compacted": q_compacted,
        "lr_flow": q_lr_flow,
        "gbt_flow": q_gbt_flow,
        "rf_flow": q_rf_flow,
        "boosted_flow": q_boosted_flow,
        "csv_roundtrip": q_csv_roundtrip,
        "convert_once": q_convert_once,
        "parquet_roundtrip": q_parquet_roundtrip,
        "union_sources": q_union_sources,
        "preview": q_preview,
        "project_features": q_project_features,
        "drop_columns": q_drop_columns,
        "bulk_cast": q_bulk_cast,
        "dropna_any": q_dropna_any,
    }
