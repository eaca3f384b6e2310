"""Null policies, IQR filter and simple cleaning steps on hand-made frames."""

from __future__ import annotations

import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.operators import clean as C


def _frame(spark, cols: dict[str, list], types: dict[str, str] | None = None):
    names = list(cols)
    n = len(cols[names[0]])
    types = types or {}
    schema = ", ".join(f"{c} {types.get(c, 'double')}" for c in names)
    rows = [tuple(cols[c][i] for c in names) for i in range(n)]
    return spark.createDataFrame(rows, schema)


def _actions(model):
    return {a.column: a.action for a in model.actions}


def test_60_5_tier_boundaries(spark):
    n = 100
    # exactly 5% missing -> drop rows; exactly 60% -> impute (needs > 60% to drop)
    cols = {
        "five": [None if i < 5 else float(i) for i in range(n)],
        "sixty": [None if i >= 40 else float(i) for i in range(n)],
        "sixty_one": [None if i >= 39 else 1.0 for i in range(n)],
        "six": [None if 50 <= i < 56 else 2.0 for i in range(n)],
    }
    df = _frame(spark, cols)
    model = C.fit_null_policy(df, ["five", "sixty_one", "six", "sixty"])
    acts = _actions(model)
    assert acts["five"] == C.DROP_ROWS
    assert acts["sixty_one"] == C.DROP_COLUMN
    assert acts["six"] == C.IMPUTE
    # 'sixty' is judged after the 5 rows of 'five' were dropped: still 60 missing of
    # n=100 -> not > 60 -> impute, with the mean over the remaining present rows
    assert acts["sixty"] == C.IMPUTE
    mean_sixty = [a.mean for a in model.actions if a.column == "sixty"][0]
    assert math.isclose(mean_sixty, sum(range(5, 40)) / 35)
    out = model.transform(df)
    assert "sixty_one" not in out.columns
    assert out.count() == 95
    assert out.where(F.col("six").isNull() | F.col("sixty").isNull()).count() == 0


def test_60_5_order_dependence(spark):
    # b is missing exactly where a is missing: once a's rows are dropped, b has none
    n = 100
    a = [None if i < 4 else 1.0 for i in range(n)]
    b = [None if i < 10 else 2.0 for i in range(n)]
    df = _frame(spark, {"a": a, "b": b})
    assert _actions(C.fit_null_policy(df, ["a", "b"])) == {"a": C.DROP_ROWS, "b": C.IMPUTE}
    m = C.fit_null_policy(df, ["a", "b"])
    assert [x.missing for x in m.actions] == [4, 6]


def _one_column_at_a_time(df, cols, n_rows, drop_column_above, drop_rows_at_most):
    """The sequential rule taken literally: one aggregate per column over the rows left."""
    actions = []
    for c in cols:
        r = df.agg(F.count_if(F.col(c).isNull()).alias("missing"), F.avg(c).alias("mean")).first()
        missing = int(r["missing"])
        if missing > drop_column_above * n_rows:
            actions.append(C.ColumnAction(c, C.DROP_COLUMN, missing))
        elif missing <= drop_rows_at_most * n_rows:
            actions.append(C.ColumnAction(c, C.DROP_ROWS, missing))
            df = df.where(F.col(c).isNotNull())
        else:
            actions.append(C.ColumnAction(c, C.IMPUTE, missing, r["mean"]))
    return actions


def test_histogram_equals_sequential(spark):
    rnd = random.Random(7)
    n = 400
    cols = {f"c{j}": [None if rnd.random() < p else rnd.uniform(-5, 5) for _ in range(n)]
            for j, p in enumerate([0.02, 0.3, 0.7, 0.05, 0.45])}
    df = _frame(spark, cols)
    names = list(cols)
    fast = C.fit_null_policy(df, names)
    slow_actions = _one_column_at_a_time(df, names, n, 0.6, 0.05)
    assert [(a.column, a.action, a.missing) for a in fast.actions] == \
           [(a.column, a.action, a.missing) for a in slow_actions]
    for a, b in zip(fast.actions, slow_actions):
        if a.mean is not None:
            assert math.isclose(a.mean, b.mean, rel_tol=1e-12)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.booleans(), st.booleans()), min_size=1, max_size=60))
def test_histogram_property(spark, masks):
    rows = [tuple(None if m else float(i + k) for k, m in enumerate(ms)) for i, ms in enumerate(masks)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    fast = C.fit_null_policy(df, ["a", "b", "c"])
    slow = _one_column_at_a_time(df, ["a", "b", "c"], len(rows), 0.6, 0.05)
    assert [(x.action, x.missing) for x in fast.actions] == [(x.action, x.missing) for x in slow]


def test_all_null_and_empty(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    m = C.fit_null_policy(df, ["a", "b"])
    assert _actions(m) == {"a": C.DROP_COLUMN, "b": C.DROP_ROWS}
    empty = spark.createDataFrame([], "a double")
    m2 = C.fit_null_policy(empty, ["a"])
    assert m2.n_rows == 0 and m2.transform(empty).count() == 0


def test_ratio_policy_40_10(spark):
    n = 100
    df = _frame(spark, {
        "forty": [None if i < 40 else 1.0 for i in range(n)],
        "forty_one": [None if i < 41 else 1.0 for i in range(n)],
        "ten": [None if i < 10 else 3.0 for i in range(n)],
        "eleven": [None if i < 11 else float(i) for i in range(n)],
    })
    m = C.fit_null_policy_ratio(df, ["forty", "forty_one", "ten", "eleven"])
    assert _actions(m) == {"forty": C.IMPUTE, "forty_one": C.DROP_COLUMN, "ten": C.KEEP, "eleven": C.IMPUTE}
    out = m.transform(df)
    # 'ten' keeps its NULLs until the final dropna removes those 10 rows
    assert out.count() == 90 and "forty_one" not in out.columns


def test_threshold_policy(spark):
    df = spark.createDataFrame(
        [(None if i < 5 else 1.0, None if i < 4 else "x", float(i)) for i in range(10)],
        "a double, s string, b double")
    # int(0.6 * 10) = 6 non-null needed: a has 5 -> dropped, s has 6 -> kept
    m = C.fit_null_policy_threshold(df, 0.6)
    assert _actions(m) == {"a": C.DROP_COLUMN, "s": C.KEEP, "b": C.IMPUTE}


def test_nan_is_not_null_until_converted(spark):
    from tarmac.functions.nulls import nan_to_null
    df = spark.createDataFrame([(float("nan"),), (1.0,), (3.0,)], "a double")
    assert df.where(F.col("a").isNull()).count() == 0
    out = C.mean_impute(nan_to_null(df), ["a"])
    assert sorted(r.a for r in out.collect()) == [1.0, 2.0, 3.0]


def test_iqr_filter_sequential_and_null(spark):
    vals = [float(v) for v in range(1, 21)] + [1000.0, None]
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(vals)], "d double, e double")
    out, bounds = C.iqr_filter(df, ["d"], factor=1.5, exact=True, count_rows=True)
    # lower quartile element: rank ceil(.25*21)-1 = 5 -> 6.0; upper: ceil(.75*21)-1 = 15 -> 16.0
    assert (bounds[0].q1, bounds[0].q3) == (6.0, 16.0)
    assert bounds[0].rows_after == 20          # 1000 and NULL removed
    assert out.where(F.col("d").isNull()).count() == 0


def test_iqr_zero_keeps_only_the_mode(spark):
    df = spark.createDataFrame([(5.0,)] * 10 + [(6.0,)], "d double")
    out, b = C.iqr_filter(df, ["d"], exact=True)
    assert b[0].lower == b[0].upper == 5.0 and out.count() == 10


def test_drop_columns_reports_unknown(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out, missing = C.drop_columns(df, ["a", "nope"])
    assert out.columns == ["b"] and missing == ["nope"]


def test_bulk_cast_and_narrow(spark):
    df = spark.createDataFrame([(1.5, 2, "x")], "a double, b int, s string")
    out = C.narrow_doubles(df)
    assert dict(out.dtypes) == {"a": "float", "b": "int", "s": "string"}
    out2 = C.bulk_cast(df, {"b": "double"})
    assert dict(out2.dtypes)["b"] == "double"


def test_distinct_counts_reports_errors_per_column(spark):
    from tarmac.operators.profile import distinct_counts
    df = spark.createDataFrame([("a", "x"), ("b", "x"), (None, "y")], "s string, t string")
    out = {r.column_name: (r.n_distinct, r.error) for r in distinct_counts(df, ["s", "t", "nope"]).collect()}
    assert out == {"s": (2, None), "t": (2, None), "nope": (None, "column not found")}


def test_dropna_policy_drops_sparse_column_first(spark):
    # the row with a NULL only in the sparse column survives because that column goes first
    df = _frame(spark, {"a": [1.0, None, 3.0, 4.0], "sparse": [None, None, None, 9.0],
                        "s": ["x", "y", None, "z"]}, {"s": "string"})
    model = C.fit_null_policy_dropna(df, ["sparse"])
    assert _actions(model) == {"a": C.KEEP, "sparse": C.DROP_COLUMN, "s": C.KEEP}
    assert {a.column: a.missing for a in model.actions} == {"a": 1, "sparse": 3, "s": 1}
    out = model.transform(df)
    assert out.columns == ["a", "s"]
    assert sorted(tuple(r) for r in out.collect()) == [(1.0, "x"), (4.0, "z")]
