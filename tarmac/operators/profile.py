"""Profiling: null counts, distinct counts, correlations, summaries, column kinds.

Each profile is one aggregate over all requested columns (the reference ran one job
per column), returned as a long table with one row per column (or column pair).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.kinds import column_kinds, numeric_columns, string_columns
from tarmac.operators.moments import cross_products
from tarmac.operators.quantiles import exact_quantiles_with, quantiles


def _unpivot(one_row: DataFrame, names: list[str], fields: dict[str, list[str]]) -> DataFrame:
    """Turn a one-row aggregate with columns ``{field}_{i}`` into one row per name."""
    structs = []
    for i, name in enumerate(names):
        structs.append(F.struct(
            F.lit(name).alias("column_name"),
            *[F.col(f"{f}_{i}").alias(f) for f in fields[name]],
        ))
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column_name, n_rows, n_null, null_ratio) for every column, from one scan."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"n_null_{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    structs = []
    for i, c in enumerate(cols):
        structs.append(F.struct(
            F.lit(c).alias("column_name"),
            F.col("n_rows").cast("bigint").alias("n_rows"),
            F.col(f"n_null_{i}").cast("bigint").alias("n_null"),
        ))
    out = one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")
    return out.withColumn(
        "null_ratio",
        F.when(F.col("n_rows") > 0, F.col("n_null") / F.col("n_rows")).otherwise(F.lit(None)).cast("double"),
    )


def distinct_counts(
    df: DataFrame, cols: list[str] | None = None, approx: bool = False, rsd: float = 0.05
) -> DataFrame:
    """(column_name, n_distinct) for the non-numeric columns (or ``cols``); NULL not counted.

    Exact mode is one aggregate of several distinct counts (partial aggregation on
    (column, value) before the shuffle); ``approx`` uses HyperLogLog++ sketches.
    Columns whose type cannot be counted get n_distinct NULL and an error text
    instead of failing the whole profile.
    """
    cols = list(cols) if cols is not None else string_columns(df)
    ok, errors = [], {}
    for c in cols:
        if c not in df.columns:
            errors[c] = "column not found"
        elif isinstance(df.schema[c].dataType, (T.MapType,)):
            errors[c] = "map columns cannot be compared"
        else:
            ok.append(c)
    spark = df.sparkSession
    schema = "column_name string, n_distinct bigint, error string"
    parts = []
    if ok:
        fn = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
        one = df.agg(*[fn(F.col(c)).alias(f"n_{i}") for i, c in enumerate(ok)])
        parts.append(
            one.select(F.explode(F.array(*[
                F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").cast("bigint").alias("n_distinct"),
                         F.lit(None).cast("string").alias("error"))
                for i, c in enumerate(ok)
            ])).alias("r")).select("r.*")
        )
    if errors:
        parts.append(spark.createDataFrame([(c, None, e) for c, e in errors.items()], schema))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def correlation_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(col_a, col_b, corr): Pearson, pairwise-complete (a pair skips rows where
    either value is NULL). NULL where a pair has no rows or one side does not vary.

    Two scans: the columns' means, then blocks of cross products of centred values (see
    ``moments``), whatever the number of columns. Rows are never multiplied; one row of
    sums per column and task is shuffled.
    """
    cols = list(cols or numeric_columns(df))
    schema = "col_a string, col_b string, corr double"
    if not cols:
        return df.sparkSession.createDataFrame([], schema)
    p = range(len(cols))
    x = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    first = x.agg(*[f(f"x{i}").alias(f"{f.__name__}{i}") for i in p for f in (F.avg, F.min, F.max)]).first()
    # a constant column is centred exactly
    centre = [first[f"min{i}"] if first[f"min{i}"] == first[f"max{i}"] else first[f"avg{i}"] for i in p]
    centre = [0.0 if v is None or not math.isfinite(v) else v for v in centre]
    found = cross_products(x, x.columns, centre).get(None)
    if found is None:
        return df.sparkSession.createDataFrame([(a, b, None) for a in cols for b in cols], schema)
    n, s, q = found.n, found.s, found.q
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = np.where(n > 0, q - s * s / n, 0.0)  # n times the variance of i where j is set
        varies = (spread > 1e-12 * q) | np.isnan(spread)
        corr = (found.c - s * s.T / n) / np.sqrt(spread * spread.T)
    corr[np.diag_indices(len(cols))] = np.where(np.isnan(np.diag(spread)), np.nan, 1.0)
    known = varies & varies.T
    return df.sparkSession.createDataFrame([(a, b, float(corr[i, j]) if known[i, j] else None) for i, a in enumerate(cols) for j, b in enumerate(cols)], schema)


def describe(
    df: DataFrame,
    cols: list[str] | None = None,
    exact: bool = True,
    relative_error: float = 0.001,
) -> DataFrame:
    """(column_name, count, mean, std, min, q25, q50, q75, max) per numeric column.

    Moments come from one aggregate; quartiles are exact and linearly interpolated
    (as in pandas' describe) by default, or approximate with bounded memory.
    """
    cols = list(cols or numeric_columns(df))
    spark = df.sparkSession
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).cast("bigint").alias(f"count_{i}"),
            F.avg(x).alias(f"mean_{i}"),
            F.stddev_samp(x).alias(f"std_{i}"),
            F.min(x).alias(f"min_{i}"),
            F.max(x).alias(f"max_{i}"),
        ]
    probs = [0.25, 0.5, 0.75]
    if exact:
        # the moments ride along in the quantiles' first scan
        q, m = exact_quantiles_with(df, cols, probs, interpolation="linear", extra_aggs=aggs)
    else:
        q = quantiles(df, cols, probs, exact=False, relative_error=relative_error)
        m = df.agg(*aggs).first()
    rows = [(c, m[f"count_{i}"], m[f"mean_{i}"], m[f"std_{i}"], m[f"min_{i}"],
             *[None if v is None else float(v) for v in q[c]], m[f"max_{i}"])
            for i, c in enumerate(cols)]
    return spark.createDataFrame(
        rows, "column_name string, count bigint, mean double, std double, min double, "
              "q25 double, q50 double, q75 double, max double",
    )


def column_kinds_frame(df: DataFrame) -> DataFrame:
    """(column_name, kind, data_type) - schema only, no job."""
    return df.sparkSession.createDataFrame(
        column_kinds(df), "column_name string, kind string, data_type string"
    )
