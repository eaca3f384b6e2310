"""Feature preparation: assembling, standard scaling, hash split and folds.

Splits and folds come from ``key_bucket`` (md5 of the key columns), so they do not
depend on partitioning; rows sharing a key land on the same side.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.hashing import key_bucket

SPLIT_COL = "is_train"
FOLD_COL = "fold"


def assemble(df: DataFrame, cols: list[str], out: str = "features", handle_invalid: str = "error") -> DataFrame:
    """Numeric columns -> one vector column (NULL/NaN fail unless ``handle_invalid``)."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid).transform(df)


def hash_split(df: DataFrame, keys: list[str], train_share: float = 0.8, buckets: int | None = None,
               method: str = "md5") -> DataFrame:
    """Add boolean ``is_train``: bucket (hash window 0) < train_share * buckets.

    Without ``buckets``, the least power of ten that gives the share exactly (10 for 0.8,
    100 for 0.95), 1,000,000 at most; given ``buckets`` must express the share."""
    if not 0 < train_share < 1:
        raise ValueError("train_share must be between 0 and 1")
    if buckets is None:
        exact = (b for b in (10, 100, 1000, 10_000, 100_000)
                 if abs(train_share * b - round(train_share * b)) < 1e-9)
        buckets = next(exact, 1_000_000)
    cut = int(round(train_share * buckets))
    if not 0 < cut < buckets:
        raise ValueError(f"{buckets} buckets cannot express a share of {train_share}")
    return df.withColumn(SPLIT_COL, key_bucket(keys, buckets, window=0, method=method) < F.lit(cut))


def split_frames(df: DataFrame, keys: list[str], train_share: float = 0.8,
                 seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test). With ``seed`` the built-in ``randomSplit`` is used instead of
    the hash (its rows then depend on the input layout)."""
    if seed is not None:
        a, b = df.randomSplit([train_share, 1 - train_share], seed=seed)
        return a, b
    tagged = hash_split(df, keys, train_share)
    return (tagged.where(F.col(SPLIT_COL)).drop(SPLIT_COL),
            tagged.where(~F.col(SPLIT_COL)).drop(SPLIT_COL))


def assign_folds(df: DataFrame, keys: list[str], k: int = 5, method: str = "md5") -> DataFrame:
    """Add int ``fold`` in [0, k) from hash window 1 (independent of the split)."""
    return df.withColumn(FOLD_COL, key_bucket(keys, k, window=1, method=method))


def fit_scaler(df: DataFrame, input_col: str = "features", output_col: str = "scaled",
               with_mean: bool = True, with_std: bool = True) -> StandardScalerModel:
    """Built-in StandardScaler: sample std; a constant column scales to 0.0."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=with_mean,
                          withStd=with_std).fit(df)


def vector_columns(df: DataFrame, vec: str, names: list[str], drop: bool = True) -> DataFrame:
    """Vector column -> one double column per element."""
    arr = vector_to_array(F.col(vec))
    out = df.select("*", *[arr[i].alias(n) for i, n in enumerate(names)])
    return out.drop(vec) if drop else out


def standard_scale(
    df: DataFrame,
    cols: list[str],
    fit_on: DataFrame | None = None,
    prefix: str = "z_",
) -> DataFrame:
    """Standardize ``cols`` with mean/sample-std fitted on ``fit_on`` (default ``df``).

    The default in pipelines is to fit on training rows only; passing the whole table
    reproduces fitting before the split.
    """
    fit_on = fit_on if fit_on is not None else df
    tmp_in, tmp_out = "__feat", "__scaled"
    model = fit_scaler(assemble(fit_on, cols, tmp_in), tmp_in, tmp_out)
    scaled = model.transform(assemble(df, cols, tmp_in)).drop(tmp_in)
    return vector_columns(scaled, tmp_out, [prefix + c for c in cols])


def _merge(a, b):
    """Chan et al. merge of (n, mean, m2) moments."""
    na, ma, va = a
    nb, mb, vb = b
    n = na + nb
    if n == 0:
        return (0, 0.0, 0.0)
    d = mb - ma
    return (n, ma + d * nb / n, va + vb + d * d * na * nb / n)


def fold_moments(df: DataFrame, cols: list[str], fold_col: str = FOLD_COL) -> dict[int, dict[str, tuple]]:
    """Per fold and column: (n, mean, m2) from one grouped aggregate (k rows)."""
    rows = df.groupBy(fold_col).agg(*[
        e for i, c in enumerate(cols) for e in (
            F.count(F.col(c)).alias(f"n_{i}"),
            F.avg(F.col(c).cast("double")).alias(f"m_{i}"),
            (F.var_pop(F.col(c).cast("double")) * F.count(F.col(c))).alias(f"v_{i}"),
        )
    ]).collect()
    return {
        int(r[fold_col]): {c: (int(r[f"n_{i}"]), r[f"m_{i}"] or 0.0, r[f"v_{i}"] or 0.0) for i, c in enumerate(cols)}
        for r in rows
    }


def fold_scale(df: DataFrame, cols: list[str], fold_col: str = FOLD_COL, prefix: str = "z_") -> DataFrame:
    """Scale each row with the mean and *population* std of the other folds.

    This is per-fold scaling fitted on the training part only: the held-out fold's
    rows are transformed with statistics that never saw them.
    """
    moments = fold_moments(df, cols, fold_col)
    stats = []
    for f in sorted(moments):
        row = [f]
        for c in cols:
            acc = (0, 0.0, 0.0)
            for g, m in moments.items():
                if g != f:
                    acc = _merge(acc, m[c])
            n, mean, m2 = acc
            std = math.sqrt(m2 / n) if n else 0.0
            row += [mean, std]
        stats.append(tuple(row))
    schema = f"{fold_col} int, " + ", ".join(f"mu_{i} double, sd_{i} double" for i in range(len(cols)))
    sdf = df.sparkSession.createDataFrame(stats, schema)
    joined = df.join(F.broadcast(sdf), fold_col)
    scaled = [
        F.when(F.col(f"sd_{i}") == 0, F.lit(0.0))
        .otherwise((F.col(c).cast("double") - F.col(f"mu_{i}")) / F.col(f"sd_{i}")).alias(prefix + c)
        for i, c in enumerate(cols)
    ]
    return joined.select(*df.columns, *scaled)
