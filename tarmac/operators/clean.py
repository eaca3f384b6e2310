"""Cleaning: null policies (fit/transform), IQR outlier filter, imputation, drops, casts.

Null policies are Estimator/Model pairs: ``fit`` decides each column's action from
a small aggregate, ``transform`` applies all actions as one projection + one filter,
so the plan does not grow with one node per column and per job.

The sequential 60/5 policy (column k is judged on the rows left after the row drops
of columns 1..k-1, against a fixed total) is fitted from a *null-pattern histogram*:
``groupBy(null mask).agg(count, sum(c)...)``. The histogram has one row per distinct
pattern of NULLs and is written to the shared folder; the walk over columns aggregates it,
exactly reproducing the sequential rule with one scan of the data, whatever the number of
patterns. Only counts and sums per column reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.kinds import numeric_columns
from tarmac.functions.nulls import null_bits, null_mask
from tarmac.operators.quantiles import quantiles
from tarmac.sources.tables import materialize

DROP_COLUMN = "drop_column"
DROP_ROWS = "drop_rows"
IMPUTE = "impute"
KEEP = "keep"


@dataclass
class ColumnAction:
    column: str
    action: str
    missing: int
    mean: float | None = None


@dataclass
class NullPolicyModel:
    """Fitted actions; ``transform`` is one projection and one filter."""

    actions: list[ColumnAction]
    n_rows: int
    drop_any_null: bool = False
    row_filter_cols: list[str] = field(default_factory=list)

    def action_of(self, column: str) -> str | None:
        for a in self.actions:
            if a.column == column:
                return a.action
        return None

    def transform(self, df: DataFrame) -> DataFrame:
        dropped = {a.column for a in self.actions if a.action == DROP_COLUMN}
        impute = {a.column: a.mean for a in self.actions if a.action == IMPUTE}
        unseen = {a.column: a.missing == 0 for a in self.actions}
        cond: Column | None = None
        for a in self.actions:
            if a.action == DROP_ROWS:
                c = F.col(a.column).isNotNull()
                cond = c if cond is None else cond & c
        if cond is not None:
            df = df.where(cond)
        proj = []
        for c in df.columns:
            if c in dropped:
                continue
            if c in impute and impute[c] is not None:
                if unseen[c]:  # nothing was missing in the fit: the column keeps its type
                    filler = F.lit(float(impute[c])).cast(df.schema[c].dataType)
                    proj.append(F.coalesce(F.col(c), filler).alias(c))
                else:
                    proj.append(F.coalesce(F.col(c).cast("double"), F.lit(float(impute[c]))).alias(c))
            else:
                proj.append(F.col(c))
        out = df.select(*proj)
        if self.drop_any_null:
            out = out.na.drop(how="any")
        return out

    def report(self, spark) -> DataFrame:
        """(column_name, action, missing, mean_value) - one row per judged column."""
        return spark.createDataFrame(
            [(a.column, a.action, int(a.missing), None if a.mean is None else float(a.mean))
             for a in self.actions],
            "column_name string, action string, missing bigint, mean_value double",
        )


def null_pattern_histogram(df: DataFrame, cols: list[str]) -> DataFrame:
    """(mask, cnt, s_0..s_k): one row per distinct NULL pattern over ``cols``.

    The mask is a bigint bitmask (a string for more than 63 columns). Partial
    aggregation runs before the shuffle, so a pattern held by most rows (the usual
    case: nothing missing) costs one row per task, not a hot key.
    """
    mask = null_bits(cols) if len(cols) <= 63 else null_mask(cols)
    return df.groupBy(mask.alias("mask")).agg(
        F.count(F.lit(1)).alias("cnt"),
        *[F.sum(F.col(c).cast("double")).alias(f"s_{i}") for i, c in enumerate(cols)],
    )


def _pattern_lacks(i: int, n_cols: int) -> Column:
    """Whether a pattern of the histogram has column ``i`` NULL."""
    if n_cols <= 63:
        return F.col("mask").bitwiseAND(F.lit(1 << i)) != 0
    return F.substring("mask", i + 1, 1) == "1"


def _walk_histogram(hist: DataFrame, cols: list[str], drop_column_above: float,
                    drop_rows_at_most: float) -> tuple[list[ColumnAction], int]:
    """(actions, rows before cleaning) from the written histogram.

    One aggregate gives every column's missing count and sum over the patterns still left;
    it holds until a column drops rows, and is then taken again.
    """
    lacks = [_pattern_lacks(i, len(cols)) for i in range(len(cols))]
    left, n_rows, actions = hist, None, []
    while n_rows is None or len(actions) < len(cols):
        todo = range(len(actions), len(cols))
        r = left.agg(
            F.sum("cnt").alias("n"),
            *[F.sum(F.when(lacks[i], F.col("cnt"))).alias(f"m_{i}") for i in todo],
            *[F.sum(f"s_{i}").alias(f"t_{i}") for i in todo],
        ).first()
        n = int(r["n"] or 0)
        n_rows = n if n_rows is None else n_rows
        for i in todo:
            missing = int(r[f"m_{i}"] or 0)
            if missing > drop_column_above * n_rows:
                actions.append(ColumnAction(cols[i], DROP_COLUMN, missing))
            elif missing <= drop_rows_at_most * n_rows:
                actions.append(ColumnAction(cols[i], DROP_ROWS, missing))
                if missing:
                    left = left.where(~lacks[i])
                    break
            else:
                present = n - missing
                mean = r[f"t_{i}"] / present if present else None
                actions.append(ColumnAction(cols[i], IMPUTE, missing, mean))
    return actions, n_rows


def fit_null_policy(
    df: DataFrame,
    cols: list[str] | None = None,
    drop_column_above: float = 0.6,
    drop_rows_at_most: float = 0.05,
) -> NullPolicyModel:
    """Sequential three-tier policy on numeric columns (default 60/5).

    For each column in order, with ``n`` = rows before cleaning and ``missing``
    counted on the rows still left: missing > drop_column_above*n -> drop the column;
    missing <= drop_rows_at_most*n -> drop those rows; otherwise impute the mean of
    the rows still left.
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    hist = materialize(null_pattern_histogram(df, cols), "null-patterns")
    actions, n_rows = _walk_histogram(hist, cols, drop_column_above, drop_rows_at_most)
    return NullPolicyModel(actions, n_rows)


def _independent_counts(df: DataFrame, cols: list[str], with_means: list[str]) -> tuple[int, dict, dict]:
    r = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"m_{i}") for i, c in enumerate(cols)],
        *[F.avg(F.col(c).cast("double")).alias(f"a_{i}") for i, c in enumerate(with_means)],
    ).first()
    missing = {c: int(r[f"m_{i}"]) for i, c in enumerate(cols)}
    means = {c: r[f"a_{i}"] for i, c in enumerate(with_means)}
    return int(r["n"]), missing, means


def fit_null_policy_ratio(
    df: DataFrame,
    cols: list[str] | None = None,
    drop_column_above: float = 0.4,
    impute_above: float = 0.1,
    drop_remaining_nulls: bool = True,
) -> NullPolicyModel:
    """Ratio policy (default 40/10 + dropna).

    No rows are removed while columns are judged, so one aggregate gives every
    column's missing count and mean: ratio > drop_column_above -> drop the column;
    ratio > impute_above -> impute the mean; else keep. Afterwards rows with a NULL
    in any remaining column are dropped.
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    n, missing, means = _independent_counts(df, cols, cols)
    actions = []
    for c in cols:
        ratio = missing[c] / n if n else 0.0
        if ratio > drop_column_above:
            actions.append(ColumnAction(c, DROP_COLUMN, missing[c]))
        elif ratio > impute_above:
            actions.append(ColumnAction(c, IMPUTE, missing[c], means[c]))
        else:
            actions.append(ColumnAction(c, KEEP, missing[c]))
    return NullPolicyModel(actions, n, drop_any_null=drop_remaining_nulls)


def fit_null_policy_threshold(df: DataFrame, keep_share: float = 0.6,
                              exclude: list[str] | tuple[str, ...] = ()) -> NullPolicyModel:
    """Keep a column (any type) only if it has at least ``int(keep_share*n)`` non-NULL
    values; mean-impute every remaining numeric column (mean over all rows). Columns in
    ``exclude`` (keys, the target) are not judged and never changed."""
    cols = [c for c in df.columns if c not in exclude]
    nums = [c for c in numeric_columns(df) if c in cols]
    n, missing, means = _independent_counts(df, cols, nums)
    thresh = int(keep_share * n)
    actions = []
    for c in cols:
        if n - missing[c] < thresh:
            actions.append(ColumnAction(c, DROP_COLUMN, missing[c]))
        elif c in nums:
            actions.append(ColumnAction(c, IMPUTE, missing[c], means[c]))
        else:
            actions.append(ColumnAction(c, KEEP, missing[c]))
    return NullPolicyModel(actions, n)


def fit_null_policy_dropna(df: DataFrame, drop: list[str] | tuple[str, ...] = ()) -> NullPolicyModel:
    """Drop the named (sparse) columns, then every row that still has a NULL.

    One aggregate records each column's NULL count before the drop (the report); the
    transform is a projection and one ``na.drop``.
    """
    cols = list(df.columns)
    n, missing, _ = _independent_counts(df, cols, [])
    actions = [ColumnAction(c, DROP_COLUMN if c in drop else KEEP, missing[c]) for c in cols]
    return NullPolicyModel(actions, n, drop_any_null=True)


def mean_impute(df: DataFrame, cols: list[str]) -> DataFrame:
    """Replace NULL by the column mean (one aggregate for all means)."""
    r = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return df.select(*[
        F.coalesce(F.col(c).cast("double"), F.lit(r[c])).alias(c) if c in cols and r[c] is not None
        else F.col(c)
        for c in df.columns
    ])


def fill_nulls(df: DataFrame, values: dict) -> DataFrame:
    return df.na.fill(values)


@dataclass
class IqrBound:
    column: str
    q1: float
    q3: float
    lower: float
    upper: float
    rows_after: int | None = None


def iqr_filter(
    df: DataFrame,
    cols: list[str],
    factor: float = 1.5,
    relative_error: float = 0.01,
    exact: bool = False,
    count_rows: bool = False,
) -> tuple[DataFrame, list[IqrBound]]:
    """Keep rows inside [q1 - f*iqr, q3 + f*iqr] for each column in turn.

    Later columns' quartiles are taken on rows already filtered by earlier ones, so
    there is one quantile pass per column. NULLs fail the range test and are removed.
    Where several passes read the columns, they are written alone first, so that what ``df`` is made
    of runs once for all passes and once for the filtered rows.
    """
    bounds = []
    passes = len(cols) * (1 + exact + count_rows)
    seen = materialize(df.select(*dict.fromkeys(cols)), "iqr_columns", spread=False) if passes > 1 else df
    for c in cols:
        q = quantiles(seen, [c], [0.25, 0.75], exact=exact, relative_error=relative_error)[c]
        q1, q3 = q
        if q1 is None:
            lower = upper = None
            keep = F.lit(False)
        else:
            iqr = q3 - q1
            lower, upper = q1 - factor * iqr, q3 + factor * iqr
            keep = F.col(c).between(lower, upper)
        df, seen = df.where(keep), seen.where(keep)
        bounds.append(IqrBound(c, q1, q3, lower, upper, seen.count() if count_rows else None))
    return df, bounds


def drop_columns(df: DataFrame, cols: list[str]) -> tuple[DataFrame, list[str]]:
    """Drop the named columns; names not present are ignored and returned."""
    missing = [c for c in cols if c not in df.columns]
    return df.drop(*[c for c in cols if c in df.columns]), missing


def dropna_any(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=subset)


def project(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


def bulk_cast(df: DataFrame, types: dict[str, str | T.DataType]) -> DataFrame:
    """Cast the named columns in one projection; others pass through."""
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def narrow_doubles(df: DataFrame) -> DataFrame:
    """Every double column to 32-bit float."""
    return bulk_cast(df, {f.name: T.FloatType() for f in df.schema.fields
                          if isinstance(f.dataType, T.DoubleType)})
