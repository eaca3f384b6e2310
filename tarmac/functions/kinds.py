"""Split a schema into numeric and string columns (schema arithmetic, no job)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _kind(dt: T.DataType) -> str:
    if isinstance(dt, T.NumericType):
        return "numeric"
    if isinstance(dt, T.StringType):
        return "string"
    if isinstance(dt, T.BooleanType):
        return "boolean"
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "temporal"
    return "other"


def column_kinds(df: DataFrame) -> list[tuple[str, str, str]]:
    """(column, kind, Spark type) for every column in schema order.

    Every ``NumericType`` counts as numeric, so ``bigint``, ``smallint`` and
    ``decimal`` columns are cleaned like ``int``/``double`` ones.
    """
    return [(f.name, _kind(f.dataType), f.dataType.simpleString()) for f in df.schema.fields]


def numeric_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    return [c for c, k, _ in column_kinds(df) if k == "numeric" and c not in exclude]


def string_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    return [c for c, k, _ in column_kinds(df) if k == "string" and c not in exclude]


def feature_columns(df: DataFrame, target: str, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    """All columns except the target and any excluded (key) columns."""
    return [c for c in df.columns if c != target and c not in exclude]
