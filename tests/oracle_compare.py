"""Compare a registered Spark query with its DuckDB SQL (row count, names, values).

Values are compared exactly after sorting columns by name and rows by value, the way
an order-insensitive hash would see them.
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(v) for v in r) for r in pdf[cols].astype(object).itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, query_fn, sql: str, sf_dir: str) -> dict:
    sdf = query_fn(spark, sf_dir)
    spark_pdf = pd.DataFrame([r.asDict() for r in sdf.collect()], columns=sdf.columns)
    duck_pdf = con.sql(sql).df()
    res = {
        "rows_spark": len(spark_pdf),
        "rows_oracle": len(duck_pdf),
        "names_match": sorted(spark_pdf.columns) == sorted(duck_pdf.columns),
    }
    res["values_match"] = res["names_match"] and _rows(spark_pdf) == _rows(duck_pdf)
    if res["names_match"] and not res["values_match"]:
        a, b = _rows(spark_pdf), _rows(duck_pdf)
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        res["first_diff"] = diff[:3]
    elif not res["names_match"]:
        res["columns"] = (list(spark_pdf.columns), list(duck_pdf.columns))
    return res
