"""Materialized intermediate tables in the shared checkpoint folder.

Writing a prepared table as Parquet and reading it back cuts the lineage (a lost
executor re-reads files instead of recomputing joins and cleaning), and lets later
passes scan it in parallel. A rebalance hint lets AQE size the written partitions (a source
file with one row group would else stay one task); the plan runs once, with the write.
Rows that a join of large tables has just dealt out are written as they lie (``spread=False``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tarmac.session import scratch_path


def materialize(df: DataFrame, name: str = "table", partitions: int | None = None, spread: bool = True) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if partitions:
        df = df.repartition(partitions, *[df[c] for c in df.columns])
    elif spread:
        df = df.hint("rebalance")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
