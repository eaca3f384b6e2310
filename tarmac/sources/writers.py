"""Sinks: Parquet (overwrite), CSV with header, and size-targeted compaction.

A single-file export (``repartition(1)``) would push the whole table through one
task; ``write_compacted`` instead lets AQE size the output partitions so each file
holds about ``target_file_bytes``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null_value: str = "") -> str:
    """CSV with a header line; NULL written as ``null_value`` (empty by default)."""
    df.write.mode(mode).option("header", True).option("nullValue", null_value) \
        .option("emptyValue", '""').csv(path)
    return path


def count_files(spark, path: str, suffix: str = ".parquet") -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(1 for st in fs.listStatus(p) if st.getPath().getName().endswith(suffix))


def write_compacted(
    df: DataFrame,
    path: str,
    target_file_bytes: int = 512 * 1024 * 1024,
    mode: str = "overwrite",
) -> int:
    """Parquet files of about ``target_file_bytes`` (of shuffle data) each; returns the
    number of files written.

    The ``rebalance`` hint lets AQE split or coalesce the output partitions to the
    advisory size from the actual shuffle sizes at run time. Optimizer estimates of a
    join's size can be off by orders of magnitude, so they are not used. Upstream
    stages keep their full parallelism (unlike ``coalesce``).
    """
    spark = df.sparkSession
    # the advisory size must win over "as many partitions as cores" while coalescing
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(int(target_file_bytes)),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df.hint("rebalance").write.mode(mode).parquet(path)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    return count_files(spark, path)
