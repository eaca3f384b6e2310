"""Configuration sweeps: run clean + train under each setting and record the times.

Settings that can change at run time are swept in one session:
``spark.sql.shuffle.partitions`` (the partition size of the reference's sweeps) and
the grid-search parallelism. Executor counts, cores and memory are deployment settings: each
record states those of its session. While a sweep runs, adaptive execution does not merge
partitions, which would undo the setting. The result is a DataFrame of run records; where the
session writes an event log that can be read (``run_log``), a record also has the tasks, their
times, the shuffled and the spilled bytes of its run.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.plans.run_log import event_log_path, run_figures
from tarmac.sources.tables import materialize

RUN_SCHEMA = (
    "partition_size int, parallelism int, cleaning_time double, training_time double, "
    "rows_clean bigint, rmse double, memory string, executor_cores int, executor_instances int, task_cpus int, "
    "stages bigint, tasks bigint, task_seconds double, longest_task_seconds double, "
    "shuffle_read_bytes bigint, shuffle_written_bytes bigint, spilled_bytes bigint"
)
LOG_FIELDS = ["stages", "tasks", "task_seconds", "longest_task_seconds", "shuffle_read_bytes",
              "shuffle_written_bytes", "spilled_bytes"]
COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"


def deployment(spark: SparkSession) -> tuple[str, int, int, int]:
    """(executor memory, cores of an executor, executors, cores of a task) of the session. On a local
    master, one executor has all its cores."""
    sc = spark.sparkContext
    conf = sc.getConf()
    local = sc.master.startswith("local")
    memory = conf.get("spark.driver.memory" if local else "spark.executor.memory", "1g")
    task_cpus = int(conf.get("spark.task.cpus", "1"))
    if local:
        return memory, sc.defaultParallelism, 1, task_cpus
    instances = conf.get("spark.executor.instances", None)
    cores = int(conf.get("spark.executor.cores", "1"))
    return memory, cores, int(instances) if instances else max(sc.defaultParallelism // cores, 1), task_cpus


def run_once(spark: SparkSession, load: Callable[[], DataFrame], model: str = "ols",
             parallelism: int = 1, make_config=None) -> tuple[float, float, int, float]:
    """(cleaning seconds, training seconds, clean rows, test RMSE) for one run.

    Cleaning runs until the cleaned, encoded table is written. Training covers the rest:
    re-read, assemble, scale, fit (or grid search) and the test metrics.
    ``make_config(parallelism)`` builds the pipeline configuration (for example a
    grid-search flow whose CV runs ``parallelism`` fits at a time); by default the
    pipeline fits ``model`` once."""
    from tarmac.operators.metrics import regression_metrics
    from tarmac.plans.pipeline import PipelineConfig, fit_pipeline

    cfg = make_config(parallelism) if make_config else PipelineConfig(model=model, parallelism=parallelism)
    marks: dict = {}
    t0 = time.time()
    fitted, train_s, test_s = fit_pipeline(load(), cfg, timings=marks)
    preds = fitted.model.transform(test_s)
    m = regression_metrics(preds, cfg.target, "prediction").first()
    t2 = time.time()
    t1 = marks.get("cleaned_at", t0)
    rows = train_s.count() + test_s.count()
    train_s.unpersist()
    return t1 - t0, t2 - t1, rows, m["rmse"]


def sweep(spark: SparkSession, load: Callable[[], DataFrame], partition_sizes: list[int],
          parallelism: list[int] | None = None, model: str = "ols", make_config=None) -> DataFrame:
    """One run record per (partition size, parallelism)."""
    sc = spark.sparkContext
    old, merges = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get(COALESCE)
    group = {k: sc.getLocalProperty(k) for k in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")}
    settings, records, name = deployment(spark), [], uuid.uuid4().hex
    try:
        spark.conf.set(COALESCE, "false")
        for ps in partition_sizes:
            spark.conf.set("spark.sql.shuffle.partitions", str(ps))
            for par in parallelism or [1]:
                sc.setJobGroup(f"{name}-{len(records)}", f"sweep: {ps} partitions, {par} fits at a time")
                c, t, n, rmse = run_once(spark, load, model, par, make_config)
                records.append((f"{name}-{len(records)}", ps, par, c, t, n, rmse, *settings))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set(COALESCE, merges)
        for k, v in group.items():
            sc.setLocalProperty(k, v)
    fields = RUN_SCHEMA.split(", ")
    runs = spark.createDataFrame(records, ", ".join(["run string", *fields[:-len(LOG_FIELDS)]]))
    path = event_log_path(spark)
    if path is None:
        return runs.select(*runs.columns[1:], *[F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in fields[-len(LOG_FIELDS):]])
    figures = run_figures(spark, path).select("run", *LOG_FIELDS)
    return materialize(runs.join(F.broadcast(runs.select("run")).join(figures, "run"), "run", "left").drop("run"), "runs")


def write_run_records(df: DataFrame, path: str) -> str:
    """Run records as CSV with a header (one small file per partition)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_run_records(spark: SparkSession, path: str) -> DataFrame:
    """Run records written by ``write_run_records`` (or a CSV with the same columns)."""
    return spark.read.option("header", True).schema(RUN_SCHEMA).csv(path)


def speedup_table(spark: SparkSession, rows: list[tuple[str, int, float]]) -> DataFrame:
    """(model, cores, seconds) -> plus speed-up against the 1-core time of each model."""
    df = spark.createDataFrame(rows, "model string, cores int, seconds double")
    base = df.where(F.col("cores") == 1).select("model", F.col("seconds").alias("_base"))
    return df.join(base, "model", "left").select(
        "model", "cores", "seconds", (F.col("_base") / F.col("seconds")).alias("speedup")
    )
