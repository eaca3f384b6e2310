"""Stage and task figures of a run, read from the session's event log with Spark.

Spark writes one JSON line per event where ``spark.eventLog.enabled`` and ``spark.eventLog.dir``
say so. The lines are read as text and cut to the few fields wanted. Jobs carry the job
group they ran in, so the figures of a group are those of the stages of its jobs: a stage that
several jobs share counts for the first. Compressed logs can be read once Spark has closed
them; a running session's own log must be uncompressed (``spark.eventLog.compress=false``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fields of the events that are used (fixed names of Spark's log format).
EVENT_SCHEMA = """
    Event string, `Job ID` bigint, `Stage IDs` array<bigint>, Properties map<string, string>, `Stage ID` bigint,
    `Task End Reason` struct<Reason: string>,
    `Task Metrics` struct<`Executor Run Time`: bigint, `Executor CPU Time`: bigint, `JVM GC Time`: bigint,
        `Memory Bytes Spilled`: bigint, `Disk Bytes Spilled`: bigint,
        `Shuffle Read Metrics`: struct<`Remote Bytes Read`: bigint, `Local Bytes Read`: bigint>,
        `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: bigint>>
"""


def event_log_path(spark: SparkSession) -> str | None:
    """Pattern of the files of this session's event log; None where none (that can be read now) is written."""
    conf = spark.sparkContext.getConf()
    if conf.get("spark.eventLog.enabled", "false") != "true" or conf.get("spark.eventLog.compress", "true") == "true":
        return None
    base = conf.get("spark.eventLog.dir", "file:/tmp/spark-events").rstrip("/")
    app = spark.sparkContext.applicationId
    if conf.get("spark.eventLog.rolling.enabled", "true") == "true":
        return f"{base}/eventlog_v2_{app}/events_*"
    return f"{base}/{app}*"


def events(spark: SparkSession, path: str) -> DataFrame:
    """Job starts and task ends of a log, with the wanted fields only."""
    lines = spark.read.text(path).where("value like '%\"Event\":\"SparkListenerJobStart\"%' or value like '%\"Event\":\"SparkListenerTaskEnd\"%'")
    return lines.select(F.from_json("value", EVENT_SCHEMA).alias("e")).select("e.*")


def stage_figures(spark: SparkSession, path: str) -> DataFrame:
    """One row per stage that ran tasks: (run, stage_id, tasks, failed_tasks, task_seconds, cpu_seconds, gc_seconds,
    longest_task_seconds, shuffle_read_bytes, shuffle_written_bytes, spilled_bytes). ``run`` is the job group
    (NULL without one)."""
    e = events(spark, path)
    jobs = e.where("Event = 'SparkListenerJobStart'").select(
        F.col("Job ID").alias("job"), F.col("Properties")["spark.jobGroup.id"].alias("run"), F.explode("Stage IDs").alias("stage_id"))
    owner = jobs.groupBy("stage_id").agg(F.min_by("run", "job").alias("run"))
    m = F.col("Task Metrics")
    read, written = m["Shuffle Read Metrics"], m["Shuffle Write Metrics"]
    seconds = m["Executor Run Time"] / 1000
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    tasks = e.where("Event = 'SparkListenerTaskEnd'").groupBy(F.col("Stage ID").alias("stage_id")).agg(
        F.count(F.lit(1)).alias("tasks"),
        F.count_if(F.col("Task End Reason.Reason") != "Success").alias("failed_tasks"),
        total(seconds).alias("task_seconds"),
        total(m["Executor CPU Time"] / 1e9).alias("cpu_seconds"),
        total(m["JVM GC Time"] / 1000).alias("gc_seconds"),
        F.coalesce(F.max(seconds), F.lit(0.0)).alias("longest_task_seconds"),
        total(read["Remote Bytes Read"] + read["Local Bytes Read"]).alias("shuffle_read_bytes"),
        total(written["Shuffle Bytes Written"]).alias("shuffle_written_bytes"),
        total(m["Disk Bytes Spilled"]).alias("spilled_bytes"),
    )
    return tasks.join(owner, "stage_id", "left").select("run", *tasks.columns)


def run_figures(spark: SparkSession, path: str) -> DataFrame:
    """``stage_figures`` summed by run: one row per job group."""
    s = stage_figures(spark, path)
    return s.groupBy("run").agg(
        F.count(F.lit(1)).alias("stages"),
        *[F.sum(c).alias(c) for c in ("tasks", "failed_tasks", "task_seconds", "cpu_seconds", "gc_seconds")],
        F.max("longest_task_seconds").alias("longest_task_seconds"),
        *[F.sum(c).alias(c) for c in ("shuffle_read_bytes", "shuffle_written_bytes", "spilled_bytes")],
    )
