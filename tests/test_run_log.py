"""Run figures from an event log: hand-written lines, and the log of a real sweep."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from tarmac.plans.run_log import event_log_path, run_figures, stage_figures
from tarmac.session import scratch_path
from tests.conftest import SF_SMALL


def _task(stage: int, ms: int, spilled: int = 0, reason: str = "Success") -> dict:
    return {"Event": "SparkListenerTaskEnd", "Stage ID": stage, "Task End Reason": {"Reason": reason}, "Task Info": {"Task ID": 1},
            "Task Metrics": {"Executor Run Time": ms, "Executor CPU Time": ms * 500_000, "JVM GC Time": 10, "Memory Bytes Spilled": 7,
                             "Disk Bytes Spilled": spilled, "Shuffle Read Metrics": {"Remote Bytes Read": 3, "Local Bytes Read": 4},
                             "Shuffle Write Metrics": {"Shuffle Bytes Written": 100}}}


def test_figures_of_stages_and_runs(spark):
    lost = {"Event": "SparkListenerTaskEnd", "Stage ID": 2, "Task End Reason": {"Reason": "ExecutorLostFailure"}}
    lines = [
        {"Event": "SparkListenerApplicationStart", "App Name": "x"},
        {"Event": "SparkListenerJobStart", "Job ID": 0, "Stage IDs": [0, 1], "Properties": {"spark.jobGroup.id": "one"}},
        _task(0, 2000), _task(0, 500), _task(1, 1000, spilled=9),
        {"Event": "SparkListenerJobStart", "Job ID": 1, "Stage IDs": [1, 2], "Properties": {"spark.jobGroup.id": "two"}},
        lost, _task(2, 250),
        {"Event": "SparkListenerJobStart", "Job ID": 2, "Stage IDs": [3], "Properties": {}},
        _task(3, 1, reason="TaskKilled"),
    ]
    path = scratch_path(spark, "log")
    local = path.removeprefix("file:")
    os.makedirs(local)
    with open(f"{local}/events_1_app", "w") as f:
        f.write("".join(json.dumps(x, separators=(",", ":")) + "\n" for x in lines))
    stages = {r.stage_id: r for r in stage_figures(spark, f"{path}/events_*").collect()}
    assert [stages[k].run for k in range(4)] == ["one", "one", "two", None]
    assert (stages[0].tasks, stages[0].task_seconds, stages[0].longest_task_seconds) == (2, 2.5, 2.0)
    assert (stages[2].tasks, stages[2].failed_tasks, stages[2].task_seconds) == (2, 1, 0.25)
    runs = {r.run: r for r in run_figures(spark, f"{path}/events_*").collect()}
    assert (runs["one"].stages, runs["one"].tasks, runs["one"].spilled_bytes, runs["one"].shuffle_written_bytes) == (2, 3, 9, 300)
    assert runs["one"].shuffle_read_bytes == 21 and runs[None].failed_tasks == 1


def test_no_log_in_this_session(spark):
    assert event_log_path(spark) is None


SWEEP = """
import sys
from tarmac.session import get_session
from tarmac.plans.sweep import sweep
from tarmac.sources.shipments import shipments
spark = get_session("local[2]", shuffle_partitions=2, extra={
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file:" + sys.argv[1], "spark.eventLog.compress": "false"})
runs = sweep(spark, lambda: shipments(spark, sys.argv[2]), partition_sizes=[2, 7]).orderBy("partition_size").collect()
assert [r.partition_size for r in runs] == [2, 7], runs
assert all(r.stages > 3 and r.tasks >= r.stages and r.task_seconds > 0 and r.shuffle_written_bytes > 0 for r in runs), runs
assert all(r.executor_cores == 2 and r.executor_instances == 1 and r.task_cpus == 1 and r.memory for r in runs), runs
assert runs[1].tasks > runs[0].tasks, runs    # more partitions are more tasks: nothing merged them
assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
spark.stop()
"""


def test_sweep_records_tasks_of_its_runs(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    got = subprocess.run([sys.executable, "-c", SWEEP, str(tmp_path), SF_SMALL], cwd=root, env={**os.environ, "PYTHONPATH": root},
                         capture_output=True, text=True, timeout=300)
    assert got.returncode == 0, got.stderr[-3000:]
