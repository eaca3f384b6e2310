"""Session helpers: building a session, the checkpoint directory and scratch paths.

On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, S3, ...). We read it
from the session and only choose our own folder when it is unset *and* the master is
local (tests, laptops). Intermediate files written by operators (round-trip checks,
stream sinks, lineage cuts) live under that folder, never in a machine-local temp dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def get_session(
    master: str | None = None,
    app_name: str = "tarmac",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or return) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting it if needed.

    Order: the directory already set on the SparkContext, then the
    ``spark.checkpoint.dir`` setting, then (local masters only) a fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster needs a shared folder for "
                "checkpoints and intermediate tables"
            )
        configured = tempfile.mkdtemp(prefix="tarmac-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Have this package on the executors (once a session): tasks that run its Python code import it
    wherever the session was started. The zip is the driver's own; Spark serves it."""
    sc = spark.sparkContext
    if sc.master.startswith("local[") or sc.master == "local" or sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="tarmac-package-")) / "tarmac-package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tarmac-scratch/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str | None:
    """Strip a ``file:`` scheme; None when the path is not on the local filesystem."""
    if path.startswith("file:"):
        p = path[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
        return p
    if "://" in path:
        return None
    return path if os.path.isabs(path) else os.path.abspath(path)
