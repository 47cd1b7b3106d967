"""Session construction and the shared scratch folder.

On a cluster the scratch folder is the one named by ``spark.checkpoint.dir``
(a shared file system visible to every executor).  Only when that setting is
unset - local runs and tests - do we create one under the system temp dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(app: str = "jobflow", cpus: int | str = "*", shuffle_partitions: int = 8,
              driver_memory: str = "8g", event_log_dir: str | None = None) -> SparkSession:
    """Local session configured the way the library expects (AQE on, UTC, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; only a ``local`` session gets one of its own when it is unset."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="jobflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


class session_conf:
    """Temporarily set session configs around an action, restoring the previous values."""

    def __init__(self, spark: SparkSession, **conf: str):
        self.spark, self.conf, self.old = spark, {k.replace("__", "."): v for k, v in conf.items()}, {}

    def __enter__(self):
        for k, v in self.conf.items():
            self.old[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)
        return self

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path inside the shared checkpoint folder; ``clear_scratch`` removes what stands there."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _SCRATCH.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder whose rows are no longer needed; a missing one is no error."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    if path in _SCRATCH:
        _SCRATCH.remove(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete every scratch folder that this process has named; frames that read them can't be used afterwards."""
    for path in list(_SCRATCH):
        remove(spark, path)


def side_session(spark: SparkSession, **conf: str) -> SparkSession:
    """A session of its own with ``spark``'s settings and some others, so that no concurrent query sees these."""
    side = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if k.startswith("spark.sql.") and side.conf.isModifiable(k):
            side.conf.set(k, v)
    for k, v in conf.items():
        side.conf.set(k.replace("__", "."), v)
    return side
