"""Session settings and the shared folder that intermediate data is written to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app_name: str = "sluice", **overrides) -> SparkSession:
    """A session with the settings the loads are designed for; a cluster's own defaults win over none of them.

    Without a ``master`` it is the one the job was submitted to.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Loads write few partitions per task: keep their files open instead of sorting all rows by partition first.
        "spark.sql.maxConcurrentOutputFileWriters": "8",
        # Call sites of every column expression cost more than building the query itself.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(overrides)
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster that would be lost with the machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="sluice-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that :func:`new_folder` has named, with what is in it."""
    if not folder.startswith(f"{shared_folder(spark).rstrip('/')}/"):
        raise ValueError(f"{folder} is not in the shared folder")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
