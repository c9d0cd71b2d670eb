"""SparkSession settings the engine relies on.

Days are UTC days (the warehouse semantics of ``date(timestamp)``), ANSI mode
stays on, and adaptive execution re-plans joins and shuffle partitions at run
time.  On a cluster the session is created by the platform; ``configure``
only sets what the engine needs and leaves sizing to the deployment.
"""

from __future__ import annotations

import os
import re
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every model depends on (idempotent)."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "gridmix", event_log_dir: str | None = None) -> SparkSession:
    """A local session for tests and the bench; the UI stays off.

    ``event_log_dir`` writes Spark's event log there (stage and task times
    for later reading, instead of a live UI).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("GRIDMIX_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint directory.

    The deployment names it in ``spark.checkpoint.dir``.  Without it only a
    local session (tests, one machine) gets a scratch folder; on a cluster a
    machine's own folder would be lost to the others, so it is an error.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="gridmix-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts])


@contextmanager
def described(spark: SparkSession, text: str):
    """Label the Spark jobs started inside the block (event log and UI show it)."""
    sc = spark.sparkContext
    previous = sc.getLocalProperty("spark.job.description")
    sc.setJobDescription(text)
    try:
        yield
    finally:
        sc.setJobDescription(previous)


@contextmanager
def unsorted_writes(spark: SparkSession, files: int = 256):
    """Inside the block a partitioned write keeps up to ``files`` files open in a task, instead of sorting its rows by partition.

    For wide rows and few partitions, whose sort would spill all the text.  A task that meets more partitions sorts the rest.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    previous = spark.conf.get(key)
    spark.conf.set(key, str(files))
    try:
        yield
    finally:
        spark.conf.set(key, previous)
