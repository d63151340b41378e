"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # wide single-pass aggregates (55 pairwise correlations, per-column
    # describe structs) exceed the default 100-field limit and would fall
    # back from whole-stage codegen to interpreted aggregation
    "spark.sql.codegen.maxFields": "1000",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "panelsight") -> SparkSession:
    """Local/test session. On a cluster, pass the session you already have."""
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or os.environ.get("PANELSIGHT_MASTER", "local[*]"))
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("PANELSIGHT_DRIVER_MEM", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a folder of its own; on a cluster
    that is an error, since executors could not see a folder of the driver.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    context = spark.sparkContext
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(os.path.join(tempfile.gettempdir(), f"panelsight-{context.applicationId}"))
    return context.getCheckpointDir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def input_stamp(spark: SparkSession, path: str) -> tuple:
    """Names, lengths and times of the files under ``path``, by Spark's own file systems."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return ()
    files = fs.listFiles(p, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``work_dir`` gave."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
