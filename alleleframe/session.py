"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


def session_builder(app_name: str, hive: bool = False) -> SparkSession.Builder:
    """Builder with the settings the jobs rely on; the cluster adds its own.

    Statistics written by ``sinks.statistics`` only influence plans when the
    cost-based optimizer is on. Adaptive execution splits hot shuffle
    partitions of joins and coalesces small ones. Recording the Python line of
    every expression only serves error messages and slows the driver.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.cbo.enabled", "true")
        .config("spark.sql.cbo.joinReorder.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    return builder.enableHiveSupport() if hive else builder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="alleleframe-"))
        root = spark.sparkContext.getCheckpointDir()
    app = spark.sparkContext.applicationId
    return f"{root.rstrip('/')}/alleleframe-{app}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it is; PySpark has no call of its own for this."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete one folder made by ``scratch_path`` of this application."""
    if f"/alleleframe-{spark.sparkContext.applicationId}/" not in path:
        raise ValueError(f"not a scratch folder of this application: {path}")
    delete_folder(spark, path)


def size_shuffles(spark: SparkSession, input_bytes: int, mb_per_partition: int = 1280) -> int:
    """Raise the number of shuffle partitions to fit ``input_bytes``; never lower it.

    A partition takes about 1.25 GB of files: sorts and joins spill, and at 100 TB
    there are 80,000 partitions, not a million whose block lists no driver holds.
    The session's number covers small inputs, and adaptive execution splits and
    merges partitions by their measured size.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(current, -(-input_bytes // (mb_per_partition * 1024 * 1024)))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def setting_bytes(spark: SparkSession, name: str) -> int:
    """A size among the session's settings, such as ``16m``, in bytes."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))


@contextmanager
def held_settings(spark: SparkSession, values: Mapping[str, int]) -> Iterator[None]:
    """Session settings for what is planned and run inside the block."""
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
