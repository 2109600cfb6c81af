"""Where intermediate tables live, and small file-system helpers."""

from __future__ import annotations

import gc
import tempfile
import uuid
from functools import cache

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The Hadoop file system of ``path`` and the path object on it."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jpath


def qualified_path(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme; one without is on Hadoop's default file system."""
    fs, jpath = hadoop_path(spark, path)
    return fs.makeQualified(jpath).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return fs.exists(jpath)


def touch_path(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    fs, jpath = hadoop_path(spark, path)
    fs.create(jpath, True).close()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = hadoop_path(spark, path)
    fs.delete(jpath, True)


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    fs, jpath = hadoop_path(spark, old)
    if not fs.rename(jpath, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"cannot rename {old}")


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``; empty when it does not exist."""
    fs, jpath = hadoop_path(spark, path)
    if not fs.exists(jpath):
        return []
    return [s.getPath().getName() for s in fs.listStatus(jpath)]


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are done.

    It does so when the driver collects its garbage, which on a cluster may be long after
    the disks are full. Takes the driver about a second.
    """
    gc.collect()
    spark._jvm.java.lang.System.gc()


def work_dir(spark: SparkSession) -> str:
    """A fresh folder name under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Only a local session that has
    none gets one of its own, where driver and executors share one machine.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="siltstone-")
