"""Directories on the cluster's file system, and scratch space every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as its object."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def list_directories(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories right below a path; none where it does not exist."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files right in a directory; those whose names readers pass over do not count."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target) if not s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def delete_directory(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target) and fs.delete(target, True)


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None where there is none."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8", "replace")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, in place of what is there."""
    fs, target = file_system(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for data that cuts lineage. Only a local session may go without one."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="quayside-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
    fs, target = file_system(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return path
