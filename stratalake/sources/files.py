"""Paths on any Hadoop file system: existence and size, asked of the file system, not of the data."""

from __future__ import annotations

from pyspark.sql import SparkSession


def path_size(spark: SparkSession, path: str) -> int | None:
    """Bytes under a file or folder; None when it does not exist."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(jpath).getLength() if fs.exists(jpath) else None


def extension(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    return "." + name.rsplit(".", 1)[-1] if "." in name else ""
