"""Places shared by all executors for checkpoints, topics and results."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one below the session's warehouse.

    A folder that was named is taken to be shared, whatever its scheme: it may be a mounted one.
    The warehouse is only taken on a cluster when it is no local path.
    """
    root = spark.conf.get("spark.checkpoint.dir", "")
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if urlparse(warehouse).scheme in ("", "file") and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{warehouse}/millrace-scratch"


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared root; nothing is created yet."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Rows written below the shared root and read from there: a lost executor costs no more than the tasks it ran."""
    path = new_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def is_directory(spark: SparkSession, path: str) -> bool:
    jpath, fs = _file_system(spark, path)
    return fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names below a directory; empty when it does not exist."""
    jpath, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a directory."""
    jpath, fs = _file_system(spark, path)
    return fs.getContentSummary(jpath).getLength()


def remove(spark: SparkSession, path: str) -> None:
    jpath, fs = _file_system(spark, path)
    fs.delete(jpath, True)
