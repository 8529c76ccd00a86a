"""Paths on the file system the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a directory this library wrote; nothing happens where there is none."""
    target, fs = _path(spark, path)
    fs.delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a directory; empty when it does not exist."""
    target, fs = _path(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def _numbers(names: list[str], prefix: str) -> list[int]:
    found = (n.removeprefix(prefix) for n in names if n.startswith(prefix))
    return sorted(int(n) for n in found if n.isdigit())


def numbered_children(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers n of all entries named ``<prefix><n>``, ascending."""
    return _numbers(child_names(spark, path), prefix)


def complete_children(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The same for directories whose writing job has finished."""
    return [
        n
        for n in numbered_children(spark, path, prefix)
        if exists(spark, f"{path}/{prefix}{n}/_SUCCESS")
    ]


def refuse_patterns(path: str) -> None:
    """Raise where Spark would take a path for a pattern of paths."""
    found = sorted(set(path) & set("*?[]{}\\"))
    if found:
        raise ValueError(f"{path!r}: a path must not have the characters {' '.join(found)}")


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    The cluster names that shared folder. Only a local session, where driver
    and executors are one process, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        return tempfile.mkdtemp(prefix="millrace-")
    return f"{shared.rstrip('/')}/millrace-{uuid.uuid4().hex}"


def written(frame: DataFrame) -> DataFrame:
    """The same rows, read from a table in the shared folder; its files go when the driver ends.

    It ends the frame's lineage, is evaluated once, and the planner knows its size.
    """
    spark = frame.sparkSession
    path = f"{scratch(spark)}/rows"
    frame.write.parquet(path)
    target, fs = _path(spark, path)
    fs.deleteOnExit(target)
    return spark.read.schema(frame.schema).parquet(path)
