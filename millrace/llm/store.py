"""Tables written to the shared folder, to be read more than once or to end a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new place below ``spark.checkpoint.dir``, removed when the driver ends.

    Where the setting is missing (tests, a notebook), a local session gets a
    temporary checkpoint folder; a cluster has to name a shared one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
        shared = spark.sparkContext.getCheckpointDir()
    path = f"{shared.rstrip('/')}/millrace-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stored(frame: DataFrame) -> DataFrame:
    """The same rows, read from a Parquet table in the shared folder.

    The table's size is known to the planner, so that a join with it is a
    broadcast only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = frame.sparkSession
    path = folder(spark)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
