"""Rows that could not be stored, kept apart by batch for inspection and replay.

Layout below ``root``, each directory replaced when its batch is repeated:
``dead/raw/batch_id=<n>/topic=<t>`` has topic rows that cannot be typed,
``dead/rows/stream=<s>/batch_id=<n>`` a stream's result rows that its table
cannot take, ``dead/failed/stream=<s>/batch_id=<n>`` the topic rows of a
stream whose statement failed. All have ``_reason`` and ``_error``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.conform import REASON
from millrace.sources.paths import complete_children, remove
from millrace.sources.topics import TOPIC_ROW

ERROR = "_error"
NULL_KEY = "null_key"
STORE_FAILED = "store_failed"
TRANSFORM_FAILED = "transform_failed"


def has_null_key(key: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for column in key:
        found = found | F.col(f"`{column}`").isNull()
    return found


def split_by_key(rows: DataFrame, key: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Rows a keyed table can take, and the others with the reason."""
    bad = has_null_key(key)
    return rows.filter(~bad), with_reason(rows.filter(bad), NULL_KEY)


def with_reason(rows: DataFrame, reason: str, error: str | None = None) -> DataFrame:
    return rows.withColumns({REASON: F.lit(reason), ERROR: F.lit(error).cast("string")})


def _raw_dir(root: str) -> str:
    return f"{root}/dead/raw"


def _rows_dir(root: str, stream: str) -> str:
    return f"{root}/dead/rows/stream={stream}"


def _failed_dir(root: str, stream: str) -> str:
    return f"{root}/dead/failed/stream={stream}"


def write_raw(rejects: DataFrame, root: str, batch_id: int) -> None:
    """All untypable rows of a batch, in one job for all topics."""
    rows = rejects.withColumn(ERROR, F.lit(None).cast("string"))
    target = f"{_raw_dir(root)}/batch_id={batch_id}"
    rows.write.mode("overwrite").partitionBy("topic").parquet(target)


def write_rows(rows: DataFrame, root: str, stream: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{_rows_dir(root, stream)}/batch_id={batch_id}")


def write_failed(rows: DataFrame, root: str, stream: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{_failed_dir(root, stream)}/batch_id={batch_id}")


def forget(spark: SparkSession, root: str, streams: Iterable[str], batch_id: int) -> None:
    """Drop what an earlier attempt at a batch set aside, as the batch runs again."""
    homes = [_raw_dir(root)]
    for stream in streams:
        homes += [_rows_dir(root, stream), _failed_dir(root, stream)]
    for home in homes:
        remove(spark, f"{home}/batch_id={batch_id}")


def _read(spark: SparkSession, home: str) -> DataFrame | None:
    """All complete batches of a dead letter; a write that failed is no batch."""
    batches = complete_children(spark, home, "batch_id=")
    if not batches:
        return None
    # a stream's definition may have changed between batches
    reader = spark.read.option("basePath", home).option("mergeSchema", True)
    return reader.parquet(*[f"{home}/batch_id={n}" for n in batches])


def read_raw(spark: SparkSession, root: str) -> DataFrame | None:
    """Untypable topic rows of all batches, with ``batch_id``; None if there are none."""
    return _read(spark, _raw_dir(root))


def read_rows(spark: SparkSession, root: str, stream: str) -> DataFrame | None:
    """Result rows one stream's table could not take."""
    return _read(spark, _rows_dir(root, stream))


def read_failed(spark: SparkSession, root: str, stream: str) -> DataFrame | None:
    """Topic rows one stream's statement failed on."""
    return _read(spark, _failed_dir(root, stream))


def replayable(dead: DataFrame) -> DataFrame:
    """Dead topic rows as topic rows, to be put through a corrected pipeline."""
    return dead.select(*[F.col(f.name).cast(f.dataType) for f in TOPIC_ROW])
