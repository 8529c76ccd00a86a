"""Small inputs and plan text."""

import json

from pyspark.sql import DataFrame, SparkSession

from millrace import TOPIC_ROW


def topic_frame(spark: SparkSession, messages: list[tuple]) -> DataFrame:
    """Topic rows from ``(topic, offset, value)``; dicts become JSON."""
    rows = [
        (
            None,
            json.dumps(v).encode() if isinstance(v, dict) else v,
            topic,
            0,
            offset,
            None,
        )
        for topic, offset, v in messages
    ]
    return spark.createDataFrame(
        [(k, bytearray(v) if v is not None else None, *rest) for k, v, *rest in rows], TOPIC_ROW
    )


def plan(frame: DataFrame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def rows_of(frame: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=repr)
