"""Topic rows, read and written: one row per message, in the column layout of Spark's Kafka source.

Two sources give such rows. ``KafkaSource`` needs the Kafka connector on the
cluster. ``ReplaySource`` reads Parquet files of the same layout, which is how
archived topics are re-run and how everything here is tested.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.codec import to_json_bytes
from millrace.sources.layout import TOPIC_ROW
from millrace.sources.zones import Offsets, files_from, located, starting_at

#: Where a new query begins: at one end, at offsets by topic and partition, or at a time.
Start = str | Offsets | datetime

@dataclass(frozen=True)
class KafkaSource:
    brokers: str
    topics: tuple[str, ...]
    start: Start = "latest"
    group: str | None = None
    max_offsets_per_batch: int | None = None
    min_partitions: int | None = None
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        found = {
            "kafka.bootstrap.servers": self.brokers,
            "subscribe": ",".join(self.topics),
            **self._start_options(),
        }
        if self.group:
            found["kafka.group.id"] = self.group
        if self.max_offsets_per_batch:
            found["maxOffsetsPerTrigger"] = str(self.max_offsets_per_batch)
        if self.min_partitions:
            found["minPartitions"] = str(self.min_partitions)
        return found | self.options

    def _start_options(self) -> dict[str, str]:
        if isinstance(self.start, datetime):
            return {"startingTimestamp": str(round(self.start.timestamp() * 1000))}
        if isinstance(self.start, Mapping):
            named = {t: {str(p): o for p, o in by.items()} for t, by in self.start.items()}
            return {"startingOffsets": json.dumps(named)}
        if self.start not in ("latest", "earliest"):
            raise ValueError(f"start must be latest or earliest, offsets or a time, not {self.start!r}")
        return {"startingOffsets": self.start}

    def batch_options(self) -> dict[str, str]:
        """The same for a batch, which covers a closed range: from the offsets
        or times that ``start`` or ``options`` name, else from the beginning."""
        found = self.reader_options()
        found.pop("maxOffsetsPerTrigger", None)
        if not isinstance(self.start, str):
            return found
        named = [k for k in self.options if k.lower().startswith("startingoffset") or k.lower() == "startingtimestamp"]
        return found if named else found | {"startingOffsets": "earliest"}


@dataclass(frozen=True)
class ReplaySource:
    """Topic files below ``path``, as ``write_topic_files`` lays them out.

    The ``topic=`` directories let a scan of some topics skip all others. A start other
    than the earliest row skips files by the map of ``zones.index_topic_files``; a stream, which
    finds its files itself, skips rows only, and wants offsets (``zones.located`` gives them).
    """

    path: str
    topics: tuple[str, ...] = ()
    max_files_per_batch: int | None = None
    start: Start = "earliest"


def _subscribed(rows: DataFrame, topics: tuple[str, ...]) -> DataFrame:
    return rows.filter(F.col("topic").isin(*topics)) if topics else rows


def read_topics(spark: SparkSession, source: KafkaSource | ReplaySource) -> DataFrame:
    """All rows present now, as a batch."""
    if isinstance(source, KafkaSource):
        frame = spark.read.format("kafka").options(**source.batch_options()).load()
        return frame.select(*TOPIC_ROW.fieldNames())
    source = located(spark, source)
    reader = spark.read.schema(TOPIC_ROW).option("basePath", source.path)
    if source.start == "earliest":
        return _subscribed(reader.parquet(source.path).select(*TOPIC_ROW.fieldNames()), source.topics)
    files = files_from(spark, source.path, source.topics, source.start)
    if files is None:
        frame = reader.parquet(source.path)
    else:
        frame = reader.parquet(*files) if files else spark.createDataFrame([], TOPIC_ROW)
    return _subscribed(frame.select(*TOPIC_ROW.fieldNames()), source.topics).filter(starting_at(source.start))


def stream_topics(spark: SparkSession, source: KafkaSource | ReplaySource) -> DataFrame:
    """The same rows as one stream over all topics."""
    if isinstance(source, KafkaSource):
        frame = spark.readStream.format("kafka").options(**source.reader_options()).load()
        return frame.select(*TOPIC_ROW.fieldNames())
    if source.start != "earliest" and not isinstance(source.start, Mapping):
        raise ValueError("a stream over files starts at the earliest row or at offsets")
    reader = spark.readStream.schema(TOPIC_ROW)
    if source.max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", source.max_files_per_batch)
    frame = reader.parquet(source.path)
    rows = _subscribed(frame.select(*TOPIC_ROW.fieldNames()), source.topics)
    return rows if source.start == "earliest" else rows.filter(starting_at(source.start))


def as_topic_rows(
    table: DataFrame,
    *,
    topic: Column,
    value: Column,
    offset: Column,
    key: Column | None = None,
    partition: Column | None = None,
    timestamp: Column | None = None,
) -> DataFrame:
    """Rows of any table as topic rows; struct values become JSON payloads."""
    is_struct = isinstance(table.select(value.alias("v")).schema["v"].dataType, T.StructType)
    parts = {
        "key": F.lit(None) if key is None else key.cast("string"),
        "value": to_json_bytes(value) if is_struct else value,
        "topic": topic,
        "partition": F.lit(0) if partition is None else partition,
        "offset": offset,
        "timestamp": F.lit(None) if timestamp is None else timestamp,
    }
    return table.select(*[parts[f.name].cast(f.dataType).alias(f.name) for f in TOPIC_ROW])


def write_topic_files(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Topic rows as replayable files, one ``topic=`` directory per topic."""
    rows.select(*TOPIC_ROW.fieldNames()).write.mode(mode).partitionBy("topic").parquet(path)


def write_kafka(rows: DataFrame, brokers: str, options: dict[str, str] | None = None) -> None:
    """Send topic rows to the topics they name; the cluster assigns offsets."""
    sent = rows.select("key", "value", "topic").write.format("kafka")
    sent.option("kafka.bootstrap.servers", brokers).options(**(options or {})).save()
