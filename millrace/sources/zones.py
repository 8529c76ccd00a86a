"""Where to begin in replayed topic files: a map of each file's offsets and times.

The map has one row per file, topic and partition, in ``_zones`` below the topic files, a
name that readers of the folder pass over. With it a start at an offset or a time opens the
files that reach behind it and no others. Files that the map does not know are read too.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import replace
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import literal
from millrace.sources.layout import TOPIC_ROW
from millrace.sources.paths import exists, refuse_patterns

ZONES = "topic string, partition int, file string, rows long, low long, high long, first_time timestamp, last_time timestamp"
Offsets = Mapping[str, Mapping[int, int]]


def _home(path: str) -> str:
    return f"{path.rstrip('/')}/_zones"


def _path(name: str) -> str:
    """A path as readers take it, from a name as scans report it."""
    return re.sub("^file:/+", "file:///", unquote(name))


def _files(frame: DataFrame) -> list[str]:
    return [_path(f) for f in frame.inputFiles()]


def _measured(rows: DataFrame) -> DataFrame:
    """Each file's ranges, from three columns of its rows."""
    return (
        rows.select("topic", "partition", "offset", "timestamp", F.input_file_name().alias("file"))
        .groupBy("topic", "partition", "file")
        .agg(
            F.count("*").alias("rows"), F.min("offset").alias("low"), F.max("offset").alias("high"),
            F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"),
        )
    )


def zone_map(spark: SparkSession, path: str) -> DataFrame | None:
    """The map as it was last extended; None before that."""
    return spark.read.schema(ZONES).parquet(_home(path)) if exists(spark, _home(path)) else None


def index_topic_files(spark: SparkSession, path: str) -> int:
    """Extend the map by the files that came since; their number.

    Reads partitions, offsets and times of the new files only. The names of all files are
    on the driver, as they are for any scan of the folder.
    """
    refuse_patterns(path)
    reader = spark.read.schema(TOPIC_ROW).option("basePath", path)
    every, known = _files(reader.parquet(path)), _known(spark, path)
    new = sorted(set(every) - known)
    if not new:
        return 0
    rows = reader.parquet(path) if len(new) == len(every) else reader.parquet(*new)
    _measured(rows).write.mode("append").parquet(_home(path))
    return len(new)


def _known(spark: SparkSession, path: str) -> set[str]:
    zones = zone_map(spark, path)
    return set() if zones is None else {_path(r.file) for r in zones.select("file").distinct().collect()}


def first_offsets_at(spark: SparkSession, path: str, topics: tuple[str, ...], time: datetime) -> dict[str, dict[int, int]]:
    """By topic and partition, the first offset whose time is not before the given one.

    Where there is none it is the offset behind the last. Of the files that have such times
    only those are opened that may hold a partition's first.
    """
    refuse_patterns(path)
    index_topic_files(spark, path)
    zones = zone_map(spark, path)
    if zones is None:
        return {}
    if topics:
        zones = zones.where(F.col("topic").isin(*topics))
    late = zones.where(F.col("last_time") >= F.lit(time))
    # the first file in offset order that has a late row ends the search
    ends = late.groupBy("topic", "partition").agg(F.min("high").alias("end"))
    chosen = late.join(ends, ["topic", "partition"]).where("low <= end").select("file").distinct()
    files = [_path(r.file) for r in chosen.collect()]
    found: dict[str, dict[int, int]] = {}
    for row in zones.groupBy("topic", "partition").agg(F.max("high").alias("high")).collect():
        found.setdefault(row.topic, {})[row.partition] = row.high + 1
    if files:
        rows = spark.read.schema(TOPIC_ROW).option("basePath", path).parquet(*files)
        rows = rows.where(F.col("timestamp") >= F.lit(time))
        for row in rows.groupBy("topic", "partition").agg(F.min("offset").alias("low")).collect():
            if not topics or row.topic in topics:
                found[row.topic][row.partition] = row.low
    return found


def located(spark: SparkSession, source):
    """The replay source with offsets in place of ``latest`` or a time, as they are now.

    A stream that goes on later should be given these: ``latest`` would move with the files.
    """
    if source.start == "earliest" or isinstance(source.start, Mapping):
        return source
    if isinstance(source.start, datetime):
        return replace(source, start=first_offsets_at(spark, source.path, source.topics, source.start))
    if source.start != "latest":
        raise ValueError(f"start must be latest or earliest, offsets or a time, not {source.start!r}")
    index_topic_files(spark, source.path)
    ends: dict[str, dict[int, int]] = {}
    for row in zone_map(spark, source.path).groupBy("topic", "partition").agg(F.max("high").alias("high")).collect():
        ends.setdefault(row.topic, {})[row.partition] = row.high + 1
    return replace(source, start=ends)


def starting_at(offsets: Offsets, column: str = "offset") -> Column:
    """Whether a topic row is at its partition's start or behind it; partitions without one begin at their first row."""
    before = [
        f"(topic = {literal(topic)} AND partition = {int(partition)} AND {column} < {int(first)})"
        for topic, by_partition in offsets.items()
        for partition, first in by_partition.items()
    ]
    return F.expr(f"NOT coalesce({' OR '.join(before)}, false)") if before else F.lit(True)


def files_from(spark: SparkSession, path: str, topics: tuple[str, ...], offsets: Offsets) -> list[str] | None:
    """The files that may hold rows from these offsets on; None if there is no map to tell."""
    zones = zone_map(spark, path)
    if zones is None:
        return None
    refuse_patterns(path)
    if topics:
        zones = zones.where(F.col("topic").isin(*topics))
    needed = zones.where(starting_at(offsets, "high")).select("file").distinct()
    kept = {_path(r.file) for r in needed.collect()}
    every = set(_files(spark.read.schema(TOPIC_ROW).option("basePath", path).parquet(path)))
    return sorted((kept & every) | (every - _known(spark, path)))

