"""Start positions in replayed files, and the files that a start opens."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from millrace import TOPIC_ROW, KafkaSource, ReplaySource, read_topics, stream_topics, write_topic_files
from millrace.sources.zones import first_offsets_at, index_topic_files, located, zone_map

ZERO = datetime(2024, 1, 1, tzinfo=timezone.utc)
ODD = "a b:c%d"


@pytest.fixture
def home(spark, tmp_path):
    """Two topics of two partitions in six files of ten offsets each; a minute between offsets, every 7th is late."""
    path = str(tmp_path / "topics")
    for n in range(6):
        rows = [
            (None, b"v", topic, p, o, ZERO + timedelta(minutes=o - (30 if o % 7 == 0 else 0)))
            for topic in ("t", ODD) for p in (0, 1) for o in range(10 * n, 10 * n + 10)
        ]
        write_topic_files(spark.createDataFrame(rows, TOPIC_ROW).coalesce(1), path)
        if n < 4:
            index_topic_files(spark, path)
    return path


def offsets(frame, topic="t"):
    found = {}
    for r in frame.where(F.col("topic") == topic).collect():
        found.setdefault(r.partition, []).append(r.offset)
    return {p: sorted(o) for p, o in found.items()}


def test_map_grows_by_new_files(spark, home):
    assert zone_map(spark, home).select("file").distinct().count() == 8
    assert index_topic_files(spark, home) == 4 and index_topic_files(spark, home) == 0
    zones = zone_map(spark, home).where("topic = 't' AND partition = 1").orderBy("low").collect()
    assert [(z.low, z.high, z.rows) for z in zones] == [(10 * n, 10 * n + 9, 10) for n in range(6)]
    assert read_topics(spark, ReplaySource(home)).count() == 240  # the map is no topic


def test_offsets_open_only_files_behind_them(spark, home):
    index_topic_files(spark, home)
    rows = read_topics(spark, ReplaySource(home, ("t",), start={"t": {0: 35, 1: 52}}))
    assert offsets(rows) == {0: list(range(35, 60)), 1: list(range(52, 60))}
    assert len(rows.inputFiles()) == 3  # from 30, 40 and 50 on
    past = read_topics(spark, ReplaySource(home, ("t",), start={"t": {0: 60, 1: 99}}))
    assert past.count() == 0 and len(past.inputFiles()) == 0
    free = read_topics(spark, ReplaySource(home, ("t", ODD), start={ODD: {1: 41}}))
    assert offsets(free) == {0: list(range(60)), 1: list(range(60))}
    assert offsets(free, ODD) == {0: list(range(60)), 1: list(range(41, 60))}


def test_files_that_the_map_does_not_know_are_read(spark, home):
    rows = read_topics(spark, ReplaySource(home, (ODD,), start={ODD: {0: 25, 1: 25}}))
    assert offsets(rows, ODD) == {p: list(range(25, 60)) for p in (0, 1)}
    assert len(rows.inputFiles()) == 2 + 4  # both topics' new files


def test_a_folder_without_a_map(spark, tmp_path):
    path = str(tmp_path / "plain")
    write_topic_files(spark.createDataFrame([(None, b"v", "t", 0, o, None) for o in range(9)], TOPIC_ROW), path)
    assert zone_map(spark, path) is None
    assert offsets(read_topics(spark, ReplaySource(path, start={"t": {0: 6}}))) == {0: [6, 7, 8]}


def test_a_time_begins_at_the_first_row_that_is_not_before_it(spark, home):
    at = ZERO + timedelta(minutes=21)  # offset 21 itself is half an hour late
    assert first_offsets_at(spark, home, ("t",), at) == {"t": {0: 22, 1: 22}}
    rows = read_topics(spark, ReplaySource(home, ("t",), start=at))
    assert offsets(rows) == {p: list(range(22, 60)) for p in (0, 1)}
    assert len(rows.inputFiles()) == 4
    assert first_offsets_at(spark, home, ("t",), ZERO + timedelta(days=9)) == {"t": {0: 60, 1: 60}}
    assert first_offsets_at(spark, home, (), ZERO - timedelta(days=9)) == {t: {0: 0, 1: 0} for t in ("t", ODD)}


def test_latest_is_what_was_there(spark, home):
    source = located(spark, ReplaySource(home, ("t",), start="latest"))
    assert source.start["t"] == {0: 60, 1: 60} and read_topics(spark, source).count() == 0
    rows = [(None, b"v", "t", 0, o, ZERO) for o in (60, 61)]
    write_topic_files(spark.createDataFrame(rows, TOPIC_ROW), home)
    assert offsets(read_topics(spark, source)) == {0: [60, 61]}
    assert located(spark, source) is source
    with pytest.raises(ValueError, match="latest or earliest"):
        located(spark, ReplaySource(home, start="soon"))


def test_a_stream_begins_at_offsets(spark, home):
    source = ReplaySource(home, ("t",), start={"t": {0: 55, 1: 58}})
    query = stream_topics(spark, source).writeStream.format("memory").queryName("begun").trigger(availableNow=True).start()
    query.awaitTermination()
    assert offsets(spark.table("begun")) == {0: list(range(55, 60)), 1: [58, 59]}
    for start in ("latest", ZERO):
        with pytest.raises(ValueError, match="earliest row or at offsets"):
            stream_topics(spark, ReplaySource(home, start=start))


def test_kafka_takes_the_same_starts():
    named = KafkaSource("b:1", ("t",), start={"t": {0: 5, 1: -2}})
    assert named.reader_options()["startingOffsets"] == '{"t": {"0": 5, "1": -2}}'
    assert named.batch_options()["startingOffsets"] == '{"t": {"0": 5, "1": -2}}'
    timed = KafkaSource("b:1", ("t",), start=ZERO)
    assert timed.reader_options()["startingTimestamp"] == "1704067200000" and "startingOffsets" not in timed.batch_options()
    assert KafkaSource("b:1", ("t",)).batch_options()["startingOffsets"] == "earliest"
