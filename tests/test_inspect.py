import pytest

from helpers import rows_of, topic_frame
from millrace import ReplaySource, TopicContract, start_print, stream_topics, write_topic_files
from pyspark.sql import types as T

CONTRACT = TopicContract("t", T.StructType().add("id", T.LongType()).add("name", T.StringType()))


def source(spark, root):
    rows = [("t", 0, {"id": 1, "name": "a"}), ("t", 1, b"oops"), ("other", 2, {"id": 3})]
    write_topic_files(topic_frame(spark, rows), root)
    return stream_topics(spark, ReplaySource(root, ("t",)))


def test_memory_sink_shows_records_and_reasons(spark, root):
    start_print(source(spark, root), CONTRACT, sink="memory", name="seen").awaitTermination()
    assert rows_of(spark.table("seen")) == [(1, "a", None), (None, None, "bad_payload")]


def test_console_sink_runs_through(spark, root):
    query = start_print(source(spark, root), CONTRACT)
    query.awaitTermination()
    assert query.exception() is None and query.lastProgress["numInputRows"] == 2


def test_other_sinks_are_refused(spark, root):
    with pytest.raises(ValueError, match="console or memory"):
        start_print(source(spark, root), CONTRACT, sink="kafka")
