import pytest

from helpers import plan, rows_of, topic_frame
from millrace import (
    ReplaySource,
    ReplicaDef,
    TopicContract,
    read_topics,
    replicate,
    start_replica,
    stream_topics,
    write_topic_files,
)
from millrace.functions import codec
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRUCT = T.StructType().add("number", T.LongType()).add("name", T.StringType())
CONTRACT = TopicContract("t", STRUCT)
MESSAGES = [
    ("t", 0, {"number": 3, "name": "a"}),
    ("t", 1, {"number": 37, "name": "3"}),
    ("t", 2, {"number": None, "name": "null"}),
    ("t", 3, {"name": " 3"}),
    ("other", 4, {"number": 3}),
]


def copied(spark, messages, contract=CONTRACT, **definition):
    frame = topic_frame(spark, messages)
    out = replicate(frame, contract, ReplicaDef("t", "copy", **definition))
    return sorted(r.offset for r in out.collect())


@pytest.mark.parametrize(
    ("definition", "offsets"),
    [
        ({"field": "number", "values": "3,7"}, [0]),
        ({"field": "number", "values": "3,37,,"}, [0, 1]),
        ({"field": "number", "values": " 3"}, []),
        ({"field": "name", "values": " 3"}, [3]),
        ({"field": "number", "values": "null"}, [2, 3]),
        ({"field": "number", "values": "null,3", "match_null": False}, [0]),
        ({"field": "name", "values": "null", "match_null": False}, [2]),
        ({"field": "unknown", "values": "null"}, [0, 1, 2, 3]),
        ({"field": "unknown", "values": "3"}, []),
        ({"field": "number", "values": ","}, []),
        ({"field": "name", "values": ["a", "3"]}, [0, 1]),
    ],
)
def test_membership(spark, definition, offsets):
    assert copied(spark, MESSAGES, **definition) == offsets


def test_value_bytes_pass_through_and_the_key_goes(spark):
    frame = topic_frame(spark, [("t", 0, b'{"number": 3,  "unknown":[1]}')])
    frame = frame.withColumn("key", F.lit(b"k"))
    out = replicate(frame, CONTRACT, ReplicaDef("t", "copy", "number", "3")).first()
    assert (out.key, bytes(out.value), out.topic) == (None, b'{"number": 3,  "unknown":[1]}', "copy")
    kept = replicate(frame, CONTRACT, ReplicaDef("t", "copy", "number", "3", keep_key=True))
    assert bytes(kept.first().key) == b"k"


def test_malformed_rows_stop_the_copy_or_are_skipped(spark):
    messages = [*MESSAGES, ("t", 9, b"oops"), ("t", 10, None)]
    with pytest.raises(Exception, match="cannot read t offset"):
        copied(spark, messages, field="number", values="3")
    assert copied(spark, messages, field="number", values="null", on_malformed="skip") == [2, 3]
    with pytest.raises(ValueError, match="fail or skip"):
        ReplicaDef("t", "c", "f", "v", on_malformed="ignore")


def test_target_registry_frame(spark):
    contract = TopicContract("t", STRUCT, framed=True, writers={7: ""}, latest_id=7)
    body = b'{"number": 3}'
    frame = topic_frame(spark, [("t", 0, b"\x00\x00\x00\x00\x07" + body)])
    out = replicate(frame, contract, ReplicaDef("t", "c", "number", "3", target_schema_id=300)).first()
    assert bytes(out.value) == codec.FRAME_MAGIC + (300).to_bytes(4, "big") + body


def test_stream_goes_on_where_it_stopped(spark, root):
    replica = ReplicaDef("t", "copy", "number", "3,37")
    for messages in (MESSAGES[:1], MESSAGES[1:], []):
        if messages:
            write_topic_files(topic_frame(spark, messages), f"{root}/in")
        source = stream_topics(spark, ReplaySource(f"{root}/in", ("t",)))
        start_replica(source, CONTRACT, replica, f"{root}/check", path=f"{root}/out").awaitTermination()
    out = read_topics(spark, ReplaySource(f"{root}/out"))
    assert rows_of(out.select("offset", "topic")) == [(0, "copy"), (1, "copy")]
    with pytest.raises(ValueError, match="path or brokers"):
        start_replica(source, CONTRACT, replica, f"{root}/check")


def test_plan_is_narrow_and_reads_one_field(spark, root):
    write_topic_files(topic_frame(spark, MESSAGES), root)
    rows = read_topics(spark, ReplaySource(root))
    text = plan(replicate(rows, CONTRACT, ReplicaDef("t", "copy", "number", "3")))
    assert "Exchange" not in text and "Python" not in text
    assert text.count("from_json") == 1 and "name,StringType" not in text
    assert "topic" in text.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_values_of_a_table_equal_listed_values(spark):
    frame = topic_frame(spark, MESSAGES)
    listed = spark.createDataFrame([("3",), ("null",)], "v string")
    found = replicate(frame, CONTRACT, ReplicaDef("t", "copy", "number", ()), listed)
    assert sorted(r.offset for r in found.collect()) == copied(spark, MESSAGES, field="number", values="3,null")


@pytest.mark.parametrize("size", [2, 5000])
def test_lists_of_any_length_have_one_plan(spark, size):
    replica = ReplicaDef("t", "copy", "number", [str(i) for i in range(size)])
    found = plan(replicate(topic_frame(spark, MESSAGES), CONTRACT, replica))
    assert "Join" not in found and "Exchange" not in found


def test_unframed_values_keep_their_bytes_in_a_target_frame(spark):
    frame = topic_frame(spark, [("t", 0, {"number": 1, "name": "x"})])
    replica = ReplicaDef("t", "copy", "number", "1", target_schema_id=7)
    value = replicate(frame, CONTRACT, replica).first().value
    assert bytes(value) == b"\x00\x00\x00\x00\x07" + b'{"number": 1, "name": "x"}'


def test_writer_without_a_target_id_is_malformed(spark):
    frame = topic_frame(spark, [("t", 0, {"number": 1})])
    frame = frame.withColumn("value", codec.frame(F.col("value"), 5))
    contract = TopicContract("t", STRUCT, framed=True, writers={5: "{}"}, latest_id=5)
    skip = ReplicaDef("t", "copy", "number", "1", target_schema_id={6: 9}, on_malformed="skip")
    assert replicate(frame, contract, skip).collect() == []
    known = ReplicaDef("t", "copy", "number", "1", target_schema_id={5: 300})
    assert bytes(replicate(frame, contract, known).first().value)[:5] == b"\x00\x00\x00\x01\x2c"
