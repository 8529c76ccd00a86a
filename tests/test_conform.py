import dataclasses
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import plan, rows_of, topic_frame
from millrace import KafkaSource, ReplaySource, TopicContract, TypedBatch, conform, read_topics, write_topic_files
from millrace.functions import codec
from millrace.operators.conform import (
    BAD_ENVELOPE,
    BAD_PAYLOAD,
    NULL_VALUE,
    REASON,
    UNKNOWN_SCHEMA,
)
from millrace.sources.registry import struct_of
from workload.fixtures import EVENT_V1, event_contracts, event_rows

STRUCT = (
    T.StructType()
    .add("id", T.LongType())
    .add("name", T.StringType())
    .add("amount", T.DecimalType(10, 2))
)


def test_json_fields_by_name(spark):
    rows = topic_frame(
        spark,
        [
            ("t", 0, {"name": "a", "id": 1, "amount": 12345, "extra": [1]}),
            ("t", 1, {"id": 2}),
            ("t", 2, {"id": 3, "name": 7, "amount": None}),
            ("t", 3, {}),
            ("other", 4, {"id": 9}),
        ],
    )
    batch = TypedBatch(rows, [TopicContract("t", STRUCT)])
    assert rows_of(batch.typed("t")) == rows_of(
        spark.createDataFrame(
            [
                (1, "a", Decimal("12345.00")),
                (2, None, None),
                (3, "7", None),
                (None, None, None),
            ],
            STRUCT,
        )
    )
    assert batch.rejects().count() == 0


def test_json_rejects_keep_their_bytes(spark):
    bad = [b"oops", b"", b"[]", b"3", b"null", b'{"id": "x"}', b'{"id": 1.5}']
    messages = [("t", i, v) for i, v in enumerate(bad)] + [("t", 99, None)]
    batch = TypedBatch(topic_frame(spark, messages), [TopicContract("t", STRUCT)])
    found = {r.offset: (r[REASON], r.value) for r in batch.rejects().collect()}
    assert found[99] == (NULL_VALUE, None)
    assert {o: (BAD_PAYLOAD, v) for o, v in enumerate(bad)} == {
        o: v for o, v in found.items() if o != 99
    }
    assert batch.typed("t").count() == 0


def test_frames(spark):
    contract = event_contracts(spark, "click", framed=True)["click"]
    body = b'{"event_id": 1, "user_id": 2, "value": 0.5}'

    def framed(schema_id, magic=b"\x00"):
        return magic + schema_id.to_bytes(4, "big") + body

    messages = [
        ("click", 0, framed(101)),
        ("click", 1, framed(102)),
        ("click", 2, framed(999)),
        ("click", 3, framed(101, b"\x01")),
        ("click", 4, b"\x00\x00"),
        ("click", 5, b""),
        ("click", 6, b"\x00" + (101).to_bytes(4, "big")),
        ("click", 7, None),
        ("click", 8, framed(2**32 - 1)),
    ]
    batch = TypedBatch(topic_frame(spark, messages), [contract])
    reasons = {r.offset: r[REASON] for r in batch.rejects().collect()}
    assert reasons == {
        2: UNKNOWN_SCHEMA,
        3: BAD_ENVELOPE,
        4: BAD_ENVELOPE,
        5: BAD_ENVELOPE,
        6: BAD_PAYLOAD,
        7: NULL_VALUE,
        8: UNKNOWN_SCHEMA,
    }
    assert batch.typed("click").select("event_id", "props").collect() == [(1, None)] * 2


def test_frame_round_trip_with_a_large_id(spark):
    value = codec.frame(F.lit(b"x"), 2**31 - 1)
    framed = spark.range(1).select(value.alias("value"))
    row = framed.select(codec.frame_id("value"), codec.frame_body("value")).first()
    assert tuple(row) == (2**31 - 1, b"x")


def test_topics_have_their_own_schemas(spark):
    rows = topic_frame(spark, [("a", 0, {"x": 1}), ("b", 0, {"y": "s"}), ("a", 1, {"x": 2})])
    batch = TypedBatch(
        rows,
        [
            TopicContract("a", T.StructType.fromDDL("x bigint")),
            TopicContract("b", T.StructType.fromDDL("y string")),
        ],
    )
    assert rows_of(batch.typed("a")) == [(1,), (2,)]
    assert batch.typed("b").columns == ["y"]


def test_source_columns_on_request(spark):
    batch = TypedBatch(
        topic_frame(spark, [("t", 5, {"id": 1})]), [TopicContract("t", T.StructType.fromDDL("id int"))]
    )
    assert rows_of(batch.typed("t", source_columns=True)) == [(1, 0, 5, None)]


def test_microseconds_survive(spark):
    frame = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:05.678901' AS n,"
                      " timestamp'2024-01-02 03:04:05.678901' AS z, timestamp_ntz'2024-01-02' AS m")
    back = frame.select(
        codec.from_json_bytes(codec.to_json_bytes(F.struct("n", "z", "m")), frame.schema).alias("r")
    ).select("r.n", "r.z", "r.m")
    assert back.collect() == frame.collect()


def test_nested_values(spark):
    struct = T.StructType.fromDDL("a array<struct<x: int>>, m map<string, double>, s struct<y: string>")
    rows = topic_frame(spark, [("t", 0, {"a": [{"x": 1}], "m": {"k": 2.5}, "s": {"y": "z"}})])
    row = TypedBatch(rows, [TopicContract("t", struct)]).typed("t").first()
    assert (row.a[0].x, row.m, row.s.y) == (1, {"k": 2.5}, "z")


def test_conform_typed_table(spark):
    table = spark.sql("SELECT 12345L AS amount, 1.5D AS name, 3 AS id, 'gone' AS extra, 'X' AS Name2")
    struct = T.StructType.fromDDL("id bigint, name string, amount decimal(10,2), absent date")
    assert rows_of(conform(table, struct)) == [(3, "1.5", Decimal("12345.00"), None)]


def test_conform_overflow_is_null(spark):
    table = spark.sql("SELECT 123456L AS n")
    assert rows_of(conform(table, T.StructType.fromDDL("n decimal(4,2)"))) == [(None,)]


def test_avro_without_the_module_says_so(spark):
    contract = TopicContract(
        "t", T.StructType.fromDDL("event_id bigint"), "avro", writers={1: EVENT_V1}, latest_id=1
    )
    with pytest.raises(Exception, match="(?i)avro"):
        TypedBatch(topic_frame(spark, [("t", 0, b"x")]), [contract]).typed("t").collect()


def test_avro_rows_are_read_by_their_writers_schema(spark, monkeypatch):
    """The module is not here; JSON bodies stand in for Avro ones."""

    def stand_in(payload, schema, mode="PERMISSIVE"):
        return F.from_json(payload.cast("string"), struct_of(schema), {"mode": mode})

    monkeypatch.setattr(codec, "from_avro_bytes", stand_in)
    contract = event_contracts(spark, "click", framed=True)["click"]
    contract = dataclasses.replace(contract, codec="avro")

    def framed(schema_id, body):
        return b"\x00" + schema_id.to_bytes(4, "big") + body

    full = b'{"event_id": 1, "user_id": 2, "value": 0.5, "event_type": "e", "props": "p"}'
    messages = [
        ("click", 0, framed(101, full)),
        ("click", 1, framed(102, full)),
        ("click", 2, framed(102, b"oops")),
        ("click", 3, framed(103, full)),
    ]
    batch = TypedBatch(topic_frame(spark, messages), [contract])
    found = batch.typed("click").select("event_id", "value", "event_type", "props")
    assert rows_of(found) == [(1, 0.5, "e", "p"), (1, 0.5, None, None)]
    reasons = {r.offset: r[REASON] for r in batch.rejects().collect()}
    assert reasons == {2: BAD_PAYLOAD, 3: UNKNOWN_SCHEMA}
    assert plan(batch.typed("click")).count("from_json") == 2  # one per writer


def test_one_parse_per_row_and_pruned_files(spark, sf_dir, root):
    write_topic_files(event_rows(spark, sf_dir), root)
    batch = TypedBatch(
        read_topics(spark, ReplaySource(root)), event_contracts(spark, "click", "view").values()
    )
    text = plan(batch.typed("click"))
    assert text.count("from_json") == 2  # one per topic
    assert "(topic" in text.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "Python" not in text and "RDD" not in text and "Exchange" not in text


def test_named_start_positions_hold_for_batches():
    plain = KafkaSource("b:9092", ("t",), "latest", max_offsets_per_batch=5)
    assert plain.batch_options()["startingOffsets"] == "earliest"
    assert "maxOffsetsPerTrigger" not in plain.batch_options()
    text = '{"t": {"0": 23}}'
    named = KafkaSource("b:9092", ("t",), "latest", options={"startingOffsets": text})
    assert named.batch_options()["startingOffsets"] == text
