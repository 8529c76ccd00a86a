"""The test tables as topics, registry entries and stream definitions."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import StreamDef, TopicContract, as_topic_rows, conform, contracts
from millrace.plans.statements import register_view, statement
from millrace.sources.registry import SNAPSHOT, struct_of

EVENT_TOPICS = ("click", "error", "purchase", "signup", "view")

_NTZ = {"type": "long", "logicalType": "local-timestamp-micros"}


def _record(name: str, **fields) -> str:
    listed = [{"name": n, "type": t} for n, t in fields.items()]
    return json.dumps({"type": "record", "name": name, "fields": listed})


EVENT_V1 = _record("event", event_id="long", user_id="long", value="double")
EVENT_V2 = _record(
    "event",
    event_id="long",
    user_id="long",
    value="double",
    ts=["null", _NTZ],
    event_type=["null", "string"],
    props=["null", "string"],
)
CONVERSATION_KEY = _record("conversation_key", conv_id="long", turn="long")
CONVERSATION = _record("conversation", role="string", text=["null", "string"])

# The writer ids of each event topic, first and second version.
EVENT_SCHEMA_IDS = {
    "click": (101, 102),
    "error": (201, 202),
    "purchase": (301, 302),
    "signup": (401, 402),
    "view": (501, 502),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registry_snapshot(spark: SparkSession) -> DataFrame:
    entries = [
        (f"{topic}-value", version, schema_id, schema)
        for topic, ids in EVENT_SCHEMA_IDS.items()
        for version, (schema_id, schema) in enumerate(zip(ids, (EVENT_V1, EVENT_V2)), start=1)
    ]
    entries.append(("conversation-key", 1, 601, CONVERSATION_KEY))
    entries.append(("conversation-value", 1, 602, CONVERSATION))
    columns = zip(SNAPSHOT.fieldNames(), zip(*entries))
    return spark.createDataFrame(pa.table(dict(columns))).to(SNAPSHOT)


def event_contracts(
    spark: SparkSession, *topics: str, framed: bool = False
) -> dict[str, TopicContract]:
    return contracts(registry_snapshot(spark), list(topics or EVENT_TOPICS), framed=framed)


def event_rows(
    spark: SparkSession,
    sf_dir: str,
    topic: Column | None = None,
    value: Column | None = None,
) -> DataFrame:
    """All events as topic rows with JSON payloads, one topic per event type."""
    events = table(spark, sf_dir, "events")
    return as_topic_rows(
        events,
        topic=F.col("event_type") if topic is None else topic,
        key=F.col("user_id"),
        value=F.struct(*events.columns) if value is None else value,
        partition=F.pmod("user_id", F.lit(4)),
        offset=F.col("event_id"),
        timestamp=F.col("ts"),
    )


def topic_views(spark: SparkSession, sf_dir: str, *topics: str) -> None:
    """Views of event topics and of whole tables under their own names."""
    for topic in topics:
        if topic in EVENT_TOPICS:
            events = table(spark, sf_dir, "events").filter(F.col("event_type") == topic)
            register_view(conform(events, struct_of(EVENT_V2)), topic)
        else:
            rows = table(spark, sf_dir, topic)
            register_view(conform(rows, rows.schema), topic)


def spliced(
    spark: SparkSession,
    sf_dir: str,
    topics: tuple[str, ...],
    transform: str = "*",
    where: str = "1=1",
    sql: str | None = None,
) -> DataFrame:
    """The statement of a stream over the first topic, with all topics' views present."""
    topic_views(spark, sf_dir, *topics)
    stream = StreamDef("s", topics[0], "t", "k", transform, where, sql)
    return spark.sql(statement(stream))
