"""Topic-to-table pipelines on Spark."""

from millrace.operators.conform import TypedBatch, conform
from millrace.operators.produce import Produced, produce
from millrace.operators.replicate import replicate
from millrace.operators.sizing import Sizing
from millrace.operators.upsert import upsert_rows
from millrace.plans.definitions import (
    ReplicaDef,
    Settings,
    StreamDef,
    TableDef,
    replica_from,
    settings_from,
)
from millrace.plans.statements import check_streams, statement, view_name
from millrace.sources.registry import TopicContract, contracts
from millrace.sources.topics import (
    TOPIC_ROW,
    KafkaSource,
    ReplaySource,
    as_topic_rows,
    read_topics,
    stream_topics,
    write_topic_files,
)
from millrace.streaming.inspection import start_print
from millrace.streaming.pipeline import TopicPipeline, committed_batch, start_configured
from millrace.streaming.replication import start_replica

__all__ = [name for name in dir() if not name.startswith("_")]
