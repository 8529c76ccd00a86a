"""Topic replication as a stateless stream tied to a checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.replicate import replicate
from millrace.plans.definitions import ReplicaDef
from millrace.sources.registry import TopicContract


def start_replica(
    rows: DataFrame,
    contract: TopicContract,
    replica: ReplicaDef,
    checkpoint: str,
    *,
    path: str | None = None,
    brokers: str | None = None,
    every_seconds: int | None = None,
) -> StreamingQuery:
    """Copy a stream of topic rows to topic files (exactly once) or brokers (at least once)."""
    if (path is None) == (brokers is None):
        raise ValueError("give either path or brokers")
    copied = replicate(rows, contract, replica)
    if path is not None:
        writer = copied.writeStream.format("parquet").partitionBy("topic").option("path", path)
    else:
        sent = copied.select("key", "value", "topic")
        writer = sent.writeStream.format("kafka").option("kafka.bootstrap.servers", brokers)
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if every_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{every_seconds} seconds").start()
