"""A decoded look at one topic."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.conform import REASON, TypedBatch
from millrace.sources.registry import TopicContract


def decoded(rows: DataFrame, contract: TopicContract) -> DataFrame:
    """One topic's records in the columns of its latest schema.

    Framed values are resolved from their writer's schema, with the latest one's
    defaults and aliases. Rows that cannot be read show nulls and the reason.
    """
    if contract.framed:
        contract = dataclasses.replace(contract, resolve=True)
    batch = TypedBatch(rows, [contract])
    return batch.frame.select(*batch.fields(contract.topic), REASON)


def start_print(
    rows: DataFrame,
    contract: TopicContract,
    *,
    sink: str = "console",
    name: str | None = None,
    checkpoint: str | None = None,
    every_seconds: int | None = None,
) -> StreamingQuery:
    """Print a topic as it comes, or keep it in a named in-memory table."""
    if sink not in ("console", "memory"):
        raise ValueError("sink must be console or memory")
    writer = decoded(rows, contract).writeStream.format(sink).outputMode("append")
    if name:
        writer = writer.queryName(name)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if every_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{every_seconds} seconds").start()
