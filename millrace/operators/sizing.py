"""Batch sizes and the rule that splits big batches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sizing:
    """Split a batch when its rows per given partition exceed ``max_records``."""

    max_records: int
    partitions: int

    def __post_init__(self):
        if self.max_records < 1 or self.partitions < 1:
            raise ValueError("max_records and partitions must be at least 1")

    def target(self, count: int) -> int | None:
        """The new number of partitions, or None to leave the batch as it is."""
        if count // self.partitions > self.max_records:
            return count // self.max_records
        return None

    def target_column(self, count: Column) -> Column:
        """``target`` over a column of batch sizes."""
        size = F.lit(self.max_records)
        over = F.floor(count / self.partitions) > size
        return F.when(over, F.floor(count / size))

    def apply(self, rows: DataFrame, count: int) -> DataFrame:
        """The rows, dealt out anew if their number asks for it."""
        wanted = self.target(count)
        return rows if wanted is None else rows.repartition(wanted)


def counts_by_topic(rows: DataFrame) -> DataFrame:
    return rows.groupBy("topic").agg(F.count("*").alias("records"))

