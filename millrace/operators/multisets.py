"""EXCEPT ALL and INTERSECT ALL on counts of equal rows.

Both sides are counted by row in one aggregate with map-side combine, so a row that holds a
third of the input is one row per task before the shuffle. What is left of it is dealt out by
number: a row with very many copies becomes chunks of copies on several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import name as quoted

_LEFT, _RIGHT, _COPIES, _CHUNK = "__m_left", "__m_right", "__m_copies", "__m_chunk"


def except_all(left: DataFrame, right: DataFrame, chunk: int = 4096) -> DataFrame:
    """The left rows without as many copies of each as the right side has. Nulls are equal."""
    return _remaining(left, right, F.col(_LEFT) - F.col(_RIGHT), chunk)


def intersect_all(left: DataFrame, right: DataFrame, chunk: int = 4096) -> DataFrame:
    """The rows of both sides, with the lesser number of copies of each. Nulls are equal."""
    return _remaining(left, right, F.least(_LEFT, _RIGHT), chunk)


def _remaining(left: DataFrame, right: DataFrame, copies: Column, chunk: int) -> DataFrame:
    if len(left.columns) != len(right.columns):
        raise ValueError(f"{len(left.columns)} and {len(right.columns)} columns")
    if chunk < 1:
        raise ValueError("chunk must be positive")
    names = left.columns
    columns = [F.col(quoted(c)) for c in names]
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = left.select("*", one.alias(_LEFT), none.alias(_RIGHT)).union(right.select("*", none, one))
    counted = both.groupBy(*columns).agg(F.sum(_LEFT).alias(_LEFT), F.sum(_RIGHT).alias(_RIGHT))
    kept = counted.select(*columns, copies.alias(_COPIES)).where(F.col(_COPIES) > 0)
    few = kept.where(F.col(_COPIES) <= chunk)
    many = kept.where(F.col(_COPIES) > chunk)
    last = F.floor((F.col(_COPIES) - 1) / chunk)
    chunks = many.withColumn(_CHUNK, F.explode(F.sequence(F.lit(0).cast("long"), last)))
    # by number and not by size: chunks are small rows, which the planner would put together
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks.repartition(tasks).withColumn(
        _COPIES, F.least(F.lit(chunk).cast("long"), F.col(_COPIES) - F.col(_CHUNK) * chunk)
    )
    return _repeated(few, names).union(_repeated(dealt.drop(_CHUNK), names))


def _repeated(rows: DataFrame, names: list[str]) -> DataFrame:
    copied = rows.withColumn(_COPIES, F.explode(F.array_repeat(F.lit(0), F.col(_COPIES).cast("int"))))
    return copied.select(*[F.col(quoted(c)) for c in names])
