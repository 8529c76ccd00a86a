"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.store import stored


def _hooked(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: neighbours of each node are moved to the least of them.

    A large star moves the neighbours above the node, a small star those below
    and the node itself. The least neighbour comes from an aggregate with map-side
    combine, and a node with very many edges is a join key that Spark splits.
    """
    if large:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = near.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = near.groupBy("u").agg(F.min("v").alias("m"))
        moved = near.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        moved = moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``u, v`` (longs): the least node it is linked with.

    Loops, repeated edges and either direction are allowed; nulls are no
    edges; an empty table gives an empty one. Each round is written to the shared folder, and
    the rounds, some logarithm of the longest chain, end when nothing moves.
    """
    current = stored(
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    mark = None
    while True:
        current = stored(_hooked(_hooked(current, large=True), large=False))
        after = current.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))
        ).first()
        if after == mark:
            break
        mark = after
    inner = current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return inner.union(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
