"""NOT IN at any size: SQL's rules for nulls without a side that has to be broadcast.

A row is kept if every row of the other side differs from it in some column where both have
a value; a null leaves the comparison open, and the row is dropped. Rows with nulls in the same
columns follow the same rule, so a census of these patterns says which hashed anti joins are needed:
one for each pair of patterns that occur, on the columns that have values in both. A key on which very
many rows lie is salted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import name as quoted
from millrace.sources.paths import written

_OWN = "__n_"


def _pattern(columns: Sequence[str]) -> Column:
    """The columns that are null, as bits."""
    bits = [F.when(F.col(quoted(c)).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(columns)]
    return sum(bits, F.lit(0))


def _patterns(rows: DataFrame, columns: Sequence[str]) -> list[int]:
    return sorted(r[0] for r in rows.select(_pattern(columns).alias("p")).distinct().collect())


def _without(rows: DataFrame, keys: DataFrame, columns: list[str], hot_rows: int, salts: int) -> DataFrame:
    """An anti join on columns that have values; ``keys`` are distinct, in columns of these names."""
    there = [f"{_OWN}k{i}" for i in range(len(columns))]
    keys = keys.toDF(*there)
    match = [F.col(quoted(c)) == F.col(t) for c, t in zip(columns, there)]
    # at most one key for so many rows can be hot
    hot = written(rows.groupBy(*[F.col(quoted(c)) for c in columns]).agg(F.count("*").alias("n")).where(F.col("n") >= hot_rows).drop("n"))
    if hot.isEmpty():
        return rows.join(keys, match, "left_anti")
    names = [f"{_OWN}h{i}" for i in range(len(columns))]
    hot = hot.toDF(*names).withColumn(f"{_OWN}hot", F.lit(True))
    salted = rows.join(hot, [F.col(quoted(c)) == F.col(n) for c, n in zip(columns, names)], "left")
    salt = F.when(F.col(f"{_OWN}hot"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts))).otherwise(0).cast("int")
    salted = salted.withColumn(f"{_OWN}salt", salt).drop(*names, f"{_OWN}hot")
    spread = keys.join(hot, [F.col(t) == F.col(n) for t, n in zip(there, names)], "left")
    copies = F.when(F.col(f"{_OWN}hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread = spread.select(*there, F.explode(copies).alias(f"{_OWN}there"))
    return salted.join(spread, [*match, F.col(f"{_OWN}salt") == F.col(f"{_OWN}there")], "left_anti").drop(f"{_OWN}salt")


def not_in(
    rows: DataFrame,
    columns: Sequence[str],
    other: DataFrame,
    *,
    hot_rows: int = 1 << 20,
    salts: int = 64,
) -> DataFrame:
    """The rows for which ``(columns) NOT IN (SELECT * FROM other)`` is true.

    ``other`` has as many columns. Nothing is dropped where it is empty. Keys with ``hot_rows`` rows
    or more are dealt out over ``salts`` tasks; their number is bounded by the rows.
    """
    columns = list(columns)
    if not columns or len(columns) != len(other.columns):
        raise ValueError(f"{len(columns)} columns against {len(other.columns)}")
    if len(columns) > 8:
        raise ValueError("up to 8 columns")
    names = [f"{_OWN}c{i}" for i in range(len(columns))]
    keys = written(other.toDF(*names).distinct())
    there, here = _patterns(keys, names), _patterns(rows, columns)
    if not there:
        return rows
    kept = []
    for own in here:
        part = rows.where(_pattern(columns) == own)
        for pattern in there:
            shared = [i for i in range(len(columns)) if not (own | pattern) >> i & 1]
            if not shared:  # a null against every value: open for each row
                part = None
                break
            found = keys.where(_pattern(names) == pattern).select(*[names[i] for i in shared]).distinct()
            part = _without(part, found, [columns[i] for i in shared], hot_rows, salts)
        if part is not None:
            kept.append(part)
    result = rows.limit(0) if not kept else kept[0]
    for part in kept[1:]:
        result = result.union(part)
    return result
