"""Mixing sources to target weights: whole repetitions plus one drawn copy.

All steps are DataFrame functions. What leaves the documents is one row per
source, and the few largest documents of each, on which a source's words hang: these
are drawn systematically, each with the same probability as all others, so that
as many of them are taken as the rate says. The others are drawn by their own hashes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.store import stored
from millrace.operators.windows import By, Call, Frame, blocked_windows

#: Documents of each source that are drawn systematically, the largest ones.
LARGEST = 128
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), repeat_limit: int = 3
) -> DataFrame:
    """``source, source_size, target``: shares of the whole size by weight.

    ``sizes`` has one row per source (``source``, ``source_size``). Weights go
    round over the sources in code point order, null last. A target stops at
    ``repeat_limit`` times its source's size and the excess is shared again by
    weight among the others, until none is above. All is a running sum over
    sources in the order in which they reach their limit: those before the
    first one within its share are at the limit. No size at all gives targets 0.
    However many sources there are, they are ordered in blocks; one row comes to the driver.
    """
    scale = math.lcm(*weights)
    last = [By("source", nulls_last=True)]
    ranked = blocked_windows(sizes.select("source", "source_size"), [], last, {"rank": Call("row_number")})
    weight = F.array(*map(F.lit, weights))[((F.col("rank") - 1) % len(weights)).cast("int")].cast("long")
    stepped = (
        ranked.withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * repeat_limit)
        .withColumn("reach", F.col("source_size") * (F.lit(scale) / F.col("weight")).cast("long"))
    )
    before = Frame(None, -1, rows=True)
    sums = {"used": Call("sum", "limit", frame=before), "used_weight": Call("sum", "weight", frame=before)}
    stepped = stored(blocked_windows(stepped, [], [By("reach"), *last], sums))
    whole = stepped.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    left = F.lit(whole["size"]).cast("long") - F.coalesce("used", F.lit(0))
    shares = F.lit(whole["weight"]).cast("long") - F.coalesce("used_weight", F.lit(0))
    judged = stepped.withColumns({"left": left, "shares": shares}).withColumn(
        "above", F.col("weight") * F.col("left") > F.col("limit") * F.col("shares")
    )
    place = F.struct("reach", F.col("source").isNull().alias("none"), "source")
    first = judged.where(~F.col("above")).agg(F.min_by(F.struct("left", "shares"), place).alias("first")).first()["first"]
    rest = (F.lit(None), F.lit(None)) if first is None else (F.lit(first["left"]), F.lit(first["shares"]))
    return judged.select(
        "source",
        "source_size",
        F.when(F.col("above"), F.col("limit").cast("double"))
        .otherwise((F.col("weight") * rest[0].cast("long")).cast("double") / rest[1].cast("double"))
        .alias("target"),
    )


def _largest(measured: DataFrame, seed: str) -> DataFrame:
    """``source, key, nth``: the largest documents of each source by size, ties by their draw.

    Rows of one key and source stand where the first of them does.
    """
    order = Window.partitionBy("source").orderBy(F.col("size").desc(), draw(F.col("key"), seed), "key")
    few = measured.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= LARGEST)
    return few.groupBy("source", "key").agg(F.min("nth").alias("nth"))


def copies_taken(rate: Column, key: Column, seed: str, nth: Column, source: Column) -> Column:
    """floor(rate), and one more with the probability of the fraction; a null rate takes none.

    The ``nth`` of the largest documents takes one more where the running sum of the fraction,
    from a start that the source's hash gives, passes a whole number; the others where their
    own hash is below the fraction.
    """
    whole = F.floor(rate)
    part = rate - whole
    start = draw(F.concat(F.lit("start:"), F.coalesce(source, F.lit(""))), seed)
    passes = F.floor(nth * part + start) > F.floor((nth - 1) * part + start)
    more = F.coalesce(passes, draw(key, seed) < part).cast("long")
    return F.coalesce(whole + more, F.lit(0)).cast("long")


def _key(identity: str, text: str) -> Column:
    return F.coalesce(F.col(identity).cast("string"), F.md5(F.col(text)), F.lit(""))


def mix_counts(
    documents: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    repeat_limit: int = 3,
    seed: str = "mix-1",
    identity: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, copies, taken``.

    Null text has size 0. Null is a source of its own, the last one. Repeated
    rows are documents of their own with the same draw; a null id draws by the
    text. An empty table gives an empty one. Other columns are not read.
    """
    measured = _measured(documents, identity, text, source)
    targets = _targets(measured, weights, repeat_limit)
    largest = stored(_largest(measured, seed))
    rate = F.expr("try_divide(target, source_size)")
    d, t, g = measured.alias("d"), targets.alias("t"), largest.alias("g")
    same = F.col("d.source").eqNullSafe(F.col("g.source")) & (F.col("d.key") == F.col("g.key"))
    copies = copies_taken(F.col("rate"), F.col("d.key"), seed, F.col("nth"), F.col("d.source"))
    return (
        d.join(t, F.col("d.source").eqNullSafe(F.col("t.source")))
        .join(g, same, "left")
        .withColumn("rate", rate)
        .select("doc_id", "size", "source_size", "target", copies.alias("copies"))
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
    )


def _measured(documents: DataFrame, identity: str, text: str, source: str) -> DataFrame:
    """One narrow row per document."""
    return stored(
        documents.select(
            F.col(identity).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            word_count(F.col(text)).alias("size"),
            _key(identity, text).alias("key"),
        )
    )


def _targets(measured: DataFrame, weights: Sequence[int], repeat_limit: int) -> DataFrame:
    sizes = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    return stored(source_targets(sizes, weights, repeat_limit))


def mix(
    documents: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    repeat_limit: int = 3,
    seed: str = "mix-1",
    identity: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The documents with all their columns, each as often as the mix takes it.

    Cases as in ``mix_counts``; a source without words is not taken at all.
    """
    measured = _measured(documents, identity, text, source)
    targets = _targets(measured, weights, repeat_limit).select(
        F.col("source").alias("__mix_source"),
        F.expr("try_divide(target, source_size)").alias("__mix_rate"),
    )
    largest = stored(_largest(measured, seed)).toDF("__mix_of", "__mix_key", "__mix_nth")
    own, key = F.col(source).cast("string"), _key(identity, text)
    copies = copies_taken(F.col("__mix_rate"), key, seed, F.col("__mix_nth"), own)
    return (
        documents.join(targets, own.eqNullSafe(F.col("__mix_source")))
        .join(largest, own.eqNullSafe(F.col("__mix_of")) & (key == F.col("__mix_key")), "left")
        .withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))))
        .drop("__mix_source", "__mix_rate", "__mix_of", "__mix_key", "__mix_nth", "__mix_copy")
    )
