"""Near-duplicate documents by MinHash bands, odd sketches and a check on full sets.

1. Each document's shingle set is hashed; documents with equal sets are a class,
   and one of each class goes on.
2. Band hashes of MinHash values put classes into buckets. In every bucket all
   members are compared with its least member: as many pairs as members.
3. The pairs found connect most of a bucket. What is left are pairs across
   different components; the join that looks for them evaluates the odd sketches
   inside and lets only pairs through whose estimate comes near the threshold.
4. Every pair is confirmed on the full sets before it counts as a link.

An odd sketch folds many MinHash values into a bitmap of parities. The bits in
which two sketches differ come from values in only one of them, so their number
tells the similarity, most precisely where it is high.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.bloom import MOST_BITS, bloom_of, passes
from millrace.llm.components import components
from millrace.llm.store import stored
from millrace.llm.words import mixed, shingle_hashes, texts, word_hashes


#: Ids that a filter of documents is made for.
MOST_KEYS = MOST_BITS // 10


@dataclass(frozen=True)
class NearDup:
    """``percent``: linked are sets with 100 * intersection >= percent * union.

    With 24 bands of 5 values a pair at 85 % misses all bands with a
    probability of 1e-6, one at 80 % of 7e-5; take 40 bands for lower thresholds. The
    sketch lets a pair at the threshold through but for ``spread`` standard deviations.
    """

    width: int = 3
    percent: int = 85
    bands: int = 24
    rows: int = 5
    samples: int = 2048
    bits: int = 4096
    spread: float = 4.75

    def most_differing(self) -> int:
        """Differing bits up to which a pair goes on to the check on full sets.

        For sets at the threshold the number of differing values is binomial, and
        each flips two bits; the parities add a variance of their own.
        """
        m, apart = self.bits, 1 - self.percent / 100
        flips = 2 * self.samples * apart
        even, both = (1 - 2 / m) ** flips, (1 - 4 / m) ** flips
        folding = (m + m * (m - 1) * both - (m * even) ** 2) / 4
        drawing = self.samples * apart * (1 - apart) * (2 * even) ** 2
        return math.ceil(m * (1 - even) / 2 + self.spread * math.sqrt(folding + drawing))


def _seeds(n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    rows = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) + np.uint64(salt << 32))
    return rows[:n], rows[n:] | np.uint64(1)


def min_hashes(shingles: np.ndarray, flips: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least value of the set under each of the hash functions."""
    least = np.full(len(flips), np.uint64(0xFFFFFFFFFFFFFFFF))
    for low in range(0, len(shingles), 1024):
        part = shingles[low : low + 1024]
        for at in range(0, len(flips), 128):
            values = (part[None, :] ^ flips[at : at + 128, None]) * factors[at : at + 128, None]
            np.minimum(least[at : at + 128], values.min(axis=1), out=least[at : at + 128])
    return least


def odd_sketch(least: np.ndarray, bits: int) -> np.ndarray:
    """Parities of the MinHash values by place, as signed longs."""
    place = mixed(least + np.arange(len(least), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(bits)
    odd = (np.bincount(place.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    """Each row's sorted set of shingle hashes."""
    hashes, firsts = word_hashes(batch.column("__text"))
    for low, high in zip(firsts[:-1], firsts[1:]):
        yield np.unique(shingle_hashes(hashes[low:high], width))


def _set_key(shingles: np.ndarray) -> int:
    """A hash of the whole set."""
    if not len(shingles):
        return 0
    spread = mixed(shingles)
    total = np.array([spread.sum(dtype=np.uint64), np.bitwise_xor.reduce(spread), len(shingles)], np.uint64)
    return int(mixed(total * _seeds(3, 4)[1]).view(np.int64).sum(dtype=np.int64))


def _signatures(documents: DataFrame, rule: NearDup) -> DataFrame:
    """``doc_id, n_shingles, key, other, bands``: the class key twice, by independent hashes."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips, factors = _seeds(rule.bands * rule.rows, 1)
        step, _ = _seeds(rule.rows, 2)
        for batch in source:
            for part in texts(batch, "__text"):
                sizes, keys, others, bands = [], [], [], []
                for own in _sets(part, rule.width):
                    sizes.append(len(own))
                    keys.append(_set_key(own))
                    others.append(_set_key(own * np.uint64(0xC2B2AE3D27D4EB4F) ^ np.uint64(0x165667B19E3779F9)))
                    if len(own):
                        least = min_hashes(own, flips, factors).reshape(rule.bands, rule.rows)
                        bands.append(mixed((least * (step | np.uint64(1))).sum(axis=1, dtype=np.uint64)).view(np.int64))
                    else:
                        bands.append(np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(keys, pa.int64()),
                        pa.array(others, pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "key", "other", "bands"],
                )

    return documents.mapInArrow(
        batches, "doc_id long, n_shingles long, key long, other long, bands array<long>"
    )


def _full_sets(documents: DataFrame, wanted: bytes | None, rule: NearDup) -> DataFrame:
    """``doc_id, n, shingles, sketch`` of the documents whose id passes the filter, if there is one."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips, factors = _seeds(rule.samples, 3)
        for batch in source:
            chosen = batch
            if wanted is not None:
                ids = np.asarray(batch.column("doc_id").fill_null(0)).astype(np.int64).view(np.uint64)
                chosen = batch.take(pa.array(np.flatnonzero(passes(wanted, mixed(ids))), pa.int64()))
            for part in texts(chosen, "__text"):
                sets = list(_sets(part, rule.width))
                sketches = [odd_sketch(min_hashes(s, flips, factors), rule.bits) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                        pa.array(sketches, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "shingles", "sketch"],
                )

    return documents.mapInArrow(batches, "doc_id long, shingles array<long>, sketch array<long>")


def _sets_of(rows: DataFrame, involved: DataFrame, rule: NearDup) -> DataFrame:
    """The full sets of the involved documents, one row for each set of an id.

    A filter picks their texts out where they are; more ids than it is made for are joined first.
    """
    count = involved.count()
    if count > MOST_KEYS:
        found = _full_sets(rows.join(involved, "doc_id", "left_semi"), None, rule)
    else:
        found = _full_sets(rows, _id_filter(involved, count), rule).join(involved, "doc_id")
    # rows of one id mostly have one set; it goes by its sketch, which is shorter
    return stored(found.groupBy("doc_id", F.xxhash64("shingles").alias("set"), "sketch").agg(F.first("shingles").alias("shingles")).drop("set"))


def _id_filter(ids: DataFrame, count: int) -> bytes:
    """A filter of mixed ids; the mixing is that of ``words.mixed``, done in Arrow."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            values = np.asarray(batch.column(0)).astype(np.int64).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(mixed(values).view(np.int64))], names=["key"])

    return bloom_of(ids.mapInArrow(batches, "key long"), F.col("key"), count)


def _differing(a: str, b: str, words: int) -> Column:
    """Bits in which two sketches differ."""
    total = F.lit(0)
    for k in range(words):
        total = total + F.bit_count(F.get(F.col(a), F.lit(k)).bitwiseXOR(F.get(F.col(b), F.lit(k))))
    return total


def _confirmed(pairs: DataFrame, sets: DataFrame, rule: NearDup) -> DataFrame:
    """The pairs ``u, v`` whose full sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    union = F.size("a") + F.size("b") - both
    return (
        pairs.join(left, "u").join(right, "v").where(100 * both >= rule.percent * union).select("u", "v")
    )


def near_duplicates(
    documents: DataFrame, rule: NearDup = NearDup(), identity: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``.

    Words are lower-cased (A-Z); a set has the distinct shingles of
    ``rule.width`` words, or the whole text as one if it has fewer. Null texts
    and texts without words have the empty set and are linked with nothing:
    their component is their own id. ``component_id`` is the least id reachable over links,
    ``kept`` is ``doc_id = component_id``. Ids are integers; rows of one id are
    one document, linked with whatever any of them is. Rows with a null id take
    the component of their class, null if no other row has it, and are kept
    only then. Extra columns are not read; an empty table gives an empty one.
    """
    rows = documents.select(
        F.col(identity).cast("long").alias("doc_id"), F.col(text).cast("string").alias("__text")
    )
    signed = stored(_signatures(rows, rule))
    classes = stored(
        signed.where("n_shingles > 0 and doc_id is not null")
        .groupBy("key", "other")
        .agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands"), F.first("n_shingles").alias("n"))
    )
    banded = classes.select("rep", "n", F.posexplode("bands").alias("band", "bucket"))
    buckets = stored(
        banded.groupBy("band", "bucket")
        .agg(F.min("rep").alias("leader"), F.count("*").alias("members"))
        .where("members > 1")
    )
    members = stored(
        banded.join(buckets.select("band", "bucket", "leader"), ["band", "bucket"]).select(
            F.xxhash64("band", "bucket").alias("bucket"), "band", "leader", "rep", "n"
        )
    )
    involved = stored(members.select(F.col("rep").alias("doc_id")).distinct())
    sets = _sets_of(rows, involved, rule)

    longs = rule.bits // 64
    stars = members.where("rep <> leader").select(F.col("leader").alias("u"), F.col("rep").alias("v")).distinct()
    near = _differing("s", "t", longs) <= rule.most_differing()
    sketches = sets.select("doc_id", "sketch")
    star_pairs = (
        stars.join(sketches.toDF("u", "s"), "u").join(sketches.toDF("v", "t"), "v").where(near).select("u", "v")
    )
    links = stored(_confirmed(star_pairs, sets, rule))

    marks = sketches.join(classes.select(F.col("rep").alias("doc_id"), "bands"), "doc_id")
    across = stored(_across(members, marks, sets, links, near, rule))
    more = stored(_confirmed(across, sets, rule))
    linked = stored(components(links.union(more)))

    by_class = classes.select("key", "other", "rep").join(
        linked.select(F.col("node").alias("rep"), "component"), "rep", "left"
    )
    own = F.coalesce("component", "rep", "doc_id")
    return (
        signed.select("doc_id", "n_shingles", "key", "other")
        .join(by_class, ["key", "other"], "left")
        .select("doc_id", "n_shingles", own.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
    )


#: Comparisons in a bucket beyond which its members are found by their rarest shingles.
MANY_PAIRS = 1 << 22


def _by_prefix(docs: DataFrame, near: Column, rule: NearDup) -> DataFrame:
    """All pairs ``u, v`` of ``rep, n, component, sketch, shingles`` in different components that may be linked.

    With a set's shingles in one order for all, from the rarest on, two sets at the threshold share
    one of their first ``n - ceil(percent * n / 100) + 1``. Unlike texts that share a template
    differ in these, so that the work follows the number of texts and not of their pairs.
    """
    words = docs.select("rep", F.explode("shingles").alias("w"))
    counts = words.groupBy("w").agg(F.count("*").alias("f"))
    ordered = words.join(counts, "w").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("f", "w"))).alias("o"))
    least = F.ceil(F.size("o") * F.lit(rule.percent) / F.lit(100)).cast("int")
    first = ordered.select("rep", F.explode(F.slice("o", F.lit(1), F.size("o") - least + 1)).alias("x")).select("rep", "x.w")
    rows = stored(first.join(docs.select("rep", "n", "component"), "rep"))
    left = rows.select("w", F.col("rep").alias("u"), F.col("n").alias("nu"), F.col("component").alias("cu"))
    right = rows.select(F.col("w").alias("x"), F.col("rep").alias("v"), F.col("n").alias("nv"), F.col("component").alias("cv"))
    sizes = 100 * F.least("nu", "nv") >= rule.percent * F.greatest("nu", "nv")
    pairs = left.join(right, (F.col("w") == F.col("x")) & (F.col("u") < F.col("v")) & (F.col("cu") != F.col("cv")) & sizes)
    sketches = docs.select("rep", "sketch")
    found = pairs.select("u", "v").distinct().join(sketches.toDF("u", "s"), "u").join(sketches.toDF("v", "t"), "v")
    return found.where(near).select("u", "v")


def _across(
    members: DataFrame, marks: DataFrame, sets: DataFrame, links: DataFrame, near: Column, rule: NearDup
) -> DataFrame:
    """Pairs ``u, v`` of a bucket in different components, by size and sketch near enough.

    In a bucket, members outside its largest component are compared with all
    others that are not in their own. The join's condition holds the tests, and
    takes a pair only in the first band that it shares, so that what comes out
    are few pairs, each once. Where a bucket would take more than ``MANY_PAIRS`` comparisons, its
    members' pairs are found by ``_by_prefix``, which misses none.
    """
    joined = stored(components(links))
    placed = stored(
        members.join(joined.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
            "bucket", "band", "rep", "n", F.coalesce("component", "rep").alias("component")
        )
    )
    mixed_buckets = (
        placed.groupBy("bucket", "component")
        .agg(F.count("*").alias("n"))
        .groupBy("bucket")
        .agg(
            F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts"),
            F.sum("n").alias("all"), F.max("n").alias("most"),
        )
        .where("parts > 1")
        .withColumn("many", F.col("all").cast("double") * (F.col("all") - F.col("most")) > MANY_PAIRS)
        .select("bucket", "main", "many")
    )
    every = stored(placed.join(mixed_buckets, "bucket"))
    large = stored(every.where("many").select("rep", "n", "component").distinct())
    open_rows = stored(every.where("not many").drop("many").join(marks, F.col("rep") == F.col("doc_id")).drop("doc_id"))
    left = open_rows.where("component <> main").selectExpr(
        "bucket", "band", "rep AS u", "n AS nu", "component AS cu", "sketch AS s", "bands AS bu"
    )
    right = open_rows.selectExpr(
        "bucket", "rep AS v", "n AS nv", "component AS cv", "sketch AS t", "bands AS bv",
        "component = main AS in_main",
    )
    sizes = 100 * F.least("nu", "nv") >= rule.percent * F.greatest("nu", "nv")
    once = F.col("in_main") | (F.col("u") < F.col("v"))
    first = F.array_position(F.zip_with("bu", "bv", lambda a, b: a == b), True) == F.col("band") + 1
    test = (F.col("cu") != F.col("cv")) & once & sizes & near & first
    pairs = left.alias("l").join(right.alias("r"), (F.col("l.bucket") == F.col("r.bucket")) & test)
    found = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    if large.isEmpty():
        return found
    more = _by_prefix(stored(large.join(sets, F.col("rep") == F.col("doc_id")).drop("doc_id")), near, rule)
    return found.union(more).distinct()


def deduplicated(documents: DataFrame, rule: NearDup = NearDup(), identity: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents of which ``near_duplicates`` keeps the row, with all their columns.

    All rows of a kept id stay, and rows without id.
    """
    gone = stored(
        near_duplicates(documents, rule, identity, text)
        .where("not kept and doc_id is not null")
        .select(F.col("doc_id").alias("__id"))
        .distinct()
    )
    return documents.join(gone, F.col(identity).cast("long") == F.col("__id"), "left_anti")
