"""Benchmark decontamination by spaced seeds.

A mask picks some of the word positions of a window and ignores the others, so
that the hash of the picked words survives substitutions at ignored positions.
Hashes of benchmark items and of documents meet in a join; around each hit the
two texts are compared word by word on the hit's diagonal.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bloom import MOST_BITS, bloom_of, passes
from millrace.llm.store import stored
from millrace.llm.words import mixed, texts, word_hashes

#: Word positions that count (1) in a window. Six words count in each of these.
MASKS = ("111111", "11011011", "1101010011", "1010011101", "110010100101")
#: Words compared, and the share of them that has to agree.
OVERLAP, SIMILARITY = 13, 0.8
#: Windows of fewer words have masks of their own, as ``MASKS`` miss some of theirs.
SHORT = 12

#: Bits of the filter for each hash, so that hardly a stretch is stored in vain, and the hashes of a filter.
BITS_A_KEY = 32
MOST_KEYS = MOST_BITS // BITS_A_KEY


@cache
def short_masks(width: int, similarity: float) -> tuple[str, ...]:
    """Masks of which one hits, whichever words of a window of ``width`` are substituted.

    The words are dealt to some groups more than there may be substitutions; each
    mask ignores as many groups as there may be, so that one ignores all of them.
    """
    wrong = max(k for k in range(width) if width - k >= width * similarity or not k)
    groups = min(width, max(3, 2 * wrong + 1) if width > 5 else width)
    return tuple(
        "".join("0" if k * groups // width in gone else "1" for k in range(width))
        for gone in itertools.combinations(range(groups), wrong)
    )


def seed_hashes(words: np.ndarray, masks: Sequence[str] = MASKS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per mask the seeds' hashes and where their windows begin."""
    found = []
    for mask in masks:
        n = max(0, len(words) - len(mask) + 1)
        total = np.full(n, int(f"1{mask}", 2), np.uint64)
        for k, bit in enumerate(mask):
            if bit == "1":
                total = total * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
        found.append((mixed(total), np.arange(n)))
    return found


def _item_seeds(items: DataFrame, masks: Sequence[str], overlap: int, similarity: float) -> DataFrame:
    """``item_id, words, seeds`` of the items; a seed is a hash and a position."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in texts(batch, "__text"):
                hashes, firsts = word_hashes(part.column("__text"))
                words, seeds = [], []
                for low, high in zip(firsts[:-1], firsts[1:]):
                    own = hashes[low:high]
                    words.append(own.view(np.int64))
                    width = min(overlap, len(own))
                    every = seed_hashes(own, short_masks(width, similarity) if 0 < width < SHORT else masks)
                    seeds.append(
                        [
                            {"hash": h, "pos": p}
                            for hs, ps in every
                            for h, p in zip(hs.view(np.int64).tolist(), ps.tolist())
                        ]
                    )
                kind = pa.list_(pa.struct([("hash", pa.int64()), ("pos", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("item_id"), pa.array(words, pa.list_(pa.int64())), pa.array(seeds, kind)],
                    names=["item_id", "words", "seeds"],
                )

    kind = items.schema["item_id"].dataType.simpleString()
    return items.mapInArrow(
        batches, f"item_id {kind}, words array<long>, seeds array<struct<hash:long,pos:int>>"
    )


def _stretches(documents: DataFrame, body: bytes, masks: Sequence[str], around: int) -> DataFrame:
    """``doc_id, start, words, hits``: the documents' stretches that the filter lets through.

    Windows less than ``2 * around`` words apart make one stretch, which has
    ``around`` words more on each side. ``start`` is the place of its first word.
    """
    span = max(map(len, masks))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in texts(batch, "__text"):
                hashes, firsts = word_hashes(part.column("__text"))
                ids, starts, words, hits = [], [], [], []
                found = []
                for h, p in seed_hashes(hashes, masks):
                    at = np.flatnonzero(passes(body, h))
                    found.append(np.column_stack([p[at].astype(np.uint64), h[at]]))
                seeds = np.concatenate(found)
                seeds = seeds[np.argsort(seeds[:, 0], kind="stable")]
                rows = np.searchsorted(firsts, seeds[:, 0].astype(np.int64), "right") - 1
                place = seeds[:, 0].astype(np.int64)
                apart = (np.diff(rows) > 0) | (np.diff(place) > 2 * around + span)
                for piece in np.split(np.arange(len(seeds)), np.flatnonzero(apart) + 1):
                    if not len(piece):
                        continue
                    row = rows[piece[0]]
                    low = max(firsts[row], place[piece[0]] - around)
                    high = min(firsts[row + 1], place[piece[-1]] + span + around)
                    ids.append(row)
                    starts.append(int(low - firsts[row]))
                    words.append(hashes[low:high].view(np.int64))
                    at = (place[piece] - low).tolist()
                    own = seeds[piece, 1].view(np.int64).tolist()
                    hits.append([{"hash": h, "pos": p} for h, p in zip(own, at)])
                kind = pa.list_(pa.struct([("hash", pa.int64()), ("pos", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(ids, pa.int64())),
                        pa.array(starts, pa.int32()),
                        pa.array(words, pa.list_(pa.int64())),
                        pa.array(hits, kind),
                    ],
                    names=["doc_id", "start", "words", "hits"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInArrow(
        batches, f"doc_id {kind}, start int, words array<long>, hits array<struct<hash:long,pos:int>>"
    )


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    identity: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    overlap: int = OVERLAP,
    similarity: float = SIMILARITY,
    masks: Sequence[str] = MASKS,
) -> DataFrame:
    """``doc_id, item_id, matched``: the documents that hold a passage of a benchmark item.

    A passage is ``overlap`` aligned words (the whole item where it is shorter)
    of which the share ``similarity`` is the same; ``matched`` is the greatest
    number of equal words of any such window. Words are lower-cased. Windows
    under ``SHORT`` words have masks for their width, which hit all that the
    comparison lets pass; documents are hashed by those of the widths that the
    benchmark has. Null and empty texts are not searched for. Rows without id are reported under a null id; repeated rows and
    items under their ids once. An empty table gives an empty result.

    A filter of the benchmark's hashes leaves the stretches around possible hits; only
    those are stored and joined. The documents are read once, or for a benchmark of
    more than ``MOST_KEYS`` hashes once for each part of so many. Hits of a stretch on one diagonal are
    one candidate.
    """
    sources = benchmark.select(F.col(item).alias("item_id"), F.col(item_text).cast("string").alias("__text"))
    # of items with the same text one is searched for, and its hits are all items'
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    one = sources.groupBy(F.translate("__text", upper, upper.lower()).alias("__text")).agg(F.collect_set("item_id").alias("ids"))
    numbered = one.select(F.xxhash64("__text").alias("item_id"), "__text", "ids")
    items = stored(_item_seeds(numbered.select("item_id", "__text"), masks, overlap, similarity))
    width = F.least(F.lit(overlap), F.size("words"))
    widths = sorted(r.width for r in items.select(width.alias("width")).where("width > 0").distinct().collect())
    # at most SHORT - 1 widths have masks of their own
    used = [m for w in widths if w < SHORT for m in short_masks(w, similarity)]
    if not widths or widths[-1] >= SHORT:
        used = [*masks, *used]
    seeds = items.select("item_id", F.explode("seeds").alias("s")).select(
        "item_id", F.col("s.hash").alias("hash"), F.col("s.pos").alias("at")
    )
    seeds = stored(seeds)
    hashes = seeds.count()
    parts = -(-hashes // MOST_KEYS) or 1
    rows = documents.select(F.col(identity).alias("doc_id"), F.col(text).cast("string").alias("__text"))
    masks_used = list(dict.fromkeys(used))
    found = None
    for part in range(parts):
        own = seeds if parts == 1 else seeds.where(F.pmod("hash", F.lit(parts)) == part)
        hits = _hits(rows, own, hashes // parts, items, masks_used, overlap, similarity)
        found = hits if found is None else found.union(hits)
    ids = numbered.select("item_id", "ids")
    return (
        found.join(ids, "item_id")
        .select("doc_id", F.explode("ids").alias("item_id"), "matched")
        .groupBy("doc_id", "item_id")
        .agg(F.max("matched").cast("long").alias("matched"))
    )


def _hits(
    rows: DataFrame, seeds: DataFrame, hashes: int, items: DataFrame, masks: list[str], overlap: int, similarity: float
) -> DataFrame:
    """``doc_id, item_id, matched`` around the hits of some of the benchmark's hashes."""
    body = bloom_of(seeds, F.col("hash"), hashes, BITS_A_KEY)
    stretches = stored(_stretches(rows, body, masks, overlap).withColumn("stretch", F.xxhash64("words")))
    # equal stretches are compared once; which documents have them is joined at the end
    kinds = stored(stretches.groupBy("stretch").agg(F.first("words").alias("words"), F.first("hits").alias("hits")))
    candidates = (
        kinds.select("stretch", F.explode("hits").alias("h"))
        .select("stretch", F.col("h.hash").alias("hash"), F.col("h.pos").alias("pos"))
        .join(seeds, "hash")
        .select("stretch", "item_id", (F.col("pos") - F.col("at")).alias("diagonal"))
        .distinct()
    )
    compared = (
        candidates.join(kinds.select("stretch", "words"), "stretch")
        .join(items.select("item_id", F.col("words").alias("item_words")), "item_id")
        .withColumn("low", F.greatest(F.lit(0), -F.col("diagonal")))
        .withColumn("high", F.least(F.size("item_words"), F.size("words") - F.col("diagonal")))
        .withColumn("width", F.least(F.lit(overlap), F.size("item_words")))
        .where(F.col("high") - F.col("low") >= F.col("width"))
        .withColumn(
            "same",
            F.expr(
                "transform(sequence(low, high - 1), i -> int(get(words, i + diagonal) = get(item_words, i)))"
            ),
        )
        .withColumn(
            "matched",
            F.expr(
                "array_max(transform(sequence(1, size(same) - width + 1),"
                " i -> aggregate(slice(same, i, width), 0, (a, x) -> a + x)))"
            ),
        )
        .where(F.col("matched") >= F.col("width") * similarity)
        .groupBy("stretch", "item_id")
        .agg(F.max("matched").alias("matched"))
    )
    return stretches.select("doc_id", "stretch").join(compared, "stretch").select("doc_id", "item_id", "matched")


def decontaminate(documents: DataFrame, benchmark: DataFrame, identity: str = "doc_id", **options) -> DataFrame:
    """The documents that hold no passage of the benchmark, with all their columns.

    Rows without id stay, as no result names them; rows of one id go together.
    """
    found = stored(contaminated(documents, benchmark, identity, **options).select(F.col("doc_id").alias("__id")).distinct())
    return documents.join(found, F.col(identity) == F.col("__id"), "left_anti")
