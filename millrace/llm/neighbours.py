"""Approximate nearest neighbours: lists of near vectors, read by an adaptive dimension scan.

Vectors are dealt to the list of their nearest centroid; a query reads the lists
whose centroids are nearest to it. In a list, vectors and query are rotated at
random and compared by blocks of columns. After each block a hypothesis test asks
whether the whole distance can still be within that of the best k, given the
distance so far; what fails is not looked at again. What is left is measured on
the original vectors.

Equal vectors are one candidate with their smallest ids, as no query can need more
of them, and equal queries are one search. A list is cut into parts of bounded size,
and so are the queries that read it: each cell of parts is one group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.store import stored


@dataclass(frozen=True)
class Scan:
    """How an index is made and read.

    neighbours: results of a query.
    recall: a query reads so many lists that they hold this share of the nearest
        neighbours of sampled vectors within the sample.
    fit_rows: vectors on which centroids are fitted, those of the least hashes; there
        is one list to 16 of them at most, and to the square root of all vectors.
    fit_queries: of these vectors, how many are asked to find the number of lists to read.
    block: columns compared between two tests.
    slack: the test's epsilon; more of it gives up less early.
    cell: numbers in the vectors of one part of a list, and in those of its queries.
    """

    neighbours: int = 10
    recall: float = 0.97
    fit_rows: int = 65_536
    fit_queries: int = 256
    rounds: int = 6
    block: int = 16
    slack: float = 2.1
    cell: int = 1 << 21


#: Components that one rotation mixes; longer vectors are shuffled and mixed in pieces.
_TURNED = 256
#: Components beyond it are scaled before they are squared.
_LARGE = 1e150


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite and not all zero."""
    finite = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


# --- the index ------------------------------------------------------------------------


def _classes(rows: DataFrame, most: int) -> DataFrame:
    """``key, ids, dim, vector``: each vector once, with its ``most`` smallest ids; key is the first."""
    order = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)
    made = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return made.select(F.col("ids")[0].alias("key"), "ids", F.size("vector").alias("dim"), "vector")


def _rows_of(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all centroids, less the points' own squares."""
    held = np.clip(points, -1e100, 1e100)
    return (centroids**2).sum(1) - 2 * held @ centroids.T


def _fitted(sample: pa.Table, counts: dict[int, int], rule: Scan) -> dict[int, tuple[np.ndarray, int]]:
    """Centroids by dimension, from k-means on the sample, and how many lists a query reads.

    A dimension without sample has one list.
    """
    found = {dim: (np.zeros((1, dim)), 1) for dim in counts}
    dims = sample.column("dim").to_numpy()
    vectors = sample.column("vector").combine_chunks()
    for dim in sorted(set(dims.tolist())):
        points = np.clip(_rows_of(vectors.take(pa.array(np.flatnonzero(dims == dim))), dim), -1e100, 1e100)
        lists = max(1, min(round(counts[dim] ** 0.5), len(points) // 16))
        start = np.random.default_rng(dim).choice(len(points), lists, replace=False)
        centroids, near = points[np.sort(start)], np.zeros(len(points), np.int64)
        for _ in range(rule.rounds):
            near = _nearest_lists(points, centroids)
            sizes = np.bincount(near, minlength=lists)
            sums = np.zeros_like(centroids)
            np.add.at(sums, near, points)
            centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
        found[dim] = centroids, _lists_to_read(points, centroids, rule)
    return found


def _nearest_lists(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    parts = [_distances(points[low : low + 4096], centroids).argmin(1) for low in range(0, len(points), 4096)]
    return np.concatenate(parts)


def _lists_to_read(points: np.ndarray, centroids: np.ndarray, rule: Scan) -> int:
    """How many of the lists nearest to a sampled vector hold the wanted share of its nearest neighbours."""
    asked = np.linspace(0, len(points) - 1, min(len(points), rule.fit_queries)).astype(np.int64)
    k = min(rule.neighbours, len(points) - 1)
    if len(centroids) == 1 or k == 0:
        return 1
    near = _nearest_lists(points, centroids)
    places = []
    for low in range(0, len(asked), 16):
        some = asked[low : low + 16]
        far = _distances(points[some], points)
        far[np.arange(len(some)), some] = np.inf
        neighbours = np.argpartition(far, k - 1, axis=1)[:, :k]
        place = _distances(points[some], centroids).argsort(1).argsort(1)
        places.append(np.take_along_axis(place, near[neighbours], 1).ravel())
    ranks = np.sort(np.concatenate(places))
    return int(ranks[min(len(ranks) - 1, int(np.ceil(rule.recall * len(ranks))) - 1)]) + 1


def _listed(frame: DataFrame, centroids: dict[int, np.ndarray], probes: dict[int, int]) -> DataFrame:
    """The rows with the numbers of their nearest lists, so many of each dimension."""
    names = frame.columns

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            lists: list = [None] * batch.num_rows
            for dim in set(dims.tolist()):
                at = np.flatnonzero(dims == dim)
                for low in range(0, len(at), 1024):
                    rows = at[low : low + 1024]
                    far = _distances(_rows_of(batch.column("vector").take(pa.array(rows)), dim), centroids[dim])
                    n = probes[dim]
                    near = np.argpartition(far, n - 1, axis=1)[:, :n] if n < far.shape[1] else np.tile(
                        np.arange(far.shape[1]), (len(rows), 1)
                    )
                    for row, own in zip(rows, near):
                        lists[row] = own.astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))], [*names, "lists"])

    schema = f"{', '.join(f'{n} {t}' for n, t in frame.dtypes)}, lists array<int>"
    return frame.mapInArrow(batches, schema)


# --- the scan -------------------------------------------------------------------------


def turned(points: np.ndarray) -> np.ndarray:
    """The points in a random rotation that depends on their dimension alone."""
    dim = points.shape[1]
    draw = np.random.default_rng(dim)
    points = points[:, draw.permutation(dim)]
    made = []
    for low in range(0, dim, _TURNED):
        width = min(_TURNED, dim - low)
        basis, upper = np.linalg.qr(draw.standard_normal((width, width)))
        made.append(points[:, low : low + width] @ (basis * np.sign(np.diag(upper))))
    spread = np.concatenate(made, axis=1)
    return spread[:, draw.permutation(dim)] if dim > _TURNED else spread


def exact_distances(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision."""
    with np.errstate(over="ignore"):
        apart = points - query
        scale = np.abs(apart).max(initial=0.0)
        if scale > _LARGE:
            held = min(scale, np.finfo(float).max)
            return held * np.sqrt(((points / held - query / held) ** 2).sum(1))
        return np.sqrt((apart**2).sum(1))


def survivors(blocks: list[np.ndarray], query: np.ndarray, most: int, slack: float) -> np.ndarray:
    """Places of the vectors that no test gave up.

    ``blocks`` are the columns of the rotated vectors, block by block. The bound is the
    ``most``-th least whole distance among the vectors that look nearest after
    the first block. With d of D columns read, a vector goes when its squared distance
    so far times D/d is beyond the bound times (1 + slack/sqrt(d))^2.
    """
    size, dim = len(blocks[0]), len(query)
    if size <= 2 * most:
        return np.arange(size)
    width = blocks[0].shape[1]
    so_far = ((blocks[0] - query[:width]) ** 2).sum(1)
    seeds = np.argpartition(so_far, 2 * most - 1)[: 2 * most]
    whole = so_far[seeds].copy()
    low = width
    for block in blocks[1:]:
        whole += ((block[seeds] - query[low : low + block.shape[1]]) ** 2).sum(1)
        low += block.shape[1]
    bound = np.partition(whole, most - 1)[most - 1] * (1 + 1e-9)
    alive, low = np.arange(size), width
    for block in [*blocks[1:], None]:
        limit = bound if low == dim else bound * low / dim * (1 + slack / low**0.5) ** 2
        left = so_far <= limit
        alive, so_far = alive[left], so_far[left]
        if block is not None:
            so_far = so_far + ((block[alive] - query[low : low + block.shape[1]]) ** 2).sum(1)
            low += block.shape[1]
    return alive


def _scanner(rule: Scan):
    most = rule.neighbours + 1

    def scan(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        keys, ids, scores = [], [], []
        if vectors.num_rows and queries.num_rows:
            dim = vectors.column("dim")[0].as_py()
            points = _rows_of(vectors.column("vector").combine_chunks(), dim)
            asked = _rows_of(queries.column("vector").combine_chunks(), dim)
            own_ids = vectors.column("ids").to_pylist()
            first = np.array([i[0] for i in own_ids])
            scale = max(np.abs(points).max(), np.abs(asked).max())
            spread, turned_asked = turned(points / scale), turned(asked / scale)
            blocks = [np.ascontiguousarray(spread[:, low : low + rule.block]) for low in range(0, dim, rule.block)]
            del spread
            for n, key in enumerate(queries.column("key").to_pylist()):
                left = survivors(blocks, turned_asked[n], most, rule.slack)
                exact = exact_distances(points[left], asked[n])
                best = np.lexsort((first[left], exact))[:most]
                near = sorted((exact[b], i) for b in best for i in own_ids[left[b]])[:most]
                keys += [key] * len(near)
                scores += [s for s, _ in near]
                ids += [i for _, i in near]
        return pa.table({"key": pa.array(keys, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.float64())})

    return scan


def _counted(listed: DataFrame, name: str, rule: Scan) -> DataFrame:
    """``dim, list`` and in how many parts its rows are dealt."""
    rows = F.ceil(F.count("*") * F.col("dim") / F.lit(float(rule.cell)))
    return listed.groupBy("dim", "list").agg(rows.cast("int").alias(name))


def _searched(index: DataFrame, asked: DataFrame, rule: Scan) -> DataFrame:
    """``key, vec_id, score``: the best of every cell, then the best of every query.

    ``index`` has one row per vector and list, ``asked`` one per query and list to read.
    """
    parts = _counted(index, "parts", rule).join(_counted(asked, "shares", rule), ["dim", "list"])
    cells = stored(parts)
    place = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    vectors = index.join(cells, ["dim", "list"]).select(
        "dim", "list", "ids", "vector", place.alias("part"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share")
    )
    place = F.pmod(F.xxhash64("key"), F.col("shares")).cast("int")
    queries = asked.join(cells, ["dim", "list"]).select(
        "dim", "list", "key", "vector", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        place.alias("share"),
    )
    cell = ["dim", "list", "part", "share"]
    found = vectors.groupBy(*cell).cogroup(queries.groupBy(*cell)).applyInArrow(
        _scanner(rule), "key long, vec_id long, score double"
    )
    order = Window.partitionBy("key").orderBy("score", "vec_id")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= rule.neighbours + 1).drop("nth")


def nearest_neighbours(
    vectors: DataFrame,
    asked: Column,
    rule: Scan = Scan(),
    identity: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest vectors found for each row where ``asked`` holds.

    Vectors null, empty, all zero, or with a component null or not finite take
    no part, nor do rows with a null id. Only vectors of one length are compared.
    Rows of one id count once, with the least of their vectors. ``score`` is the Euclidean
    distance, in double precision; equal ones rank by id. A query whose lists hold too
    few vectors reads all lists, so that there are ``neighbours`` results
    wherever there are so many other vectors. An empty table gives an empty one;
    other columns are not read.
    """
    kind = vectors.schema[vector].dataType.elementType.typeName()
    held = F.col(vector) if kind in ("float", "double") else F.col(vector).cast("array<double>")
    chosen = vectors.where(F.col(identity).isNotNull() & usable(F.col(vector)))
    rows = stored(
        chosen.select(F.col(identity).cast("long").alias("vec_id"), held.alias("vector"), F.coalesce(asked, F.lit(False)).alias("asked"))
        .groupBy("vec_id").agg(F.min("vector").alias("vector"), F.max("asked").alias("asked"))
    )
    most = rule.neighbours + 1
    classes = stored(_classes(rows.select("vec_id", "vector"), most))
    queries = rows.where("asked").select("vec_id", "vector")
    searches = stored(queries.groupBy("vector").agg(F.min("vec_id").alias("key")).withColumn("dim", F.size("vector")))
    named = stored(queries.join(searches, "vector").select(F.col("vec_id").alias("query_id"), "key"))

    counts = dict(classes.groupBy("dim").count().collect())
    wide = max(counts, default=1)
    drawn = classes.orderBy(F.xxhash64("key"), "key").limit(min(rule.fit_rows, (1 << 24) // min(wide, 1 << 16)))
    fitted = _fitted(drawn.select("dim", "vector").toArrow(), counts, rule)
    centroids, probes = {d: c for d, (c, _) in fitted.items()}, {d: n for d, (_, n) in fitted.items()}

    index = stored(_listed(classes, centroids, dict.fromkeys(probes, 1)).withColumn("list", F.explode("lists")).drop("lists"))
    listed = stored(_listed(searches, centroids, probes).withColumn("list", F.explode("lists")).drop("lists"))
    found = stored(_searched(index, listed, rule))

    sizes = rows.groupBy(F.size("vector").alias("dim")).agg(F.least(F.count("*"), F.lit(most)).alias("there"))
    seen = found.groupBy("key").agg(F.count("*").alias("seen"))
    short = stored(
        searches.join(seen, "key", "left").join(sizes, "dim").where(F.coalesce("seen", F.lit(0)) < F.col("there"))
        .select("vector", "key", "dim")
    )
    if short.count():
        every = {d: len(c) for d, c in centroids.items()}
        again = _listed(short, centroids, every).withColumn("list", F.explode("lists")).drop("lists")
        found = found.join(short, "key", "left_anti").union(_searched(index, stored(again), rule))

    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        named.join(found, "key")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= rule.neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )
