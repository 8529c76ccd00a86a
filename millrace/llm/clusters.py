"""Centroid clustering of integer vectors, in DataFrame expressions alone.

Centroids are literal arrays in the plan: ``zip_with`` and ``aggregate`` give a
vector's squared distance to each, ``array_min`` over structs of distance and
number the nearest one. The next centroids come from one sum per component and
cluster, combined before the shuffle: each round moves as many rows as there are
tasks and clusters, whatever a cluster holds, and k rows come to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.store import stored

#: Components are held to +-2**27, so that squared distances of up to 127 of them fit a long.
BOUND = 1 << 27
_MOST = (1 << 63) - 1


def whole_components(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component, as longs within ``BOUND``."""
    held = lambda x: F.greatest(F.least(x.cast("double") * scale, F.lit(float(BOUND))), F.lit(float(-BOUND)))
    return F.transform(vector, lambda x: F.floor(held(x)).cast("long"))


def usable(vector: Column, width: int) -> Column:
    """Whether a vector has so many components, none of them null or not finite."""
    finite = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf")))
    return F.coalesce((F.size(vector) == width) & F.forall(vector, finite), F.lit(False))


def squared_distance(vector: Column, centroid: Sequence[int]) -> Column:
    """The squared Euclidean distance to a literal array, as the sum of x(x - 2c) and of c squared."""
    twice = F.expr(f"array({', '.join(f'{2 * c}L' for c in centroid)})")
    parts = F.zip_with(vector, twice, lambda x, y: x * (x - y))
    return F.aggregate(parts, F.lit(sum(c * c for c in centroid)).cast("long"), lambda total, x: total + x)


def nearest(vector: Column, centroids: Sequence[Sequence[int]]) -> Column:
    """``distance, cluster`` of the nearest centroid, the smaller number of equally near ones."""
    found = [
        F.struct(squared_distance(vector, c).alias("distance"), F.lit(k).alias("cluster"))
        for k, c in enumerate(centroids)
    ]
    return F.array_min(F.array(*found))


def _means(points: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The floors of the clusters' means; a cluster without vectors keeps its centroid."""
    placed = points.withColumn("cluster", nearest(F.col("vector"), centroids)["cluster"])
    sums = [F.expr(f"sum(vector[{i}]) AS s{i}") for i in range(len(centroids[0]))]
    after = [list(c) for c in centroids]
    for row in placed.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        after[row.cluster] = [row[f"s{i}"] // row.n for i in range(len(centroids[0]))]
    return after


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    width: int = 64,
    seed: str = "3",
    identity: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Per usable vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Vectors of exactly ``width`` components, none null or not finite, are kept,
    with ``floor(scale * x)`` of each component x as a long, held to ``BOUND``. The k
    vectors whose ``sha256(seed:id)`` comes first are the centroids at the start;
    fewer vectors make fewer centroids. Equal hashes (an id given twice) are ordered by
    their components. Repeated rows count each, a null id hashes as the empty text. An
    inertia beyond a long is the greatest long. No vector gives an empty table.
    Other columns are not read.
    """
    kept = stored(
        vectors.where(usable(F.col(vector), width)).select(
            F.col(identity).alias("vec_id"), whole_components(F.col(vector), scale).alias("vector")
        )
    )
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = kept.orderBy(F.sha2(name, 256), "vector").limit(k)
    centroids = [list(row.vector) for row in first.select("vector").collect()]
    if centroids:
        for _ in range(rounds):
            centroids = _means(kept, centroids)
    else:  # nothing to place; a centroid only gives the columns their types
        centroids = [[0] * width]
    placed = stored(kept.select("vec_id", nearest(F.col("vector"), centroids).alias("found")))
    spread = F.sum(F.col("found.distance").cast("decimal(38,0)")).alias("spread")
    spreads = {r.cluster: int(r.spread) for r in placed.groupBy("found.cluster").agg(spread).collect()}
    points = {n: ",".join(map(str, c)) for n, c in enumerate(centroids)}
    whole = min(sum(spreads.values()), _MOST)
    return placed.select(
        "vec_id",
        "found.cluster",
        "found.distance",
        _by_number({n: min(spreads.get(n, 0), _MOST) for n in points}).cast("long").alias("cluster_inertia"),
        F.lit(whole).cast("long").alias("inertia"),
        F.sha2(_by_number(points), 256).alias("centroid_sha256"),
    )


def _by_number(values: dict) -> Column:
    """The literal of a row's cluster."""
    return F.element_at(F.array(*[F.lit(values[n]) for n in sorted(values)]), F.col("found.cluster") + 1)
