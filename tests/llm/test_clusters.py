"""Centroid clustering against plain Python."""

import hashlib
import math
import random

from pyspark.sql import functions as F

from millrace.llm.clusters import BOUND, cluster

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, k, rounds, width, scale=1024, seed="3"):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [max(-BOUND, min(BOUND, math.floor(scale * x) if abs(x) < 1e200 else int(math.copysign(BOUND, x)))) for x in v]))
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        places = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            own = [v for (_, v), p in zip(kept, places) if p == n]
            if own:
                centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *nearest(v)) for i, v in kept]
    spread = [sum(d for _, d, p in found if p == n) for n in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, p, d, spread[p], sum(spread), digest[p]) for i, d, p in found), key=repr)


def clustered(spark, rows, **rule):
    found = cluster(spark.createDataFrame(rows, SCHEMA), **rule)
    assert [t for _, t in found.dtypes] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_clusters_are_those_of_plain_python(spark):
    draw = random.Random(1)
    centres = [[draw.uniform(-3, 3) for _ in range(4)] for _ in range(5)]
    rows = [(k, [x + draw.gauss(0, 0.4) for x in draw.choice(centres)]) for k in range(300)]
    rows += [(1000 + k, [0.25, -0.25, 0.0, 1.0]) for k in range(150)]  # a third are copies
    rule = {"k": 6, "rounds": 7, "width": 4}
    assert clustered(spark, rows, **rule) == plain(rows, **rule)


def test_ties_take_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(k, [0.5, 0.5]) for k in range(12)] + [(20, [0.0, 0.0]), (21, [1.0, 1.0])]
    rule = {"k": 5, "rounds": 3, "width": 2}
    assert clustered(spark, rows, **rule) == plain(rows, **rule)


def test_odd_vectors(spark):
    one = [0.5, -0.001]
    rows = [(1, None), (2, []), (3, one), (3, one), (None, one), (4, [1.0]), (5, [1.0, None]), (6, [1.0, float("nan")])]
    rows += [(7, [1.0, float("-inf")]), (8, [1e300, -1e300]), (9, [0.0, 0.0])]
    rule = {"k": 8, "rounds": 2, "width": 2}
    assert clustered(spark, rows, **rule) == plain(rows, **rule)
    assert clustered(spark, []) == []
    clash = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("x") for n in ("cluster", "vector", "distance", "found")})
    assert cluster(clash, **rule).count() == 5


def test_distances_and_inertia_fit_longs(spark):
    rows = [(k, [1e30 if k % 2 else -1e30] * 64) for k in range(9)]
    found = clustered(spark, rows, k=1, rounds=0)
    assert max(r[2] for r in found) == 64 * (2 * BOUND) ** 2 and found[0][4] == (1 << 63) - 1


def test_plan_has_no_python(spark):
    frame = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(20)], SCHEMA)
    plan = cluster(frame, k=3, width=2)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
