"""Nearest neighbours against brute force."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from conftest import TESTDATA
from millrace.llm.neighbours import Scan, exact_distances, nearest_neighbours, survivors, turned
from millrace.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, asked, k):
    """All neighbours of each asked id in order; an id's least vector counts."""
    held = {}
    for i, v in rows:
        fine = i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if fine and (i not in held or v < held[i]):
            held[i] = v
    found = {}
    for q in filter(asked, held):
        near = sorted((math.dist(held[q], v), i) for i, v in held.items() if i != q and len(v) == len(held[q]))
        found[q] = near[:k]
    return {q: near for q, near in found.items() if near}


def searched(spark, rows, k=3, rule=None):
    frame = spark.createDataFrame(rows, SCHEMA)
    rule = rule or Scan(neighbours=k)
    found = {}
    for r in sorted(nearest_neighbours(frame, F.col("vec_id") % 10 == 0, rule).collect()):
        assert r["rank"] == len(found.setdefault(r.query_id, [])) + 1
        found[r.query_id].append((r.score, r.vec_id))
    return found


def same(found, wanted):
    assert found.keys() == wanted.keys()
    for q, near in found.items():
        assert [i for _, i in near] == [i for _, i in wanted[q]]
        assert np.allclose([s for s, _ in near], [s for s, _ in wanted[q]], rtol=1e-12)


def test_odd_vectors_ties_and_copies(spark):
    rows = [(k, [float(k % 7), 1.0]) for k in range(45)] + [(k, [2.0, 1.0]) for k in range(100, 160)]
    rows += [(200, None), (210, []), (220, [0.0, 0.0]), (230, [1.0, None]), (240, [float("nan"), 1.0]), (250, [float("inf"), 1.0])]
    rows += [(None, [1.0, 1.0]), (20, [9.0, 9.0]), (20, [6.0, 1.0]), (300, [1.0, 2.0, 3.0]), (301, [1.0, 2.0, 4.0]), (310, [5.0])]
    rows += [(7, [0.0, 1.0])] * 3
    same(searched(spark, rows), plain(rows, lambda i: i % 10 == 0, 3))
    assert 310 not in searched(spark, rows)


def test_large_components_do_not_overflow(spark):
    rows = [(0, [1e300, 1e300]), (1, [1e300, -1e300]), (2, [1.0, 2.0]), (3, [2.0, 2.0]), (10, [1.0, 1.0])]
    found = searched(spark, rows, k=4)
    assert [i for _, i in found[10]] == [2, 3, 0, 1] and len(found[0]) == 4


def test_a_query_gets_all_candidates_if_they_are_few(spark):
    draw = random.Random(2)
    rows = [(k, [draw.gauss(0, 1) for _ in range(6)]) for k in range(400)]
    rule = Scan(neighbours=120, recall=0.01)  # one list holds some 20 vectors
    found = searched(spark, rows, rule=rule)
    assert all(len(near) == 120 for near in found.values())
    few = rows[:7]
    same(searched(spark, few, k=10), plain(few, lambda i: i % 10 == 0, 10))


def test_cells_cut_lists_and_queries_without_changing_results(spark):
    draw = random.Random(3)
    rows = [(k, [draw.gauss(0, 1) for _ in range(8)]) for k in range(600)]
    wanted = plain(rows, lambda i: i % 10 == 0, 5)
    same(searched(spark, rows, rule=Scan(neighbours=5, recall=1.0, fit_queries=600, slack=50.0, cell=128)), wanted)


def test_empty_table_and_clashing_names(spark):
    rows = [(k, [float(k), 1.0]) for k in range(30)]
    clash = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(1) for n in ("key", "vector", "list", "rank", "asked", "dim")})
    assert nearest_neighbours(clash, F.col("vec_id") % 10 == 0).count() == 30
    assert nearest_neighbours(clash.limit(0), F.col("vec_id") % 10 == 0).collect() == []


def test_rotation_keeps_distances_and_the_test_keeps_near_vectors():
    draw = np.random.default_rng(4)
    for dim in (3, 64, 300):
        points = draw.standard_normal((200, dim))
        spread = turned(points)
        assert np.allclose(exact_distances(points, points[0]), exact_distances(spread, spread[0]))
    points = draw.standard_normal((5000, 64)) * draw.uniform(0.5, 2, (5000, 1))
    blocks = [np.ascontiguousarray(points[:, k : k + 16]) for k in range(0, 64, 16)]
    hits, left = 0, 0
    for query in draw.standard_normal((20, 64)):
        kept = survivors(blocks, query, 11, 2.1)
        near = np.argsort(exact_distances(points, query))[:11]
        hits += len(set(near) & set(kept))
        left += len(kept)
    assert hits >= 0.98 * 20 * 11 and left < 0.2 * 20 * 5000


def test_recall_over_the_whole_table(spark):
    sf_dir = str(TESTDATA / "sf0.1")
    rows = [(r.vec_id, list(map(float, r.embedding))) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    points = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    found = {}
    for r in QUERIES["op11_neighbours"](spark, sf_dir).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert found.keys() == {i for i in ids if i % 100 == 0}
    hits = 0
    for at in np.flatnonzero(ids % 100 == 0):
        far = exact_distances(points, points[at])
        order = [i for i in np.lexsort((ids, far)) if i != at][:10]
        near = sorted(found[ids[at]])
        assert [n for n, _, _ in near] == list(range(1, 11))
        assert [(s, i) for _, i, s in near] == sorted((s, i) for _, i, s in near)
        place = {i: n for n, i in enumerate(ids)}
        assert all(abs(s - far[place[i]]) < 1e-12 for _, i, s in near)
        hits += len({ids[i] for i in order} & {i for _, i, _ in near})
    assert hits >= 0.9 * 10 * len(found)
