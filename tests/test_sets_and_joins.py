"""Multisets, overlapping ranges and NOT IN against Spark's own forms."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows_of
from millrace.operators.multisets import except_all, intersect_all
from millrace.operators.notin import not_in
from millrace.operators.rangejoin import overlap_join


def _rows(seed, n):
    draw = random.Random(seed)
    odd = [None, float("nan"), 0.0, -0.0, 1.5]
    return [(draw.choice(["hot", "hot", "a", None]), draw.choice(odd)) for _ in range(n)]


@pytest.mark.parametrize("chunk", [1, 3, 4096])
def test_multisets_are_spark_s(spark, chunk):
    left, right = (spark.createDataFrame(_rows(s, n), "`a b` string, d double") for s, n in ((1, 200), (2, 120)))
    shown = lambda frame: [repr(r).replace("-0.0", "0.0") for r in rows_of(frame)]
    assert shown(except_all(left, right, chunk)) == shown(left.exceptAll(right))
    assert shown(intersect_all(left, right, chunk)) == shown(left.intersectAll(right))
    assert sorted(shown(except_all(left, right.limit(0), chunk))) == sorted(shown(left))
    assert intersect_all(left.limit(0), right, chunk).collect() == []
    with pytest.raises(ValueError, match="columns"):
        except_all(left, right.select("d"))


def test_copies_of_one_row_are_dealt_out(spark):
    """A third of the input is one row; no task of the result has over twice the median of the others' rows."""
    left = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("v"))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = except_all(left, spark.range(10).select(F.lit(-1).cast("long")), chunk=512)
        hot = [r["n"] for r in found.where("v = -1").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert sum(hot) == 100_000 - 10 and len(hot) > 1 and max(hot) <= 2 * sorted(hot)[len(hot) // 2] + 512


def _plain_pairs(left, right):
    fine = lambda r: None not in r[1:] and all(x == x for x in r[1:]) and r[1] <= r[2]
    return sorted((a[0], b[0]) for a, b in itertools.product(filter(fine, left), filter(fine, right)) if a[1] <= b[2] and b[1] <= a[2])


@pytest.mark.parametrize(("width", "seed"), [(None, 0), (0.5, 1), (40.0, 2)])
def test_overlaps_are_those_of_all_pairs(spark, width, seed):
    draw = random.Random(seed)

    def ranges(n):
        made = []
        for i in range(n):
            low = round(draw.uniform(-50, 50), 1)
            made.append((i, low, low + draw.choice([0.0, 0.1, 1.0, 3.0, 30.0, 500.0])))
        inf = float("inf")
        return made + [(n, None, 1.0), (n + 1, 5.0, 4.0), (n + 2, float("nan"), 3.0), (n + 3, -inf, inf), (n + 4, -inf, -49.0), (n + 5, 7.0, 7.0)]

    left, right = ranges(120), ranges(90)
    a = spark.createDataFrame(left, "i long, low double, high double")
    b = spark.createDataFrame(right, "j long, from double, to double")
    joined = overlap_join(a, b, ("low", "high"), ("from", "to"), width=width)
    assert joined.columns == ["i", "low", "high", "j", "from", "to"]
    assert sorted((r.i, r.j) for r in joined.collect()) == _plain_pairs(left, right)


def test_points_long_ranges_and_no_rows(spark):
    points = spark.range(2000).select("id", (F.col("id") * 3).alias("at"))
    wide = spark.createDataFrame([(0, 0, 6000), (1, 30, 33), (2, -9, -1)], "n long, low long, high long")
    joined = overlap_join(points, wide, ("at", "at"), ("low", "high"))
    assert {r.n: r["count"] for r in joined.groupBy("n").count().collect()} == {0: 2000, 1: 2}
    assert overlap_join(points.limit(0), wide, ("at", "at"), ("low", "high")).collect() == []
    assert overlap_join(points.limit(0), wide.limit(0), ("at", "at"), ("low", "high")).collect() == []
    with pytest.raises(ValueError, match="both sides"):
        overlap_join(points, points, ("at", "at"), ("at", "at"))
    with pytest.raises(ValueError, match="no number"):
        overlap_join(points.select(F.col("at").cast("string").alias("s")), wide, ("s", "s"), ("low", "high"))


def test_overlaps_need_no_nested_loop(spark):
    a = spark.range(1000).select(F.col("id").alias("i"), (F.col("id") + 2).alias("e"))
    b = spark.range(1000).select(F.col("id").alias("j"), (F.col("id") + 1).alias("f"))
    text = plan(overlap_join(a, b, ("i", "e"), ("j", "f")))
    assert "NestedLoop" not in text and "Cartesian" not in text


KEYS = [(1, 1), (1, None), (None, 2), (2, 2), (None, None), (3, 1), (3, 1)]


@pytest.mark.parametrize("hot_rows", [1 << 20, 2])
def test_not_in_follows_sql_for_all_nulls(spark, hot_rows):
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(KEYS * 2)], "i long, a long, b long")
        rows.createOrReplaceTempView("not_in_rows")
        for chosen in [(), (0,), (1,), (2,), (4,), (0, 3), (1, 2), (0, 2, 5)]:
            other = spark.createDataFrame([KEYS[k] for k in chosen], "c long, d long")
            other.createOrReplaceTempView("not_in_other")
            wanted = spark.sql("SELECT * FROM not_in_rows WHERE (a, b) NOT IN (SELECT c, d FROM not_in_other)")
            assert rows_of(not_in(rows, ["a", "b"], other, hot_rows=hot_rows, salts=5)) == rows_of(wanted)
            if len(chosen) < 2:
                one = spark.sql("SELECT * FROM not_in_rows WHERE a NOT IN (SELECT c FROM not_in_other)")
                assert rows_of(not_in(rows, ["a"], other.select("c"), hot_rows=hot_rows, salts=5)) == rows_of(one)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


def test_not_in_plans_no_nested_loop(spark):
    rows = spark.range(100).select(F.when(F.col("id") % 5 > 0, F.col("id") % 9).alias("a b"))
    found = not_in(rows, ["a b"], spark.range(3).toDF("x"), hot_rows=10)
    assert "NestedLoop" not in plan(found) and found.count() == sum(1 for i in range(100) if i % 5 and i % 9 > 2)
    with pytest.raises(ValueError, match="columns against"):
        not_in(rows, [], spark.range(3))
