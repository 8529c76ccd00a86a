"""Windows by blocks against Spark's own."""

import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import plan
from millrace.operators.windows import By, Call, Frame, blocked_windows

SCHEMA = "k string, o long, d double, v long, id long"


def data(seed, n=260):
    """Few partitions, one of which holds most rows; ties, nulls, NaN and infinities."""
    draw = random.Random(seed)
    odd = [None, float("nan"), float("inf"), float("-inf"), -0.0, 0.0]
    rows = []
    for i in range(n):
        key = draw.choice(["hot", "hot", "hot", "a", None, f"only{i}"])
        order = None if draw.random() < 0.1 else draw.randrange(-20, 20) * draw.choice([1, 1, 7])
        real = draw.choice(odd) if draw.random() < 0.15 else round(draw.uniform(-4, 4), 1)
        rows.append((key, order, real, None if draw.random() < 0.15 else draw.randrange(100), i))
    draw.shuffle(rows)
    return rows


def same(spark, rows, partition, order, calls, sql, **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    found = blocked_windows(frame, partition, order, calls, **options)
    assert found.columns == [*frame.columns, *calls]
    wanted = frame.selectExpr("*", *[f"{text} AS `{n}`" for n, text in sql.items()])
    show = lambda r: tuple("nan" if isinstance(x, float) and math.isnan(x) else round(x, 9) if isinstance(x, float) else x for x in r)
    key = lambda t: (t[4], repr(t))
    assert sorted(map(show, found.collect()), key=key) == sorted(map(show, wanted.collect()), key=key)


def spec(order, frame=None, partition="k"):
    part = f"PARTITION BY {partition} " if partition else ""
    return f"({part}ORDER BY {order}{f' {frame}' if frame else ''})"


def text(frame):
    def bound(n, open_end):
        if n is None:
            return f"UNBOUNDED {open_end}"
        return "CURRENT ROW" if n == 0 else f"{abs(n)} {'PRECEDING' if n < 0 else 'FOLLOWING'}"

    return f"{'ROWS' if frame.rows else 'RANGE'} BETWEEN {bound(frame.low, 'PRECEDING')} AND {bound(frame.high, 'FOLLOWING')}"


RANK_CALLS = {"r": Call("rank"), "de": Call("dense_rank"), "p": Call("percent_rank"), "c": Call("cume_dist")}
RANK_SQL = {"r": "CAST(rank() OVER {w} AS bigint)", "de": "CAST(dense_rank() OVER {w} AS bigint)", "p": "percent_rank() OVER {w}", "c": "cume_dist() OVER {w}"}


@pytest.mark.parametrize(
    ("order", "sql"),
    [(["o"], "o"), ([By("o", descending=True)], "o DESC"), ([By("o", nulls_last=True), "v"], "o NULLS LAST, v"), (["d"], "d"), ([By("d", True, False)], "d DESC NULLS FIRST")],
)
@pytest.mark.parametrize("blocks", [1, 23])
def test_ranks(spark, order, sql, blocks):
    same(spark, data(1), ["k"], order, RANK_CALLS, {n: t.format(w=spec(sql)) for n, t in RANK_SQL.items()}, blocks=blocks)


def test_peers_over_many_blocks(spark):
    rows = [("hot", 7 if i > 20 else i % 3, 0.0, i, i) for i in range(300)] + [("b", 1, 0.0, 1, 1000 + i) for i in range(40)]
    same(spark, rows, ["k"], ["o"], RANK_CALLS, {n: t.format(w=spec("o")) for n, t in RANK_SQL.items()}, blocks=29)


def test_numbers_buckets_and_offsets(spark):
    calls = {
        "rn": Call("row_number"), "t3": Call("ntile", offset=3), "t500": Call("ntile", offset=500), "t17": Call("ntile", offset=17),
        "l1": Call("lag", "v"), "l9": Call("lag", "v", 9, -5), "n2": Call("lead", "v", 2, 8), "n40": Call("lead", "d", 40), "neg": Call("lag", "v", -3), "zero": Call("lead", "v", 0),
    }
    w = spec("o DESC, id")
    sql = {
        "rn": f"CAST(row_number() OVER {w} AS bigint)", "t3": f"CAST(ntile(3) OVER {w} AS bigint)", "t500": f"CAST(ntile(500) OVER {w} AS bigint)",
        "t17": f"CAST(ntile(17) OVER {w} AS bigint)", "l1": f"lag(v) OVER {w}", "l9": f"lag(v, 9, -5L) OVER {w}", "n2": f"lead(v, 2, 8L) OVER {w}",
        "n40": f"lead(d, 40) OVER {w}", "neg": f"lag(v, -3) OVER {w}", "zero": f"lead(v, 0) OVER {w}",
    }
    same(spark, data(2), ["k"], [By("o", descending=True), "id"], calls, sql, blocks=11, block_rows=7)


def framed(frames, functions):
    calls, sql = {}, {}
    for i, frame in enumerate(frames):
        for f in functions:
            calls[f"{f}{i}"] = Call(f, None if f == "count" and i % 2 else "v", frame=frame)
            sql[f"{f}{i}"] = (f, "*" if f == "count" and i % 2 else "v", frame)
    return calls, sql


@pytest.mark.parametrize("seed", range(3))
def test_random_rows_frames(spark, seed):
    draw = random.Random(seed)
    frames = [Frame(None, 0, True), Frame(0, None, True), Frame(None, None, True)]
    for _ in range(6):
        low, high = sorted(draw.sample(range(-15, 16), 2))
        frames.append(Frame(None if draw.random() < 0.25 else low, None if draw.random() < 0.25 else high, True))
    calls, sql = framed(frames, ["sum", "count", "min", "max", "avg", "first_value", "last_value"])
    sql = {n: f"{f}({c}) OVER {spec('o, id', text(fr))}" for n, (f, c, fr) in sql.items()}
    same(spark, data(seed + 3), ["k"], ["o", "id"], calls, sql, blocks=9, block_rows=draw.choice([1, 5, 16]))


@pytest.mark.parametrize(("order", "sql"), [("o", "o"), ("d", "d")])
@pytest.mark.parametrize("descending", [False, True])
def test_range_frames(spark, order, sql, descending):
    frames = [Frame(), Frame(0, 0), Frame(0, None), Frame(None, None), Frame(-3, 2), Frame(None, 4), Frame(None, -2), Frame(-5, None), Frame(3, None), Frame(-9, -4), Frame(1, 6)]
    calls, named = framed(frames, ["sum", "count", "min", "max", "avg"])
    way = f"{sql} DESC" if descending else sql
    named = {n: f"{f}({c}) OVER {spec(way, text(fr))}" for n, (f, c, fr) in named.items()}
    same(spark, data(8, 160), ["k"], [By(order, descending)], calls, named, blocks=7, block_rows=4)


def test_first_and_last_of_peers(spark):
    calls = {"f": Call("first_value", "id", frame=Frame(-4, 0)), "l": Call("last_value", "id", frame=Frame(None, None))}
    rows = [(k, o, 0.0, 1, i) for i, (k, o) in enumerate({(k, o): 0 for k, o, *_ in data(9) if o is not None})]
    sql = {"f": f"first_value(id) OVER {spec('o', text(Frame(-4, 0)))}", "l": f"last_value(id) OVER {spec('o', text(Frame(None, None)))}"}
    same(spark, rows, ["k"], ["o"], calls, sql, blocks=5, block_rows=6)


def test_no_partition_and_no_rows(spark):
    calls = {"rn": Call("row_number"), "s": Call("sum", "v", frame=Frame(None, 0, True)), "r": Call("max", "v", frame=Frame(-4, 4))}
    sql = {"rn": "CAST(row_number() OVER (ORDER BY id) AS bigint)", "s": f"sum(v) OVER {spec('id', text(Frame(None, 0, True)), '')}", "r": f"max(v) OVER {spec('id', text(Frame(-4, 4)), '')}"}
    same(spark, data(10), [], ["id"], calls, sql, blocks=6, block_rows=10)
    same(spark, [], [], ["id"], calls, sql)


def test_columns_of_odd_names(spark):
    frame = spark.createDataFrame(data(11, 40), SCHEMA).withColumnsRenamed({"k": "a key", "v": "v.x", "id": "I`d"})
    found = blocked_windows(frame, ["a key"], ["o", "I`d"], {"s.um": Call("sum", "v.x"), "r n": Call("row_number")}, blocks=3, block_rows=5)
    assert found.columns == [*frame.columns, "s.um", "r n"] and found.count() == 40
    with pytest.raises(ValueError, match="taken"):
        blocked_windows(frame, [], ["o"], {"o": Call("rank")})


def test_calls_are_checked():
    for wrong in (lambda: Call("median", "v"), lambda: Call("sum"), lambda: Call("ntile", offset=0), lambda: Call("sum", "v", frame=Frame(2, 1))):
        with pytest.raises(ValueError):
            wrong()


def test_distances_need_one_number(spark):
    frame = spark.createDataFrame(data(12, 20), SCHEMA)
    for order in (["o", "id"], ["k"]):
        with pytest.raises(ValueError, match="one numeric column"):
            blocked_windows(frame, [], order, {"s": Call("sum", "v", frame=Frame(-2, 0))})


def test_no_window_sorts_a_whole_partition(spark):
    """A partition that holds nearly all rows is cut: each window's task has a tile and its reach."""
    frame = spark.range(60_000).select((F.col("id") % 100 == 0).cast("int").alias("k"), "id", (F.col("id") % 7).alias("v"))
    calls = {"near": Call("sum", "v", frame=Frame(-3, 3, True)), "run": Call("max", "v", frame=Frame(None, 0, True))}
    found = blocked_windows(frame, ["k"], ["id"], calls, block_rows=1000, blocks=20)
    windows = [line for line in plan(found).splitlines() if "Window [" in line]
    assert windows and all("__w_cell" in line for line in windows if "near" in line)
    assert found.agg(F.sum("near"), F.count("*")).first()[1] == 60_000
