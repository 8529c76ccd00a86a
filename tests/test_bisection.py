"""Failing rows told by halving, against the rows that are known to fail."""

import math
import random

import pytest
from pyspark.sql import types as T

from millrace import StreamDef, TopicContract, TopicPipeline
from millrace.operators import deadletter as dead
from millrace.operators.bisection import find_failing
from millrace.operators.conform import REASON
from millrace.plans.statements import take_rows_alone
from workload.fixtures import event_contracts, event_rows
from workload.flows import FLOWS


def offsets(spark, rows):
    return spark.createDataFrame(rows, "partition int, offset long")


class Job:
    """Fails on given rows, as a job over the chosen rows would; counts its runs."""

    def __init__(self, frame, bad, together=()):
        self.rows = {(r.partition, r.offset) for r in frame.collect()}
        self.bad, self.together, self.runs = set(bad), set(together), 0
        self.frame = frame

    def __call__(self, condition):
        self.runs += 1
        chosen = {(r.partition, r.offset) for r in self.frame.where(condition).collect()}
        hit = sorted(chosen & self.bad)
        if hit:
            return f"no {hit[0]}"
        return "too many" if self.together and self.together <= chosen else None


@pytest.mark.parametrize(("seed", "k"), [(1, 1), (2, 3), (3, 6)])
def test_bad_rows_stand_alone(spark, seed, k):
    draw = random.Random(seed)
    rows = [(p, o) for p in range(3) for o in draw.sample(range(10 ** (3 + 2 * p)), 120)]
    frame = offsets(spark, rows)
    bad = draw.sample(rows, k)
    job = Job(frame, bad)
    found = find_failing(frame, job, most=16, error="whole")
    assert [(r.partition, r.low, r.high, r.rows, e) for r, e in found.ranges] == [(p, o, o, 1, f"no {(p, o)}") for p, o in sorted(bad)]
    assert found.rows == k and found.runs == job.runs <= 2 * k * math.ceil(math.log2(len(rows)))
    assert sorted(map(tuple, frame.where(found.covers()).collect())) == sorted(bad)
    assert {tuple(r) for r in frame.where(found.covers()).select(found.error()).collect()} == {(f"no {b}",) for b in bad}


def test_many_bad_rows_are_given_as_ranges(spark):
    frame = offsets(spark, [(0, o) for o in range(200)] + [(1, o) for o in range(200)])
    job = Job(frame, [(0, o) for o in range(200)])
    found = find_failing(frame, job, most=4, error="whole")
    covered = {tuple(r) for r in frame.where(found.covers()).collect()}
    assert {(0, o) for o in range(200)} <= covered and job.runs <= 16
    assert not any(p == 1 for p, _ in covered)


def test_rows_that_fail_only_together_are_not_told(spark):
    frame = offsets(spark, [(0, o) for o in range(64)])
    assert find_failing(frame, Job(frame, [], together=[(0, 1), (0, 60)]), most=8, error="whole") is None
    assert find_failing(frame.limit(0), Job(frame, []), most=8, error="whole") is None
    lost = spark.createDataFrame([(None, 1), (0, 2)], "partition int, offset long")
    assert find_failing(lost, Job(lost, [(0, 2)]), most=8, error="whole") is None


def test_repeated_and_sparse_offsets(spark):
    rows = [(0, 5)] * 3 + [(0, 1 << 50), (0, -7), (2, 5), (2, 5)]
    frame = offsets(spark, rows)
    found = find_failing(frame, Job(frame, [(0, 5), (2, 5)]), most=8, error="whole")
    assert [(r.partition, r.low, r.high, r.rows) for r, _ in found.ranges] == [(0, 5, 5, 3), (2, 5, 5, 2)]


@pytest.mark.parametrize(("seed", "k"), [(4, 12), (5, 40)])
def test_more_bad_rows_than_the_limit_stand_alone(spark, seed, k):
    draw = random.Random(seed)
    rows = [(p, o) for p in range(2) for o in draw.sample(range(10 ** (2 + 3 * p)), 60)]
    frame = offsets(spark, rows)
    bad = sorted(draw.sample(rows, k))
    job, asked = Job(frame, bad), []
    found = find_failing(frame, job, most=4, error="whole", rest=lambda c: asked.append(c))
    assert [(r.partition, r.low, r.high, r.rows, e) for r, e in found.ranges] == [(p, o, o, 1, f"no {(p, o)}") for p, o in bad]
    assert len(asked) == 1 and found.rows == k and found.runs == job.runs <= 2 * k * math.ceil(math.log2(len(rows)))
    assert sorted(map(tuple, found.of(frame).collect())) == bad
    assert sorted(map(tuple, found.others(frame).collect())) == sorted(set(rows) - set(bad))


def test_the_rest_may_be_told_at_once(spark):
    rows = [(p, o) for p in range(2) for o in range(300)] + [(1, 7), (1, None)]
    frame = offsets(spark, rows)
    bad = [(0, o) for o in range(0, 300, 3)] + [(1, 7)]
    job = Job(frame, bad)
    found = find_failing(frame, job, most=4, error="whole", rest=lambda c: offsets(spark, bad).where(c))
    assert job.runs <= 20 and found.rows == 102
    key = lambda row: (row[0], row[1] is None, row[1])
    assert sorted(map(tuple, found.of(frame).collect()), key=key) == sorted([*bad, (1, 7)], key=key)
    assert sorted(map(tuple, found.others(frame).collect()), key=key) == sorted((r for r in rows if r not in bad), key=key)
    assert found.of(frame).where(found.error().isNull()).count() == 0


SHARES = StreamDef("shares", "click", "shares", "event_id", "event_id, 10 div (event_id % 100 - 7) AS z", order_by="event_id")


def test_pipeline_stores_the_rest(spark, sf_dir, root):
    rows = event_rows(spark, sf_dir).filter("topic IN ('click', 'view')")
    count = StreamDef("count", "click", "counts", "n", "count(*) AS n, max(event_id) AS event_id, sum(10 div (event_id % 100 - 7)) AS z", order_by="event_id")
    fine = StreamDef("fine", "view", "views", "event_id", "event_id, user_id", order_by="event_id")
    work = TopicPipeline(spark, [SHARES, fine, count], event_contracts(spark, "click", "view"), root, ansi=True, concurrency=3, isolate=32)
    for _ in range(2):  # a batch that is repeated gives the same
        report = work.process(rows, 0)
        clicks = {r.offset for r in rows.filter("topic = 'click'").collect()}
        bad = {o for o in clicks if o % 100 == 7}
        shares, views, counts = report.streams
        assert 0 < len(bad) == shares.isolated == counts.isolated and shares.stored == len(clicks - bad)
        assert "DIVIDE_BY_ZERO" in shares.error and views.error is None and views.isolated == 0
        assert {r.event_id for r in work.table("shares").collect()} == clicks - bad
        assert [r.n for r in work.table("counts").collect()] == [len(clicks - bad)]
        for name in ("shares", "count"):
            lost = dead.read_failed(spark, root, name).collect()
            assert {r.offset for r in lost} == bad and {r[REASON] for r in lost} == {dead.TRANSFORM_FAILED}
            assert all("DIVIDE_BY_ZERO" in r[dead.ERROR] for r in lost)


def test_nothing_is_told_where_isolation_is_off(spark, sf_dir, root):
    rows = event_rows(spark, sf_dir).filter("topic = 'click'")
    work = TopicPipeline(spark, [SHARES], event_contracts(spark, "click"), root, ansi=True, isolate=0)
    report = work.process(rows, 0)
    assert report.streams[0].isolated == 0 and report.streams[0].error
    assert dead.read_failed(spark, root, "shares").count() == rows.count()


def test_failures_of_the_whole_keep_the_whole_batch(spark, sf_dir, root):
    """No row fails alone: only more than a hundred of them do."""
    rows = event_rows(spark, sf_dir).filter("topic = 'click'")
    stream = StreamDef("all", "click", "t", "n", "count(*) AS n, assert_true(count(*) < 150) AS z, max(event_id) AS event_id", order_by="event_id")
    work = TopicPipeline(spark, [stream], event_contracts(spark, "click"), root, ansi=True)
    assert work.process(rows, 0).streams[0].isolated == 0
    assert dead.read_failed(spark, root, "all").count() == rows.count() > 150


def test_rejects_stay_out_of_it(spark, root):
    struct = T.StructType.fromDDL("id long, n long")
    text = [f'{{"id": {i}, "n": {i - 5}}}' for i in range(40)] + ["oops", "{}"]
    values = [(None, bytearray(t.encode()), "t", 0, i, None) for i, t in enumerate(text)]
    rows = spark.createDataFrame(values, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    stream = StreamDef("s", "t", "t", "id", "id, 1 div n AS z, id AS o", order_by="o")
    work = TopicPipeline(spark, [stream], {"t": TopicContract("t", struct)}, root, ansi=True)
    report = work.process(rows, 0)
    assert (report.streams[0].isolated, report.streams[0].stored, report.streams[0].null_key, report.untyped) == (1, 39, 1, {"t": 1})
    assert [r.offset for r in dead.read_failed(spark, root, "s").collect()] == [5]
    assert [r.offset for r in dead.read_raw(spark, root).collect()] == [40]


def numbers(spark, root, stream, text, most=4):
    struct = T.StructType.fromDDL("id long, n long, t string")
    values = [(None, bytearray(t.encode()), "t", i % 3, i, None) for i, t in enumerate(text)]
    rows = spark.createDataFrame(values, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    work = TopicPipeline(spark, [stream], {"t": TopicContract("t", struct)}, root, ansi=True, isolate=most)
    return work, work.process(rows, 0).streams[0]


TEXT = [f'{{"id": {i}, "n": {i % 5}, "t": "{"x" if i % 7 == 0 else i}"}}' for i in range(60)]


@pytest.mark.parametrize(
    ("transform", "filter", "bad"),
    [
        ("id, 1 div n AS z", "1=1", lambda i: i % 5 == 0),
        ("id, 1 div n AS z, 1 + (1 div n) AS y, CAST(t AS int) AS x", "id <> 5", lambda i: i != 5 and (i % 5 == 0 or i % 7 == 0)),
        ("id, 1 div (id - id) AS z", "1=1", lambda i: True),
        # what the filter raises on, or a column that others' rows enter, is told by halving
        ("id, CAST(t AS int) AS z", "1 div n >= 0 AND id > 0", lambda i: i % 5 == 0 or i % 7 == 0),
        ("max(id) AS id, count(*) AS z, sum(1 div n) AS y", "1=1", lambda i: i % 5 == 0),
    ],
)
def test_pipeline_tells_all_rows_beyond_the_limit(spark, root, transform, filter, bad):
    work, report = numbers(spark, root, StreamDef("s", "t", "t", "id", transform, filter, order_by="id"), TEXT)
    wrong = [i for i in range(60) if bad(i)]
    whole = transform.startswith("max")
    kept = [i for i in range(60) if i not in wrong and (filter == "1=1" or i != 5)]
    assert (report.isolated, report.stored) == (len(wrong), 1 if whole else len(kept))
    assert sorted(r.offset for r in dead.read_failed(spark, root, "s").collect()) == wrong
    assert not dead.read_failed(spark, root, "s").where(f"{dead.ERROR} IS NULL").count()
    stored = work.table("t").collect()
    assert [r.z for r in stored] == [len(kept)] if whole else sorted(r.id for r in stored) == kept


def test_streams_that_take_rows_alone(spark):
    alone = [("event_id, 10 div (event_id - 7) AS z", "value > 1"), ("*", "1=1")]
    not_alone = [
        ("event_id, sum(value) OVER () AS z", "1=1"),
        ("max(event_id) AS event_id", "1=1"),
        ("DISTINCT event_id", "1=1"),
        ("event_id", "1=1 LIMIT 3"),
        ("event_id", "event_id IN (SELECT event_id FROM TMP_VIEW)"),
        ("event_id", "EXISTS (SELECT 1)"),
        ("event_id, rand() AS z", "1=1"),
        ("event_id, explode(array(1, 2)) AS z", "1=1"),
    ]
    streams = [StreamDef(f"s{i}", "click", "t", "event_id", *x, order_by="event_id") for i, x in enumerate(alone + not_alone)]
    streams.append(StreamDef("sql", "click", "t", "event_id", sql="SELECT event_id FROM TMP_CLICK", order_by="event_id"))
    streams.append(StreamDef("view", "view", "v", "event_id", order_by="event_id"))
    assert take_rows_alone(spark, streams, event_contracts(spark, "click", "view"), True) == {"s0", "s1", "view"}


def test_dead_letter_bisected_stores_all_other_rows(spark, tmp_path):
    """More rows than the query's limit divide by zero, each with good ones beside it."""
    ids = [4999 * i + 88 + d for i in range(90) for d in (-1, 0, 4, 8)]
    events = spark.createDataFrame([(i, i % 11, "click") for i in ids], "event_id long, user_id long, event_type string")
    events.selectExpr(
        "event_id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts", "user_id", "event_type", "1.0D AS value", "'{}' AS props"
    ).write.parquet(f"{tmp_path}/events.parquet")
    found = {(r.event_id, r.user_id): r.reason for r in FLOWS["dead_letter_bisected"](spark, str(tmp_path)).collect()}
    assert found == {(i, i % 11): "transform_failed" if i % 4999 == 88 else "stored" for i in ids}
