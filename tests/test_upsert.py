from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import plan, rows_of
from millrace import StreamDef, upsert_rows
from millrace.operators.upsert import (
    Layer,
    append_log,
    base_version,
    compact,
    latest_rows,
    merge_into,
    snapshot,
)
from millrace.plans.definitions import tables_of

ONE = StreamDef("one", "t", "out", "k", order_by="o")
LEFT = StreamDef("left", "t", "both", "k", order_by="o")
RIGHT = StreamDef("right", "t", "both", "k", order_by="o")
OUT = tables_of([ONE])["out"]
BOTH = tables_of([LEFT, RIGHT])["both"]


def frame(spark, rows, columns="k bigint, o bigint, v string"):
    return spark.createDataFrame(rows, columns)


def layer(spark, rows, batch=0, position=0, columns="k bigint, o bigint, v string"):
    return Layer(frame(spark, rows, columns), batch, position, ("o",))


def test_greatest_by_order_wins_in_a_batch(spark):
    found = latest_rows([layer(spark, [(1, 5, "a"), (1, 7, "b"), (1, 6, "c"), (2, 1, "d")])], ["k"])
    assert rows_of(found) == [(1, 7, "b"), (2, 1, "d")]


def test_later_batch_wins_over_greater_order(spark):
    found = latest_rows([layer(spark, [(1, 9, "old")]), layer(spark, [(1, 1, "new")], 1)], ["k"])
    assert rows_of(found) == [(1, 1, "new")]


def test_later_stream_wins_in_a_batch(spark):
    layers = [layer(spark, [(1, 9, "first")]), layer(spark, [(1, 1, "second")], position=1)]
    assert rows_of(latest_rows(layers, ["k"])) == [(1, 1, "second")]


def test_equal_order_gives_the_same_row_every_time(spark):
    rows = [(1, 1, f"v{i}") for i in range(40)]
    picks = {
        tuple(latest_rows([layer(spark, shift)], ["k"]).first())
        for shift in (rows, rows[::-1], rows[20:] + rows[:20])
    }
    assert len(picks) == 1


def test_explicit_null_overwrites_and_absent_column_does_not(spark):
    layers = [
        layer(spark, [(1, 1, "x"), (2, 1, "y")]),
        layer(spark, [(1, 2, None)], 1),
        layer(spark, [(2, 3, 0.5)], 2, 1, "k bigint, o bigint, w double"),
    ]
    assert rows_of(latest_rows(layers, ["k"]).select("k", "v", "w")) == [
        (1, None, None),
        (2, "y", 0.5),
    ]


def test_composite_key_and_nested_values(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES (1, 'a', 1, map('x', 1), array(1)), (1, 'a', 2, map('x', 2), array(2)),"
        " (1, 'b', 1, map('x', 3), array(3)) AS t(k, k2, o, m, l)"
    )
    found = latest_rows([Layer(rows, 0, 0, ("o",))], ["k", "k2"])
    assert [(r.k2, r.m["x"], r.l) for r in found.orderBy("k2").collect()] == [
        ("a", 2, [2]),
        ("b", 3, [3]),
    ]


def test_upsert_into_a_table(spark):
    existing = frame(spark, [(1, "a", 1.0), (2, "b", 2.0)], "k bigint, name string, bal double")
    updates = frame(spark, [(2, 1, 5.0), (2, 2, None), (3, 1, 7.0)], "k bigint, o bigint, bal double")
    found = upsert_rows(existing, updates, ["k"], ["o"]).drop("o")
    assert rows_of(found) == [(1, "a", 1.0), (2, "b", None), (3, None, 7.0)]


def test_repeated_batch_replaces_itself(spark, root):
    append_log(frame(spark, [(1, 1, "a")]), root, "out", "one", 0)
    append_log(frame(spark, [(1, 1, "b")]), root, "out", "one", 1)
    once = rows_of(snapshot(spark, root, OUT))
    append_log(frame(spark, [(1, 1, "b")]), root, "out", "one", 1)
    assert rows_of(snapshot(spark, root, OUT)) == once == [(1, 1, "b")]
    assert rows_of(snapshot(spark, root, OUT, upto=0)) == [(1, 1, "a")]


def test_unfinished_batch_is_not_read(spark, root):
    append_log(frame(spark, [(1, 1, "a")]), root, "out", "one", 0)
    append_log(frame(spark, [(1, 1, "half")]), root, "out", "one", 1)
    for mark in Path(root).glob("log/out/stream=one/shape=*/batch_id=1/_SUCCESS"):
        mark.unlink()
    assert rows_of(snapshot(spark, root, OUT)) == [(1, 1, "a")]


def test_empty_table_says_so(spark, root):
    with pytest.raises(ValueError, match="nothing stored"):
        snapshot(spark, root, OUT)


@pytest.mark.parametrize("buckets", [None, 4])
def test_compaction_changes_nothing_but_the_layout(spark, root, buckets):
    for batch in range(6):
        left = frame(spark, [(k, batch, f"l{batch}") for k in range(batch, 12, 2)])
        right = frame(
            spark, [(k, batch, float(batch)) for k in range(0, 12, batch + 1)], "k bigint, o bigint, w double"
        )
        append_log(left, root, "both", "left", batch)
        append_log(right, root, "both", "right", batch)
    before = rows_of(snapshot(spark, root, BOTH).select("k", "o", "v", "w"))
    then = rows_of(snapshot(spark, root, BOTH, upto=3).select("k", "o", "v", "w"))
    compact(spark, root, BOTH, 1, buckets)
    compact(spark, root, BOTH, 3, buckets)
    compact(spark, root, BOTH, 3, buckets)
    assert base_version(spark, root, "both") == 3
    assert rows_of(snapshot(spark, root, BOTH).select("k", "o", "v", "w")) == before
    assert rows_of(snapshot(spark, root, BOTH, upto=3).select("k", "o", "v", "w")) == then
    compact(spark, root, BOTH, 5, buckets)
    assert rows_of(snapshot(spark, root, BOTH).select("k", "o", "v", "w")) == before


@pytest.mark.parametrize("buckets", [None, 2])
def test_compaction_that_was_cut_off_is_done_again(spark, root, buckets):
    append_log(frame(spark, [(1, 1, "a")]), root, "out", "one", 0)
    frame(spark, [(9, 9, "half")]).write.parquet(f"{root}/base/out/upto=0")
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/base/out/upto=0/_SUCCESS")
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).delete(mark, False)
    assert rows_of(snapshot(spark, root, OUT)) == [(1, 1, "a")]
    compact(spark, root, OUT, 0, buckets)
    assert base_version(spark, root, "out") == 0
    assert rows_of(snapshot(spark, root, OUT)) == [(1, 1, "a")]


def test_bucketed_base_is_not_shuffled(spark, root):
    for batch in range(2):
        append_log(frame(spark, [(k, batch, "v") for k in range(50)]), root, "out", "one", batch)
    compact(spark, root, OUT, 0, buckets=4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(snapshot(spark, root, OUT))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert text.count("Exchange") == 1  # the batch after the base
    assert "Bucketed: true" in text


def test_snapshot_has_one_key_exchange_after_a_partial_aggregate(spark, root):
    for batch in range(3):
        append_log(frame(spark, [(k, batch, "v") for k in range(50)]), root, "out", "one", batch)
    text = plan(snapshot(spark, root, OUT))
    assert text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("partial_max_by")
    assert "Python" not in text


writes = st.lists(
    st.tuples(
        st.integers(0, 3),  # batch
        st.integers(0, 1),  # stream
        st.integers(0, 4),  # key
        st.integers(0, 1000),  # order
        st.one_of(st.none(), st.integers(0, 9)),  # value
    ),
    min_size=1,
    max_size=30,
    unique_by=lambda w: (w[0], w[1], w[3]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(writes)
def test_any_sequence_of_writes_equals_a_dictionary(spark, sequence):
    expected = {}
    for _, stream, key, order, value in sorted(sequence, key=lambda w: (w[0], w[1], w[3])):
        row = expected.setdefault(key, {"o": None, "a": None, "b": None})
        row["o"] = order
        row["ab"[stream]] = value
    layers = []
    for stream, column in enumerate("ab"):
        rows = [(k, o, v, b) for b, s, k, o, v in sequence if s == stream]
        if rows:
            data = frame(spark, rows, f"k bigint, o bigint, {column} bigint, batch_id bigint")
            layers.append(Layer(data, "batch_id", stream, ("o",)))
    found = {r.k: r.asDict() for r in latest_rows(layers, ["k"]).collect()}
    assert found.keys() == expected.keys()
    for key, row in expected.items():
        assert {c: found[key].get(c) for c in row} == row


def test_merge_reaches_the_catalog(spark):
    """The built-in catalog's tables cannot merge; that is what is refused, not the statement."""
    spark.sql("CREATE TABLE IF NOT EXISTS merged (k bigint, v string) USING parquet")
    with pytest.raises(PySparkException) as refused:
        merge_into(frame(spark, [(1, "a")], "k bigint, v string"), "merged", ["k"], ["v"])
    assert "MERGE" in str(refused.value) and "PARSE" not in str(refused.value)
    spark.sql("DROP TABLE merged")
