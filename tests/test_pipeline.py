from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import rows_of, topic_frame
from millrace import (
    ReplaySource,
    Sizing,
    StreamDef,
    TopicContract,
    TopicPipeline,
    committed_batch,
    settings_from,
    start_configured,
    stream_topics,
    write_topic_files,
)
from millrace.operators import deadletter as dead
from millrace.operators.conform import REASON, TypedBatch
from millrace.plans.statements import used_fields
from workload.fixtures import event_contracts, event_rows, registry_snapshot
from workload.flows import CLICKS, HOLED, PROFILE_A, PROFILE_B, VIEWS, _slices

FAILING = StreamDef(
    "failing", "error", "never", "user_id", "user_id, 1 div (event_id - event_id) AS z", order_by="z"
)


def pipeline(spark, root, streams, **options):
    topics = dict.fromkeys(s.topic for s in streams)
    return TopicPipeline(spark, streams, event_contracts(spark, *topics), root, **options)


def batch_answer(spark, sf_dir, root, streams=(CLICKS,)):
    work = pipeline(spark, root + "-batch", list(streams))
    work.process(event_rows(spark, sf_dir), 0)
    return work


@pytest.mark.parametrize("files", [1, 3, 7])
def test_stream_of_any_number_of_files_equals_the_batch(spark, sf_dir, root, files):
    expected = rows_of(batch_answer(spark, sf_dir, root).table("user_clicks"))
    work = pipeline(spark, f"{root}/out", [CLICKS])
    rows = event_rows(spark, sf_dir).filter("topic = 'click'")
    for part in _slices(spark, rows, files):
        write_topic_files(part.coalesce(1), f"{root}/in")
    source = stream_topics(spark, ReplaySource(f"{root}/in", ("click",), max_files_per_batch=1))
    query = work.start(source, f"{root}/checkpoint")
    query.awaitTermination()
    assert committed_batch(spark, f"{root}/checkpoint") == files - 1
    assert rows_of(work.table("user_clicks")) == expected


def test_batch_repeated_after_a_crash(spark, sf_dir, root):
    """The checkpoint of a batch that was stored is lost: it runs again to the same end."""
    work = pipeline(spark, f"{root}/out", [CLICKS, HOLED])
    write_topic_files(event_rows(spark, sf_dir), f"{root}/in")

    def run():
        source = stream_topics(spark, ReplaySource(f"{root}/in", ("click", "signup")))
        work.start(source, f"{root}/checkpoint").awaitTermination()

    run()
    once = rows_of(work.table("user_clicks")), rows_of(dead.read_rows(spark, f"{root}/out", "holed"))
    commit = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/checkpoint/commits/0")
    commit.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commit, False)
    run()
    again = rows_of(work.table("user_clicks")), rows_of(dead.read_rows(spark, f"{root}/out", "holed"))
    assert again == once
    assert committed_batch(spark, f"{root}/checkpoint") == 0


def test_new_checkpoint_may_not_replace_stored_batches(spark, sf_dir, root):
    work = pipeline(spark, f"{root}/out", [CLICKS])
    rows = event_rows(spark, sf_dir)
    write_topic_files(rows, f"{root}/in")
    source = stream_topics(spark, ReplaySource(f"{root}/in", ("click",)))
    for batch in range(2):
        work.process(rows, batch)
        with pytest.raises(ValueError, match=f"set first_batch_id to {batch + 1}"):
            work.start(source, f"{root}/checkpoint")
    later = pipeline(spark, f"{root}/out", [CLICKS], first_batch_id=2)
    later.start(source, f"{root}/checkpoint").awaitTermination()
    assert later.table("user_clicks", upto=1).count() == later.table("user_clicks").count()


@pytest.mark.parametrize("options", [{}, {"concurrency": 3}, {"cache": False}])
def test_failing_stream_leaves_the_others_alone(spark, sf_dir, root, options):
    rows = event_rows(spark, sf_dir)
    work = pipeline(spark, root, [CLICKS, FAILING, VIEWS], ansi=True, **options)
    report = work.process(rows, 0)
    by_name = {r.stream: r for r in report.streams}
    assert "DIVIDE_BY_ZERO" in by_name["failing"].error
    assert by_name["views"].stored == rows.filter("topic = 'view'").count()
    lost = dead.read_failed(spark, root, "failing")
    assert lost.count() == rows.filter("topic = 'error'").count()
    assert {r[0] for r in lost.select(REASON).distinct().collect()} == {dead.TRANSFORM_FAILED}
    assert dead.read_rows(spark, root, "failing") is None
    expected = batch_answer(spark, sf_dir, root).table("user_clicks")
    assert rows_of(work.table("user_clicks")) == rows_of(expected)


def test_lenient_mode_gives_null_and_restores_the_session(spark, sf_dir, root):
    before = spark.conf.get("spark.sql.ansi.enabled")
    work = pipeline(spark, root, [FAILING])
    report = work.process(event_rows(spark, sf_dir), 0)
    assert report.streams[0].error is None and report.streams[0].stored > 0
    assert spark.conf.get("spark.sql.ansi.enabled") == before


def test_store_failure_keeps_the_result_rows(spark, sf_dir, root, monkeypatch):
    from pyspark.errors import PySparkException

    def broken(*_):
        raise PySparkException("disk full")

    monkeypatch.setattr("millrace.streaming.pipeline.append_log", broken)
    report = pipeline(spark, root, [CLICKS]).process(event_rows(spark, sf_dir), 4)
    assert "disk full" in report.streams[0].error
    kept = dead.read_rows(spark, root, "clicks")
    assert {(r.batch_id, r[REASON]) for r in kept.select("batch_id", REASON).distinct().collect()} == {
        (4, dead.STORE_FAILED)
    }
    assert kept.count() == event_rows(spark, sf_dir).filter(
        "topic = 'click' AND CAST(get_json_object(CAST(value AS string), '$.value') AS double) > 1"
    ).count()


def test_every_row_is_stored_filtered_or_dead(spark, sf_dir, root):
    rows = event_rows(spark, sf_dir)
    value = (
        F.when(F.col("offset") % 5 == 0, F.lit(b"oops"))
        .when(F.col("offset") % 5 == 1, F.lit(None))
        .otherwise(F.col("value"))
    )
    work = pipeline(spark, root, [HOLED])
    report = work.process(rows.withColumn("value", value), 0)
    (stream,) = report.streams
    logged = spark.read.parquet(f"{root}/log/user_signups/stream=holed").filter("user_id IS NOT NULL").count()
    raw, rejected = dead.read_raw(spark, root), dead.read_rows(spark, root, "holed")
    sound = rows.filter("topic = 'signup' AND offset % 5 > 1")
    low = "CAST(get_json_object(CAST(value AS string), '$.value') AS double) <= 5"
    assert stream.stored == logged and stream.null_key == rejected.count() > 0
    assert report.untyped["signup"] == raw.count()
    total = rows.filter("topic = 'signup'").count()
    assert logged + rejected.count() + raw.count() + sound.filter(low).count() == total
    assert {r[0] for r in raw.select(REASON).distinct().collect()} == {"bad_payload", "null_value"}


def test_topics_without_rows_have_empty_views(spark, root):
    struct = event_contracts(spark, "click")["click"].struct
    contracts = {t: TopicContract(t, struct) for t in ("a", "b")}
    both = StreamDef(
        "both", "a", "out", "event_id", order_by="event_id",
        sql="SELECT event_id FROM TMP_A UNION ALL SELECT event_id FROM TMP_B",
    )
    other = StreamDef("other", "b", "out2", "event_id", "event_id", order_by="event_id")
    work = TopicPipeline(spark, [both, other], contracts, root)
    work.process(topic_frame(spark, [("a", 0, {"event_id": 1}), ("b", 1, {"event_id": 2})]), 0)
    report = work.process(topic_frame(spark, [("a", 2, {"event_id": 3})]), 1)
    # the second batch must not see the first batch's rows of topic b
    assert [s.stored for s in report.streams] == [1, 0]
    assert report.records == {"a": 1}
    assert rows_of(work.table("out")) == [(1,), (2,), (3,)]


def test_two_streams_of_one_topic(spark, sf_dir, root):
    again = StreamDef("again", "click", "other", "event_id", "event_id", order_by="event_id")
    work = pipeline(spark, root, [CLICKS, again])
    work.process(event_rows(spark, sf_dir), 0)
    assert work.table("other").count() > work.table("user_clicks").count()


def test_partial_columns_across_batches(spark, root):
    work = pipeline(spark, root, [PROFILE_A, PROFILE_B])

    def event(topic, offset, user, value):
        return (topic, offset, {"event_id": offset, "user_id": user, "value": value})

    work.process(topic_frame(spark, [event("click", 0, 1, 1.5), event("view", 1, 1, 2.5)]), 0)
    work.process(topic_frame(spark, [event("click", 2, 1, 9.5), event("click", 3, 2, 4.0)]), 1)
    found = rows_of(work.table("user_profile").select("user_id", "last_click", "last_view"))
    assert found == [(1, 9.5, 2.5), (2, 4.0, None)]


def test_default_order_is_by_offset(spark, root):
    stream = StreamDef("s", "click", "out", "user_id", "user_id, value, _offset")
    work = pipeline(spark, root, [stream])
    values = ((8, 0.5), (9, 0.25), (7, 1.0))
    rows = topic_frame(
        spark, [("click", o, {"event_id": 0, "user_id": 1, "value": v}) for o, v in values]
    )
    work.process(rows, 0)
    assert rows_of(work.table("out")) == [(1, 0.25, 9)]


def test_reserved_names_are_refused(spark, root):
    taken = StreamDef(
        "s", "click", "out", "user_id", "user_id, event_id AS batch_id, event_id", order_by="event_id"
    )
    with pytest.raises(ValueError, match="reserved"):
        pipeline(spark, root, [taken])


@pytest.mark.parametrize(
    ("count", "target"), [(0, None), (400, None), (403, None), (404, 4), (999, 9), (1000, 10)]
)
def test_sizing_rule(spark, count, target):
    rule = Sizing(max_records=100, partitions=4)
    assert rule.target(count) == target
    column = rule.target_column(F.lit(count)).alias("n")
    assert spark.range(1).select(column).first().n == target


def test_sizing_splits_the_batch(spark, sf_dir, root):
    rows = event_rows(spark, sf_dir).coalesce(1)
    count = rows.count()
    assert Sizing(100, 1).apply(rows, count).rdd.getNumPartitions() == count // 100
    assert Sizing(count, 1).apply(rows, count) is rows
    work = pipeline(spark, root, [CLICKS], sizing=Sizing(100, 1))
    work.process(rows, 0)
    expected = batch_answer(spark, sf_dir, root).table("user_clicks")
    assert rows_of(work.table("user_clicks")) == rows_of(expected)


def test_sizing_is_validated():
    with pytest.raises(ValueError, match="at least 1"):
        Sizing(10, 0)


def test_statement_without_rows_stores_an_empty_batch(spark, sf_dir, root):
    never = StreamDef("never", "click", "out", "user_id", "user_id, event_id", "1=0", order_by="event_id")
    report = pipeline(spark, root, [never]).process(event_rows(spark, sf_dir), 0)
    assert (report.streams[0].stored, report.streams[0].null_key) == (0, 0)


def test_limited_and_self_joined_statements_are_counted_right(spark, sf_dir, root):
    few = StreamDef(
        "few", "click", "few", "event_id", "event_id", "1=1 ORDER BY event_id LIMIT 7",
        order_by="event_id",
    )
    twice = StreamDef(
        "twice", "click", "twice", "event_id", order_by="event_id",
        sql="SELECT event_id FROM TMP_CLICK UNION ALL SELECT event_id + 1000000 FROM TMP_CLICK",
    )
    rows = event_rows(spark, sf_dir)
    report = pipeline(spark, root, [few, twice]).process(rows, 0)
    clicks = rows.filter("topic = 'click'").count()
    assert [s.stored for s in report.streams] == [7, 2 * clicks]


def test_configured_query_on_a_processing_time_trigger(spark, sf_dir, root):
    write_topic_files(event_rows(spark, sf_dir), f"{root}/in")
    entry = {"srcTopic": "click", "destTable": "user_clicks", "transform": CLICKS.transform,
             "filter": CLICKS.filter, "key": "user_id", "order_by": "event_id"}
    limits = {"maxRecordCount": 100, "count": 1}
    settings = settings_from(
        {"app": {"spark": {"batchDur": 1, "partition": limits}, "logdir": root, "streams": [entry]}}
    )
    work, query = start_configured(
        spark, settings, registry_snapshot(spark), f"{root}/checkpoint",
        source=ReplaySource(f"{root}/in", ("click",)), codec="json", framed=False,
    )
    query.processAllAvailable()
    query.stop()
    expected = batch_answer(spark, sf_dir, root).table("user_clicks")
    assert rows_of(work.table("user_clicks")) == rows_of(expected)
    assert committed_batch(spark, f"{root}/nosuch") is None


def test_a_retry_takes_back_what_the_first_attempt_set_aside(spark, sf_dir, root, monkeypatch):
    from pyspark.errors import PySparkException

    rows = event_rows(spark, sf_dir)
    broken = rows.withColumn("value", F.when(F.col("offset") % 2 == 0, F.col("value")))

    def fails(*_):
        raise PySparkException("network")

    work = pipeline(spark, root, [CLICKS, HOLED])
    with monkeypatch.context() as patch:
        patch.setattr("millrace.streaming.pipeline.append_log", fails)
        work.process(broken, 0)
    work.process(rows, 1)
    assert dead.read_raw(spark, root).count() > 0
    assert dead.read_rows(spark, root, "clicks").count() > 0
    work.process(rows, 0)
    assert dead.read_raw(spark, root) is None
    assert dead.read_rows(spark, root, "clicks") is None
    assert {r.batch_id for r in dead.read_rows(spark, root, "holed").collect()} == {0, 1}


def test_sizing_reads_the_source_once(spark, sf_dir, root):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = event_rows(spark, sf_dir).filter("topic = 'click'")
    total = rows.count()
    work = pipeline(spark, root, [CLICKS], sizing=Sizing(10, 1))
    work.process(rows.mapInArrow(seen, rows.schema), 0)
    assert read.value == total


def test_changed_type_is_refused_at_start(spark, sf_dir, root):
    pipeline(spark, root, [CLICKS]).process(event_rows(spark, sf_dir), 0)
    other = StreamDef(
        "clicks", "click", "user_clicks", "user_id", "user_id, CAST(value AS string) AS value, event_id",
        order_by="event_id",
    )
    with pytest.raises(ValueError, match="column value is stored as double"):
        pipeline(spark, root, [other])


def test_repeated_batch_with_other_columns_replaces_the_first(spark, sf_dir, root):
    rows = event_rows(spark, sf_dir)
    pipeline(spark, root, [CLICKS]).process(rows, 0)
    other = StreamDef("clicks", "click", "user_clicks", "user_id", "user_id, event_id", order_by="event_id")
    work = pipeline(spark, root, [other])
    work.process(rows, 0)
    assert sorted(work.table("user_clicks").columns) == ["event_id", "user_id"]


def test_dead_letters_of_two_definitions_are_read_together(spark, sf_dir, root):
    rows = event_rows(spark, sf_dir)
    pipeline(spark, root, [HOLED]).process(rows, 0)
    other = StreamDef(
        "holed", "signup", "user_signups", "user_id",
        "CAST(NULL AS bigint) AS user_id, event_id, event_type", order_by="event_id",
    )
    pipeline(spark, root, [other]).process(rows, 1)
    assert {"value", "event_type"} <= set(dead.read_rows(spark, root, "holed").columns)


def test_files_follow_the_bytes(spark, sf_dir, root):
    work = pipeline(spark, root, [CLICKS])
    work.process(event_rows(spark, sf_dir).repartition(50), 0)
    assert len(work.table("user_clicks").inputFiles()) == 1


def test_root_that_is_a_pattern_is_refused(spark):
    with pytest.raises(ValueError, match="must not have"):
        pipeline(spark, "/tmp/ro[1]ot", [CLICKS])


def test_expired_batches_are_gone_and_the_table_is_not(spark, sf_dir, root):
    work = pipeline(spark, root, [CLICKS])
    rows = event_rows(spark, sf_dir).filter("topic = 'click'")
    for batch_id, part in enumerate(_slices(spark, rows, 4)):
        work.process(part, batch_id)
    expected = rows_of(work.table("user_clicks"))
    work.compact("user_clicks", 1, buckets=2)
    work.compact("user_clicks", 2, buckets=2)
    read = work.table("user_clicks").inputFiles()
    assert not [f for f in read if "batch_id=0" in f or "batch_id=1" in f or "batch_id=2" in f]
    work.expire("user_clicks", 3)
    assert rows_of(work.table("user_clicks")) == expected
    stored = list(Path(root).glob("log/*/*/*/batch_id=*")) + list(Path(root).glob("base/*/upto=*"))
    assert sorted(p.name for p in stored) == ["batch_id=3", "upto=2"]


def test_fields_that_no_statement_uses_are_not_parsed(spark, sf_dir, root):
    rows = event_rows(spark, sf_dir).filter("topic = 'click'")
    odd = F.concat(F.expr("substring(value, 1, length(value) - 1)"), F.lit(b', "props": {"a": 1}}'))
    wide = StreamDef("w", "click", "user_clicks", "user_id", "user_id, event_id", "value > 1", order_by="event_id")
    work = pipeline(spark, root, [wide])
    assert work.used == {"click": {"user_id", "event_id", "value"}}
    typed = TypedBatch(rows, work.contracts.values(), used=work.used)
    assert typed.frame.schema["_record0"].dataType.fieldNames() == ["event_id", "user_id", "value", "_unparsed"]
    assert typed.typed("click").schema == TypedBatch(rows, work.contracts.values()).typed("click").schema
    expected = rows_of(batch_answer(spark, sf_dir, root, [wide]).table("user_clicks"))
    assert work.process(rows.withColumn("value", odd), 0).untyped == {}
    assert rows_of(work.table("user_clicks")) == expected


@pytest.mark.parametrize(
    ("sql", "used"),
    [
        ("SELECT * FROM TMP_CLICK", {"event_id", "user_id", "value", "ts", "event_type", "props"}),
        ("SELECT user_id, 1 AS o FROM (SELECT user_id, value + 1 AS v FROM TMP_CLICK)", {"user_id"}),
        ("SELECT user_id, 1 AS o FROM TMP_CLICK WHERE event_id IN (SELECT max(value) FROM TMP_CLICK)",
         {"user_id", "event_id", "value"}),
        ("SELECT user_id, (SELECT max(ts) FROM TMP_CLICK) AS o FROM TMP_CLICK WHERE 1=1", {"user_id", "ts"}),
        ("SELECT 1L AS user_id, count(*) AS o FROM TMP_CLICK", set()),
        ("SELECT a.user_id, b.value AS o FROM TMP_CLICK a JOIN TMP_CLICK b ON a.event_id = b.event_id",
         {"user_id", "event_id", "value"}),
    ],
)
def test_used_fields(spark, sql, used):
    first = "o" if " AS o" in sql else "event_id"
    stream = StreamDef("s", "click", "t", "user_id", sql=sql, order_by=first)
    assert used_fields(spark, [stream], event_contracts(spark, "click")) == {"click": used}
