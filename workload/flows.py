"""The operators themselves, run over the whole test tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import (
    ReplaySource,
    ReplicaDef,
    Sizing,
    StreamDef,
    TopicContract,
    TopicPipeline,
    TypedBatch,
    conform,
    produce,
    read_topics,
    replicate,
    start_replica,
    stream_topics,
    upsert_rows,
    write_topic_files,
)
from millrace.functions import codec
from millrace.operators import deadletter as dead
from millrace.operators.conform import RAW, REASON, topic_rows_of
from millrace.operators.multisets import except_all, intersect_all
from millrace.operators.notin import not_in
from millrace.operators.rangejoin import overlap_join
from millrace.operators.sizing import counts_by_topic
from millrace.operators.upsert import Layer, latest_rows, log_dir
from millrace.operators.windows import Call, Frame, blocked_windows
from millrace.plans.statements import register_view, statement
from millrace.sources.paths import scratch
from millrace.sources.registry import SNAPSHOT, contracts, matching_ids, struct_of
from millrace.sources.zones import index_topic_files
from millrace.streaming.inspection import decoded
from workload.fixtures import (
    EVENT_SCHEMA_IDS,
    event_contracts,
    event_rows,
    registry_snapshot,
    spliced,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
FLOWS: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def flow(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        FLOWS[query.__name__] = query
        if oracle is not None:
            ORACLES[query.__name__] = oracle
        return query

    return register


def _latest(topic: str, columns: str, where: str = "true") -> str:
    return f"""SELECT {columns} FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events
        WHERE event_type = '{topic}' AND {where}) WHERE rn = 1"""


CLICKS = StreamDef(
    "clicks", "click", "user_clicks", "user_id", "user_id, value, event_id", "value > 1",
    order_by="event_id",
)
VIEWS = StreamDef(
    "views", "view", "user_views", "user_id", "user_id, value, event_id", order_by="event_id"
)
PROFILE_A = StreamDef(
    "profile_a", "click", "user_profile", "user_id",
    "user_id, value AS last_click, event_id", order_by="event_id",
)
PROFILE_B = StreamDef(
    "profile_b", "view", "user_profile", "user_id",
    "user_id, value AS last_view, event_id", order_by="event_id",
)
SPEND = StreamDef(
    "grouped", "purchase", "user_spend", "user_id",
    "user_id, count(*) AS n, max(event_id) AS event_id", "value > 0 GROUP BY user_id",
    order_by="event_id",
)
# every seventh user's key is made null, which the table cannot take
HOLED = StreamDef(
    "holed", "signup", "user_signups", "user_id",
    "CASE WHEN user_id % 7 <> 0 THEN user_id END AS user_id, event_id, value", "value > 5",
    order_by="event_id",
)


# -- sources, routing, typing -------------------------------------------------


@flow(
    "SELECT event_id, CAST(user_id AS varchar) AS msg_key, CAST(user_id % 4 AS int) AS part,"
    " ts AS sent FROM events WHERE event_type = 'click'"
)
def topic_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topic_rows_of(event_rows(spark, sf_dir), "click")
    return rows.select(
        F.col("offset").alias("event_id"),
        F.col("key").cast("string").alias("msg_key"),
        F.col("partition").alias("part"),
        F.col("timestamp").cast("timestamp_ntz").alias("sent"),
    )


@flow(
    "SELECT event_id, user_id, ts, value, CAST(NULL AS varchar) AS region FROM events"
    " WHERE event_type = 'click'"
)
def topic_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the schema lacks two of the payload's fields and has one of its own
    struct = T.StructType.fromDDL(
        "event_id bigint, user_id bigint, ts timestamp_ntz, value double, region string"
    )
    batch = TypedBatch(event_rows(spark, sf_dir), [TopicContract("click", struct)])
    return batch.typed("click")


@flow(
    """SELECT o_orderkey, CAST(CAST(o_custkey AS DECIMAL(12,2)) AS varchar) AS o_custkey,
    o_totalprice AS o_totalprice, CAST(NULL AS int) AS channel FROM orders"""
)
def conform_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    struct = T.StructType.fromDDL(
        "o_orderkey bigint, o_custkey decimal(12,2), o_totalprice double, channel int"
    )
    typed = conform(table(spark, sf_dir, "orders"), struct)
    return typed.withColumn("o_custkey", F.col("o_custkey").cast("string"))


@flow(
    """SELECT event_id, event_type AS topic, CAST(CASE WHEN user_id % 10 = 0 THEN NULL ELSE
    CASE event_type WHEN 'click' THEN 102 WHEN 'error' THEN 202 WHEN 'purchase' THEN 302
    WHEN 'signup' THEN 402 ELSE 502 END END AS bigint) AS schema_id,
    CASE WHEN user_id % 10 <> 0 THEN event_id END AS body_id FROM events"""
)
def envelope_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _framed_rows(spark, sf_dir)
    sound = codec.is_framed("value")
    body = codec.from_json_bytes(codec.frame_body("value"), T.StructType.fromDDL("event_id bigint"))
    return rows.select(
        F.col("offset").alias("event_id"),
        "topic",
        F.when(sound, codec.frame_id("value")).alias("schema_id"),
        F.when(sound, body.getField("event_id")).alias("body_id"),
    )


def _framed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events framed by their topic's latest schema id; every tenth user's magic byte is wrong."""
    rows = event_rows(spark, sf_dir)
    framed = F.lit(None).cast("binary")
    for topic, (_, latest) in EVENT_SCHEMA_IDS.items():
        framed = F.when(F.col("topic") == topic, codec.frame(F.col("value"), latest)).otherwise(framed)
    wrong = F.concat(F.lit(b"\x01"), F.substring(framed, 2, 2**31 - 1))
    user = F.col("key").cast("string").cast("bigint")
    return rows.withColumn("value", F.when(user % 10 == 0, wrong).otherwise(framed))


@flow(
    """SELECT event_id, user_id, value,
    CASE WHEN event_id % 3 = 1 THEN props END AS props,
    CASE WHEN event_id % 3 = 1 THEN event_type END AS event_type
    FROM events WHERE event_type = 'click' AND event_id % 3 <> 2"""
)
def registry_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written by an old, a new and an unknown schema version, read by the latest."""
    turn, (old, new) = F.col("event_id") % 3, EVENT_SCHEMA_IDS["click"]
    slim = codec.to_json_bytes(F.struct("event_id", "user_id", "value"))
    full = codec.to_json_bytes(F.struct(*table(spark, sf_dir, "events").columns))
    value = (
        F.when(turn == 0, codec.frame(slim, old))
        .when(turn == 1, codec.frame(full, new))
        .otherwise(codec.frame(full, 999))
    )
    rows = event_rows(spark, sf_dir, value=value)
    batch = TypedBatch(rows, event_contracts(spark, "click", framed=True).values())
    return batch.typed("click").drop("ts")


def _schema(*fields: tuple, **more) -> str:
    listed = [{"name": n, "type": t, **o} for n, t, o in fields]
    return json.dumps({"type": "record", "name": "event", "fields": listed} | more)


_KINDS = {"type": "enum", "name": "kind", "symbols": ["click", "error", "purchase", "signup", "view"]}
_FEWER_KINDS = {"type": "enum", "name": "what", "aliases": ["kind"], "symbols": ["other", "click", "view"], "default": "other"}
_SPOT = {"type": "record", "name": "spot", "fields": [{"name": "area", "type": "int"}, {"name": "zone", "type": "string", "default": "z"}]}
#: The first writer has narrow numbers and old names, the second more fields; the latest reads both.
_FIRST = _schema(("id", "int", {}), ("uid", "long", {}), ("amount", "float", {}), ("kind", _KINDS, {}), ("note", ["null", "string"], {}))
_SECOND = _schema(
    ("id", "long", {}),
    ("user", "long", {}),
    ("amount", "double", {}),
    ("kind", _KINDS, {}),
    ("note", ["null", "string"], {}),
    ("tags", {"type": "array", "items": "int"}, {}),
    ("spot", {"type": "record", "name": "spot", "fields": [{"name": "area", "type": "int"}]}, {}),
)
_LATEST = _schema(
    ("event_id", "long", {"aliases": ["id"]}),
    ("user_id", "long", {"aliases": ["user", "uid"]}),
    ("amount", "double", {}),
    ("kind", _FEWER_KINDS, {}),
    ("note", "string", {}),
    ("tags", {"type": "array", "items": "long"}, {"default": [1, 2]}),
    ("spot", _SPOT, {"default": {"area": -1}}),
    ("region", ["string", "null"], {"default": "none"}),
)


@flow(
    """SELECT event_id, user_id, CASE WHEN event_id % 2 = 0 THEN CAST(CAST(value AS FLOAT) AS DOUBLE) ELSE value END AS amount,
    CASE WHEN event_type IN ('click', 'view') THEN event_type ELSE 'other' END AS kind, event_type AS note,
    CASE WHEN event_id % 2 = 0 THEN 3 ELSE user_id + event_id END AS tag_sum,
    CASE WHEN event_id % 2 = 0 THEN -1 ELSE user_id % 5 END AS area, 'z' AS zone, 'none' AS region, NULL AS reason
    FROM events WHERE event_id % 7 <> 0
    UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'bad_payload' FROM events WHERE event_id % 7 = 0"""
)
def registry_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two writers read by a third schema; a null where it has none makes a reject."""
    area = (F.col("user_id") % 5).cast("int").alias("area")
    note = F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("note")
    common = [F.col("event_type").alias("kind"), note]
    first = F.struct(F.col("event_id").alias("id"), F.col("user_id").alias("uid"), F.col("value").cast("float").alias("amount"), *common)
    second = F.struct(
        F.col("event_id").alias("id"), F.col("user_id").alias("user"), F.col("value").alias("amount"), *common,
        F.array("user_id", "event_id").alias("tags"), F.struct(area).alias("spot"),
    )
    value = F.when(F.col("event_id") % 2 == 0, codec.frame(codec.to_json_bytes(first), 1)).otherwise(
        codec.frame(codec.to_json_bytes(second), 2)
    )
    rows = event_rows(spark, sf_dir, topic=F.lit("changing"), value=value)
    entries = [("changing-value", n, n, text) for n, text in enumerate((_FIRST, _SECOND, _LATEST), start=1)]
    snapshot = spark.createDataFrame(entries, SNAPSHOT)
    batch = TypedBatch(rows, contracts(snapshot, ["changing"], framed=True, resolve=True).values())
    none = F.lit(None).cast("string")
    good = batch.typed("changing").select(
        "event_id", "user_id", "amount", "kind", "note", F.aggregate("tags", F.lit(0).cast("bigint"), lambda t, x: t + x).alias("tag_sum"),
        F.col("spot.area").cast("bigint").alias("area"), F.col("spot.zone").alias("zone"), "region", none.alias("reason"),
    )
    bad = batch.rejects().select(
        F.col("offset").alias("event_id"), *[F.lit(None).cast(t).alias(n) for n, t in good.dtypes[1:-1]], F.col(REASON).alias("reason")
    )
    return good.union(bad)


@flow(
    """SELECT event_type AS topic, CASE WHEN user_id % 10 = 0 THEN 'bad_envelope'
    WHEN event_id % 11 = 0 THEN 'unknown_schema' WHEN event_id % 13 = 0 THEN 'bad_payload'
    WHEN event_id % 19 IN (1, 2, 3, 4) THEN 'bad_payload'
    WHEN event_id % 17 = 0 THEN 'null_value' ELSE 'typed' END AS outcome, count(*) AS n
    FROM events GROUP BY ALL"""
)
def conform_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _framed_rows(spark, sf_dir)
    offset, user = F.col("offset"), F.col("key").cast("string").cast("bigint")
    sound = user % 10 != 0
    value = (
        F.when(~sound, F.col("value"))
        .when(offset % 11 == 0, codec.frame(F.lit(b"{}"), 999))
        .when(
            offset % 13 == 0,
            F.concat(F.substring(F.col("value"), 1, codec.FRAME_BYTES), F.lit(b"oops")),
        )
        .when(offset % 19 == 1, F.concat("value", codec.frame_body("value")))
        .when(offset % 19 == 2, F.concat("value", F.lit(b"oops")))
        .when(offset % 19 == 3, F.concat("value", F.lit(b"]")))
        .when(offset % 19 == 4, F.concat("value", F.lit(b","), codec.frame_body("value")))
        .when(offset % 17 == 0, F.lit(None))
        .otherwise(F.col("value"))
    )
    batch = TypedBatch(
        rows.withColumn("value", value), event_contracts(spark, framed=True).values()
    )
    return batch.frame.groupBy("topic", F.coalesce(REASON, F.lit("typed")).alias("outcome")).agg(
        F.count("*").alias("n")
    )


@flow(
    "SELECT event_id, user_id, value, ts, event_type, props FROM events WHERE event_type = 'view'"
)
def topic_inspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = event_contracts(spark, "view")["view"]
    return decoded(event_rows(spark, sf_dir), contract).drop(REASON)


@flow(
    "SELECT event_id, user_id FROM events WHERE event_type = 'click' AND user_id % 2 = 0"
)
def topic_view_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic name with a dot and a dash becomes a view all the same."""
    topic = "my.topic-1"
    rows = event_rows(spark, sf_dir).filter("topic = 'click'").withColumn("topic", F.lit(topic))
    struct = T.StructType.fromDDL("event_id bigint, user_id bigint")
    register_view(TypedBatch(rows, [TopicContract(topic, struct)]).typed(topic), topic)
    stream = StreamDef("s", topic, "t", "user_id", "event_id, user_id", "user_id % 2 = 0")
    return spark.sql(statement(stream))


@flow(
    """SELECT event_id, user_id, value FROM events WHERE event_type IN ('click', 'view')"""
)
def source_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic files written by topic and read back for two topics only."""
    home = scratch(spark)
    write_topic_files(event_rows(spark, sf_dir), home)
    rows = read_topics(spark, ReplaySource(home, ("click", "view")))
    batch = TypedBatch(rows, event_contracts(spark, "click", "view").values())
    columns = ["event_id", "user_id", "value"]
    return batch.typed("click").select(*columns).union(batch.typed("view").select(*columns))


_FROM = datetime(2024, 1, 12, 6, 30, tzinfo=timezone.utc)


@flow(
    """SELECT event_id, event_type AS topic FROM events WHERE event_type IN ('click', 'error')
        AND NOT (event_type = 'click' AND (user_id % 4 = 0 AND event_id < 300 OR user_id % 4 = 1 AND event_id < 700))
    UNION ALL SELECT event_id, event_type FROM (SELECT *, min(event_id) FILTER (WHERE ts >= TIMESTAMP '2024-01-12 06:30:00')
        OVER (PARTITION BY user_id % 4) AS first_id FROM events WHERE event_type = 'view') WHERE event_id >= first_id"""
)
def source_start_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some topics from offsets on, one from a time; the map of the files leaves out those before."""
    home = scratch(spark)
    for part in _slices(spark, event_rows(spark, sf_dir), 4):
        write_topic_files(part, home)
        index_topic_files(spark, home)
    by_offset = ReplaySource(home, ("click", "error"), start={"click": {0: 300, 1: 700}})
    by_time = ReplaySource(home, ("view",), start=_FROM)
    found = read_topics(spark, by_offset).union(read_topics(spark, by_time))
    return found.select(F.col("offset").alias("event_id"), "topic")


@flow(
    """SELECT source, count(*) AS n, CAST(sum(event_id) AS bigint) AS ids, max(ts) AS last_ts
    FROM events, (VALUES ('csv'), ('json'), ('orc'), ('parquet')) AS v(source) GROUP BY source"""
)
def source_file_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files named inside a statement, in every built-in format."""
    home, events = scratch(spark), table(spark, sf_dir, "events")
    stamps = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    plain = events.withColumn("ts", F.date_format("ts", stamps))
    plain.write.option("header", True).csv(f"{home}/csv")
    plain.write.json(f"{home}/json")
    events.write.orc(f"{home}/orc")
    branches = [
        f"""SELECT '{kind}' AS source, count(*) AS n, CAST(sum(CAST({ident} AS bigint)) AS bigint) AS ids,
        max(CAST({ts} AS timestamp_ntz)) AS last_ts FROM {kind}.`{path}` {where}"""
        for kind, path, ident, ts, where in (
            ("csv", f"{home}/csv", "_c0", "_c1", "WHERE _c0 <> 'event_id'"),
            ("json", f"{home}/json", "event_id", "ts", ""),
            ("orc", f"{home}/orc", "event_id", "ts", ""),
            ("parquet", f"{sf_dir}/events.parquet", "event_id", "ts", ""),
        )
    ]
    return spark.sql(" UNION ALL ".join(branches))


# -- sizes --------------------------------------------------------------------


@flow("SELECT event_type AS topic, count(*) AS records FROM events GROUP BY event_type")
def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_by_topic(event_rows(spark, sf_dir))


@flow(
    """SELECT CAST(ts AS date) AS day, count(*) AS records,
    CASE WHEN count(*) // 4 > 50 THEN CAST(count(*) // 50 AS bigint) END AS target
    FROM events GROUP BY 1"""
)
def batch_sizing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = Sizing(max_records=50, partitions=4)
    days = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"))
    counted = days.agg(F.count("*").alias("records"))
    return counted.withColumn("target", rule.target_column(F.col("records")))


@flow(
    """SELECT count(*) AS records, CAST(CASE WHEN count(*) // 4 > 200 THEN count(*) // 200 END AS bigint)
    AS partitions FROM events"""
)
def batch_sizing_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch over the limit, dealt out as the rule says."""
    rows = table(spark, sf_dir, "events")
    sized = Sizing(max_records=200, partitions=4).apply(rows, rows.count())
    by_task = sized.groupBy(F.spark_partition_id().alias("at")).agg(F.count("*").alias("n"))
    return by_task.agg(F.sum("n").alias("records"), F.count("*").alias("partitions"))


# -- windows ------------------------------------------------------------------
# The statement's rows go through the splice; its windows run by blocks, so that a
# busy user's rows need not meet in one task.

_OF_USER = "PARTITION BY user_id ORDER BY event_id"


@flow(
    f"""SELECT event_id, row_number() OVER w AS rn, rank() OVER p AS rnk, dense_rank() OVER p AS dense,
    round(percent_rank() OVER w, 6) AS pct, round(cume_dist() OVER p, 6) AS cume, ntile(3) OVER w AS tile
    FROM events WHERE event_type = 'purchase' WINDOW w AS ({_OF_USER}),
    p AS (PARTITION BY user_id ORDER BY CAST(trunc(value / 10) AS int) NULLS FIRST)"""
)
def sql_transform_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spliced(spark, sf_dir, ("purchase",), "event_id, user_id, CAST(value / 10 AS int) AS v")
    by_id = {"rn": Call("row_number"), "pct": Call("percent_rank"), "tile": Call("ntile", offset=3)}
    by_value = {"rnk": Call("rank"), "dense": Call("dense_rank"), "cume": Call("cume_dist")}
    ranked = blocked_windows(blocked_windows(rows, ["user_id"], ["event_id"], by_id), ["user_id"], ["v"], by_value)
    return ranked.select("event_id", "rn", "rnk", "dense", F.round("pct", 6).alias("pct"), F.round("cume", 6).alias("cume"), "tile")


@flow(
    f"""SELECT event_id, lag(value) OVER w AS before, lead(value, 2, -1.0) OVER w AS after2,
    first_value(event_id) OVER w AS first_id,
    last_value(event_id) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_id,
    last_value(value) OVER (w ROWS BETWEEN 1 PRECEDING AND 3 FOLLOWING) AS third_next,
    CAST(count(*) OVER (PARTITION BY user_id) AS bigint) AS in_all
    FROM events WHERE event_type = 'view' WINDOW w AS ({_OF_USER})"""
)
def sql_transform_window_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spliced(spark, sf_dir, ("view",), "event_id, user_id, value")
    whole = Frame(None, None, rows=True)
    calls = {
        "before": Call("lag", "value"),
        "after2": Call("lead", "value", 2, -1.0),
        "first_id": Call("first_value", "event_id", frame=Frame(None, 0, rows=True)),
        "last_id": Call("last_value", "event_id", frame=whole),
        "third_next": Call("last_value", "value", frame=Frame(-1, 3, rows=True)),
        "in_all": Call("count", frame=whole),
    }
    return blocked_windows(rows, ["user_id"], ["event_id"], calls).drop("user_id", "value")


@flow(
    f"""SELECT event_id, count(*) OVER (w ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS near_rows,
    max(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_so_far,
    min(event_id) OVER (w RANGE BETWEEN 1000 PRECEDING AND CURRENT ROW) AS recent_id
    FROM events WHERE event_type = 'click' WINDOW w AS ({_OF_USER})"""
)
def sql_transform_window_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spliced(spark, sf_dir, ("click",), "event_id, user_id, value")
    calls = {
        "near_rows": Call("count", frame=Frame(-2, 1, rows=True)),
        "best_so_far": Call("max", "value", frame=Frame(None, 0, rows=True)),
        "recent_id": Call("min", "event_id", frame=Frame(-1000, 0)),
    }
    return blocked_windows(rows, ["user_id"], ["event_id"], calls).drop("user_id", "value")


# -- sets and joins at size ----------------------------------------------------


@flow(
    """(SELECT user_id, CAST(ts AS date) AS day, 'except' AS what FROM events
            WHERE event_type = 'click' EXCEPT ALL
            SELECT user_id, CAST(ts AS date), 'except' FROM events WHERE event_type = 'view')
        UNION ALL (SELECT user_id, CAST(ts AS date), 'intersect' FROM events
            WHERE event_type = 'click' INTERSECT ALL
            SELECT user_id, CAST(ts AS date), 'intersect' FROM events WHERE event_type = 'view')"""
)
def sql_transform_setop_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements' rows as multisets; copies of a row are counted, not paired."""
    clicks, views = (spliced(spark, sf_dir, (topic,), "user_id, CAST(ts AS date) AS day") for topic in ("click", "view"))
    left, both = except_all(clicks, views), intersect_all(clicks, views)
    return left.withColumn("what", F.lit("except")).union(both.withColumn("what", F.lit("intersect")))


@flow(
    """SELECT c.event_id AS click_id, v.event_id AS view_id FROM events c JOIN events v
    ON c.event_id + c.user_id % 5 >= v.event_id AND c.event_id <= v.event_id + v.user_id % 40
    WHERE c.event_type = 'click' AND v.event_type = 'view'"""
)
def range_join_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of ids behind clicks and views that overlap, whoever's they are."""
    clicks = spliced(spark, sf_dir, ("click",), "event_id AS click_id, event_id + user_id % 5 AS click_end")
    views = spliced(spark, sf_dir, ("view",), "event_id AS view_id, event_id + user_id % 40 AS view_end")
    return overlap_join(clicks, views, ("click_id", "click_end"), ("view_id", "view_end")).select("click_id", "view_id")


_RICH = "SELECT c_custkey FROM customer WHERE c_acctbal > 5000"


@flow(
    f"""WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 7 > 0 THEN o_custkey END AS cust FROM orders)
    SELECT o_orderkey, 'without null' AS side FROM o WHERE cust NOT IN ({_RICH})
    UNION ALL SELECT o_orderkey, 'with null' FROM o WHERE cust NOT IN ({_RICH} UNION ALL SELECT NULL)
    UNION ALL SELECT o_orderkey, 'empty' FROM o WHERE cust NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 1e9)"""
)
def not_in_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT IN for rows with nulls, against keys without, with a null, and none."""
    rows = spliced(spark, sf_dir, ("orders",), "o_orderkey, CASE WHEN o_custkey % 7 > 0 THEN o_custkey END AS cust")
    customers = table(spark, sf_dir, "customer")
    rich = customers.where("c_acctbal > 5000").select("c_custkey")
    sides = {
        "without null": rich,
        "with null": rich.union(spark.range(1).selectExpr("CAST(NULL AS bigint)")),
        "empty": customers.where("c_acctbal > 1e9").select("c_custkey"),
    }
    parts = [not_in(rows, ["cust"], keys).select("o_orderkey", F.lit(side).alias("side")) for side, keys in sides.items()]
    return reduce(DataFrame.union, parts)


# -- upsert -------------------------------------------------------------------


def _stream_rows(spark: SparkSession, rows: DataFrame, stream: StreamDef) -> DataFrame:
    batch = TypedBatch(rows, event_contracts(spark, stream.topic).values())
    register_view(batch.typed(stream.topic), stream.topic)
    return spark.sql(statement(stream))


@flow(_latest("click", "user_id, value, event_id", "value > 1"))
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _stream_rows(spark, event_rows(spark, sf_dir), CLICKS)
    return latest_rows([Layer(result, 0, 0, CLICKS.order_by)], CLICKS.key)


@flow(
    """WITH u AS (SELECT * FROM (SELECT CASE WHEN event_id % 5 = 0 THEN user_id + 1000000
        ELSE user_id END AS id, value, event_id, event_type FROM events)
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_id DESC) = 1)
    SELECT coalesce(c_custkey, id) AS c_custkey, c_name, c_mktsegment,
        CASE WHEN id IS NULL THEN c_acctbal WHEN event_type <> 'error' THEN value END AS c_acctbal
    FROM customer FULL JOIN u ON c_custkey = id"""
)
def upsert_into_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New balances: some for new customers, and null where the event was an error."""
    customer = table(spark, sf_dir, "customer")
    existing = customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    events = table(spark, sf_dir, "events")
    fresh = F.col("event_id") % 5 == 0
    updates = events.select(
        F.when(fresh, F.col("user_id") + 1000000).otherwise(F.col("user_id")).alias("c_custkey"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("c_acctbal"),
        "event_id",
    )
    return upsert_rows(existing, updates, ["c_custkey"], ["event_id"]).drop("event_id")


def _at(profile_topic: str) -> str:
    return f"max_by(value, event_id) FILTER (WHERE event_type = '{profile_topic}')"


# Streams of one batch run in their order, so the views' event ids come last.
_PROFILE = f"""SELECT user_id, {_at('click')} AS last_click, {_at('view')} AS last_view,
    coalesce(max(event_id) FILTER (WHERE event_type = 'view'),
             max(event_id) FILTER (WHERE event_type = 'click')) AS event_id
    FROM events WHERE event_type IN ('click', 'view') GROUP BY user_id"""


@flow(_PROFILE)
def upsert_partial_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    streams = (PROFILE_A, PROFILE_B)
    topics = [s.topic for s in streams]
    rows = event_rows(spark, sf_dir).filter(F.col("topic").isin(*topics))
    batch = TypedBatch(rows, event_contracts(spark, *topics).values())
    for topic in topics:
        register_view(batch.typed(topic), topic)
    layers = [Layer(spark.sql(statement(s)), 0, i, s.order_by) for i, s in enumerate(streams)]
    return latest_rows(layers, ["user_id"])


def _slices(spark: SparkSession, rows: DataFrame, count: int) -> list[DataFrame]:
    """The rows cut by offset into so many ranges."""
    low, high = rows.agg(F.min("offset"), F.max("offset")).first()
    step = (high - low) // count + 1
    offset = F.col("offset")
    return [
        rows.filter((offset >= low + i * step) & (offset < low + (i + 1) * step))
        for i in range(count)
    ]


def _replayed(
    spark: SparkSession, sf_dir: str, streams: list[StreamDef], slices: int = 3
) -> TopicPipeline:
    """A pipeline whose stream was started anew, on one checkpoint, for every slice."""
    home = scratch(spark)
    topics = tuple(dict.fromkeys(s.topic for s in streams))
    rows = event_rows(spark, sf_dir).filter(F.col("topic").isin(*topics))
    work = TopicPipeline(
        spark, streams, event_contracts(spark, *topics), f"{home}/out", concurrency=len(streams)
    )
    for part in _slices(spark, rows, slices):
        write_topic_files(part, f"{home}/in")
        source = stream_topics(spark, ReplaySource(f"{home}/in", topics))
        work.start(source, f"{home}/checkpoint").awaitTermination()
    return work


@flow(_latest("click", "user_id, value, event_id", "value > 1"))
def upsert_stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replayed(spark, sf_dir, [CLICKS]).table("user_clicks")


@flow(_PROFILE.replace(
    """coalesce(max(event_id) FILTER (WHERE event_type = 'view'),
             max(event_id) FILTER (WHERE event_type = 'click'))""",
    "arg_max(event_id, (slice, event_type = 'view', event_id))",
).replace(
    "FROM events WHERE",
    """FROM (SELECT *, (event_id - min(event_id) OVER ()) //
        ((max(event_id) OVER () - min(event_id) OVER ()) // 3 + 1) AS slice
        FROM events WHERE event_type IN ('click', 'view')) WHERE""",
))
def upsert_partial_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replayed(spark, sf_dir, [PROFILE_A, PROFILE_B]).table("user_profile")


@flow(
    """SELECT user_id, arg_max(value, event_id) FILTER (WHERE slice < 2) AS value,
    arg_max(event_type, event_id) FILTER (WHERE slice > 0) AS kind, max(event_id) AS event_id
    FROM (SELECT *, (event_id - min(event_id) OVER ()) //
        ((max(event_id) OVER () - min(event_id) OVER ()) // 3 + 1) AS slice
        FROM events WHERE event_type = 'click') GROUP BY user_id"""
)
def upsert_evolved_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream whose definition gets a column and then loses another, across restarts."""
    home = scratch(spark)
    rows = event_rows(spark, sf_dir).filter("topic = 'click'")
    definitions = (
        "user_id, value, event_id",
        "user_id, value, event_type AS kind, event_id",
        "user_id, event_type AS kind, event_id",
    )
    for part, transform in zip(_slices(spark, rows, 3), definitions):
        stream = StreamDef("clicks", "click", "evolved", "user_id", transform, order_by="event_id")
        work = TopicPipeline(spark, [stream], event_contracts(spark, "click"), f"{home}/out")
        write_topic_files(part, f"{home}/in")
        source = stream_topics(spark, ReplaySource(f"{home}/in", ("click",)))
        work.start(source, f"{home}/checkpoint").awaitTermination()
    return work.table("evolved")


@flow(
    """SELECT 'a.b' AS tab, user_id, max(event_id) AS event_id FROM events
    WHERE event_type = 'click' GROUP BY user_id
    UNION ALL SELECT 'a_b', user_id, max(event_id) FROM events
    WHERE event_type = 'view' GROUP BY user_id"""
)
def compacted_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of like names below one root, both compacted into buckets."""
    home = scratch(spark)
    streams = [
        StreamDef(f"{topic}s", topic, name, "user_id", "user_id, event_id", order_by="event_id")
        for topic, name in (("click", "a.b"), ("view", "a_b"))
    ]
    rows = event_rows(spark, sf_dir).filter("topic IN ('click', 'view')")
    work = TopicPipeline(spark, streams, event_contracts(spark, "click", "view"), home)
    for batch_id, part in enumerate(_slices(spark, rows, 2)):
        work.process(part, batch_id)
    found = []
    for stream in streams:
        work.compact(stream.table, 0, buckets=4)
        named = work.table(stream.table).withColumn("tab", F.lit(stream.table))
        found.append(named.select("tab", "user_id", "event_id"))
    return found[0].union(found[1])


@flow(
    """SELECT user_id, CASE WHEN event_id % 2 = 0 THEN event_id END AS n,
    100.0 / nullif(event_id % 3, 0) AS share, event_id FROM events
    WHERE event_type = 'purchase' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"""
)
def sql_transform_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pipeline as it is by default: casts that fail and divisions by zero give null."""
    stream = StreamDef(
        "lenient", "purchase", "shares", "user_id",
        """user_id, event_id, CAST(CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS string)
            ELSE concat('x', event_id) END AS bigint) AS n,
        CAST(100 AS double) / (event_id % 3) AS share""",
        order_by="event_id",
    )
    work = TopicPipeline(spark, [stream], event_contracts(spark, "purchase"), scratch(spark))
    work.process(event_rows(spark, sf_dir).filter("topic = 'purchase'"), 0)
    return work.table("shares").select("user_id", "n", "share", "event_id")


@flow(_latest("click", "user_id, value, event_id", "value > 1"))
def compacted_equals_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = _replayed(spark, sf_dir, [CLICKS])
    work.compact("user_clicks", 0)
    work.compact("user_clicks", 1)
    return work.table("user_clicks")


@flow(
    """SELECT user_id, count(*) AS n, max(event_id) AS event_id FROM events
    WHERE event_type = 'purchase' AND value > 0 GROUP BY user_id"""
)
def upsert_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _stream_rows(spark, event_rows(spark, sf_dir), SPEND)
    return latest_rows([Layer(result, 0, 0, SPEND.order_by)], SPEND.key)


# -- dead letters and fan-out -------------------------------------------------


@flow(
    """SELECT event_id, value, CASE WHEN user_id % 7 <> 0 THEN user_id END AS user_id,
    CASE WHEN user_id % 7 = 0 THEN 'null_key' END AS reason
    FROM events WHERE event_type = 'signup' AND value > 5"""
)
def dead_letter_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _stream_rows(spark, event_rows(spark, sf_dir), HOLED)
    good, bad = dead.split_by_key(result, HOLED.key)
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(
        bad.drop(dead.ERROR).withColumnRenamed(REASON, "reason")
    )


@flow(
    """SELECT user_id, value, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id
        ORDER BY event_id % 4 <> 0 , event_id DESC) AS rn
        FROM events WHERE event_type = 'click' AND value > 1) WHERE rn = 1"""
)
def dead_letter_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken payloads land in the dead letter; mended, they go through as the next batch."""
    home = scratch(spark)
    mark = b"broken "
    rows = event_rows(spark, sf_dir).filter("topic = 'click'")
    broken = F.concat(F.lit(mark), F.col("value"))
    rows = rows.withColumn("value", F.when(F.col("offset") % 4 == 0, broken).otherwise(F.col("value")))
    work = TopicPipeline(spark, [CLICKS], event_contracts(spark, "click"), home)
    work.process(rows, 0)
    found = dead.replayable(dead.read_raw(spark, home))
    mended = F.substring(F.col("value"), len(mark) + 1, 2**31 - 1)
    work.process(found.withColumn("value", mended), 1)
    return work.table("user_clicks")


@flow(
    """SELECT 'clicks' AS stream, count(*) FILTER (WHERE value > 1) AS stored, 0 AS rejected,
        count(*) FILTER (WHERE NOT value > 1) AS filtered FROM events WHERE event_type = 'click'
    UNION ALL SELECT 'views', count(*), 0, 0 FROM events WHERE event_type = 'view'
    UNION ALL SELECT 'holed', count(*) FILTER (WHERE value > 5 AND user_id % 7 <> 0),
        count(*) FILTER (WHERE value > 5 AND user_id % 7 = 0),
        count(*) FILTER (WHERE NOT value > 5) FROM events WHERE event_type = 'signup'"""
)
def fan_out_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = scratch(spark)
    streams = [CLICKS, VIEWS, HOLED]
    topics = [s.topic for s in streams]
    rows = event_rows(spark, sf_dir).filter(F.col("topic").isin(*topics))
    work = TopicPipeline(
        spark, streams, event_contracts(spark, *topics), home, concurrency=len(streams)
    )
    work.process(rows, 0)

    def marked(found: DataFrame, stream: StreamDef, stored: int) -> DataFrame:
        return found.select(
            F.lit(stream.name).alias("stream"),
            F.lit(stream.topic).alias("topic"),
            F.lit(stored).alias("stored"),
            F.lit(1 - stored).alias("rejected"),
        )

    logged = {s: spark.read.parquet(log_dir(home, s.table, s.name)) for s in streams}
    parts = [marked(dead.split_by_key(rows, s.key)[0], s, stored=1) for s, rows in logged.items()]
    parts.append(marked(dead.read_rows(spark, home, HOLED.name), HOLED, stored=0))
    ended = reduce(DataFrame.union, parts).groupBy("stream", "topic")
    ended = ended.agg(F.sum("stored").alias("stored"), F.sum("rejected").alias("rejected"))
    rest = (F.col("records") - F.col("stored") - F.col("rejected")).alias("filtered")
    read = counts_by_topic(event_rows(spark, sf_dir))
    return ended.join(read, "topic").select("stream", "stored", "rejected", rest)


@flow(
    """SELECT event_id, user_id, 'transform_failed' AS reason FROM events WHERE event_type = 'error'
    UNION ALL SELECT event_id, user_id, 'stored' FROM events WHERE event_type = 'view'"""
)
def failing_stream_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream divides by zero; the other's rows are stored all the same."""
    home = scratch(spark)
    failing = StreamDef(
        "failing", "error", "never", "user_id", "user_id, 1 div (event_id - event_id) AS z",
        order_by="z",
    )
    streams = [failing, VIEWS]
    work = TopicPipeline(spark, streams, event_contracts(spark, "error", "view"), home, ansi=True)
    work.process(event_rows(spark, sf_dir).filter("topic IN ('error', 'view')"), 0)
    lost = dead.read_failed(spark, home, "failing")
    kept = spark.read.parquet(log_dir(home, "user_views", "views"))
    return lost.select(
        F.col("offset").alias("event_id"),
        F.col("key").cast("string").cast("bigint").alias("user_id"),
        F.col(REASON).alias("reason"),
    ).unionByName(kept.select("event_id", "user_id", F.lit("stored").alias("reason")))


@flow(
    """SELECT event_id, user_id, CASE WHEN event_id % 4999 = 88 THEN 'transform_failed' ELSE 'stored' END AS reason
    FROM events WHERE event_type = 'click'"""
)
def dead_letter_bisected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statement divides by zero on single rows; these are set aside, the topic's others stored."""
    home = scratch(spark)
    stream = StreamDef(
        "shares", "click", "click_shares", "event_id",
        "event_id, user_id, 1000 div (event_id % 4999 - 88) AS share", order_by="event_id",
    )
    work = TopicPipeline(spark, [stream], event_contracts(spark, "click"), home, ansi=True, isolate=64)
    work.process(event_rows(spark, sf_dir).filter("topic = 'click'"), 0)
    kept = work.table("click_shares").select("event_id", "user_id", F.lit("stored").alias("reason"))
    lost = dead.read_failed(spark, home, "shares")
    return kept.union(
        lost.select(F.col("offset").alias("event_id"), F.col("key").cast("string").cast("bigint").alias("user_id"), F.col(REASON).alias("reason"))
    )


# -- replicate and produce ----------------------------------------------------


def _one_topic(spark: SparkSession, sf_dir: str, value=None) -> tuple[DataFrame, TopicContract]:
    rows = event_rows(spark, sf_dir, topic=F.lit("events"), value=value)
    struct = table(spark, sf_dir, "events").schema
    return rows, TopicContract("events", struct)


def _copied(rows: DataFrame, contract: TopicContract) -> DataFrame:
    batch = TypedBatch(rows, [TopicContract("copy", contract.struct)])
    columns = ["event_id", "user_id", "event_type"]
    return batch.typed("copy").select(*columns)


@flow(
    """SELECT event_id, user_id, event_type FROM events
    WHERE CAST(user_id AS varchar) IN ('3', '7')"""
)
def replicate_in_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, contract = _one_topic(spark, sf_dir)
    copied = replicate(rows, contract, ReplicaDef("events", "copy", "user_id", "3,7,,"))
    return _copied(copied, contract)


@flow(
    """SELECT event_id, user_id, event_type FROM events
    WHERE coalesce(CASE WHEN user_id % 6 <> 0 THEN event_type END, 'null') IN ('null', 'view')"""
)
def replicate_null_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("user_id") % 6 != 0, F.col("event_type")).alias("kind")
    value = F.struct("event_id", "user_id", "event_type", kind)
    rows, _ = _one_topic(spark, sf_dir, value)
    struct = T.StructType.fromDDL(
        "event_id bigint, user_id bigint, event_type string, kind string"
    )
    contract = TopicContract("events", struct)
    copied = replicate(rows, contract, ReplicaDef("events", "copy", "kind", "null,view"))
    return _copied(copied, contract)


@flow(
    """SELECT event_id, user_id, event_type FROM events
    WHERE event_type IN ('click', 'purchase')"""
)
def replicate_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = scratch(spark)
    rows, contract = _one_topic(spark, sf_dir)
    replica = ReplicaDef("events", "copy", "event_type", "click,purchase")
    for part in _slices(spark, rows, 2):
        write_topic_files(part, f"{home}/in")
        source = stream_topics(spark, ReplaySource(f"{home}/in", ("events",)))
        start_replica(
            source, contract, replica, f"{home}/checkpoint", path=f"{home}/out"
        ).awaitTermination()
    return _copied(read_topics(spark, ReplaySource(f"{home}/out")), contract)


@flow(
    """SELECT event_id, user_id, CASE WHEN event_id % 2 = 0 THEN 9101 ELSE 9102 END AS id,
    CASE WHEN event_id % 2 <> 0 THEN event_type END AS event_type
    FROM events WHERE event_type = 'click' AND user_id % 2 = 1"""
)
def replicate_target_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of two writers, each with its own schema's id in the target registry."""
    old, new = EVENT_SCHEMA_IDS["click"]
    slim = codec.to_json_bytes(F.struct("event_id", "user_id", "value"))
    full = codec.to_json_bytes(F.struct(*table(spark, sf_dir, "events").columns))
    value = F.when(F.col("event_id") % 2 == 0, codec.frame(slim, old)).otherwise(codec.frame(full, new))
    rows = event_rows(spark, sf_dir, value=value)
    there = registry_snapshot(spark).withColumns(
        {"subject": F.regexp_replace("subject", "^click", "copy"), "id": F.col("id") + 9000}
    )
    ids = matching_ids(registry_snapshot(spark), there, "click", "copy")
    users = table(spark, sf_dir, "events").select(F.col("user_id").cast("string")).distinct()
    odd = users.filter("CAST(user_id AS bigint) % 2 = 1")
    contract = event_contracts(spark, "click", framed=True)["click"]
    replica = ReplicaDef("click", "copy", "user_id", (), target_schema_id=ids)
    copied = replicate(rows, contract, replica, listed=odd)
    there_by_id = contracts(there, ["copy"], framed=True)["copy"]
    batch = TypedBatch(copied, [there_by_id], keep_values=True)
    record = [f"{path} AS {n}" for path, n in zip(batch.fields("copy"), there_by_id.struct.names)]
    return batch.frame.selectExpr(*record, f"{codec.frame_id_sql(RAW)} AS id").select(
        "event_id", "user_id", "id", "event_type"
    )


_PRODUCED = """SELECT conv_id, turn, role, text FROM conversations
    WHERE turn % 5 <> 3 AND turn % 5 <> 4"""


def _produce_contracts(spark: SparkSession) -> tuple[TopicContract, TopicContract]:
    snapshot = registry_snapshot(spark)
    key = contracts(snapshot, ["conversation"], side="key")["conversation"]
    return key, contracts(snapshot, ["conversation"], framed=True)["conversation"]


def _sent_back(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Produced rows read as a consumer would, key and value."""
    key, value = _produce_contracts(spark)
    keys = codec.from_json_bytes(F.col("key"), key.struct)
    values = codec.from_json_bytes(codec.frame_body("value"), value.struct)
    both = rows.select(F.inline(F.array(F.struct(keys.alias("k"), values.alias("v")))))
    return both.select("k.conv_id", "k.turn", "v.role", "v.text")


@flow(_PRODUCED)
def produce_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some keys and values are malformed or empty; the others come back typed."""
    talk = table(spark, sf_dir, "conversations")
    turn = F.col("turn") % 5
    source = talk.select(
        F.to_json(F.struct("conv_id", "turn")).alias("key"),
        F.when(turn == 3, "oops")
        .when(turn == 4, F.lit(None))
        .otherwise(F.to_json(F.struct("role", "text")))
        .alias("value"),
    )
    key, value = _produce_contracts(spark)
    return _sent_back(spark, produce(source, "conversation", key, value).rows)


@flow(
    """SELECT CASE turn % 5 WHEN 3 THEN 'bad_value' ELSE 'missing_field' END AS reason,
    count(*) AS n FROM conversations WHERE turn % 5 IN (3, 4) GROUP BY 1"""
)
def produce_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = table(spark, sf_dir, "conversations")
    turn = F.col("turn") % 5
    source = talk.select(
        F.to_json(F.struct("conv_id", "turn")).alias("key"),
        F.when(turn == 3, "oops")
        .when(turn == 4, F.lit(None))
        .otherwise(F.to_json(F.struct("role", "text")))
        .alias("value"),
    )
    key, value = _produce_contracts(spark)
    rejects = produce(source, "conversation", key, value).rejects
    return rejects.groupBy(F.col(REASON).alias("reason")).agg(F.count("*").alias("n"))


# a note in a namespace, whose records name their fields' types by short and full names
_NOTE = json.dumps(
    {
        "type": "record",
        "name": "note",
        "namespace": "com.talk",
        "fields": [
            {"name": "by", "type": {"type": "record", "name": "Person", "fields": [{"name": "role", "type": "string"}]}},
            {"name": "text", "type": ["null", "string"]},
            {"name": "to", "type": ["null", "com.talk.Person"]},
            {"name": "raw", "type": ["null", "bytes", "long"]},
        ],
    }
)


@flow(
    """SELECT conv_id, turn, role, CASE WHEN turn % 2 = 0 THEN text END AS text,
    CASE WHEN turn % 3 = 0 THEN role END AS to_role, CASE WHEN turn % 3 = 1 THEN role END AS raw,
    CASE WHEN turn % 3 = 2 THEN turn END AS num, NULL AS reason FROM conversations WHERE turn % 7 < 5
    UNION ALL SELECT conv_id, turn, NULL, NULL, NULL, NULL, NULL, 'bad_value' FROM conversations WHERE turn % 7 >= 5"""
)
def produce_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values in Avro's JSON form: branches by full names, and wrong ones refused."""
    talk = table(spark, sf_dir, "conversations")
    turn, role = F.col("turn"), F.to_json(F.struct("role"))
    text = F.when(turn % 2 == 0, F.to_json(F.struct(F.col("text").alias("string")))).otherwise("null")
    person = F.when(turn % 3 == 0, F.format_string('{"com.talk.Person": %s}', role)).otherwise("null")
    raw = (
        F.when(turn % 3 == 1, F.format_string('{"bytes": "%s"}', "role"))
        .when(turn % 3 == 2, F.format_string('{"long": %d}', "turn"))
        .otherwise("null")
    )
    wrong = F.when(turn % 7 == 5, '{"str": "x"}').when(turn % 7 == 6, '{"Person": {"role": "x"}}')
    # the sixth of seven has a wrong branch for its text, the last a short name for its person
    value = F.format_string(
        '{"by": %s, "text": %s, "to": %s, "raw": %s}',
        role,
        F.when(turn % 7 == 5, wrong).otherwise(text),
        F.when(turn % 7 == 6, wrong).otherwise(person),
        raw,
    )
    source = talk.select("conv_id", "turn", F.to_json(F.struct("conv_id", "turn")).alias("key"), value.alias("value"))
    key, _ = _produce_contracts(spark)
    note = TopicContract("note", struct_of(_NOTE), writers={1: _NOTE}, latest_id=1)
    made = produce(source, "note", key, note, unions="tagged")
    keys = codec.from_json_bytes(F.col("key"), key.struct)
    values = codec.from_json_bytes(F.col("value"), note.struct)
    sent = made.rows.select(F.inline(F.array(F.struct(keys.alias("k"), values.alias("v")))))
    none = F.lit(None).cast("string")
    good = sent.select(
        "k.conv_id", "k.turn", "v.by.role", "v.text", F.col("v.to.role").alias("to_role"),
        F.col("v.raw.member0").cast("string").alias("raw"), F.col("v.raw.member1").alias("num"), none.alias("reason"),
    )
    gone = [none.alias(n) for n in ("role", "text", "to_role", "raw")]
    bad = made.rejects.select("conv_id", "turn", *gone, F.lit(None).cast("bigint").alias("num"), F.col(REASON).alias("reason"))
    return good.union(bad)
