"""Topic views and the SQL statements that run over them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.conform import SOURCE_COLUMNS
from millrace.plans.definitions import StreamDef, tables_of
from millrace.sources.registry import TopicContract

_SOURCE_TYPES = (T.IntegerType(), T.LongType(), T.TimestampType())


def view_name(topic: str) -> str:
    """The view of a topic, quoted: ``TMP_`` and the topic in upper case."""
    return "`TMP_" + topic.upper().replace("`", "``") + "`"


def register_view(typed: DataFrame, topic: str) -> None:
    """Name a topic's typed rows on the session they belong to."""
    typed.createOrReplaceTempView(view_name(topic))


def statement(stream: StreamDef) -> str:
    if stream.sql is not None:
        return stream.sql
    return f"SELECT {stream.transform} FROM {view_name(stream.topic)} WHERE {stream.filter}"


def uses_source_columns(streams: Iterable[StreamDef]) -> bool:
    """Whether any stream orders by a message column, which views then show."""
    return any(set(s.order_by) & set(SOURCE_COLUMNS) for s in streams)


def _with_empty_views(
    spark: SparkSession,
    streams: list[StreamDef],
    contracts: dict[str, TopicContract],
    ansi: bool,
) -> tuple[SparkSession, dict[str, DataFrame]]:
    """A session of its own with a view of every topic, and the frames behind them."""
    session = spark.newSession()
    session.conf.set("spark.sql.ansi.enabled", str(ansi).lower())
    extra = []
    if uses_source_columns(streams):
        extra = [T.StructField(n, t) for n, t in zip(SOURCE_COLUMNS, _SOURCE_TYPES)]
    frames = {}
    for topic, contract in contracts.items():
        columns = [T.StructField(f.name, f.dataType) for f in contract.struct]
        # over an RDD, whose emptiness the optimizer does not know and so keeps its columns
        nothing = session.sparkContext.emptyRDD()
        frames[topic] = session.createDataFrame(nothing, T.StructType([*columns, *extra]))
        register_view(frames[topic], topic)
    return session, frames


def _each(seq) -> Iterator:
    items = seq.iterator()
    while items.hasNext():
        yield items.next()


def _nodes(plan) -> Iterator:
    yield plan
    for below in (*_each(plan.children()), *_each(plan.subqueries())):
        yield from _nodes(below)


def used_fields(
    spark: SparkSession,
    streams: list[StreamDef],
    contracts: dict[str, TopicContract],
    ansi: bool = False,
) -> dict[str, set[str]]:
    """By topic, the fields on which some stream's result depends.

    These are the columns of the views that the optimized statements refer to.
    """
    session, frames = _with_empty_views(spark, streams, contracts, ansi)
    leaf = lambda plan: [n for n in _nodes(plan) if n.nodeName() == "LogicalRDD"]
    topics = {leaf(f._jdf.queryExecution().optimizedPlan())[0].rdd().id(): t for t, f in frames.items()}
    used: dict[str, set[str]] = {t: set() for t in frames}
    for stream in streams:
        plan = session.sql(statement(stream))._jdf.queryExecution().optimizedPlan()
        named = {a.exprId().id() for a in _each(plan.output())}
        for node in _nodes(plan):
            named |= {a.exprId().id() for a in _each(node.references().toSeq())}
        for view in leaf(plan):
            columns = (a for a in _each(view.output()) if a.exprId().id() in named)
            used[topics[view.rdd().id()]] |= {a.name() for a in columns}
    return used


def take_rows_alone(
    spark: SparkSession,
    streams: list[StreamDef],
    contracts: dict[str, TopicContract],
    ansi: bool = False,
) -> set[str]:
    """Names of the streams whose columns and filter look at one row at a time: it fails by itself or not."""
    session, _ = _with_empty_views(spark, streams, contracts, ansi)
    simple = {"Project", "Filter", "SubqueryAlias", "View", "LogicalRDD"}
    found = set()
    for stream in streams:
        plan = session.sql(statement(stream))._jdf.queryExecution().analyzed()
        kinds = [n.nodeName() for n in _nodes(plan)]
        if stream.sql is None and set(kinds) <= simple and kinds.count("LogicalRDD") == 1 and plan.deterministic():
            found.add(stream.name)
    return found


def _raises(session: SparkSession, expression: str) -> Column:
    """Whether an expression raises on a row; ``expression`` is never null where it does not."""
    sql = session._jvm.org.apache.spark.sql
    tree = sql.classic.ExpressionUtils.expression(F.expr(expression)._jc)
    return Column(sql.classic.ExpressionUtils.column(sql.catalyst.expressions.TryEval(tree))).isNull()


def failing_rows(session: SparkSession, stream: StreamDef) -> DataFrame:
    """``partition, offset`` of the rows in the topic's view on which the stream's columns raise.

    For streams that take rows alone, on a view that shows the message columns. Raises where the filter does.
    """
    taken = session.table(view_name(stream.topic)).where(stream.filter)
    found = taken.where(_raises(session, f"struct({stream.transform}\n)"))
    return found.selectExpr("_partition AS partition", "_offset AS offset").distinct()


def check_streams(
    spark: SparkSession,
    streams: list[StreamDef],
    contracts: dict[str, TopicContract],
    ansi: bool = False,
) -> dict[str, T.StructType]:
    """Analyse every statement before any row is read; output columns by stream.

    Works in a session of its own on empty views, so the caller's views and
    settings stay as they are. Raises ValueError for the first wrong stream.
    """
    names = [s.name for s in streams]
    if len(set(names)) < len(names):
        raise ValueError("stream names must be unique")
    topics = list(dict.fromkeys(s.topic for s in streams))
    if len({t.upper() for t in topics}) < len(topics):
        raise ValueError(f"topics {topics} differ only in case and would share a view")
    missing = [t for t in topics if t not in contracts]
    if missing:
        raise ValueError(f"no contract for topics {missing}")

    session, _ = _with_empty_views(spark, streams, contracts, ansi)
    found = {}
    for stream in streams:
        try:
            schema = session.sql(statement(stream)).schema
        except AnalysisException as error:
            raise ValueError(f"stream {stream.name}: {error}") from error
        columns = schema.fieldNames()
        if len(set(columns)) < len(columns):
            raise ValueError(f"stream {stream.name}: columns {columns} are not unique")
        absent = [c for c in (*stream.key, *stream.order_by) if c not in columns]
        if absent:
            raise ValueError(f"stream {stream.name}: the statement does not return {absent}")
        found[stream.name] = schema
    _check_shared_columns(streams, found)
    return found


def _check_shared_columns(streams: list[StreamDef], schemas: dict[str, T.StructType]) -> None:
    for table in tables_of(streams).values():
        types: dict[str, T.DataType] = {}
        orders = set()
        for stream in table.streams:
            schema = schemas[stream.name]
            orders.add(tuple(schema[c].dataType.simpleString() for c in stream.order_by))
            for column in schema:
                if types.setdefault(column.name, column.dataType) != column.dataType:
                    raise ValueError(
                        f"table {table.name}: streams give {column.name} different types"
                    )
        if len(orders) > 1:
            raise ValueError(f"table {table.name}: its streams order by different types")
