"""Topics to tables: the work of one micro-batch, and the stream that repeats it."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager, contextmanager
from dataclasses import dataclass, replace

from py4j.protocol import Py4JError
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import deadletter as dead
from millrace.operators.bisection import find_failing, without
from millrace.operators.conform import REASON, TypedBatch
from millrace.operators.sizing import Sizing
from millrace.operators.upsert import (
    RESERVED,
    append_log,
    compact,
    expire,
    log_dir,
    refuse_type_changes,
    snapshot,
)
from millrace.plans.definitions import Settings, StreamDef, tables_of
from millrace.plans.statements import (
    check_streams,
    failing_rows,
    register_view,
    statement,
    take_rows_alone,
    used_fields,
    uses_source_columns,
)
from millrace.sources.paths import child_names, numbered_children, refuse_patterns
from millrace.sources.registry import TopicContract, contracts
from millrace.sources.topics import KafkaSource, ReplaySource, stream_topics


@dataclass(frozen=True)
class StreamReport:
    """What one stream did with one batch."""

    stream: str
    batch_id: int
    stored: int = 0
    null_key: int = 0
    error: str | None = None
    #: Topic rows on which the statement failed, while the others were stored.
    isolated: int = 0
    #: Whether all that the error concerns is in the dead letter.
    set_aside: bool = True


@dataclass(frozen=True)
class BatchReport:
    batch_id: int
    records: dict[str, int]
    untyped: dict[str, int]
    streams: tuple[StreamReport, ...]


@contextmanager
def _setting(session: SparkSession, name: str, on: bool) -> Iterator[None]:
    before = session.conf.get(name)
    session.conf.set(name, str(on).lower())
    try:
        yield
    finally:
        session.conf.set(name, before)


def ansi_mode(session: SparkSession, on: bool) -> AbstractContextManager[None]:
    """SQL errors raise (on) or give null (off) while the block runs."""
    return _setting(session, "spark.sql.ansi.enabled", on)


class TopicPipeline:
    """Several streams over one source, stored below one shared ``root``.

    Every batch is typed once for all topics and kept for the batch's time.
    All topic views of the batch exist before the first statement runs.
    ``concurrency`` streams store at a time. Statements that fail do not stop
    other streams; a dead letter that cannot be written stops the query, which
    then repeats the batch.

    Where a statement raises on some of its topic's rows, these are found by halving the
    batch and set aside; the statement then runs over the rest. Where more than ``isolate`` ranges
    fail, a transform that takes each row alone is tried on all their rows in one pass, any other
    statement's are halved to the last row; 0 sets the topic's whole batch aside.

    Of a payload the fields are parsed that some statement uses, and a wrong
    value in another does no harm; ``check_all_fields`` parses all.

    ``first_batch_id`` is where batch ids start: a query on a new checkpoint
    counts from 0, and must not replace what an earlier one stored.
    """

    def __init__(
        self,
        spark: SparkSession,
        streams: list[StreamDef],
        contracts: dict[str, TopicContract],
        root: str,
        *,
        sizing: Sizing | None = None,
        ansi: bool = False,
        cache: bool = True,
        concurrency: int = 1,
        first_batch_id: int = 0,
        check_all_fields: bool = False,
        isolate: int = 8,
    ):
        self.spark = spark
        self.streams = list(streams)
        used = {s.topic for s in self.streams}
        self.contracts = {t: c for t, c in contracts.items() if t in used}
        self.root = root.rstrip("/")
        self.sizing, self.ansi, self.cache = sizing, ansi, cache
        self.concurrency, self.first_batch_id, self.isolate = concurrency, first_batch_id, isolate
        self.schemas = check_streams(spark, self.streams, self.contracts, ansi)
        for name, schema in self.schemas.items():
            taken = set(schema.fieldNames()) & {*RESERVED, REASON, dead.ERROR}
            if taken:
                raise ValueError(f"stream {name}: column names {sorted(taken)} are reserved")
        self.tables = tables_of(self.streams)
        refuse_patterns(self.root)
        for table in self.tables.values():
            refuse_type_changes(spark, self.root, table, self.schemas)
        self._source_columns = uses_source_columns(self.streams)
        self.used = None
        if not check_all_fields:
            self.used = used_fields(spark, self.streams, self.contracts, ansi)

    # -- one batch ---------------------------------------------------------

    def process(self, batch: DataFrame, batch_id: int) -> BatchReport:
        """Store one batch of topic rows. Repeating a batch repeats its result."""
        batch_id += self.first_batch_id
        with ansi_mode(batch.sparkSession, self.ansi):
            typed = TypedBatch(batch, self.contracts.values(), used=self.used)
            kept = [self._kept(typed.frame)]
            try:
                counts = self._counts(typed)
                if self.sizing:
                    sized = self.sizing.apply(typed.frame, sum(r.records for r in counts))
                    if sized is not typed.frame:
                        kept.append(self._kept(sized))
                        typed = typed.over(sized)
                return self._store_all(batch, typed, counts, batch_id)
            finally:
                for frame in kept if self.cache else ():
                    frame.unpersist()

    def _kept(self, frame: DataFrame) -> DataFrame:
        return frame.persist(StorageLevel.MEMORY_AND_DISK) if self.cache else frame

    @staticmethod
    def _counts(typed: TypedBatch) -> list[Row]:
        counted = typed.frame.groupBy("topic")
        return counted.agg(F.count("*").alias("records"), F.count(REASON).alias("untyped")).collect()

    def _store_all(
        self, batch: DataFrame, typed: TypedBatch, counts: list[Row], batch_id: int
    ) -> BatchReport:
        untyped = {r.topic: r.untyped for r in counts if r.untyped}
        dead.forget(self.spark, self.root, [s.name for s in self.streams], batch_id)
        if untyped:
            dead.write_raw(typed.rejects(), self.root, batch_id)
        for topic in self.contracts:
            register_view(typed.typed(topic, self._source_columns), topic)

        def store(stream: StreamDef) -> StreamReport:
            return self._store(batch, stream, batch_id)

        if self.concurrency == 1:
            reports = [store(s) for s in self.streams]
        else:
            with ThreadPoolExecutor(self.concurrency) as pool:
                work = inheritable_thread_target(self.spark)(store)
                reports = list(pool.map(work, self.streams))
        # one after the other: each gives its topic's view other rows while it looks
        reports = [
            self._without_failing_rows(batch, typed, stream, report) if report.error and not report.set_aside else report
            for stream, report in zip(self.streams, reports)
        ]
        records = {r.topic: r.records for r in counts}
        return BatchReport(batch_id, records, untyped, tuple(reports))

    def _store(self, batch: DataFrame, stream: StreamDef, batch_id: int) -> StreamReport:
        try:
            return self._append(batch.sparkSession, stream, batch_id)
        except (PySparkException, Py4JError) as error:
            aside = self._set_aside(batch, stream, batch_id, str(error))
            return StreamReport(stream.name, batch_id, error=str(error), set_aside=aside)

    def _append(self, session: SparkSession, stream: StreamDef, batch_id: int) -> StreamReport:
        """Store the statement's result over the views as they are."""
        result = session.sql(statement(stream))
        seen = Observation()
        bad = dead.has_null_key(stream.key)
        counted = result.observe(
            seen, F.count("*").alias("rows"), F.count_if(bad).alias("null_key")
        )
        path = append_log(counted, self.root, stream.table, stream.name, batch_id)
        null_key = seen.get["null_key"]
        if null_key:
            # the log's readers pass these rows over
            _, bad_rows = dead.split_by_key(session.read.parquet(path), stream.key)
            dead.write_rows(bad_rows, self.root, stream.name, batch_id)
        return StreamReport(stream.name, batch_id, seen.get["rows"] - null_key, null_key)

    def _set_aside(self, batch: DataFrame, stream: StreamDef, batch_id: int, error: str) -> bool:
        """Keep the result rows of a stream that cannot be stored; False if they do not evaluate."""
        try:
            rows = dead.with_reason(batch.sparkSession.sql(statement(stream)), dead.STORE_FAILED, error)
            dead.write_rows(rows, self.root, stream.name, batch_id)
        except (PySparkException, Py4JError):
            return False
        return True

    def _without_failing_rows(
        self, batch: DataFrame, typed: TypedBatch, stream: StreamDef, report: StreamReport
    ) -> StreamReport:
        """Store what a raising statement makes of the rows on which it does not raise.

        The others, or all of the topic's rows if they cannot be told, go to the dead letter.
        """
        topic, session = stream.topic, batch.sparkSession
        own = typed.frame.filter((F.col("topic") == topic) & F.col(REASON).isNull())

        told: list[DataFrame] = []

        def over(rows: DataFrame, source_columns: bool = self._source_columns) -> None:
            register_view(typed.over(rows).typed(topic, source_columns), topic)

        def failure(condition: Column) -> str | None:
            return error_over(own.filter(condition))

        def error_over(rows: DataFrame) -> str | None:
            over(rows)
            try:
                session.sql(statement(stream)).write.format("noop").mode("overwrite").save()
            except (PySparkException, Py4JError) as error:
                return str(error)[:2000]
            return None

        def one_by_one(condition: Column) -> DataFrame | None:
            """The chosen rows on which the statement raises, if it takes rows alone and raises on no others."""
            if stream.name not in take_rows_alone(self.spark, self.streams, self.contracts, self.ansi):
                return None
            chosen = own.filter(condition)
            over(chosen, source_columns=True)
            try:
                # what two columns share would be evaluated before either, where raising is not held back
                with _setting(session, "spark.sql.subexpressionElimination.enabled", False):
                    bad = failing_rows(session, stream).persist(StorageLevel.MEMORY_AND_DISK)
                    told.append(bad)
                    bad.count()
            except (PySparkException, Py4JError):
                return None
            return bad if error_over(without(chosen, bad)) is None else None

        source = batch.filter(F.col("topic") == topic)
        try:
            found = find_failing(own, failure, self.isolate, report.error, one_by_one) if self.isolate else None
            if found is not None:
                over(found.others(own))
                done = self._append(session, stream, report.batch_id)
                lost = dead.with_reason(found.of(source), dead.TRANSFORM_FAILED).withColumn(dead.ERROR, found.error())
                dead.write_failed(lost, self.root, stream.name, report.batch_id)
                return replace(done, error=report.error, isolated=found.rows)
        except (PySparkException, Py4JError):
            pass  # nothing is stored; all goes below
        finally:
            register_view(typed.typed(topic, self._source_columns), topic)
            for frame in told:
                frame.unpersist()
        rows = dead.with_reason(source, dead.TRANSFORM_FAILED, report.error)
        dead.write_failed(rows, self.root, stream.name, report.batch_id)
        return replace(report, set_aside=True)

    # -- the stream --------------------------------------------------------

    def start(
        self, rows: DataFrame, checkpoint: str, *, every_seconds: int | None = None
    ) -> StreamingQuery:
        """Run over a stream of topic rows.

        Without ``every_seconds`` the query takes all rows present and stops;
        started again on the same checkpoint it goes on with what came since.
        """
        self._refuse_overwriting(checkpoint)
        writer = rows.writeStream.foreachBatch(
            lambda batch, batch_id: self.process(batch, batch_id) and None
        ).option("checkpointLocation", checkpoint)
        if every_seconds is None:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=f"{every_seconds} seconds").start()

    def _refuse_overwriting(self, checkpoint: str) -> None:
        """A new checkpoint counts batches from 0 and would replace stored ones."""
        if numbered_children(self.spark, f"{checkpoint}/offsets", ""):
            return
        for stream in self.streams:
            home = log_dir(self.root, stream.table, stream.name)
            shapes = child_names(self.spark, home)
            stored = [n for s in shapes for n in numbered_children(self.spark, f"{home}/{s}", "batch_id=")]
            if stored and max(stored) >= self.first_batch_id:
                raise ValueError(
                    f"stream {stream.name} has batches up to {max(stored)} below {self.root}, "
                    f"but the checkpoint is new: set first_batch_id to {max(stored) + 1}"
                )

    # -- tables ------------------------------------------------------------

    def table(self, name: str, upto: int | None = None) -> DataFrame:
        """A destination table's rows, as of a batch if given."""
        return snapshot(self.spark, self.root, self.tables[name], upto)

    def compact(self, name: str, upto: int, buckets: int | None = None) -> None:
        """Fold a table's batches up to a committed one into a base layer."""
        compact(self.spark, self.root, self.tables[name], upto, buckets)

    def expire(self, name: str, before: int) -> None:
        """Remove the files that the newest base layer up to ``before`` replaces."""
        expire(self.spark, self.root, self.tables[name], before)


def start_configured(
    spark: SparkSession,
    settings: Settings,
    registry: DataFrame,
    checkpoint: str,
    *,
    source: KafkaSource | ReplaySource | None = None,
    codec: str = "avro",
    framed: bool = True,
) -> tuple[TopicPipeline, StreamingQuery]:
    """Start all streams of the settings, on their brokers unless a source is given."""
    topics = list(dict.fromkeys(s.topic for s in settings.streams))
    work = TopicPipeline(
        spark,
        list(settings.streams),
        contracts(registry, topics, codec=codec, framed=framed),
        settings.root,
        sizing=settings.sizing,
    )
    rows = stream_topics(spark, source or settings.source())
    return work, work.start(rows, checkpoint, every_seconds=settings.batch_seconds)


def committed_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """The last batch a checkpoint knows to be complete.

    Add the pipeline's ``first_batch_id`` to read or compact its tables as of it.
    """
    done = numbered_children(spark, f"{checkpoint}/commits", "")
    return done[-1] if done else None
