"""Topic rows to typed rows: unframe, decode, project by name, split off rejects."""

from __future__ import annotations

import copy
import dataclasses
from collections.abc import Callable, Collection, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import codec
from millrace.functions.evolution import resolution, written_fields
from millrace.functions.text import literal, name
from millrace.sources.registry import TopicContract, required_fields, struct_of

NULL_VALUE = "null_value"
BAD_ENVELOPE = "bad_envelope"
UNKNOWN_SCHEMA = "unknown_schema"
BAD_PAYLOAD = "bad_payload"

REASON = "_reason"
RAW = "_raw"
SOURCE_COLUMNS = ("_partition", "_offset", "_timestamp")


def conform(table: DataFrame, struct: T.StructType) -> DataFrame:
    """A typed table in the columns of ``struct``, matched by exact name.

    Absent columns are null, extra ones go. A bigint read as a decimal keeps
    its integer value; a value that does not fit its type becomes null.
    """
    present = {f.name: f.dataType for f in table.schema}
    return table.select(
        *[
            _coerced(F.col(f"`{f.name}`"), present[f.name], f.dataType).alias(f.name)
            if f.name in present
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in struct
        ]
    )


def _coerced(value: Column, found: T.DataType, wanted: T.DataType) -> Column:
    return value if found == wanted else value.try_cast(wanted)


def topic_rows_of(rows: DataFrame, topic: str) -> DataFrame:
    """The rows of one topic. The test reaches the scan of replayed files."""
    return rows.filter(F.col("topic") == topic)


def _envelope_problem(contract: TopicContract) -> str:
    cases = f"WHEN value IS NULL THEN '{NULL_VALUE}'"
    if contract.framed:
        known = ", ".join(str(i) for i in contract.writers)
        cases += f" WHEN NOT {codec.is_framed_sql('value')} THEN '{BAD_ENVELOPE}'"
        cases += f" WHEN {codec.frame_id_sql('value')} NOT IN ({known}) THEN '{UNKNOWN_SCHEMA}'"
    return f"CASE {cases} END"


def _by_writer(body: Column, contract: TopicContract) -> Column:
    """Avro bytes decoded by the schema each row was written with.

    Every branch projects the writer's fields onto the contract by name, so
    that all have the contract's type.
    """
    def one(schema: str) -> Column:
        written = struct_of(schema)

        def project(record: Column) -> Column:
            fields = [
                _coerced(record.getField(f.name), written[f.name].dataType, f.dataType).alias(f.name)
                if f.name in written.fieldNames()
                else F.lit(None).cast(f.dataType).alias(f.name)
                for f in contract.struct
            ]
            return F.when(record.isNotNull(), F.struct(*fields))

        # the lambda's variable holds the record, so that all fields share one decoding
        return F.get(F.transform(F.array(codec.from_avro_bytes(body, schema)), project), 0)

    if not contract.framed:
        return one(contract.writers[contract.latest_id])
    return _one_of(contract, one)


def _one_of(contract: TopicContract, one: Callable[[str], Column]) -> Column:
    """A framed value by the schema that its frame names."""
    decoded = None
    for schema_id, schema in contract.writers.items():
        hit = codec.frame_id("value") == schema_id
        decoded = F.when(hit, one(schema)) if decoded is None else decoded.when(hit, one(schema))
    return decoded


def _resolved(body: Column, contract: TopicContract) -> Column:
    """Values read by their writer's schema and resolved to the contract's.

    Of JSON the fields are parsed that the contract's come from. A value that has no
    place in the contract's schema makes the record null, and so a reject.
    """
    wanted = contract.struct.fieldNames()

    def one(schema: str) -> Column:
        way = resolution(schema, contract.schema, wanted)
        if contract.codec == "avro":
            record = codec.from_avro_bytes(body, schema)
        else:
            written = struct_of(schema)
            kept = [written[n] for n in written_fields(schema, contract.schema, wanted)]
            record = codec.from_json_bytes(body, T.StructType(kept or written.fields[:1]))

        def project(r: Column) -> Column:
            made = F.when(~way.wrong(r), way.value(r))
            return made if contract.codec == "avro" else made.withField(codec.UNPARSED, r.getField(codec.UNPARSED))

        return F.get(F.transform(F.array(record), project), 0)

    return _one_of(contract, one)


def _decoded(contract: TopicContract) -> Column:
    body = codec.frame_body("value") if contract.framed else F.col("value")
    if contract.resolve:
        return _resolved(body, contract)
    if contract.codec == "avro":
        return _by_writer(body, contract)
    return codec.from_json_bytes(body, contract.struct)


def _narrowed(contract: TopicContract, used: Mapping[str, Collection[str]] | None) -> TopicContract:
    """The contract with the used fields only; any one tells whether a payload is sound."""
    if used is None:
        return contract
    kept = [f for f in contract.struct if f.name in used.get(contract.topic, ())]
    return dataclasses.replace(contract, struct=T.StructType(kept or contract.struct.fields[:1]))


def _record_name(position: int) -> str:
    return f"_record{position}"


class TypedBatch:
    """The rows of several topics, each decoded once by its topic's contract.

    ``frame`` has the message columns, a reject reason, the value bytes of
    rejects only, and one struct column per topic that is null elsewhere. One
    frame for all topics means one pass over the source however many there are.
    With ``keep_values`` the bytes of good rows stay too. With ``used``, fields by
    topic, no others are parsed; they read as null and cannot make a reject.
    """

    def __init__(
        self,
        rows: DataFrame,
        contracts: Iterable[TopicContract],
        keep_values: bool = False,
        used: Mapping[str, Collection[str]] | None = None,
    ):
        self._whole = {c.topic: c.struct for c in contracts}
        self.contracts = {c.topic: _narrowed(c, used) for c in contracts}
        self._position = {t: i for i, t in enumerate(self.contracts)}
        envelope = self._per_topic(lambda t: _envelope_problem(self.contracts[t]))
        subscribed = rows.filter(F.col("topic").isin(*self.contracts))
        opened = subscribed.withColumn(REASON, F.expr(envelope))
        # A generator, not a projection: the optimizer would copy the parse into
        # every filter and column that uses it. This way each value is parsed once.
        records = [
            F.when(F.expr(f"topic = {literal(t)} AND {REASON} IS NULL"), _decoded(c)).alias(
                _record_name(self._position[t])
            )
            for t, c in self.contracts.items()
        ]
        parsed = opened.select("*", F.inline(F.array(F.struct(*records))))
        reason = f"coalesce({REASON}, {self._per_topic(self._payload_problem)})"
        raw = "value" if keep_values else f"CASE WHEN {reason} IS NOT NULL THEN value END"
        self.frame = parsed.selectExpr(
            "topic",
            "key",
            "partition",
            "offset",
            "timestamp",
            f"{reason} AS {REASON}",
            f"{raw} AS {RAW}",
            *[_record_name(i) for i in self._position.values()],
        )

    def over(self, frame: DataFrame) -> TypedBatch:
        """The same batch with its rows in another arrangement."""
        other = copy.copy(self)
        other.frame = frame
        return other

    def _per_topic(self, case: Callable[[str], str]) -> str:
        """SQL that is one expression for each topic."""
        branches = " ".join(f"WHEN {literal(t)} THEN {case(t)}" for t in self.contracts)
        return f"CASE topic {branches} END"

    def _payload_problem(self, topic: str) -> str:
        record = _record_name(self._position[topic])
        contract = self.contracts[topic]
        if contract.codec == "json":
            signs = [f"{record}.{codec.UNPARSED} IS NOT NULL"]
        else:
            # a malformed body decodes to nulls, also in fields that cannot be null
            writers = [contract.schema] if contract.resolve else contract.writers.values()
            needed = set.intersection(*(set(required_fields(w)) for w in writers))
            signs = [f"{record}.{name(f)} IS NULL" for f in contract.struct.names if f in needed]
        bad = " OR ".join([f"{record} IS NULL", *signs])
        return f"CASE WHEN {bad} THEN '{BAD_PAYLOAD}' END"

    def fields(self, topic: str) -> list[str]:
        """The parsed columns of one topic's records, as paths into ``frame``."""
        record = _record_name(self._position[topic])
        return [f"{record}.{name(f)}" for f in self.contracts[topic].struct.fieldNames()]

    def typed(self, topic: str, source_columns: bool = False) -> DataFrame:
        """The decoded rows of one topic, in its contract's columns.

        With ``source_columns`` also ``_partition, _offset, _timestamp``.
        """
        good = topic_rows_of(self.frame, topic).filter(f"{REASON} IS NULL")
        paths = dict(zip(self.contracts[topic].struct.fieldNames(), self.fields(topic)))
        columns = [
            F.expr(paths[f.name]) if f.name in paths else F.lit(None).cast(f.dataType).alias(f.name)
            for f in self._whole[topic]
        ]
        extra = [F.col(c.removeprefix("_")).alias(c) for c in SOURCE_COLUMNS]
        return good.select(*columns, *(extra if source_columns else []))

    def rejects(self) -> DataFrame:
        """Topic rows that cannot be typed, with the reason."""
        return self.frame.filter(f"{REASON} IS NOT NULL").selectExpr(
            "key", f"{RAW} AS value", "topic", "partition", "offset", "timestamp", REASON
        )
