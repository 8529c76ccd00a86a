"""Tables of JSON keys and values as typed, encoded topic rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import codec
from millrace.functions.unions import tagged_form
from millrace.operators.conform import REASON
from millrace.sources.registry import TopicContract, required_fields
from millrace.sources.topics import TOPIC_ROW

BAD_KEY = "bad_key"
BAD_VALUE = "bad_value"
MISSING_FIELD = "missing_field"
_KEY, _VALUE = "_key", "_value"


@dataclass(frozen=True)
class Produced:
    """Rows to send, and the input rows that do not fit with the reason."""

    rows: DataFrame
    rejects: DataFrame


def _parse(text: Column, contract: TopicContract, unions: str) -> Column:
    struct = contract.struct
    if unions == "tagged":
        struct = tagged_form(contract.schema).parsed
    return codec.from_json_bytes(F.coalesce(text, F.lit("{}")), struct)


def _plain(parsed: Column, contract: TopicContract, unions: str) -> Column:
    if unions == "tagged":
        return tagged_form(contract.schema).untag(parsed)
    return F.struct(*[parsed.getField(f.name).alias(f.name) for f in contract.struct])


def _unsound(parsed: Column, contract: TopicContract, unions: str) -> Column:
    bad = parsed.isNull() | parsed.getField(codec.UNPARSED).isNotNull()
    return bad | tagged_form(contract.schema).wrong(parsed) if unions == "tagged" else bad


def _incomplete(text: Column, record: Column, contract: TopicContract, unions: str) -> Column:
    """Whether a required field has no value or, in the tagged form, any field is left out."""
    found = F.lit(False)
    for name in required_fields(contract.schema) if contract.schema else []:
        found = found | record.getField(name).isNull()
    if unions == "tagged":
        present = F.json_object_keys(F.coalesce(text, F.lit("{}")))
        wanted = F.array(*[F.lit(n) for n in contract.struct.fieldNames()])
        found = found | (F.size(F.array_except(wanted, present)) > 0)
    return found


def encode(record: Column, contract: TopicContract) -> Column:
    """A struct as the payload bytes its contract asks for."""
    if contract.codec == "avro":
        body = codec.to_avro_bytes(record, contract.schema)
    else:
        body = codec.to_json_bytes(record)
    return codec.frame(body, contract.latest_id) if contract.framed else body


def produce(
    table: DataFrame,
    topic: str,
    key: TopicContract,
    value: TopicContract,
    *,
    key_text: str = "key",
    value_text: str = "value",
    unions: str = "plain",
    offset: Column | None = None,
) -> Produced:
    """Topic rows from two columns of JSON text; a null text reads as ``{}``.

    ``unions`` is ``plain`` for ordinary JSON, where nullable fields may be
    left out, or ``tagged`` for Avro's own JSON form, where none may. Needs no
    shuffle; each text is parsed once.
    """
    if unions not in ("plain", "tagged"):
        raise ValueError("unions must be plain or tagged")
    if unions == "tagged" and not (key.schema and value.schema):
        raise ValueError("the tagged form needs contracts with schemas")
    texts = {_KEY: (F.col(key_text), key), _VALUE: (F.col(value_text), value)}
    parses = [_parse(text, c, unions).alias(name) for name, (text, c) in texts.items()]
    parsed = table.select("*", F.inline(F.array(F.struct(*parses))))

    records = {name: _plain(F.col(name), c, unions) for name, (_, c) in texts.items()}
    short = F.lit(False)
    for name, (text, contract) in texts.items():
        short = short | _incomplete(text, records[name], contract, unions)
    reason = (
        F.when(_unsound(F.col(_KEY), key, unions), BAD_KEY)
        .when(_unsound(F.col(_VALUE), value, unions), BAD_VALUE)
        .when(short, MISSING_FIELD)
    )
    parts = {
        "key": encode(records[_KEY], key),
        "value": encode(records[_VALUE], value),
        "topic": F.lit(topic),
        "offset": F.lit(None) if offset is None else offset,
    }
    fields = [parts.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in TOPIC_ROW]
    return Produced(
        rows=parsed.filter(reason.isNull()).select(*fields),
        rejects=parsed.filter(reason.isNotNull()).select(*table.columns, reason.alias(REASON)),
    )
