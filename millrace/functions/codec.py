"""Payload bytes to typed columns and back, and the registry frame around them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The wire formats.
FRAME_MAGIC = b"\x00"
FRAME_BYTES = 5
# The default patterns cut microseconds on writing; reading takes any precision.
JSON_WRITE_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "ignoreNullFields": "false",
}
# Receives the text of a payload that does not fit its schema.
UNPARSED = "_unparsed"


def to_json_bytes(record: Column) -> Column:
    """A struct as UTF-8 JSON, nulls written out."""
    return F.to_json(record, JSON_WRITE_OPTIONS).cast("binary")


def from_json_bytes(payload: Column, struct: T.StructType, mode: str = "PERMISSIVE") -> Column:
    """JSON bytes as a struct: fields by name, absent ones null, extra ones dropped.

    In PERMISSIVE mode the struct has one more field, ``_unparsed``, set when
    the payload is malformed or a value does not have the declared type. Text
    behind the first value makes the whole null.
    """
    options = {"mode": mode}
    if mode == "PERMISSIVE":
        struct = T.StructType([*struct.fields, T.StructField(UNPARSED, T.StringType())])
        options["columnNameOfCorruptRecord"] = UNPARSED
    text = payload.cast("string")
    return F.when(is_one_value(text), F.from_json(text, struct, options))


def is_one_value(text: Column) -> Column:
    """Whether a text is one JSON value and nothing else; the parser stops behind the first.

    Where the first closing brace ends the text, nothing can stand behind an object, and
    what is no object is rejected anyway. Other texts are parsed once more.
    """
    flat = F.instr(text, "}") == F.char_length(text)
    return F.when(flat, F.lit(True)).otherwise(
        F.json_array_length(F.concat(F.lit("["), text, F.lit(",0]"))) == 2
    )


def from_avro_bytes(payload: Column, writer_schema: str, mode: str = "PERMISSIVE") -> Column:
    """Avro body bytes decoded by the schema they were written with."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(payload, writer_schema, {"mode": mode})


def to_avro_bytes(record: Column, schema: str) -> Column:
    from pyspark.sql.avro.functions import to_avro

    return to_avro(record, schema)


def frame(body: Column, schema_id: int | Column) -> Column:
    """Magic byte, four-byte schema id, body."""
    if isinstance(schema_id, int):
        return F.concat(F.lit(FRAME_MAGIC + schema_id.to_bytes(4, "big")), body)
    four = F.unhex(F.lpad(F.hex(schema_id.cast("bigint")), 8, "0"))
    return F.concat(F.lit(FRAME_MAGIC), four, body)


def frame_id_sql(value: str) -> str:
    """The schema id of a framed value; wide enough for any four bytes."""
    return f"CAST(conv(hex(substring({value}, 2, 4)), 16, 10) AS BIGINT)"


def is_framed_sql(value: str) -> str:
    magic = f"X'{FRAME_MAGIC.hex()}'"
    return f"(length({value}) >= {FRAME_BYTES} AND substring({value}, 1, 1) = {magic})"


def frame_body_sql(value: str) -> str:
    return f"substring({value}, {FRAME_BYTES + 1})"


def frame_id(value: str) -> Column:
    return F.expr(frame_id_sql(value))


def is_framed(value: str) -> Column:
    return F.expr(is_framed_sql(value))


def frame_body(value: str) -> Column:
    return F.expr(frame_body_sql(value))
