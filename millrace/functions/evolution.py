"""Values of one schema version read by another, as Avro's schema resolution has it.

A writer's and a reader's schema are compared once, on the driver; what comes of it
is an expression from the writer's columns to the reader's. Fields go by name or by the
reader's aliases, absent ones take the reader's default, numbers are widened, an unknown
enum symbol becomes the reader's default symbol, and a union's value goes to the first
branch that can take it. Schemas that never fit are refused; a value that does not fit,
such as a null where the reader has none, is told apart.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.registry import NAMED, resolved, spark_type

# To which types a written one may be widened.
PROMOTIONS = {
    "int": ("long", "float", "double"),
    "long": ("float", "double"),
    "float": ("double",),
    "string": ("bytes",),
    "bytes": ("string",),
}
_UNITS = {"timestamp-millis": "millis", "timestamp-micros": "micros"}
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


class SchemaMismatch(ValueError):
    """No value of the writer's schema has a place in the reader's."""


@dataclass(frozen=True)
class Resolution:
    """The reader's value of a written one, and whether there is none."""

    value: Callable[[Column], Column]
    wrong: Callable[[Column], Column]


def _fine(value: Callable[[Column], Column]) -> Resolution:
    return Resolution(value, lambda v: F.lit(False))


def _any(found: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, found, F.lit(False))


def _kind(schema) -> str:
    return "union" if isinstance(schema, list) else schema["type"] if isinstance(schema, dict) else schema


def _logical(schema) -> str | None:
    return schema.get("logicalType") if isinstance(schema, dict) else None


def _bare(name: str) -> str:
    return name.rpartition(".")[2]


def _same_name(writer: dict, reader: dict) -> bool:
    """Whether two named types are one: by the name without its namespace, or by the reader's aliases."""
    known = {_bare(reader["name"]), *map(_bare, reader.get("aliases", ()))}
    return _bare(writer["name"]) in known


# --- logical types --------------------------------------------------------------------


def _plain(value: Column, schema) -> Column:
    """A column of a logical type as the number it was written as."""
    logical = _logical(schema)
    if logical == "date":
        return F.unix_date(value)
    if logical in _UNITS:
        return getattr(F, f"unix_{_UNITS[logical]}")(value)
    if logical in ("local-timestamp-millis", "local-timestamp-micros"):
        step = "0.001" if logical.endswith("millis") else "0.000001"
        return F.call_function("div", value - F.expr(_EPOCH), F.expr(f"INTERVAL '{step}' SECOND"))
    return value


def _as_logical(value: Column, schema) -> Column:
    logical = _logical(schema)
    if logical == "date":
        return F.date_from_unix_date(value.cast("int"))
    if logical in _UNITS:
        return getattr(F, f"timestamp_{_UNITS[logical]}")(value.cast("long"))
    if logical in ("local-timestamp-millis", "local-timestamp-micros"):
        unit = "MILLISECOND" if logical.endswith("millis") else "MICROSECOND"
        return F.timestamp_add(unit, value.cast("long"), F.expr(_EPOCH))
    return value


# --- defaults -------------------------------------------------------------------------


def default_of(schema, value) -> Column:
    """A default from the schema's JSON as a column of the schema's type."""
    kind = _kind(schema)
    if kind == "union":
        branches = [b for b in schema if _accepts(b, value)]
        if not branches:
            raise ValueError(f"the default {value!r} fits no branch of {schema}")
        return _in_union(schema, branches[0], default_of(branches[0], value))
    plain = spark_type(schema)
    if kind == "null":
        return F.lit(None)
    if kind == "record":
        fields = []
        for field in schema["fields"]:
            if field["name"] not in value and "default" not in field:
                raise ValueError(f"the default of {schema['name']} lacks {field['name']}")
            own = value.get(field["name"], field.get("default"))
            fields.append(default_of(field["type"], own).cast(spark_type(field["type"])).alias(field["name"]))
        return F.struct(*fields)
    if kind == "array":
        return F.array(*[default_of(schema["items"], v) for v in value]).cast(plain)
    if kind == "map":
        parts = [p for k, v in value.items() for p in (F.lit(k), default_of(schema["values"], v))]
        return (F.create_map(*parts) if parts else F.create_map()).cast(plain)
    if _logical(schema) == "decimal":
        unscaled = int.from_bytes(value.encode("latin-1"), "big", signed=True)
        return F.lit(Decimal(unscaled).scaleb(-schema.get("scale", 0))).cast(plain)
    if kind in ("bytes", "fixed"):
        return F.lit(value.encode("latin-1"))
    if _logical(schema):
        return _as_logical(F.lit(value), schema)
    return F.lit(value).cast(plain)


def _accepts(schema, value) -> bool:
    """Whether a JSON value may stand for a type."""
    kind = _kind(schema)
    if kind in ("int", "long"):
        return isinstance(value, int) and not isinstance(value, bool)
    if kind in ("float", "double"):
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    known = {"null": type(None), "boolean": bool, "record": dict, "map": dict, "array": list}
    if kind == "enum":
        return value in schema["symbols"]
    return isinstance(value, known.get(kind, str))


# --- unions ---------------------------------------------------------------------------


def _branches(schema: list) -> list:
    """The branches of a union that have columns of their own; one if they share a column."""
    found = [b for b in schema if b != "null"]
    plain = spark_type(schema)
    shared = {"bigint": "long", "double": "double"}.get(plain.simpleString())
    return [shared] if len(found) > 1 and shared else found


def _in_union(schema: list, branch, value: Column) -> Column:
    """A branch's value in the union's column."""
    plain, branches = spark_type(schema), _branches(schema)
    if branch == "null":
        return F.lit(None).cast(plain)
    if len(branches) == 1:
        return value.cast(plain) if not isinstance(plain, T.StructType) else value
    members = [
        (value if b is branch or b == branch else F.lit(None)).cast(spark_type(b)).alias(f"member{i}")
        for i, b in enumerate(branches)
    ]
    return F.when(value.isNotNull(), F.struct(*members))


def _from_union(writer: list, reader) -> Resolution:
    """Each written branch has a way of its own; one that has none is wrong where it occurs."""
    branches = _branches(writer)
    takes_null = "null" in reader if isinstance(reader, list) else reader == "null"
    ways: list[tuple[Callable[[Column], Column], Resolution | None]] = []
    for i, branch in enumerate(branches):
        of = (lambda v, i=i: v.getField(f"member{i}")) if len(branches) > 1 else (lambda v: v)
        try:
            ways.append((of, _resolution(branch, reader)))
        except SchemaMismatch:
            ways.append((of, _narrow(writer, branch, reader)))
    if not any(way for _, way in ways) and not ("null" in writer and takes_null):
        raise SchemaMismatch(f"no branch of {writer} fits {reader}")
    plain = spark_type(reader)

    def value(v: Column) -> Column:
        found = [F.when(of(v).isNotNull(), way.value(of(v))) for of, way in ways if way]
        return F.coalesce(*[f.cast(plain) if not isinstance(plain, T.StructType) else f for f in found]) if found else F.lit(None).cast(plain)

    def wrong(v: Column) -> Column:
        found = [of(v).isNotNull() & (way.wrong(of(v)) if way else F.lit(True)) for of, way in ways]
        if "null" in writer and not takes_null:
            found.append(v.isNull())
        return _any(found)

    return Resolution(value, wrong)


def _narrow(writer: list, branch, reader) -> Resolution | None:
    """The way of ints that share a column with longs; what is no int was no int."""
    if branch != "long" or "int" not in writer:
        return None
    try:
        way = _resolution("int", reader)
    except SchemaMismatch:
        return None
    return Resolution(lambda v: way.value(v.try_cast("int")), lambda v: v.try_cast("int").isNull())


def _to_union(writer, reader: list) -> Resolution:
    """The first branch of the written type or, without one, the first it can be widened to."""
    if writer == "null":
        if "null" not in reader:
            raise SchemaMismatch(f"{reader} takes no null")
        return _fine(lambda v: F.lit(None).cast(spark_type(reader)))
    candidates = [b for b in _branches(reader) if b != "null"]
    same = [b for b in candidates if _kind(b) == _kind(writer)]
    for branch in [*same, *[b for b in candidates if b not in same]]:
        try:
            way = _resolution(writer, branch)
        except SchemaMismatch:
            continue
        return Resolution(lambda v, b=branch, w=way: _in_union(reader, b, w.value(v)), way.wrong)
    raise SchemaMismatch(f"{writer} fits no branch of {reader}")


# --- types ----------------------------------------------------------------------------


def _record(writer: dict, reader: dict, top: bool = False) -> Resolution:
    if not top and not _same_name(writer, reader):
        raise SchemaMismatch(f"record {writer['name']} is not {reader['name']}")
    written = {f["name"]: f["type"] for f in writer["fields"]}
    ways: dict[str, tuple[str, Resolution] | Column] = {}
    for field in reader["fields"]:
        found = next((n for n in (field["name"], *field.get("aliases", ())) if n in written), None)
        if found is not None:
            try:
                ways[field["name"]] = (found, _resolution(written[found], field["type"]))
            except SchemaMismatch as error:
                raise SchemaMismatch(f"field {field['name']}: {error}") from error
        elif "default" in field:
            ways[field["name"]] = default_of(field["type"], field["default"]).cast(spark_type(field["type"]))
        else:
            raise SchemaMismatch(f"field {field['name']} is not written and has no default")

    def value(v: Column) -> Column:
        fields = [
            (w if isinstance(w, Column) else w[1].value(v.getField(w[0]))).alias(n) for n, w in ways.items()
        ]
        return F.when(v.isNotNull(), F.struct(*fields))

    def wrong(v: Column) -> Column:
        return _any([w[1].wrong(v.getField(w[0])) for w in ways.values() if not isinstance(w, Column)])

    return Resolution(value, lambda v: v.isNotNull() & wrong(v))


def _enum(writer: dict, reader: dict) -> Resolution:
    if not _same_name(writer, reader):
        raise SchemaMismatch(f"enum {writer['name']} is not {reader['name']}")
    unknown = [s for s in writer["symbols"] if s not in reader["symbols"]]
    if not unknown:
        return _fine(lambda v: v)
    if "default" in reader:
        return _fine(lambda v: F.when(v.isin(unknown), F.lit(reader["default"])).otherwise(v))
    return Resolution(lambda v: v, lambda v: F.coalesce(v.isin(unknown), F.lit(False)))


def _primitive(writer, reader) -> Resolution:
    have, want = _kind(writer), _kind(reader)
    decimals = [s for s in (writer, reader) if _logical(s) == "decimal"]
    if decimals:
        terms = [(s["precision"], s.get("scale", 0)) for s in decimals]
        if len(set(terms)) > 1 or len(decimals) == 1 or have != want:
            raise SchemaMismatch(f"{writer} and {reader} are not one decimal")
        return _fine(lambda v: v)
    if have != want and want not in PROMOTIONS.get(have, ()):
        raise SchemaMismatch(f"{have} does not fit {want}")
    if _logical(writer) == _logical(reader) and have == want:
        return _fine(lambda v: v)
    if have in ("string", "bytes"):
        return _fine(lambda v: v.cast(spark_type(reader)))
    return _fine(lambda v: _as_logical(_plain(v, writer).cast(spark_type(want)), reader))


def _resolution(writer, reader, top: bool = False) -> Resolution:
    if isinstance(writer, list):
        return _from_union(writer, reader)
    if isinstance(reader, list):
        return _to_union(writer, reader)
    have, want = _kind(writer), _kind(reader)
    if have == want == "record":
        return _record(writer, reader, top)
    if have == want == "enum":
        return _enum(writer, reader)
    if have == want == "array":
        way = _resolution(writer["items"], reader["items"])
        return Resolution(
            lambda v: F.transform(v, lambda x: way.value(x)),
            lambda v: F.coalesce(F.exists(v, lambda x: way.wrong(x)), F.lit(False)),
        )
    if have == want == "map":
        way = _resolution(writer["values"], reader["values"])
        return Resolution(
            lambda v: F.transform_values(v, lambda _, x: way.value(x)),
            lambda v: F.coalesce(F.exists(F.map_values(v), lambda x: way.wrong(x)), F.lit(False)),
        )
    if have == want == "fixed" and not (_same_name(writer, reader) and writer["size"] == reader["size"]):
        raise SchemaMismatch(f"fixed {writer['name']} is not {reader['name']}")
    if have in NAMED and want in NAMED and have != want:
        raise SchemaMismatch(f"{have} does not fit {want}")
    if have == want == "null":
        return _fine(lambda v: v)
    return _primitive(writer, reader)


def resolution(writer: str, reader: str, fields: list[str] | None = None) -> Resolution:
    """From a record written by one Avro JSON schema to the columns of another's.

    With ``fields`` the reader's record has these alone. Records at the top may have
    different names, as a topic has one kind of record. Raises ``SchemaMismatch`` if
    no value of the writer could be read.
    """
    wanted = resolved(json.loads(reader))
    if fields is not None:
        wanted = wanted | {"fields": [f for f in wanted["fields"] if f["name"] in fields]}
    return _resolution(resolved(json.loads(writer)), wanted, top=True)


def written_fields(writer: str, reader: str, fields: list[str]) -> list[str]:
    """The writer's fields from which the reader's fields are made."""
    written = [f["name"] for f in json.loads(writer)["fields"]]
    found = []
    for field in json.loads(reader)["fields"]:
        if field["name"] in fields:
            names = (field["name"], *field.get("aliases", ()))
            found += [n for n in names if n in written][:1]
    return [n for n in written if n in found]
