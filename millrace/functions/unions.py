"""Avro's JSON form of records, where a union value names its branch.

``{"name": {"string": "x"}}`` stands for a nullable string, and bytes are text
of the code points 0 to 255. Such text is parsed by a wider type, in which a
union is a map from branch name to value, and then projected onto the plain
one. Values whose branch is not one of the union's are told apart.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.registry import resolved, spark_type

@dataclass(frozen=True)
class Tagged:
    """The type that parses a value, the way from it to the plain one, and whether it is wrong."""

    parsed: T.DataType
    untag: Callable[[Column], Column]
    wrong: Callable[[Column], Column]


def _plain(kind: T.DataType) -> Tagged:
    return Tagged(kind, lambda v: v, lambda v: F.lit(False))


def _branch_name(schema) -> str:
    if isinstance(schema, str):
        return schema
    return schema.get("fullname", schema["type"])


def _bytes() -> Tagged:
    beyond = "[^\\x{0}-\\x{ff}]"
    return Tagged(
        T.StringType(),
        lambda v: F.encode(v, "ISO-8859-1"),
        lambda v: F.coalesce(v.rlike(beyond), F.lit(False)),
    )


def _record(schema: dict) -> Tagged:
    parts = {f["name"]: _tagged(f["type"]) for f in schema["fields"]}

    def untag(value: Column) -> Column:
        fields = [p.untag(value.getField(n)).alias(n) for n, p in parts.items()]
        return F.when(value.isNotNull(), F.struct(*fields))

    def wrong(value: Column) -> Column:
        found = F.lit(False)
        for name, part in parts.items():
            found = found | part.wrong(value.getField(name))
        return found

    return Tagged(T.StructType([T.StructField(n, p.parsed) for n, p in parts.items()]), untag, wrong)


def _branch_of_text(part: Tagged, text: Column) -> Column:
    """One branch's value from its JSON text."""
    if isinstance(part.parsed, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(text, part.parsed, {"mode": "PERMISSIVE"})
    return text.try_cast(part.parsed)


def _union(schema: list) -> Tagged:
    branches = {_branch_name(b): _tagged(b) for b in schema if b != "null"}
    one = next(iter(branches.values())) if len(branches) == 1 else None
    inner = one.parsed if one else T.StringType()

    def of(value: Column, name: str) -> Column:
        found = F.try_element_at(value, F.lit(name))
        return found if one else _branch_of_text(branches[name], found)

    def untag(value: Column) -> Column:
        values = [part.untag(of(value, n)) for n, part in branches.items()]
        if len(values) == 1:
            return values[0]
        plain = spark_type(schema)
        if not isinstance(plain, T.StructType) or "member0" not in plain.names:
            return F.coalesce(*[v.cast(plain) for v in values])
        named = [v.alias(f"member{i}") for i, v in enumerate(values)]
        return F.when(value.isNotNull(), F.struct(*named))

    def wrong(value: Column) -> Column:
        known = F.array(*[F.lit(n) for n in branches])
        strange = (F.size(F.map_keys(value)) != 1) | (
            F.size(F.array_except(F.map_keys(value), known)) > 0
        )
        for name, part in branches.items():
            named = F.map_contains_key(value, name)
            read = of(value, name)
            strange = strange | (named & read.isNull()) | (named & part.wrong(read))
        return F.coalesce(value.isNotNull() & strange, F.lit(False))

    return Tagged(T.MapType(T.StringType(), inner), untag, wrong)


def _tagged(schema) -> Tagged:
    if isinstance(schema, list):
        return _union(schema)
    kind = schema["type"] if isinstance(schema, dict) else schema
    if kind == "record":
        return _record(schema)
    if kind == "array":
        part = _tagged(schema["items"])
        return Tagged(
            T.ArrayType(part.parsed),
            lambda v: F.transform(v, part.untag),
            lambda v: F.coalesce(F.exists(v, part.wrong), F.lit(False)),
        )
    if kind == "map":
        part = _tagged(schema["values"])
        return Tagged(
            T.MapType(T.StringType(), part.parsed),
            lambda v: F.transform_values(v, lambda _, x: part.untag(x)),
            lambda v: F.coalesce(F.exists(F.map_values(v), part.wrong), F.lit(False)),
        )
    if kind in ("bytes", "fixed") and not (isinstance(schema, dict) and "logicalType" in schema):
        return _bytes()
    return _plain(spark_type(schema))


def tagged_form(avro_json: str) -> Tagged:
    """How tagged text of a record schema is read."""
    return _tagged(resolved(json.loads(avro_json)))
