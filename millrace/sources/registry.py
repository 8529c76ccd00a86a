"""Schemas by topic, from a snapshot table of the schema registry.

The snapshot has one row per registered schema version:
``subject string, version int, id int, schema string``, where a topic's
subjects are ``<topic>-key`` and ``<topic>-value`` and ``schema`` is Avro JSON.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT = (
    T.StructType()
    .add("subject", T.StringType())
    .add("version", T.IntegerType())
    .add("id", T.IntegerType())
    .add("schema", T.StringType())
)

# Avro type names and the Spark types they stand for.
PRIMITIVES = {
    "null": T.NullType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
    "enum": T.StringType(),
    "fixed": T.BinaryType(),
}
NAMED = ("record", "enum", "fixed")
LOGICAL = {
    "date": T.DateType(),
    "timestamp-millis": T.TimestampType(),
    "timestamp-micros": T.TimestampType(),
    "local-timestamp-millis": T.TimestampNTZType(),
    "local-timestamp-micros": T.TimestampNTZType(),
}


@dataclass(frozen=True)
class TopicContract:
    """How one topic's payload is typed for a run.

    ``struct`` is the latest schema, all columns nullable. ``writers`` maps
    every known schema id to its Avro JSON; it is needed for framed values.
    With ``resolve`` values of every writer are read by the latest schema as Avro
    does it: with its defaults, aliases and wider types; otherwise fields
    go by name and absent ones are null.
    """

    topic: str
    struct: T.StructType
    codec: str = "json"
    framed: bool = False
    writers: dict[int, str] = field(default_factory=dict)
    latest_id: int | None = None
    resolve: bool = False

    def __post_init__(self):
        if self.resolve and not self.framed:
            raise ValueError(f"topic {self.topic}: only framed values name the schema to resolve")
        if self.codec not in ("json", "avro"):
            raise ValueError(f"codec must be json or avro, not {self.codec!r}")
        if (self.framed or self.codec == "avro") and self.latest_id not in self.writers:
            raise ValueError(f"topic {self.topic}: the latest schema id must be among the writers")

    @property
    def schema(self) -> str | None:
        """The latest schema as Avro JSON, where known."""
        return self.writers.get(self.latest_id)


def resolved(schema, space: str | None = None, known: dict | None = None):
    """A parsed Avro schema in which every type name is replaced by its definition.

    Definitions get ``fullname``. Names are looked up in their namespace first,
    which nested types inherit. A type that contains itself has no Spark type
    and is refused, as is a name that nothing defines.
    """
    known = {} if known is None else known
    if isinstance(schema, list):
        return [resolved(s, space, known) for s in schema]
    if isinstance(schema, str):
        full = f"{space}.{schema}" if space and "." not in schema else schema
        if full not in known and schema in PRIMITIVES and schema not in NAMED:
            return schema
        found = known.get(full, known.get(schema, ...))
        if found is ...:
            raise ValueError(f"no definition of the type {schema!r}")
        if found is None:
            raise ValueError(f"the type {schema!r} contains itself")
        return found
    kind = schema["type"]
    if not isinstance(kind, str):
        return resolved(kind, space, known)
    if kind in NAMED:
        name = schema["name"]
        inside = name.rpartition(".")[0] if "." in name else schema.get("namespace", space)
        name = name.rpartition(".")[2]
        full = f"{inside}.{name}" if inside else name
        known[full] = None
        made = schema | {"name": name, "fullname": full}
        if kind == "record":
            fields = [f | {"type": resolved(f["type"], inside, known)} for f in schema["fields"]]
            made["fields"] = fields
        known[full] = made
        return made
    for part in ("items", "values"):
        if part in schema:
            schema = schema | {part: resolved(schema[part], space, known)}
    if kind not in PRIMITIVES and kind not in ("array", "map"):
        return resolved(kind, space, known)
    return schema


def spark_type(schema) -> T.DataType:
    """The Spark type of a parsed and resolved Avro schema."""
    if isinstance(schema, str):
        return PRIMITIVES[schema]
    if isinstance(schema, list):
        branches = [b for b in schema if b != "null"]
        if len(branches) == 1:
            return spark_type(branches[0])
        if set(map(str, branches)) == {"int", "long"}:
            return T.LongType()
        if set(map(str, branches)) == {"float", "double"}:
            return T.DoubleType()
        members = [spark_type(b) for b in branches]
        return T.StructType([T.StructField(f"member{i}", m) for i, m in enumerate(members)])
    kind, logical = schema["type"], schema.get("logicalType")
    if logical == "decimal":
        return T.DecimalType(schema["precision"], schema.get("scale", 0))
    if logical in LOGICAL:
        return LOGICAL[logical]
    if kind == "record":
        return T.StructType([T.StructField(f["name"], spark_type(f["type"])) for f in schema["fields"]])
    if kind == "array":
        return T.ArrayType(spark_type(schema["items"]))
    if kind == "map":
        return T.MapType(T.StringType(), spark_type(schema["values"]))
    return PRIMITIVES[kind]


def required_fields(avro_json: str) -> list[str]:
    """Top-level fields that must have a value."""
    fields = json.loads(avro_json)["fields"]
    return [
        f["name"]
        for f in fields
        if f["type"] != "null" and not (isinstance(f["type"], list) and "null" in f["type"])
    ]


def struct_of(avro_json: str) -> T.StructType:
    """The columns of a record schema, by name, every one nullable."""
    found = spark_type(resolved(json.loads(avro_json)))
    if not isinstance(found, T.StructType):
        raise ValueError("the top level of a topic schema must be a record")
    return found


def contracts(
    snapshot: DataFrame,
    topics: list[str],
    side: str = "value",
    codec: str = "json",
    framed: bool = False,
    resolve: bool = False,
) -> dict[str, TopicContract]:
    """Contract by topic, from the latest version of each subject.

    Brings the registered versions of these topics to the driver and no more. With
    ``resolve`` a version that the latest schema cannot read is refused when
    the contract is first used.
    """
    subjects = {f"{t}-{side}": t for t in topics}
    entries = snapshot.filter(F.col("subject").isin(*subjects)).select(*SNAPSHOT.fieldNames())
    versions: dict[str, list] = {}
    for row in sorted(entries.collect(), key=lambda r: r.version):
        versions.setdefault(subjects[row.subject], []).append(row)
    by_topic = {}
    for topic, rows in versions.items():
        by_topic[topic] = TopicContract(
            topic=topic,
            struct=struct_of(rows[-1].schema),
            codec=codec,
            framed=framed,
            writers={r.id: r.schema for r in rows},
            latest_id=rows[-1].id,
            resolve=resolve,
        )
    missing = sorted(set(topics) - set(by_topic))
    if missing:
        raise ValueError(f"no {side} schema registered for {missing}")
    return by_topic


def matching_ids(
    source: DataFrame, target: DataFrame, topic: str, target_topic: str, side: str = "value"
) -> dict[int, int]:
    """Schema ids of one registry by those of another: each version of a topic's
    schema with the newest equal one of the target topic.

    Schemas are equal if their JSON is, whatever its layout. Versions that the
    target does not have are missing. Both snapshots' versions of one subject
    come to the driver.
    """

    def versions(snapshot: DataFrame, name: str) -> list:
        rows = snapshot.filter(F.col("subject") == f"{name}-{side}").select("version", "id", "schema")
        return sorted(rows.collect(), key=lambda r: r.version)

    plain = lambda text: json.dumps(json.loads(text), sort_keys=True)
    there = {plain(r.schema): r.id for r in versions(target, target_topic)}
    return {r.id: there[plain(r.schema)] for r in versions(source, topic) if plain(r.schema) in there}
