"""Declarations of streams, tables, replicas and run settings."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from millrace.functions.text import split_values
from millrace.operators.sizing import Sizing
from millrace.sources.topics import KafkaSource


def _names(value) -> tuple[str, ...]:
    return (value,) if isinstance(value, str) else tuple(value or ())


@dataclass(frozen=True)
class StreamDef:
    """One topic's way into one table.

    The rows are ``SELECT <transform> FROM <topic view> WHERE <filter>``, or a
    whole statement in ``sql``. ``key`` are the table's key columns; of rows
    with equal keys in one batch the greatest by ``order_by`` wins.
    """

    name: str
    topic: str
    table: str
    key: tuple[str, ...]
    transform: str = "*"
    filter: str = "1=1"
    sql: str | None = None
    order_by: tuple[str, ...] = ("_offset",)

    def __post_init__(self):
        object.__setattr__(self, "key", _names(self.key))
        object.__setattr__(self, "order_by", _names(self.order_by))
        if not self.key:
            raise ValueError(f"stream {self.name}: key is empty")
        if not self.order_by:
            raise ValueError(f"stream {self.name}: order_by is empty")
        if self.sql is None and not self.transform.strip():
            raise ValueError(f"stream {self.name}: transform is blank")
        if self.sql is None and not self.filter.strip():
            raise ValueError(f"stream {self.name}: filter is blank")
        if not self.name.replace("_", "").replace("-", "").isalnum():
            raise ValueError(f"stream name {self.name!r}: use letters, digits, _ and -")
        if not self.table or "/" in self.table:
            raise ValueError(f"stream {self.name}: {self.table!r} is no table name")


@dataclass(frozen=True)
class TableDef:
    """A destination table and the streams that feed it, in their run order."""

    name: str
    key: tuple[str, ...]
    streams: tuple[StreamDef, ...]

    @property
    def order_width(self) -> int:
        return max(len(s.order_by) for s in self.streams)


def tables_of(streams: list[StreamDef]) -> dict[str, TableDef]:
    """The tables named by the streams; streams of one table share its key."""
    found: dict[str, TableDef] = {}
    for name in dict.fromkeys(s.table for s in streams):
        feeding = tuple(s for s in streams if s.table == name)
        keys = {s.key for s in feeding}
        if len(keys) > 1:
            raise ValueError(f"table {name}: its streams name different keys {sorted(keys)}")
        found[name] = TableDef(name, feeding[0].key, feeding)
    return found


@dataclass(frozen=True)
class ReplicaDef:
    """A filtered copy of one topic into another.

    ``values`` is a list, or text split on commas without trimming. ``null``
    among them matches null and missing fields unless ``match_null`` is off.
    ``target_schema_id`` is the id that values get in the target's registry:
    one for all, or by the id of their writer (see ``registry.matching_ids``),
    where values of other writers count as malformed.
    """

    topic: str
    target: str
    field: str
    values: tuple[str, ...] | str
    match_null: bool = True
    keep_key: bool = False
    on_malformed: str = "fail"
    target_schema_id: int | Mapping[int, int] | None = None

    def __post_init__(self):
        object.__setattr__(self, "values", tuple(split_values(self.values)))
        if self.on_malformed not in ("fail", "skip"):
            raise ValueError("on_malformed must be fail or skip")


@dataclass(frozen=True)
class Settings:
    """What a pipeline run needs besides its streams."""

    brokers: str = ""
    start: str = "latest"
    group: str | None = None
    batch_seconds: int = 15
    sizing: Sizing | None = None
    root: str = ""
    streams: tuple[StreamDef, ...] = field(default=())

    def source(self, **options) -> KafkaSource:
        topics = tuple(dict.fromkeys(s.topic for s in self.streams))
        return KafkaSource(self.brokers, topics, self.start, self.group, **options)


def settings_from(config: dict) -> Settings:
    """Settings from the nested ``app`` dictionary of a pipeline's config.

    Fixed values: the names of the keys, also the misspelt one, are those of
    existing configs. Each entry of ``streams`` has ``srcTopic, destTable, transform, filter``
    and, beyond them, ``key``, ``order_by`` and optionally ``name`` and ``sql``.
    """
    app = config["app"]
    kafka, spark = app.get("kafka", {}), app.get("spark", {})
    limits = spark.get("partition")
    streams = []
    for entry in app["streams"]:
        topic, table = entry["srcTopic"], entry["destTable"]
        optional = {k: entry[k] for k in ("transform", "filter", "sql", "order_by") if k in entry}
        name = entry.get("name") or f"{topic}-{table}".replace(".", "_")
        streams.append(StreamDef(name, topic, table, entry["key"], **optional))
    return Settings(
        brokers=kafka.get("broker", ""),
        start=kafka.get("autoResetOffest", "latest"),
        group=kafka.get("groupID"),
        batch_seconds=spark.get("batchDur", 15),
        sizing=Sizing(limits["maxRecordCount"], limits["count"]) if limits else None,
        root=app.get("logdir", ""),
        streams=tuple(streams),
    )


def replica_from(config: dict) -> tuple[ReplicaDef, KafkaSource, str]:
    """A replica, its source and its target brokers from an ``app`` dictionary."""
    app = config["app"]
    replica = ReplicaDef(
        topic=app["from"]["topic"],
        target=app["to"]["topic"],
        field=app["filter"]["field"],
        values=app["filter"]["values"],
    )
    source = KafkaSource(app["from"]["cluster"], (replica.topic,), "earliest", app.get("id"))
    return replica, source, app["to"]["cluster"]
