"""Keyed upsert: an append-only change log and the latest-wins table over it.

Storing a batch writes its rows once, without a shuffle, into a directory that
belongs to that stream and batch, so a repeated batch replaces itself. The
table is an aggregate over the log: one shuffle on the key, reduced on the map
side first, so that a hot key sends one row per task. Compaction writes that
aggregate as a base layer, after which only later batches are read besides it.

Layout below ``root``: ``log/<table>/stream=<s>/shape=<columns>/batch_id=<n>``
and ``base/<table>/upto=<n>``. A stream's batches are kept apart by their
columns, so that each is read with its own: a column that a definition adds
begins with its first batch, and one that it drops keeps its values.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import name, names
from millrace.plans.definitions import TableDef
from millrace.sources.paths import child_names, exists, numbered_children, remove

# Names the log and the aggregate over it need for themselves.
BATCH, SHAPE, _AT, _FROM = "batch_id", "shape", "_at", "_from"
RESERVED = (BATCH, _AT, _FROM)


@dataclass(frozen=True)
class Layer:
    """Rows that write to a table, and when.

    Later ``batch``, a number or a column, beats earlier; within a batch later
    ``position``, then greater ``order_by``. Columns the frame lacks are left
    untouched.
    """

    frame: DataFrame
    batch: int | str
    position: int
    order_by: tuple[str, ...]


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _stamped(layer: Layer, number: int) -> DataFrame:
    """The layer's rows with the moment of their writing and the layer's number."""
    order = [f"{name(c)} AS order{i}" for i, c in enumerate(layer.order_by)]
    # rows equal in order_by: the same one wins in every run and retry
    known = names(f.name for f in layer.frame.schema if _hashable(f.dataType))
    at = [
        f"CAST({layer.batch} AS BIGINT) AS batch",
        f"{layer.position} AS position",
        *order,
        f"xxhash64({known}) AS tie",
    ]
    return layer.frame.selectExpr(
        *[name(c) for c in layer.frame.columns if c != BATCH],
        f"struct({', '.join(at)}) AS {_AT}",
        f"{number} AS {_FROM}",
    )


@dataclass(frozen=True)
class _Picks:
    """One row per key; per set of suppliers a struct of the columns they wrote last.

    The struct is null where none of the suppliers wrote the key.
    """

    frame: DataFrame
    members: tuple[tuple[str, ...], ...]

    def values(self) -> dict[str, tuple[str, str]]:
        """By column, in SQL: the struct it came in, and the value."""
        return {
            c: (f"_pick{i}", f"_pick{i}.{name(c)}")
            for i, columns in enumerate(self.members)
            for c in columns
        }


def _picks(layers: Sequence[Layer], key: Sequence[str]) -> _Picks:
    rows = _stamped(layers[0], 0)
    for number, layer in enumerate(layers[1:], start=1):
        rows = rows.unionByName(_stamped(layer, number), allowMissingColumns=True)

    columns = [c for c in rows.columns if c not in (_AT, _FROM, *key)]
    suppliers: dict[tuple[int, ...], list[str]] = {}
    for column in columns:
        having = tuple(i for i, x in enumerate(layers) if column in x.frame.columns)
        suppliers.setdefault(having, []).append(column)
    members = tuple(tuple(m) for m in suppliers.values())
    if not members:
        return _Picks(rows.select(*key).distinct(), members)

    everyone = tuple(range(len(layers)))
    picks = []
    for i, having in enumerate(suppliers):
        only = ""
        if having != everyone:
            only = f" FILTER (WHERE {_FROM} IN ({', '.join(map(str, having))}))"
        picks.append(F.expr(f"max_by(struct({names(members[i])}), {_AT}){only} AS _pick{i}"))
    return _Picks(rows.groupBy(*key).agg(*picks), members)


def latest_rows(layers: Sequence[Layer], key: Sequence[str]) -> DataFrame:
    """One row per key, every column as last written by a layer that has it.

    An explicit null overwrites; a column a layer does not have keeps its
    value. Columns with the same suppliers travel together, so the aggregate
    holds one ``max_by`` per distinct set of suppliers.
    """
    picks = _picks(layers, key)
    found = [f"{value} AS {name(c)}" for c, (_, value) in picks.values().items()]
    return picks.frame.selectExpr(*map(name, key), *found)


def overlay(base: DataFrame, layers: Sequence[Layer], key: Sequence[str]) -> DataFrame:
    """A table with one row per key after the layers were written to it.

    Only the layers are aggregated. The base takes part in one join on the
    key, without a shuffle where it is bucketed by it.
    """
    if not layers:
        return base
    picks = _picks(layers, key)
    written = picks.values()
    mine = {k: f"_base_{k}" for k in key}
    kept = base.withColumnsRenamed(mine)
    match = [kept[mine[k]] == picks.frame[k] for k in key]
    joined = kept.join(picks.frame, match, "full_outer")
    columns = [f"coalesce({name(k)}, {name(mine[k])}) AS {name(k)}" for k in key]
    for column in (c for c in base.columns if c not in key):
        value = name(column)
        if column in written:
            pick, new = written[column]
            value = f"CASE WHEN {pick} IS NOT NULL THEN {new} ELSE {value} END"
        columns.append(f"{value} AS {name(column)}")
    added = [f"{v} AS {name(c)}" for c, (_, v) in written.items() if c not in base.columns]
    return joined.selectExpr(*columns, *added)


def upsert_rows(
    existing: DataFrame, updates: DataFrame, key: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """``existing`` after inserting the new keys and overwriting the known ones.

    ``existing`` has one row per key; of updates with equal keys the greatest
    by ``order_by`` counts.
    """
    return overlay(existing, [Layer(updates, 0, 0, tuple(order_by))], key)


def merge_into(updates: DataFrame, table: str, key: Sequence[str], order_by: Sequence[str]) -> None:
    """The same into a catalog table whose format supports MERGE."""
    latest = latest_rows([Layer(updates, 0, 0, tuple(order_by))], key).alias("s")
    same = " AND ".join(f"{table}.{name(k)} = s.{name(k)}" for k in key)
    changes = {c: F.col(f"s.{name(c)}") for c in updates.columns}
    (
        latest.mergeInto(table, F.expr(same))
        .whenMatched()
        .update({c: v for c, v in changes.items() if c not in key})
        .whenNotMatched()
        .insert(changes)
        .merge()
    )


def log_dir(root: str, table: str, stream: str) -> str:
    return f"{root}/log/{table}/stream={stream}"


def base_dir(root: str, table: str) -> str:
    return f"{root}/base/{table}"


def _shape(schema: T.StructType) -> str:
    """A name for a set of columns and their types."""
    columns = sorted(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return hashlib.md5("\n".join(columns).encode()).hexdigest()[:12]


def _shape_dirs(spark: SparkSession, home: str) -> list[str]:
    return [f"{home}/{n}" for n in child_names(spark, home) if n.startswith(f"{SHAPE}=")]


def append_log(rows: DataFrame, root: str, table: str, stream: str, batch_id: int) -> str:
    """Store one batch of one stream; the same batch again replaces itself.

    The number of files follows the bytes, not the tasks that made the rows.
    Rows with a null in the key are stored but belong to no table. Returns where
    the batch is.
    """
    spark, home = rows.sparkSession, log_dir(root, table, stream)
    own = f"{home}/{SHAPE}=x{_shape(rows.schema)}"
    for other in _shape_dirs(spark, home):
        if other != own:
            remove(spark, f"{other}/{BATCH}={batch_id}")
    target = f"{own}/{BATCH}={batch_id}"
    rows.hint("rebalance").write.mode("overwrite").parquet(target)
    return target


def _complete(spark: SparkSession, home: str, prefix: str, after: int | None, upto: int | None) -> list[int]:
    """Numbers in the range whose write has finished; the rest is only listed."""
    return [
        n
        for n in numbered_children(spark, home, prefix)
        if (after is None or n > after)
        and (upto is None or n <= upto)
        and exists(spark, f"{home}/{prefix}{n}/_SUCCESS")
    ]


def base_version(spark: SparkSession, root: str, table: str, upto: int | None = None) -> int | None:
    """The newest complete base layer, at most ``upto``."""
    home = base_dir(root, table)
    for version in reversed(numbered_children(spark, home, "upto=")):
        if (upto is None or version <= upto) and exists(spark, f"{home}/upto={version}/_SUCCESS"):
            return version
    return None


def _bucketed_name(root: str, table: str, version: int) -> str:
    """The catalog name of a bucketed base, of its own for every root and table."""
    mark = hashlib.md5(f"{root}\0{table}".encode()).hexdigest()
    return f"millrace_{re.sub('[^a-z0-9]', '_', table.lower())}_{mark}_{version}"


def _described(spark: SparkSession, root: str, table: str, version: int) -> dict[str, str] | None:
    """What the catalog says of a bucketed base, if it has the one at that place."""
    found = _bucketed_name(root, table, version)
    if not spark.catalog.tableExists(found):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {found}").collect()
    told = {r.col_name: r.data_type for r in rows}
    plain = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath()
    here = plain(f"{base_dir(root, table)}/upto={version}")
    return told if plain(told["Location"]) == here else None


def read_base(spark: SparkSession, root: str, table: str, version: int) -> DataFrame:
    """A base layer, through the catalog where it was written as a bucketed table."""
    if _described(spark, root, table, version) is not None:
        return spark.table(_bucketed_name(root, table, version))
    return spark.read.parquet(f"{base_dir(root, table)}/upto={version}")


def _bucket_count(spark: SparkSession, root: str, table: str, version: int | None) -> int | None:
    """How many buckets a base layer has; None where it is not bucketed."""
    told = None if version is None else _described(spark, root, table, version)
    return int(told["Num Buckets"]) if told else None


def log_layers(
    spark: SparkSession, root: str, table: TableDef, after: int | None, upto: int | None
) -> list[Layer]:
    """The batches of every stream stored in the given range, by their columns."""
    layers = []
    for position, stream in enumerate(table.streams):
        for home in _shape_dirs(spark, log_dir(root, table.name, stream.name)):
            batches = _complete(spark, home, f"{BATCH}=", after, upto)
            if batches:
                paths = [f"{home}/{BATCH}={n}" for n in batches]
                rows = spark.read.option("basePath", home).parquet(*paths)
                keyed = rows.filter(" AND ".join(f"{name(k)} IS NOT NULL" for k in table.key))
                layers.append(Layer(keyed, BATCH, position, stream.order_by))
    return layers


def refuse_type_changes(
    spark: SparkSession, root: str, table: TableDef, schemas: Mapping[str, T.StructType]
) -> None:
    """Raise where a stream would write a column in another type than is stored.

    ``schemas`` is by stream. Added and dropped columns are no change of type.
    """
    stored: dict[str, T.DataType] = {}
    version = base_version(spark, root, table.name)
    if version is not None:
        stored |= {f.name: f.dataType for f in read_base(spark, root, table.name, version).schema}
    for stream in table.streams:
        for home in _shape_dirs(spark, log_dir(root, table.name, stream.name)):
            for batch in reversed(numbered_children(spark, home, f"{BATCH}=")):
                if exists(spark, f"{home}/{BATCH}={batch}/_SUCCESS"):
                    found = spark.read.parquet(f"{home}/{BATCH}={batch}").schema
                    stored |= {f.name: f.dataType for f in found}
                    break
    for stream in table.streams:
        for column in schemas[stream.name]:
            before = stored.get(column.name, column.dataType)
            if before != column.dataType:
                raise ValueError(
                    f"stream {stream.name}: column {column.name} is stored as {before.simpleString()} "
                    f"in table {table.name}, but now is {column.dataType.simpleString()}"
                )


def expire(spark: SparkSession, root: str, table: TableDef, before: int) -> None:
    """Remove what the newest base layer up to batch ``before`` has made superfluous.

    These are the batches folded into it and the base layers older than it. A
    snapshot as of an earlier batch is no longer possible, and one that is
    being read loses its files.
    """
    version = base_version(spark, root, table.name, before)
    if version is None:
        return
    for stream in table.streams:
        for home in _shape_dirs(spark, log_dir(root, table.name, stream.name)):
            for batch in numbered_children(spark, home, f"{BATCH}="):
                if batch <= version:
                    remove(spark, f"{home}/{BATCH}={batch}")
    for older in numbered_children(spark, base_dir(root, table.name), "upto="):
        if older < version:
            if _described(spark, root, table.name, older) is not None:
                spark.sql(f"DROP TABLE {_bucketed_name(root, table.name, older)}")
            remove(spark, f"{base_dir(root, table.name)}/upto={older}")


def snapshot(
    spark: SparkSession, root: str, table: TableDef, upto: int | None = None
) -> DataFrame:
    """The table as of a batch, by default of the last one stored."""
    version = base_version(spark, root, table.name, upto)
    layers = log_layers(spark, root, table, version, upto)
    if version is not None:
        return overlay(read_base(spark, root, table.name, version), layers, table.key)
    if not layers:
        raise ValueError(f"table {table.name}: nothing stored below {root}")
    return latest_rows(layers, table.key)


def compact(
    spark: SparkSession, root: str, table: TableDef, upto: int, buckets: int | None = None
) -> None:
    """Write the table as of a committed batch as its new base layer.

    With ``buckets`` the layer is also a catalog table bucketed by the key, so
    that neither snapshots nor the next compaction shuffle it. Nothing readers
    may be using is touched: the layer gets a directory of its own and counts
    once complete.
    """
    target = f"{base_dir(root, table.name)}/upto={upto}"
    if exists(spark, f"{target}/_SUCCESS"):
        return
    rows = snapshot(spark, root, table, upto)
    if buckets is None:
        rows.write.mode("overwrite").parquet(target)
        return
    before = base_version(spark, root, table.name, upto)
    if _bucket_count(spark, root, table.name, before) != buckets:
        # else the join with the bucketed base has left the rows bucket by bucket
        rows = rows.repartition(buckets, *table.key)
    writer = rows.write.mode("overwrite").option("path", target)
    writer = writer.bucketBy(buckets, *table.key).sortBy(*table.key)
    writer.saveAsTable(_bucketed_name(root, table.name, upto))
