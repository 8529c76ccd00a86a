"""Schema resolution against a plain resolver of Python values."""

import json
import random
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import topic_frame
from millrace import TopicContract, TypedBatch, contracts
from millrace.functions import codec
from millrace.functions.evolution import SchemaMismatch, resolution
from millrace.operators.conform import BAD_PAYLOAD, REASON
from millrace.sources.registry import SNAPSHOT, resolved, spark_type, struct_of
from millrace.streaming.inspection import decoded

WIDER = {("int", "long"), ("int", "float"), ("int", "double"), ("long", "float"), ("long", "double"), ("float", "double"), ("string", "bytes"), ("bytes", "string")}


class Wrong(Exception):
    """A value that does not fit."""


class Never(Exception):
    """No value would fit."""


def kind(s):
    return "union" if isinstance(s, list) else s["type"] if isinstance(s, dict) else s


def fits(w, r):
    """Whether some value of a written type could be read: the plain resolver's own check."""
    if kind(w) == "union":
        return any(fits(b, r) for b in w)
    if kind(r) == "union":
        return any(fits(w, b) for b in r)
    if kind(w) != kind(r):
        return (kind(w), kind(r)) in WIDER
    if kind(w) == "record":
        have = {f["name"]: f["type"] for f in w["fields"]}
        named = w["name"] in (r["name"], *r.get("aliases", []))
        return named and all(
            any(n in have and fits(have[n], f["type"]) for n in [source(f, have)]) if source(f, have) else "default" in f for f in r["fields"]
        )
    if kind(w) == "array":
        return fits(w["items"], r["items"])
    if kind(w) == "map":
        return fits(w["values"], r["values"])
    return kind(w) != "enum" or w["name"] in (r["name"], *r.get("aliases", []))


def source(field, have):
    return next((n for n in (field["name"], *field.get("aliases", [])) if n in have), None)


def read(w, r, v):
    """A value as the reader has it. Values of unions are (branch, value) here."""
    if kind(w) == "union":
        branch, v = v
        if not fits(branch, r):
            raise Wrong
        return read(branch, r, v)
    if kind(r) == "union":
        same = [b for b in r if kind(b) == kind(w) and fits(w, b)]
        branch = next(iter([*same, *[b for b in r if fits(w, b)]]), None)
        if branch is None:
            raise Wrong
        return shown(r, branch, read(w, branch, v))
    if v is None or kind(r) == "null":
        return None
    if kind(w) == "record":
        have = {f["name"]: f["type"] for f in w["fields"]}
        made = {}
        for f in r["fields"]:
            n = source(f, have)
            made[f["name"]] = read(have[n], f["type"], v[n]) if n else default(f["type"], f["default"])
        return made
    if kind(w) == "enum":
        if v in r["symbols"]:
            return v
        if "default" in r:
            return r["default"]
        raise Wrong
    if kind(w) == "array":
        return [read(w["items"], r["items"], x) for x in v]
    if kind(w) == "map":
        return {k: read(w["values"], r["values"], x) for k, x in v.items()}
    if kind(r) in ("float", "double"):
        return float(v)
    if kind(w) in ("string", "bytes") and kind(w) != kind(r):
        return v.encode() if kind(r) == "bytes" else v.decode()
    return v


def shown(union, branch, v):
    """A union's value as a column has it."""
    own = [b for b in union if b != "null"]
    if branch == "null" or len(own) == 1 or {kind(b) for b in own} in ({"int", "long"}, {"float", "double"}):
        return v
    return None if v is None else {f"member{i}": v if b == branch else None for i, b in enumerate(own)}


def default(s, v):
    if kind(s) == "union":
        return shown(s, s[0], default(s[0], v))
    if kind(s) == "record":
        return {f["name"]: default(f["type"], v.get(f["name"], f.get("default"))) for f in s["fields"]}
    if kind(s) == "bytes":
        return v.encode("latin-1")
    if kind(s) in ("float", "double"):
        return float(v)
    if kind(s) == "array":
        return [default(s["items"], x) for x in v]
    if kind(s) == "map":
        return {k: default(s["values"], x) for k, x in v.items()}
    return v


def as_column(s, v):
    """A written value as Spark's row has it."""
    if v is None:
        return None
    if kind(s) == "union":
        return shown(s, v[0], as_column(*v))
    if kind(s) == "record":
        return {f["name"]: as_column(f["type"], v[f["name"]]) for f in s["fields"]}
    if kind(s) == "array":
        return [as_column(s["items"], x) for x in v]
    if kind(s) == "map":
        return {k: as_column(s["values"], x) for k, x in v.items()}
    return v


def plain(v):
    if isinstance(v, T.Row):
        return {k: plain(x) for k, x in v.asDict().items()}
    if isinstance(v, dict):
        return {k: plain(x) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return bytes(v) if isinstance(v, bytearray) else v


class Maker:
    """Random pairs of schemas that some writer and reader may have, and values."""

    def __init__(self, seed):
        self.draw, self.n = random.Random(seed), 0

    def name(self):
        self.n += 1
        return f"n{self.n}"

    def primitive(self):
        return self.draw.choice(["int", "long", "float", "double", "string", "bytes", "boolean"])

    def schema(self, depth):
        pick = self.draw.random()
        if depth == 0 or pick < 0.4:
            return self.primitive()
        if pick < 0.5:
            return {"type": "enum", "name": self.name(), "symbols": ["A", "B", "C", "D"]}
        if pick < 0.6:
            return {"type": "array", "items": self.schema(depth - 1)}
        if pick < 0.7:
            return {"type": "map", "values": self.schema(depth - 1)}
        if pick < 0.85:
            some = self.draw.choice([["null", "string"], ["null", "long", "string"], ["int", "string", "boolean"], ["null", "int", "long"]])
            return list(some)
        return self.record(depth - 1)

    def record(self, depth):
        fields = [{"name": f"f{self.name()}", "type": self.schema(depth)} for _ in range(self.draw.randrange(1, 5))]
        return {"type": "record", "name": self.name(), "fields": fields}

    def changed(self, s):
        """What a reader may have made of a written type."""
        pick = self.draw.random()
        if kind(s) == "union":
            if pick < 0.3:
                return "long" if "int" in s and "long" in s else [b for b in s if b != "null"][0]
            return [*s, "double"] if pick < 0.5 and "string" in s and "double" not in s else s
        if kind(s) == "record":
            fields = []
            for f in s["fields"]:
                if self.draw.random() < 0.2:
                    continue
                new = {"name": f["name"], "type": self.changed(f["type"])}
                if self.draw.random() < 0.3:
                    new = new | {"name": f"r{f['name']}", "aliases": ["other", f["name"]]}
                fields.append(new)
            for t, d in (("long", 7), (["null", "string"], None), ("string", "none"), ("bytes", "ÿ"), ({"type": "array", "items": "int"}, [1, 2]),
                         ({"type": "map", "values": "string"}, {"k": "v"}), (["string", "long"], "x")):
                if self.draw.random() < 0.25:
                    fields.append({"name": f"d{self.name()}", "type": t, "default": d})
            new = s | {"fields": fields or [{"name": "only", "type": "int", "default": 3}]}
            return new | {"name": self.name(), "aliases": [s["name"]]} if pick < 0.3 else new
        if kind(s) == "enum":
            new = s | {"symbols": ["C", "B"]} if pick < 0.6 else s | {"symbols": ["D", "C", "B", "A", "E"]}
            return new | {"default": "B"} if pick < 0.3 else new
        if kind(s) == "array":
            return s | {"items": self.changed(s["items"])}
        if kind(s) == "map":
            return s | {"values": self.changed(s["values"])}
        if pick < 0.5:
            wider = sorted(b for a, b in WIDER if a == s)
            return self.draw.choice([*wider, s])
        return ["null", s] if pick < 0.7 else s

    def value(self, s):
        d = self.draw
        if kind(s) == "union":
            branch = d.choice(s)
            return branch, self.value(branch)
        if kind(s) == "record":
            return {f["name"]: self.value(f["type"]) for f in s["fields"]}
        if kind(s) == "array":
            return [self.value(s["items"]) for _ in range(d.randrange(3))]
        if kind(s) == "map":
            return {k: self.value(s["values"]) for k in "xy"[: d.randrange(3)]}
        if kind(s) == "enum":
            return d.choice(s["symbols"])
        return {"int": d.randrange(-9, 9), "long": d.randrange(-9, 9), "float": d.randrange(9) / 4, "double": d.randrange(9) / 8,
                "string": d.choice(["", "a", "é"]), "bytes": d.choice([b"", b"ab"]), "boolean": d.random() < 0.5, "null": None}[kind(s)]


@pytest.mark.parametrize("seed", range(16))
def test_resolution_is_that_of_a_plain_resolver(spark, seed):
    maker = Maker(seed)
    writer = maker.record(3)
    reader = maker.changed(writer)
    top = fits(writer, reader | {"aliases": [writer["name"]]})
    if not top:
        with pytest.raises(SchemaMismatch):
            resolution(json.dumps(writer), json.dumps(reader))
        return
    way = resolution(json.dumps(writer), json.dumps(reader))
    values = [maker.value(writer) for _ in range(40)]
    kinds = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", spark_type(resolved(writer)))])
    frame = spark.createDataFrame([(i, as_column(writer, v)) for i, v in enumerate(values)], kinds)
    found = frame.select("i", way.wrong(F.col("v")).alias("wrong"), way.value(F.col("v")).alias("made"))
    assert found.schema["made"].dataType.simpleString() == struct_of(json.dumps(reader)).simpleString()
    for row in found.collect():
        try:
            wanted = read(writer, reader | {"aliases": [writer["name"]]}, values[row.i])
        except Wrong:
            assert row.wrong is True
            continue
        assert row.wrong is False and plain(row.made) == wanted


def _record(*fields, **more):
    return json.dumps({"type": "record", "name": "r", "fields": [f if isinstance(f, dict) else {"name": f[0], "type": f[1]} for f in fields]} | more)


@pytest.mark.parametrize(
    ("written", "wanted"),
    [
        ("string", "int"), ("long", "int"), (["null", "string"], "long"), ({"type": "enum", "name": "a", "symbols": ["x"]}, {"type": "enum", "name": "b", "symbols": ["x"]}),
        ({"type": "array", "items": "string"}, {"type": "array", "items": "long"}), ({"type": "fixed", "name": "f", "size": 2}, {"type": "fixed", "name": "f", "size": 3}),
        ({"type": "bytes", "logicalType": "decimal", "precision": 5, "scale": 2}, {"type": "bytes", "logicalType": "decimal", "precision": 6, "scale": 2}),
    ],
)
def test_schemas_that_never_fit_are_refused(written, wanted):
    with pytest.raises(SchemaMismatch):
        resolution(_record(("a", written)), _record(("a", wanted)))


def test_a_field_without_default_has_to_be_written():
    with pytest.raises(SchemaMismatch, match="field b is not written"):
        resolution(_record(("a", "int")), _record(("a", "int"), ("b", "int")))
    resolution(_record(("a", "int")), _record(("a", "int"), ("b", "int")), fields=["a"])


def test_logical_types_and_their_numbers(spark):
    stamp = {"type": "long", "logicalType": "timestamp-millis"}
    local = {"type": "long", "logicalType": "local-timestamp-micros"}
    day = {"type": "int", "logicalType": "date"}
    writer = _record(("a", stamp), ("b", "long"), ("c", day), ("d", "int"), ("e", local), ("f", "long"))
    reader = _record(("a", "long"), ("b", stamp | {"logicalType": "timestamp-micros"}), ("c", "int"), ("d", day), ("e", "long"), ("f", local),
                     {"name": "g", "type": day, "default": 3}, {"name": "h", "type": local, "default": 5_000_001}, {"name": "k", "type": stamp, "default": 2000})
    way = resolution(writer, reader)
    row = "named_struct('a', timestamp'1970-01-02 00:00:00', 'b', 1500000L, 'c', date'1970-01-05', 'd', 9, 'e', timestamp_ntz'2020-07-01 00:00:00.25', 'f', 1593561600000000L)"
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        made = spark.sql(f"SELECT {row.replace('1970-01-02 00:00:00', '1970-01-02 00:00:00Z')} AS v").select(way.value(F.col("v")).alias("m")).select("m.*")
        made = made.withColumns({"b": F.unix_micros("b"), "k": F.unix_micros("k")}).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (made.a, made.b, made.c, made.d) == (86_400_000, 1_500_000, 4, date(1970, 1, 10))
    assert (made.e, made.f) == (1593561600_250000, datetime(2020, 7, 1))
    assert (made.g, made.h, made.k) == (date(1970, 1, 4), datetime(1970, 1, 1, 0, 0, 5, 1), 2_000_000)
    assert datetime.fromtimestamp(1593561600, timezone.utc).hour == 0


OLD = _record(("id", "int"), ("uid", "long"), ("kind", {"type": "enum", "name": "k", "symbols": ["A", "B", "Z"]}), ("note", ["null", "string"]))
NEW = _record(
    ("id", "long"),
    {"name": "user", "type": "long", "aliases": ["uid"]},
    ("kind", {"type": "enum", "name": "k", "symbols": ["A", "B"]}),
    ("note", "string"),
    {"name": "region", "type": "string", "default": "none"},
)


def _framed(schema_id, **fields):
    return b"\x00" + schema_id.to_bytes(4, "big") + json.dumps(fields).encode()


def _versions(spark, **options):
    entries = [("t-value", 1, 1, OLD), ("t-value", 2, 2, NEW)]
    return contracts(spark.createDataFrame(entries, SNAPSHOT), ["t"], framed=True, **options)["t"]


def test_topic_rows_of_two_writers(spark):
    messages = [
        _framed(1, id=1, uid=2, kind="A", note="x"),
        _framed(2, id=2, user=3, kind="B", note="y", region="north"),
        _framed(1, id=3, uid=2, kind="Z", note="x"),  # no such symbol and no default
        _framed(1, id=4, uid=2, kind="A", note=None),  # the reader has no null
        _framed(1, id=1 << 40, uid=2, kind="A", note="x"),  # no int
        _framed(1, id=5, user=9, kind="A", note="x"),  # written under the old name only
        _framed(2, id=6, user=None, kind="A", note="x", region=None) + b" {}",
    ]
    rows = topic_frame(spark, [("t", i, v) for i, v in enumerate(messages)])
    batch = TypedBatch(rows, [_versions(spark, resolve=True)])
    good = {r.id: tuple(r)[1:] for r in batch.typed("t").collect()}
    assert good == {1: (2, "A", "x", "none"), 2: (3, "B", "y", "north"), 5: (None, "A", "x", "none")}
    assert {r.offset: r[REASON] for r in batch.rejects().collect()} == dict.fromkeys([2, 3, 4, 6], BAD_PAYLOAD)
    by_name = TypedBatch(rows, [_versions(spark)])
    assert {r.id: (r.user, r.region) for r in by_name.typed("t").collect()}[1] == (None, None)
    shown_rows = {r.id: (r.user, r.region) for r in decoded(rows, _versions(spark)).collect()}
    assert shown_rows[1] == (2, "none") and shown_rows[2] == (3, "north")


def test_only_used_fields_decide(spark):
    messages = [_framed(1, id=1, uid=2, kind="Z", note=None), _framed(1, id="x", uid=4, kind="A", note="x")]
    rows = topic_frame(spark, [("t", i, v) for i, v in enumerate(messages)])
    batch = TypedBatch(rows, [_versions(spark, resolve=True)], used={"t": ["user", "region"]})
    assert sorted((r.user, r.region) for r in batch.typed("t").collect()) == [(2, "none"), (4, "none")]


def test_ints_that_share_a_column_with_longs(spark):
    way = resolution(_record(("a", ["int", "long"])), _record(("a", "int")))
    frame = spark.sql("SELECT i, named_struct('a', i) AS v FROM VALUES (7L), (-1L), (8589934592L) AS t(i)")
    found = frame.select("i", way.wrong(F.col("v")).alias("wrong"), way.value(F.col("v"))["a"].alias("a")).collect()
    assert {r.i: (r.wrong, r.a) for r in found} == {7: (False, 7), -1: (False, -1), 1 << 33: (True, None)}


def test_resolution_needs_frames():
    with pytest.raises(ValueError, match="only framed"):
        TopicContract("t", T.StructType.fromDDL("a int"), resolve=True)


@pytest.mark.parametrize(
    "text", ['{"a": 1}', '{"a": 1} ', '{"a": {"b": 1}}', '{"a": "}"}', '3}', '[1]{"a":1}', '"x"{"a":1}', 'null{"a":1}', '{"a":1}{"a":2}', '[]{"a":1}', '[null]{"a":1}', '[{"a":1}', "{}", "}", '{"a":1}]'],
)
def test_short_cut_changes_no_verdict(spark, text):
    """What ends with its first closing brace need not be parsed twice."""
    struct = T.StructType.fromDDL("a string")
    frame = spark.createDataFrame([(bytearray(text.encode()),)], "v binary")
    made = codec.from_json_bytes(F.col("v"), struct)
    whole = F.json_array_length(F.concat(F.lit("["), F.col("v").cast("string"), F.lit(",0]"))) == 2
    row = frame.select((made.isNull() | made.getField(codec.UNPARSED).isNotNull()).alias("bad"), F.coalesce(whole, F.lit(False)).alias("one")).first()
    assert row.bad or row.one
