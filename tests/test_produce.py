import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from millrace import TopicContract, TypedBatch, contracts, produce
from millrace.functions import codec
from millrace.operators.conform import REASON
from millrace.sources.registry import SNAPSHOT, struct_of

KEY = '{"type":"record","name":"k","fields":[{"name":"id","type":"long"}]}'
VALUE = """{"type":"record","name":"v","fields":[
  {"name":"role","type":"string"},
  {"name":"note","type":["null","string"]},
  {"name":"sub","type":["null",{"type":"record","name":"s","namespace":"n",
    "fields":[{"name":"x","type":["null","long"]}]}]},
  {"name":"tags","type":{"type":"array","items":["null","string"]}},
  {"name":"attrs","type":["null",{"type":"map","values":["null","double"]}]}]}"""


def pair(spark, framed=False):
    entries = [("t-key", 1, 1, KEY), ("t-value", 1, 2, VALUE)]
    snapshot = spark.createDataFrame(entries, SNAPSHOT)
    return (
        contracts(snapshot, ["t"], "key")["t"],
        contracts(snapshot, ["t"], "value", framed=framed)["t"],
    )


def sent(spark, texts, **options):
    key, value = pair(spark, options.pop("framed", False))
    table = spark.createDataFrame(texts, "key string, value string")
    return produce(table, "t", key, value, **options), value


def test_plain_json(spark):
    made, value = sent(spark, [('{"id": 1}', '{"role": "a", "tags": ["x"], "extra": 0}')])
    row = made.rows.first()
    assert (bytes(row.key), row.topic) == (b'{"id":1}', "t")
    typed = TypedBatch(made.rows, [value]).typed("t").first()
    assert (typed.role, typed.note, typed.sub, typed.tags, typed.attrs) == ("a", None, None, ["x"], None)
    assert made.rejects.count() == 0


def test_rejects_have_a_reason(spark):
    good = '{"role": "a", "tags": []}'
    made, _ = sent(
        spark,
        [
            ('{"id": 1}', good),
            ("oops", good),
            ('{"id": 2}', "oops"),
            ('{"id": "x"}', good),
            ("{}", good),
            (None, good),
            ('{"id": 3}', "{}"),
            ('{"id": 4}', '{"role": "a"}'),
        ],
    )
    assert made.rows.count() == 1
    assert rows_of(made.rejects.groupBy(REASON).count()) == [
        ("bad_key", 2),
        ("bad_value", 1),
        ("missing_field", 4),
    ]


def test_tagged_json(spark):
    full = (
        '{"role": "a", "note": {"string": "hi"}, "sub": {"n.s": {"x": {"long": 5}}},'
        ' "tags": [null, {"string": "t"}], "attrs": {"map": {"d": {"double": 0.5}}}}'
    )
    nulls = '{"role": "b", "note": null, "sub": null, "tags": [], "attrs": null}'
    short = '{"role": "c", "note": null, "tags": []}'
    untagged = '{"role": "d", "note": "hi", "sub": null, "tags": [], "attrs": null}'
    texts = [('{"id": 1}', v) for v in (full, nulls, short, untagged)]
    made, value = sent(spark, texts, unions="tagged")
    typed = {r.role: r for r in TypedBatch(made.rows, [value]).typed("t").collect()}
    a = typed["a"]
    assert (a.note, a.sub.x, a.tags, a.attrs) == ("hi", 5, [None, "t"], {"d": 0.5})
    b = typed["b"]
    assert (b.note, b.sub, b.tags, b.attrs) == (None, None, [], None)
    assert set(typed) == {"a", "b"}
    assert rows_of(made.rejects.groupBy(REASON).count()) == [("bad_value", 1), ("missing_field", 1)]


def test_framed_values_carry_the_latest_id(spark):
    made, value = sent(spark, [('{"id": 1}', '{"role": "a", "tags": []}')], framed=True)
    assert made.rows.select(codec.frame_id("value")).first()[0] == 2
    assert TypedBatch(made.rows, [value]).typed("t").count() == 1


def test_contract_without_schema_requires_nothing(spark):
    bare = TopicContract("t", struct_of(KEY))
    table = spark.createDataFrame([("{}", "{}")], "k string, v string")
    made = produce(table, "t", bare, bare, key_text="k", value_text="v", offset=F.lit(7))
    assert (made.rows.first().offset, made.rejects.count()) == (7, 0)
    with pytest.raises(ValueError, match="tagged"):
        produce(table, "t", bare, bare, unions="tagged")
    with pytest.raises(ValueError, match="plain or tagged"):
        produce(table, "t", bare, bare, unions="both")
