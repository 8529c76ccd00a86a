"""A filtered copy of a topic: the value bytes pass through, only one field is read."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import codec
from millrace.functions.text import literal, text_form, text_in
from millrace.operators.conform import RAW, REASON, TypedBatch
from millrace.plans.definitions import ReplicaDef
from millrace.sources.registry import TopicContract


def replicate(
    rows: DataFrame,
    contract: TopicContract,
    replica: ReplicaDef,
    listed: DataFrame | None = None,
) -> DataFrame:
    """Topic rows for the target: those whose field's text is among the values.

    The replica's own values stand in the filter, however many they are. Values
    that are data come as ``listed``, a table of one string column, and are
    looked up by a semi join instead; the planner chooses how by its size.

    ``contract`` is that of the replica's topic. The key is dropped unless
    kept. A field missing from the contract reads as null. Malformed rows stop
    the job, or are skipped on request; they never match ``null``. Works on a
    batch or a stream, and needs no shuffle unless ``listed`` is a large table.
    """
    names = contract.struct.fieldNames()
    # decode one field only; any one will do to tell whether the payload is sound
    read = replica.field if replica.field in names else names[0]
    narrow = dataclasses.replace(contract, struct=T.StructType([contract.struct[read]]))
    batch = TypedBatch(rows, [narrow], keep_values=True)
    (path,) = batch.fields(contract.topic)
    text = text_form(path if replica.field in names else "NULL", replica.match_null)
    read_rows = batch.frame.filter(_readable(contract, replica))
    if listed is None:
        kept = read_rows.filter(text_in(text, list(replica.values)))
    else:
        kept = read_rows.withColumn("_text", F.expr(text))
        kept = kept.join(listed.toDF("_listed"), F.col("_text") == F.col("_listed"), "left_semi")
    return kept.selectExpr(
        "key" if replica.keep_key else "CAST(NULL AS BINARY) AS key",
        f"{RAW} AS value",
        f"{literal(replica.target)} AS topic",
        "partition",
        "offset",
        "timestamp",
    ).withColumn("value", _target_value(contract, replica))


def _readable(contract: TopicContract, replica: ReplicaDef) -> str:
    sound = f"{REASON} IS NULL"
    if contract.framed and isinstance(replica.target_schema_id, Mapping):
        listed = ", ".join(str(i) for i in replica.target_schema_id) or "NULL"
        sound += f" AND coalesce({codec.frame_id_sql(RAW)} IN ({listed}), false)"
    if replica.on_malformed == "skip":
        return sound
    message = "concat('cannot read ', topic, ' offset ', CAST(offset AS STRING))"
    return f"CASE WHEN {sound} THEN true ELSE CAST(raise_error({message}) AS BOOLEAN) END"


def _target_value(contract: TopicContract, replica: ReplicaDef) -> Column:
    """The value as it came, or its body in the target registry's frame."""
    target = replica.target_schema_id
    if target is None:
        return F.col("value")
    body = codec.frame_body("value") if contract.framed else F.col("value")
    if not isinstance(target, Mapping):
        return codec.frame(body, target)
    if not contract.framed:
        raise ValueError(f"topic {contract.topic}: schema ids by writer need framed values")
    entries = [F.lit(i).cast("bigint") for pair in target.items() for i in pair]
    return codec.frame(body, F.element_at(F.create_map(*entries), codec.frame_id("value")))
