"""The columns of a topic row, as Spark's Kafka source has them."""

from pyspark.sql import types as T

TOPIC_ROW = (
    T.StructType()
    .add("key", T.BinaryType())
    .add("value", T.BinaryType())
    .add("topic", T.StringType())
    .add("partition", T.IntegerType())
    .add("offset", T.LongType())
    .add("timestamp", T.TimestampType())
)
