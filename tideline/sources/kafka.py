"""Kafka source/sink options and the record shapes they read and write.

The Kafka connector jar is not bundled with PySpark; these helpers build the
reader/writer and the frames, and the decode/encode steps are plain
expressions that are tested on frames with the Kafka schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])


def kafka_source_options(bootstrap: str, topics: str, group_id: str, starting: str = "latest") -> dict:
    """Reader options: subscribe to ``topics`` (comma list) from ``starting``."""
    return {"kafka.bootstrap.servers": bootstrap, "subscribe": topics,
            "kafka.group.id": group_id, "startingOffsets": starting}


def read_kafka(spark: SparkSession, options: dict) -> DataFrame:
    """Streaming Kafka source decoded to ``value`` strings (value-only
    deserializer) with ``seq`` = offset order within a partition."""
    return decode_values(spark.readStream.format("kafka").options(**options).load())


# Partitions of a topic that the arrival order has room for.
MAX_PARTITIONS = 1 << 16


def decode_values(raw: DataFrame) -> DataFrame:
    """UTF-8 value text, the source position and the arrival order ``seq``:
    within a partition the order of the offsets, across partitions by offset,
    then partition number. Kafka itself orders only within a partition."""
    seq = F.col("offset") * F.lit(MAX_PARTITIONS) + F.col("partition")
    return raw.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset", seq.alias("seq"))


def value_rows(lines: DataFrame, topic: str, col: str = "value", keep=()) -> DataFrame:
    """One record per line, value only."""
    return lines.select(F.lit(topic).alias("topic"), F.col(col).alias("value"), *keep)


def keyed_rows(lines: DataFrame, topic: str, col: str = "value", keep=(), binary: bool = True) -> DataFrame:
    """Key = first comma field of the line, value = the whole line."""
    key = F.split(F.col(col), ",").getItem(0)
    val = F.col(col)
    if binary:
        key, val = key.cast("binary"), val.cast("binary")
    return lines.select(F.lit(topic).alias("topic"), key.alias("key"), val.alias("value"), *keep)


def write_kafka(df: DataFrame, bootstrap: str, checkpoint: str, extra: dict | None = None):
    """Streaming Kafka sink. Spark's Kafka sink is at-least-once: keep a
    unique key in the records so consumers can drop replays."""
    w = (df.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("checkpointLocation", checkpoint))
    for k, v in (extra or {}).items():
        w = w.option(k, v)
    return w.start()
