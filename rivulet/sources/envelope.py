"""Message-bus envelopes: the column set of a Kafka source, and its Parquet stand-in.

``encode`` turns rows into envelope rows (``key``/``value`` bytes, topic, partition,
offset, broker timestamp, headers); ``decode`` is the bronze parse: bytes -> JSON ->
struct -> flattened columns plus the envelope coordinates that make a row traceable.
``kafka_stream``/``kafka_sink_options`` are thin adapters for clusters that ship the
Kafka connector (absent here, so untested).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.parse import parse_json, to_json_payload


def encode(df: DataFrame, key_col: str, payload_cols: Sequence[str], topic: str,
           offset_col: str, time_col: str, partitions: int = 8,
           payload: Column | None = None, passthrough: Sequence[str] = ()) -> DataFrame:
    """Rows -> envelope rows. ``partition`` is the key hash modulo ``partitions`` (the
    default partitioner's role); ``offset`` comes from a monotone column of the rows.
    ``passthrough`` columns are kept next to the envelope (e.g. a file slice number)."""
    value = payload if payload is not None else to_json_payload(list(payload_cols))
    return df.select(
        F.col(key_col).cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64(F.col(key_col)), F.lit(partitions)).cast("int").alias("partition"),
        F.col(offset_col).cast("long").alias("offset"),
        F.col(time_col).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.array(F.struct(F.lit("producer").alias("key"),
                         F.lit("rivulet").cast("binary").alias("value"))).alias("headers"),
        *passthrough,
    )


def decode(df: DataFrame, schema: T.StructType, keep_envelope: bool = False,
           corrupt_col: str | None = None) -> DataFrame:
    """Envelope -> parsed payload columns (``select("e.*")`` flattening)."""
    parsed = df.select(
        F.col("key").cast("string").alias("msg_key"),
        F.col("value").cast("string").alias("raw_value"),
        "topic", "partition", "offset", F.col("timestamp").alias("broker_ts"),
        parse_json(F.col("value").cast("string"), schema, corrupt_col).alias("e"))
    cols = ["e.*"]
    if keep_envelope:
        cols = ["msg_key", "raw_value", "topic", "partition", "offset", "broker_ts", "e.*"]
    return parsed.select(*cols)


def kafka_stream(spark: SparkSession, servers: str, topic: str | None = None,
                 pattern: str | None = None, starting_offsets: str = "earliest",
                 max_offsets_per_trigger: int | None = None,
                 fail_on_data_loss: bool = True) -> DataFrame:
    """Kafka source (needs the connector on the classpath). ``startingOffsets`` only
    applies to a fresh checkpoint; a restart resumes from the offset log."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if topic:
        r = r.option("subscribe", topic)
    if pattern:
        r = r.option("subscribePattern", pattern)
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load()


def kafka_sink_options(servers: str, topic: str) -> dict:
    """Options for ``writeStream.format("kafka")`` (at-least-once: pair it with a
    downstream dedup on an event id)."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def sink_rows(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as a bus sink takes them: ``value`` is the whole row as JSON, ``key`` (optional)
    a column as text."""
    value = to_json_payload([F.col(f"`{c}`") for c in df.columns]).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)
