"""Explicit schemas. Streaming file sources refuse inference, so every stream names one."""

from __future__ import annotations

from pyspark.sql import types as T

# The driver's `events` table with event time as an instant (what `withWatermark` accepts),
# as used in JSON payloads and streams written by this package.
EVENTS_TS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# Payload inside `events.props`.
PROPS = T.StructType([T.StructField("k", T.IntegerType())])

# Sensor reading payload of the demos; bronze adds `ingestionTime`.
SENSOR = T.StructType([
    T.StructField("sensorId", T.StringType(), False),
    T.StructField("roomId", T.StringType(), False),
    T.StructField("buildingId", T.StringType(), False),
    T.StructField("eventTime", T.TimestampType(), False),
    T.StructField("temperature", T.DoubleType(), False),
    T.StructField("humidity", T.DoubleType(), False),
    T.StructField("occupied", T.BooleanType(), False),
])

# Message-bus envelope (the column set a Kafka source produces).
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
    ]))),
])

# Changelog records: `op` is 'set' or 'delete'; `seq` orders the log.
CHANGELOG = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("value", T.IntegerType()),
])

# Per-batch trace row of a streaming query.
BATCH_TRACE = T.StructType([
    T.StructField("queryId", T.StringType()),
    T.StructField("runId", T.StringType()),
    T.StructField("batchId", T.LongType()),
    T.StructField("numInputRows", T.LongType()),
    T.StructField("watermark", T.StringType()),
    T.StructField("numRowsTotal", T.LongType()),
    T.StructField("numRowsUpdated", T.LongType()),
    T.StructField("numRowsRemoved", T.LongType()),
    T.StructField("numRowsDroppedByWatermark", T.LongType()),
    T.StructField("inputRowsPerSecond", T.DoubleType()),
    T.StructField("processedRowsPerSecond", T.DoubleType()),
    T.StructField("eventTimeMin", T.StringType()),
    T.StructField("eventTimeAvg", T.StringType()),
    T.StructField("eventTimeMax", T.StringType()),
])

# The driver's `documents` table.
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def with_field(schema: T.StructType, name: str, dtype: T.DataType) -> T.StructType:
    """A copy of ``schema`` plus one field (``StructType.add`` would mutate the original)."""
    return T.StructType(list(schema.fields) + [T.StructField(name, dtype)])


# `events` slices written by this package carry their slice number.
EVENTS_SLICED = with_field(EVENTS_TS, "slice", T.IntegerType())
