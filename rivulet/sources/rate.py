"""Rate source: ``timestamp`` plus a monotone ``value`` that replays identically.

``rate`` paces by wall clock; ``rate-micro-batch`` emits a fixed number of rows per
batch with deterministic timestamps, which is what tests want.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def rate_stream(spark: SparkSession, rows_per_second: int = 10, partitions: int | None = None) -> DataFrame:
    r = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    if partitions:
        r = r.option("numPartitions", partitions)
    return r.load()


def rate_micro_batch(spark: SparkSession, rows_per_batch: int, start_ms: int = 0,
                     advance_ms: int = 1000, partitions: int | None = None) -> DataFrame:
    r = (spark.readStream.format("rate-micro-batch")
         .option("rowsPerBatch", rows_per_batch)
         .option("startTimestamp", start_ms)
         .option("advanceMillisPerBatch", advance_ms))
    if partitions:
        r = r.option("numPartitions", partitions)
    return r.load()
