"""Caller-driven stream for tests: exact batch boundaries without an in-memory source.

PySpark has no ``MemoryStream``. ``FileDropStream`` gives the same control: ``add``
writes one new file (atomically, through Spark's writer) into a watched folder and
``process`` blocks until the running query has consumed it, so each ``add`` +
``process`` pair is one micro-batch (``maxFilesPerTrigger=1``). ``DrivenStream`` is the same
over the caller-driven source (``sources.driven``): what was added since the last trigger is
one micro-batch, and an empty ``add`` is a batch without rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rivulet.session import run_dir
from rivulet.sources.driven import BatchLog
from rivulet.streaming.observe import trace_row


class FileDropStream:
    def __init__(self, spark: SparkSession, schema: T.StructType, name: str = "drop"):
        self.spark = spark
        self.schema = schema
        self.root = run_dir(spark, f"{name}_in")
        self.n = 0
        self.query: StreamingQuery | None = None

    def stream(self) -> DataFrame:
        return (self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
                .parquet(f"{self.root}/*"))

    def add(self, rows: Iterable[tuple]) -> None:
        df = self.spark.createDataFrame(list(rows), self.schema).coalesce(1)
        df.write.mode("overwrite").parquet(f"{self.root}/{self.n:06d}")
        self.n += 1

    def start(self, build: Callable[[DataFrame], DataFrame], output_mode: str,
              foreach_batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
        out = build(self.stream())
        ck = run_dir(self.spark, "drop_checkpoint")
        self.query = (out.writeStream.outputMode(output_mode).option("checkpointLocation", ck)
                      .foreachBatch(foreach_batch).start())
        return self.query

    def run_available_now(self, build: Callable[[DataFrame], DataFrame], output_mode: str,
                          foreach_batch: Callable[[DataFrame, int], None],
                          checkpoint: str) -> StreamingQuery:
        """Drain what has been dropped so far with an ``availableNow`` run on a kept
        checkpoint (a restart per call; each run ends with a no-data batch when the
        watermark moved)."""
        out = build(self.stream())
        q = (out.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
             .foreachBatch(foreach_batch).trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        return q

    def process(self) -> None:
        assert self.query is not None, "start() first"
        self.query.processAllAvailable()

    def stop(self) -> None:
        if self.query is not None:
            self.query.stop()

    def trace(self) -> list[tuple]:
        """``batchId, numInputRows, watermark, numRowsTotal, numRowsUpdated, numRowsRemoved,
        numRowsDroppedByWatermark`` per batch of the running query, in batch order. It reads
        the query's recent progress, which must still hold its first batch."""
        rows: dict[int, tuple] = {}
        for p in self.query.recentProgress:
            r = trace_row(json.loads(p.json))
            # idle progress events repeat the last batch id with no input: keep the batch's own
            if r["batchId"] not in rows or r["numInputRows"] > rows[r["batchId"]][1]:
                rows[r["batchId"]] = tuple(r[k] for k in (
                    "batchId", "numInputRows", "watermark", "numRowsTotal", "numRowsUpdated",
                    "numRowsRemoved", "numRowsDroppedByWatermark"))
        if rows and min(rows) > 0:
            raise RuntimeError("the query's first batches have left its recent progress: use ProgressTable")
        return [rows[k] for k in sorted(rows)]


class DrivenStream(FileDropStream):
    def __init__(self, spark: SparkSession, schema: T.StructType, name: str = "driven"):
        super().__init__(spark, schema, name)
        self.log = BatchLog(spark, self.root, schema)

    def stream(self) -> DataFrame:
        return self.log.stream()

    def add(self, rows: Iterable[tuple]) -> None:
        self.log.add(self.spark.createDataFrame(list(rows), self.schema).coalesce(1))
        self.n = self.log.n
