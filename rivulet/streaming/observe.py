"""Observability: per-batch progress as a table, progress lines, checkpoint audit.

* ``ProgressTable`` is a ``StreamingQueryListener`` that appends a row per progress event to
  a folder of JSON lines: batch trace, rates and event-time stats of all queries, however
  many batches they run. (``recentProgress`` keeps only the last hundred.)
* ``ProgressReporter`` prints a line per interval.
* ``audit_checkpoints`` lines up, for many checkpoints at once, the offset log, the
  commit log and the file-sink manifest by batch id (a full outer join in Spark).
"""

from __future__ import annotations

import json
import re
import threading
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from rivulet import schemas
from rivulet.streaming import paths

EPOCH_WATERMARK = "1970-01-01T00:00:00.000Z"
_LOG_NAME = re.compile(r"^([0-9]+)([.]compact)?$")


def trace_row(p: Mapping) -> dict:
    """One progress event as a ``BATCH_TRACE`` row; state counts are summed over all
    stateful operators of the query."""
    times, ops = p.get("eventTime") or {}, p.get("stateOperators") or []

    def state(name: str) -> int:
        return sum(int(op.get(name) or 0) for op in ops)

    return {"queryId": str(p["id"]), "runId": str(p["runId"]), "batchId": int(p["batchId"]),
            "numInputRows": int(p.get("numInputRows") or 0),
            "watermark": times.get("watermark", EPOCH_WATERMARK),
            **{n: state(n) for n in ("numRowsTotal", "numRowsUpdated", "numRowsRemoved", "numRowsDroppedByWatermark")},
            "inputRowsPerSecond": float(p.get("inputRowsPerSecond") or 0),
            "processedRowsPerSecond": float(p.get("processedRowsPerSecond") or 0),
            **{f"eventTime{k.capitalize()}": times.get(k) for k in ("min", "avg", "max")}}


class ProgressTable(StreamingQueryListener):
    """Progress of every query of the session as a table under ``root``.

    Rows are written ``flush_every`` at a time, and when a query ends, so the driver never
    holds more. ``close`` detaches the listener after the events still under way."""

    def __init__(self, spark: SparkSession, root: str, flush_every: int = 100):
        self.spark, self.root, self.flush_every = spark, root.rstrip("/"), flush_every
        self._lock = threading.Lock()
        self._rows: list[str] = []
        spark.streams.addListener(self)

    def onQueryStarted(self, event):  # noqa: N802 - Spark listener API
        pass

    def onQueryProgress(self, event):  # noqa: N802
        with self._lock:
            self._rows.append(json.dumps(trace_row(json.loads(event.progress.json))))
            full = len(self._rows) >= self.flush_every
        if full:
            self.flush()

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        self.flush()

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
            if rows:
                paths.write_text(self.spark, f"{self.root}/{uuid.uuid4().hex}.json", "\n".join(rows))

    def close(self, timeout_ms: int = 60_000) -> None:
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(timeout_ms)
        self.spark.streams.removeListener(self)
        self.flush()

    def read(self) -> DataFrame:
        """One row per query run and batch. Idle progress events repeat the last batch's id
        without input: the batch's own row, the one with most input, counts."""
        if not paths.list_names(self.spark, self.root):
            return self.spark.createDataFrame([], schemas.BATCH_TRACE)
        rows = self.spark.read.schema(schemas.BATCH_TRACE).json(self.root)
        first = Window.partitionBy("queryId", "runId", "batchId").orderBy(F.desc("numInputRows"))
        return rows.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def progress_line(p: Mapping) -> str:
    """One-line summary of a progress update: batch, input rows, rates, watermark."""
    wm = (p.get("eventTime") or {}).get("watermark", "-")
    return (f"batch={p.get('batchId')} rows={p.get('numInputRows')} "
            f"in/s={float(p.get('inputRowsPerSecond') or 0):.1f} "
            f"done/s={float(p.get('processedRowsPerSecond') or 0):.1f} watermark={wm}")


class ProgressReporter:
    """Daemon thread writing ``progress_line`` of a query's last progress every
    ``interval_s`` seconds (to ``emit``, e.g. a logger) until the query stops."""

    def __init__(self, query: StreamingQuery, interval_s: float = 10.0, emit=print):
        self.query, self.interval_s, self.emit = query, interval_s, emit
        self._stop = threading.Event()
        self._thread = threading.Thread(target=self._run, daemon=True)

    def _run(self) -> None:
        while not self._stop.wait(self.interval_s):
            p = self.query.lastProgress
            if p:
                self.emit(progress_line(p))
            if not self.query.isActive:
                return

    def start(self) -> "ProgressReporter":
        self._thread.start()
        return self

    def stop(self) -> None:
        self._stop.set()
        self._thread.join(timeout=self.interval_s + 1)


def _log_batches(spark: SparkSession, folders: list[tuple[str, str]], kind: str) -> DataFrame:
    """Batch ids that log folders (``offsets``, ``commits``, ``_spark_metadata``) cover: a
    file ``N`` is batch N, and ``N.compact`` all batches up to N.

    They are listed with the Hadoop FileSystem API: Spark's file readers skip ``_``-prefixed
    folders such as ``_spark_metadata``, and the logs are metadata the driver lists itself."""
    rows = []
    for query, folder in folders:
        found = [_LOG_NAME.match(n) for n in paths.list_names(spark, folder)]
        ids = {int(m[1]) for m in found if m}
        upto = max((int(m[1]) for m in found if m and m[2]), default=-1)
        rows += [(query, n, n) for n in ids if n > upto] + ([(query, 0, upto)] if upto >= 0 else [])
    return (spark.createDataFrame(rows, "query string, first long, last long")
            .select("query", F.explode(F.sequence("first", "last")).alias("batch_id")).distinct()
            .withColumn(kind, F.lit(True)))


def audit_checkpoints(spark: SparkSession, runs: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """Per query and batch: offset planned, commit written, sink manifest written.

    ``runs`` maps a query name to ``(checkpoint_dir, file_sink_dir or None)``. A batch
    is ``aligned`` when every log that should have it does: a planned batch without a
    commit is the one Spark replays on restart. Spark deletes old offset and commit files
    while the sink's manifest stays, so only batches from the oldest offset on are judged;
    older ones are left out.
    """
    offsets = _log_batches(spark, [(q, f"{ck}/offsets") for q, (ck, _) in runs.items()], "has_offset")
    commits = _log_batches(spark, [(q, f"{ck}/commits") for q, (ck, _) in runs.items()], "has_commit")
    sinks = _log_batches(spark, [(q, f"{s}/_spark_metadata") for q, (_, s) in runs.items() if s],
                         "has_sink")
    with_sink = spark.createDataFrame([(q, s is not None) for q, (_, s) in runs.items()],
                                      "query string, expects_sink boolean")
    out = (offsets.join(commits, ["query", "batch_id"], "full")
           .join(sinks, ["query", "batch_id"], "full")
           .join(F.broadcast(with_sink), "query", "left")
           .fillna(False, ["has_offset", "has_commit", "has_sink"]))
    oldest = offsets.groupBy("query").agg(F.min("batch_id").alias("_oldest"))  # one row per query
    out = out.join(F.broadcast(oldest), "query", "left").where(
        F.col("_oldest").isNull() | (F.col("batch_id") >= F.col("_oldest")))
    aligned = (F.col("has_offset") & F.col("has_commit")
               & (F.col("has_sink") | ~F.col("expects_sink")))
    return out.select("query", "batch_id", "has_offset", "has_commit", "has_sink",
                      aligned.alias("aligned"))
