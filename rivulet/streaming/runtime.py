"""Starting, pacing and draining streaming queries.

* ``trigger_for`` turns a deploy-time run mode into a trigger (catch-up vs steady).
* ``start`` wires a streaming DataFrame to a sink with a checkpoint and refuses an
  output-mode change on an existing checkpoint (Spark itself lets it through).
* ``drain`` runs an ``availableNow`` query to the end and surfaces its failure.
"""

from __future__ import annotations

import json
import os
import re
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rivulet.streaming import paths

_MODE_FILE = "_rivulet_query.json"


def trigger_for(mode: str, interval: str = "10 seconds") -> dict:
    """Run mode as a deploy setting: ``catchup`` drains what is there and stops
    (scheduled jobs), ``steady`` polls on a fixed interval, ``once`` is one batch."""
    if mode == "catchup":
        return {"availableNow": True}
    if mode == "steady":
        return {"processingTime": interval}
    if mode == "once":
        return {"once": True}
    raise ValueError(f"unknown run mode {mode!r}")


def checkpoint_for(table_path: str, version: int = 1) -> str:
    """Checkpoint kept next to the table it feeds, versioned so that an incompatible
    query change starts a new checkpoint instead of corrupting the old one."""
    return f"{table_path.rstrip('/')}/_checkpoint/v{version}"


def plan_lines(df: DataFrame) -> list[str]:
    """The analysed plan, a line per operator from the top, without what differs from run to
    run (expression ids, where the source lies)."""
    lines = []
    for line in df._jdf.queryExecution().analyzed().toString().splitlines():
        line = re.sub(r"#\d+L?|-T\d+ms|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", "", line.lstrip(" :+-~"))
        lines.append(re.sub(r"^(StreamingRelation\w*|StreamingDataSource\w*)\b.*?(\[[^\]]*\])?$", r"\1 \2", line))
    return [x for x in lines if x]


def recorded(spark: SparkSession, checkpoint: str) -> dict:
    """Output mode and plan that the checkpoint's query was first started with."""
    marker = f"{checkpoint}/{_MODE_FILE}"
    return json.loads(paths.read_text(spark, marker)) if paths.exists(spark, marker) else {}


def _check_mode(spark: SparkSession, checkpoint: str, output_mode: str) -> bool:
    """Refuse another output mode than the checkpoint's; whether it is recorded yet."""
    saved = recorded(spark, checkpoint)
    if saved and saved.get("outputMode") != output_mode:
        raise ValueError(
            f"checkpoint {checkpoint} was written in {saved.get('outputMode')!r} mode; "
            f"restarting it in {output_mode!r} would change what the sink holds. "
            "Start a new checkpoint version instead.")
    return bool(saved)


_PARTITIONS = "spark.sql.shuffle.partitions"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_MERGE_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Settings of a query with a stateful processor, and of one whose state changes are read.
PROCESSOR = {_PROVIDER: ROCKSDB}
CHANGELOG = PROCESSOR | {"spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
_STARTING = threading.Lock()


def query_confs(spark: SparkSession, state_partitions: int | None = None,
                confs: dict[str, str] | None = None) -> dict[str, str]:
    """Settings of one query where they differ from the session's: the RocksDB provider
    unless the session names one (state on local disk, not on the JVM heap), session
    windows merged inside a partition before the shuffle, and ``state_partitions`` if the
    caller gives it. The checkpoint pins provider and partitions for the life of the
    query, so size partitions for the state the query will have; otherwise the session's
    ``spark.sql.shuffle.partitions`` holds. ``confs`` are the caller's own."""
    wanted = {_MERGE_SESSIONS: "true"}
    if spark.conf.get(_PROVIDER, None) is None:
        wanted[_PROVIDER] = ROCKSDB
    if state_partitions:
        wanted[_PARTITIONS] = str(state_partitions)
    wanted |= confs or {}
    return {k: v for k, v in wanted.items() if spark.conf.get(k, None) != v}


def start(df: DataFrame, checkpoint: str, *, output_mode: str = "append",
          sink: str | None = None, fmt: str = "parquet",
          foreach_batch: Callable[[DataFrame, int], None] | None = None,
          trigger: dict | None = None, query_name: str | None = None,
          options: dict | None = None, partition_by: list[str] | None = None,
          foreach: object | None = None, state_partitions: int | None = None,
          confs: dict[str, str] | None = None) -> StreamingQuery:
    """Start a streaming query into a file sink (``sink``), a ``foreach_batch`` function,
    or a ``foreach`` row writer (an object with ``open``/``process``/``close``; per-row
    and at-least-once, so prefer ``foreach_batch``). ``fmt="console"`` needs no sink.
    Output mode and plan are recorded with the checkpoint once the query has started."""
    spark = df.sparkSession
    known = _check_mode(spark, checkpoint, output_mode)
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w = w.trigger(**(trigger or {"availableNow": True}))
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    elif foreach is not None:
        w = w.foreach(foreach)
    else:
        if partition_by:
            w = w.partitionBy(*partition_by)
        w = w.format(fmt)
    # a query copies the session's settings when it starts: one start at a time sets its own
    with _STARTING:
        wanted = query_confs(spark, state_partitions, confs)
        saved = {k: spark.conf.get(k, None) for k in wanted}
        for k, v in wanted.items():
            spark.conf.set(k, v)
        try:
            query = w.start() if (foreach_batch is not None or foreach is not None) else w.start(sink)
        finally:
            for k, v in saved.items():
                if v is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)
    if not known:
        paths.write_text(spark, f"{checkpoint}/{_MODE_FILE}", json.dumps({"outputMode": output_mode, "plan": plan_lines(df)}))
    return query


def drain(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow``/``once`` query to finish; raise its failure if any."""
    if timeout_s is None:
        query.awaitTermination()
    else:
        finished = query.awaitTermination(timeout_s)
        if not finished:
            query.stop()
            raise TimeoutError(f"query {query.name or query.id} did not finish in {timeout_s}s")
    err = query.exception()
    if err is not None:
        raise RuntimeError(f"streaming query failed: {err}")
    if os.environ.get("RIVULET_EXPLAIN"):
        print(f"== plan of {query.name or query.id} ==")
        query.explain()
    return query


def run_to_end(df: DataFrame, checkpoint: str, **kwargs) -> StreamingQuery:
    """``start`` with ``availableNow`` and ``drain``: one catch-up run of a stream."""
    kwargs.setdefault("trigger", {"availableNow": True})
    return drain(start(df, checkpoint, **kwargs))
