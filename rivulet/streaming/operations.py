"""Operational jobs around streaming queries (all plain Spark batch jobs).

* ``export_state``: externalise a stateful operator's state as a Parquet table (first
  step of a state migration: export -> transform with DataFrame code -> seed).
* ``reset_and_backfill``: state migration by recomputing everything with the new query.
* ``migrate_totals``: state migration by converting the old query's totals; the new query
  continues from them.
* ``compact_files``: rewrite a file-sink folder (read through its manifest, so only
  committed files) into fewer, larger files in a new folder.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rivulet.operators.joins import estimated_bytes
from rivulet.sources.state import read_state
from rivulet.streaming import paths, runtime
from rivulet.streaming.sinks import AccumulatingTable

TARGET_FILE_BYTES = 256 * 1024 * 1024


def export_state(spark: SparkSession, checkpoint: str, out_path: str, operator_id: int = 0,
                 store_name: str | None = None) -> DataFrame:
    """State rows of one operator flattened to ``key.* , value.*`` and written out."""
    st = read_state(spark, checkpoint, operator_id, store_name)
    flat = st.select("key.*", "value.*")
    flat.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def reset_and_backfill(table, root: str, build: Callable[[], DataFrame], checkpoint: str, **start_kwargs):
    """State migration by recomputation: drain ``build()``, the new query over the whole input,
    on a fresh checkpoint into a fresh version of ``table`` (a sink of ``sinks``) at ``root``.
    Returns it; the old version stays as it is until its readers have moved."""
    df = build()
    for path in (root, checkpoint):
        if paths.exists(df.sparkSession, path):
            raise ValueError(f"{path} exists: a backfill needs a fresh table and checkpoint")
    new = copy.copy(table)
    new.root, new.schema = root.rstrip("/"), None
    runtime.run_to_end(df, checkpoint, foreach_batch=new, **start_kwargs)
    return new


def migrate_totals(spark: SparkSession, checkpoint: str, work_path: str, table: AccumulatingTable,
                   transform: Callable[[DataFrame], DataFrame], operator_id: int = 0) -> DataFrame:
    """State migration by conversion: the running totals in the old query's state, turned
    into the new query's keys by ``transform``, are installed in ``table``. The new
    query (fresh checkpoint, only later input) adds its partial sums to them."""
    migrated = transform(export_state(spark, checkpoint, work_path, operator_id))
    table.seed(migrated)
    return migrated


def compact_files(spark: SparkSession, src: str, dst: str,
                  target_file_bytes: int = TARGET_FILE_BYTES, fmt: str = "parquet") -> int:
    """Small-file compaction into ``dst``; returns the number of output files asked for."""
    df = spark.read.format(fmt).load(src)
    n = max(1, math.ceil(estimated_bytes(df) / target_file_bytes))
    df.repartition(n).write.mode("overwrite").format(fmt).save(dst)
    return n
