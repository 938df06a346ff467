"""Run a streaming plan to the end into a real sink and hand back a bounded reader.

Driver queries never use the memory sink (it collects on the driver): each stream is
drained with ``availableNow`` into a Parquet sink under the shared work folder, and the
result is a lazy ``spark.read`` of that sink.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from rivulet.session import run_dir
from rivulet.streaming import runtime


def append_to_parquet(df: DataFrame, name: str, **start_kwargs) -> DataFrame:
    """Append-mode stream into a Parquet file sink (exactly-once through its
    ``_spark_metadata`` log); the read-back only sees committed files."""
    spark = df.sparkSession
    d = run_dir(spark, name)
    sink = f"{d}/table"
    runtime.run_to_end(df, runtime.checkpoint_for(sink), sink=sink, output_mode="append",
                       **start_kwargs)
    return spark.read.schema(df.schema).parquet(sink)


def through_batches(df: DataFrame, name: str, make_sink: Callable[[str], object],
                    output_mode: str = "append", **start_kwargs):
    """Drain ``df`` through a ``foreachBatch`` sink built by ``make_sink(root)``;
    returns the sink object (whose ``read()`` gives the table)."""
    spark = df.sparkSession
    d = run_dir(spark, name)
    sink = make_sink(f"{d}/table")
    runtime.run_to_end(df, runtime.checkpoint_for(f"{d}/table"), output_mode=output_mode,
                       foreach_batch=sink, **start_kwargs)
    return sink
