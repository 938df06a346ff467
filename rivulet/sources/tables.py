"""Batch and streaming readers over a folder of Parquet tables (``<dir>/<name>.parquet``, a
file or a folder of files).

A streaming file source needs a *folder* (a single-file path is refused), so a stream
over a table of one file watches the folder around it and keeps only that file with
``pathGlobFilter``. A table of many files is a folder itself, whatever its files are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet import schemas
from rivulet.streaming import paths


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Bounded scan (filters and projections are pushed into the Parquet reader)."""
    return spark.read.parquet(table_path(sf_dir, name))


def stream_table(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded view of one table inside ``sf_dir``."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if paths.is_folder(spark, table_path(sf_dir, name)):
        return r.parquet(table_path(sf_dir, name))
    return r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def with_event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Event time as an instant: ``withWatermark`` rejects ``timestamp_ntz``.

    The stored wall-clock values are UTC. A ``timestamp_ntz`` column is rebuilt field by
    field as a UTC instant (``make_timestamp`` with an explicit zone), so neither the
    session zone nor a daylight-saving gap can shift it; a cast would read the wall
    clock in the session zone. Instants pass through unchanged.
    """
    if isinstance(df.schema[col].dataType, T.TimestampType):
        return df
    c = F.col(col)
    utc = F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                           F.date_part(F.lit("SECOND"), c), F.lit("UTC"))
    return df.withColumn(col, utc)


def events(spark: SparkSession, sf_dir: str, streaming: bool = True,
           max_files_per_trigger: int | None = None) -> DataFrame:
    """The `events` table, bounded or streaming, with event time as an instant.

    The stored ``timestamp_ntz`` column is read under a ``timestamp`` schema: Parquet
    hands over the stored microseconds as they are, i.e. the UTC instant, with no
    per-row work and independent of the session zone."""
    if streaming:
        return stream_table(spark, sf_dir, "events", schemas.EVENTS_TS, max_files_per_trigger)
    return spark.read.schema(schemas.EVENTS_TS).parquet(table_path(sf_dir, "events"))
