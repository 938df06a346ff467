"""File-folder streams (JSON, Parquet, text lines) and writers that feed them.

A file stream tracks *files*, not records: files must be complete and immutable when
they appear (Spark's writers commit by rename, which gives that). Pacing is by bytes
(``max_bytes``) or by file count (``max_files``); files are taken oldest first. A batch is
then as large as the pace, whatever the size of the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _reader(spark: SparkSession, schema: T.StructType | None, max_files: int | None,
            options: dict | None, max_bytes: str | None = None):
    r = spark.readStream
    if schema is not None:
        r = r.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        r = r.option("maxBytesPerTrigger", max_bytes)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r


def json_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files: int | None = None, options: dict | None = None,
                max_bytes: str | None = None) -> DataFrame:
    return _reader(spark, schema, max_files, options, max_bytes).json(path)


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType,
                   max_files: int | None = None, options: dict | None = None,
                max_bytes: str | None = None) -> DataFrame:
    return _reader(spark, schema, max_files, options, max_bytes).parquet(path)


def text_stream(spark: SparkSession, path: str, max_files: int | None = None,
                options: dict | None = None) -> DataFrame:
    """Lines as a single ``value`` string column."""
    return _reader(spark, None, max_files, options).text(path)


class Slices:
    """``df`` cut into ``n`` consecutive ranges of an integer ``order_col``.

    ``df`` carries the ``slice`` number; ``part(i)`` selects slice ``i`` with a range
    predicate on ``order_col`` (pushed into the Parquet scan, so writing all slices
    reads each row group about once instead of scanning the table ``n`` times)."""

    def __init__(self, df: DataFrame, n: int, order_col: str):
        bounds = df.agg(F.min(order_col).alias("lo"), F.max(order_col).alias("hi")).first()
        self.n, self.order_col = n, order_col
        self.lo = bounds["lo"]
        self.span = (bounds["hi"] - self.lo + 1) if self.lo is not None else 1
        if self.lo is None:
            self.df = df.withColumn("slice", F.lit(0))
        else:
            self.df = df.withColumn("slice", F.floor(
                (F.col(order_col) - F.lit(self.lo)) * F.lit(n) / F.lit(self.span)).cast("int"))

    def start(self, i: int) -> int:
        """First ``order_col`` value of slice ``i`` (slice(x) = floor((x-lo)*n/span))."""
        return self.lo + -(-i * self.span // self.n)

    def part(self, i: int) -> DataFrame:
        if self.lo is None:
            return self.df
        c = F.col(self.order_col)
        return self.df.where((c >= F.lit(self.start(i))) & (c < F.lit(self.start(i + 1))))


def with_slices(df: DataFrame, n: int, order_col: str) -> DataFrame:
    """``df`` with its ``slice`` number 0..n-1 by consecutive ranges of ``order_col``."""
    return Slices(df, n, order_col).df


def write_slice(sliced: DataFrame | Slices, root: str, i: int, fmt: str = "parquet",
                options: dict | None = None, cols: list[str] | None = None) -> str:
    """Write slice ``i`` (optionally only ``cols``, e.g. the one column of a text file)."""
    path = f"{root.rstrip('/')}/slice-{i:04d}"
    part = sliced.part(i) if isinstance(sliced, Slices) else sliced.where(F.col("slice") == i)
    if cols:
        part = part.select(*cols)
    w = part.write.mode("overwrite").format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)
    return path


def write_slices(df: DataFrame, root: str, n: int, order_col: str, fmt: str = "parquet",
                 options: dict | None = None) -> list[str]:
    """Write ``df`` as ``n`` consecutive slices of ``order_col`` into one folder, one
    write per slice in order, so a file stream sees them oldest-first as ``n`` arrivals.
    Each slice row carries its ``slice`` number. Returns the slice folders."""
    sl = Slices(df, n, order_col)
    return [write_slice(sl, root, i, fmt, options) for i in range(n)]
