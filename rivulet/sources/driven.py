"""A stream whose batches the caller sets: a Python data source with replayable offsets.

``BatchLog.add`` writes a DataFrame as the folder ``<path>/n=<number>``; Spark's ``_SUCCESS``
file makes it count, so a batch that was only partly written is never read. The offset is the
number of batches that count. A trigger takes all batches added since the last one, hence
"add, then process" sets a micro-batch exactly, and a batch that Spark runs again after a
crash reads the same folders: its bounds come from the checkpoint, its rows from files that
never change. Each file is a partition, read by an executor as Arrow batches. A folder that the
checkpoint knows and that is gone fails the query instead of losing rows silently. Spark runs
an ``availableNow`` start of a Python source as one batch, and no batch without data after it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from rivulet.streaming import paths

FORMAT = "rivulet_driven"

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class _File(InputPartition):
    path: str


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, schema: T.StructType):
        self.path, self.schema = path.rstrip("/"), schema
        self.known = 0

    def _fs(self):
        from pyarrow import fs

        if "://" in self.path or self.path.startswith("file:"):
            return fs.FileSystem.from_uri(self.path if "://" in self.path else "file://" + self.path[5:])
        return fs.LocalFileSystem(), self.path

    def initialOffset(self) -> dict:  # noqa: N802
        return {"batches": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        from pyarrow.fs import FileType

        fs, root = self._fs()
        while fs.get_file_info(f"{root}/n={self.known}/_SUCCESS").type == FileType.File:
            self.known += 1
        return {"batches": self.known}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        from pyarrow.fs import FileSelector

        fs, root = self._fs()
        return [_File(info.path) for n in range(start["batches"], end["batches"])
                for info in sorted(fs.get_file_info(FileSelector(f"{root}/n={n}")), key=lambda i: i.path)
                if info.base_name.endswith(".parquet")]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(self.schema)
        fs, _ = self._fs()
        with fs.open_input_file(partition.path) as f:
            for batch in pq.ParquetFile(f).iter_batches(columns=self.schema.fieldNames()):
                yield from pa.Table.from_batches([batch]).select(wanted.names).cast(wanted).to_batches()


class DrivenSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        raise ValueError(f"the {FORMAT} source needs a schema")

    def streamReader(self, schema: T.StructType) -> _Reader:  # noqa: N802
        if "path" not in self.options:
            raise ValueError(f"the {FORMAT} source needs the option path")
        return _Reader(self.options["path"], schema)


class BatchLog:
    """The batches under ``path``, for one caller that adds them."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        spark.dataSource.register(DrivenSource)
        self.n = 0
        while paths.exists(spark, f"{self.path}/n={self.n}/_SUCCESS"):
            self.n += 1

    def add(self, df: DataFrame) -> int:
        """Add ``df``, which may have further columns, as the next batch; its number."""
        (df.select(*self.schema.fieldNames()).write.mode("overwrite")
         .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{self.path}/n={self.n}"))
        self.n += 1
        return self.n - 1

    def stream(self) -> DataFrame:
        return self.spark.readStream.format(FORMAT).schema(self.schema).option("path", self.path).load()
