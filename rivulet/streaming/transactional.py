"""A transactional folder sink as a Python data source.

Tasks write their rows as Parquet files into a staging folder and return the file names as
commit messages. ``commit(messages, batch_id)``, which Spark calls on the driver once every
task has succeeded, gathers them in one folder and renames it to
``<path>/app=<app>/batch_id=<id>``: the batch becomes visible as a whole, and the folder itself
is the mark that it was processed. A batch that is there already is left as it is (a replay
leaves nothing but deleted staging files), whatever the query did upstream; ``abort`` deletes
what the tasks staged. Readers skip the staging folder, whose name starts with ``_``.

As a stream sink the batch id is Spark's; Python sinks take append mode only. Inside ``foreachBatch`` the same sink takes the
options ``appId`` and ``txnVersion`` and applies each ``(appId, txnVersion)`` once.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter,
                                    WriterCommitMessage)

from rivulet.streaming.sinks import with_batch_cols

FORMAT = "rivulet_txn"

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Staged(WriterCommitMessage):
    """The file a task has written; none if it had no rows."""

    file: str | None
    rows: int


class _Folder:
    """Staging and publishing of batches under ``root`` for one writer."""

    def __init__(self, root: str, app: str):
        self.root, self.app = root.rstrip("/"), app

    def _fs(self):
        from pyarrow import fs

        if "://" in self.root or self.root.startswith("file:"):
            return fs.FileSystem.from_uri(self.root if "://" in self.root else "file://" + self.root[5:])
        return fs.LocalFileSystem(), self.root

    def stage(self, batches: Iterator[pa.RecordBatch]) -> Staged:
        import pyarrow.parquet as pq

        fs, root = self._fs()
        writer, name, rows = None, None, 0
        try:
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                if writer is None:
                    fs.create_dir(f"{root}/_staged", recursive=True)
                    name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.parquet"
                    writer = pq.ParquetWriter(f"{root}/_staged/{name}", batch.schema, filesystem=fs)
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Staged(name, rows)

    def publish(self, messages: list[Staged | None], batch_id: int) -> bool:
        """Whether the batch became visible now; it did not if it had been published before."""
        from pyarrow.fs import FileType

        fs, root = self._fs()
        final = f"{root}/app={self.app}/batch_id={batch_id}"
        if fs.get_file_info(final).type != FileType.NotFound:
            self.discard(messages)
            return False
        gathered = f"{root}/_staged/{uuid.uuid4().hex}"
        fs.create_dir(gathered, recursive=True)
        for m in messages:
            if m is not None and m.file:
                fs.move(f"{root}/_staged/{m.file}", f"{gathered}/{m.file}")
        fs.create_dir(f"{root}/app={self.app}", recursive=True)
        fs.move(gathered, final)
        return True

    def discard(self, messages: list[Staged | None]) -> None:
        fs, root = self._fs()
        for m in messages:
            if m is not None and m.file:
                fs.delete_file(f"{root}/_staged/{m.file}")


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, folder: _Folder):
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.folder.stage(iterator)

    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803
        self.folder.publish(messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
        self.folder.discard(messages)


class _BatchWriter(DataSourceArrowWriter):
    def __init__(self, folder: _Folder, version: int):
        self.folder, self.version = folder, version

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.folder.stage(iterator)

    def commit(self, messages: list) -> None:
        self.folder.publish(messages, self.version)

    def abort(self, messages: list) -> None:
        self.folder.discard(messages)


class TransactionalFolder(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _folder(self) -> _Folder:
        for wanted in ("path", "appId"):
            if wanted not in self.options:
                raise ValueError(f"the {FORMAT} sink needs the option {wanted}")
        return _Folder(self.options["path"], self.options["appId"])

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> _StreamWriter:  # noqa: N802
        if overwrite:
            raise ValueError("complete mode rewrites its result: use a batch path and read the newest batch")
        return _StreamWriter(self._folder())

    def writer(self, schema: T.StructType, overwrite: bool) -> _BatchWriter:
        if overwrite or "txnVersion" not in self.options:
            raise ValueError(f"a batch write to {FORMAT} appends under an appId and a txnVersion")
        return _BatchWriter(self._folder(), int(self.options["txnVersion"]))


def register(spark: SparkSession) -> str:
    """Make the sink known to the session; its format name."""
    spark.dataSource.register(TransactionalFolder)
    return FORMAT


def write_once(df: DataFrame, path: str, app_id: str, version: int) -> None:
    """Append ``df`` once per ``(app_id, version)``, as a transaction id and version do."""
    register(df.sparkSession)
    (df.write.format(FORMAT).mode("append").option("path", path).option("appId", app_id)
     .option("txnVersion", version).save())


def published(spark: SparkSession, path: str, schema: T.StructType, keep_batch: bool = False) -> DataFrame:
    """The rows of all published batches; with ``keep_batch`` also ``app`` and ``batch_id``."""
    full = with_batch_cols(schema)
    return spark.read.schema(full).parquet(path).select(*(full if keep_batch else schema).fieldNames())
