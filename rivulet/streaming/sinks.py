"""Idempotent batch sinks for ``foreachBatch`` (and for plain batch jobs).

Spark replays a planned-but-uncommitted micro-batch with the *same* ``batch_id`` and the
same rows; a new checkpoint starts again at batch 0 with *other* rows. Every sink here
therefore knows a batch by who wrote it (the streaming query's id, or an explicit ``app_id``)
and its id.

* ``BatchPathSink``: a folder per writer and batch, replaced by dynamic partition overwrite.
* ``UpsertTable``: keyed upsert. Rows live in ``bucket = hash(key) mod n``; a batch rewrites the
  buckets that it touches and no others.
* ``AccumulatingTable``: running totals per key, in buckets as well.
* ``fan_out`` / ``split_dead_letter``: several outputs from one persisted batch.

``transactional`` has the sink whose commit publishes a batch as a whole and once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.operators.aggregate import latest_per_key
from rivulet.streaming import paths

APP_COL, BATCH_COL = "app", "batch_id"


def app_of(df: DataFrame, app_id: str | None) -> str:
    """``app_id``, else the id of the streaming query that runs this batch (kept across
    restarts of one checkpoint, new with a new checkpoint), else ``batch``."""
    query = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return quote(app_id or query or "batch", safe="")


def with_batch_cols(schema: T.StructType) -> T.StructType:
    """``schema`` plus the columns that a read by folder name adds."""
    fields = [f for f in schema.fields if f.name not in (APP_COL, BATCH_COL)]
    return T.StructType(fields + [T.StructField(APP_COL, T.StringType()), T.StructField(BATCH_COL, T.LongType())])


class BatchPathSink:
    """A folder per writer and batch: ``<root>/app=A/batch_id=N``. A replay replaces it."""

    def __init__(self, root: str, fmt: str = "parquet", partition_by: Sequence[str] = (), app_id: str | None = None):
        self.root = root.rstrip("/")
        self.fmt = fmt
        self.partition_by = list(partition_by)
        self.app_id = app_id
        self.schema: T.StructType | None = None

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        self.schema = df.schema
        named = df.withColumn(APP_COL, F.lit(app_of(df, self.app_id))).withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
        (named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(APP_COL, BATCH_COL, *self.partition_by).format(self.fmt).save(self.root))

    def read(self, spark: SparkSession, schema: T.StructType | None = None, keep_batch: bool = False) -> DataFrame:
        """The rows of all batches; with ``keep_batch`` also who wrote them and in which batch."""
        schema = schema or self.schema
        full = with_batch_cols(schema)
        if not paths.exists(spark, self.root):
            rows = spark.createDataFrame([], full)
        else:
            rows = spark.read.schema(full).format(self.fmt).load(self.root)
        return rows.select(*(full if keep_batch else schema).fieldNames())

    def read_latest(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        """The newest batch only: the result table of a ``complete`` query."""
        rows = self.read(spark, schema, keep_batch=True)
        newest = rows.select(F.max(BATCH_COL)).scalar()
        return rows.where(F.col(BATCH_COL) == newest).drop(APP_COL, BATCH_COL)


class _Buckets:
    """A keyed table whose rows live in ``_bucket = hash(key) mod buckets``.

    A batch reads the buckets that its keys fall into, merges and writes them by dynamic
    partition overwrite, so work and files follow the batch and the number of buckets, not
    the number of batches. Each bucket has two folders (``_slot`` 0 and 1) written in turn:
    Spark swaps the folders of a commit one by one, and a crash in between leaves every bucket
    with its old or its new rows. A bucket's rows say which batch of which writer they
    include last (``_meta``), so a replay skips the buckets that have it. One writer at a time."""

    def __init__(self, root: str, key: Sequence[str], buckets: int, app_id: str | None):
        self.root = root.rstrip("/")
        self.key = list(key)
        self.buckets = buckets
        self.app_id = app_id
        self.schema: T.StructType | None = None

    def _fold(self, df: DataFrame) -> DataFrame:
        """One row per key of a batch."""
        raise NotImplementedError

    def _merge(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """One row per key of the table's rows and a folded batch's."""
        raise NotImplementedError

    def _rows(self, spark: SparkSession, schema: T.StructType) -> DataFrame | None:
        if not paths.exists(spark, self.root):
            return None
        extra = [("_meta", T.StringType()), ("_bucket", T.IntegerType()), ("_slot", T.IntegerType())]
        full = T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in extra)])
        return spark.read.schema(full).parquet(self.root)

    def _newest(self, rows: DataFrame | None) -> dict[int, tuple[int, dict]]:
        """Slot and meta of each bucket's newest folder; at most two rows a bucket come back."""
        out: dict[int, tuple[int, dict]] = {}
        if rows is not None:
            for r in rows.groupBy("_bucket", "_slot").agg(F.first("_meta").alias("_meta")).collect():
                meta = json.loads(r["_meta"])
                if r["_bucket"] not in out or meta["seq"] > out[r["_bucket"]][1]["seq"]:
                    out[r["_bucket"]] = (r["_slot"], meta)
        return out

    @staticmethod
    def _in(chosen: dict[int, int]) -> Column:
        """Rows of the chosen slot of each bucket: a filter on folder names."""
        names = [f"{b}-{s}" for b, s in chosen.items()]
        return F.concat_ws("-", F.col("_bucket"), F.col("_slot")).isin(names)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark, app = df.sparkSession, app_of(df, self.app_id)
        folded = self._fold(df)
        self.schema = folded.schema
        new = folded.withColumn("_bucket", F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")).persist()
        try:
            touched = [r[0] for r in new.select("_bucket").distinct().collect()]
            rows = self._rows(spark, self.schema)
            found = self._newest(rows.where(F.col("_bucket").isin(touched)) if rows is not None and touched else None)
            due = [b for b in touched if found.get(b, (0, {"applied": {}}))[1]["applied"].get(app, -1) < batch_id]
            if not due:
                return
            slots, metas = {}, {}
            for b in due:
                slot, meta = found.get(b, (1, {"seq": 0, "applied": {}}))
                slots[b] = 1 - slot
                metas[b] = json.dumps({"seq": meta["seq"] + 1, "applied": meta["applied"] | {app: batch_id}})
            merged = new.where(F.col("_bucket").isin(due)).drop("_bucket")
            base = {b: found[b][0] for b in due if b in found}
            if base:
                merged = self._merge(rows.where(self._in(base)).select(*self.schema.fieldNames()), merged)
            bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
            out = merged.select(*self.schema.fieldNames(), bucket.alias("_bucket"))
            for name, of in (("_meta", metas), ("_slot", slots)):
                table = F.create_map(*[F.lit(x) for b in due for x in (b, of[b])])
                out = out.withColumn(name, table[F.col("_bucket")])
            (out.repartition(len(due), "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("_bucket", "_slot").parquet(self.root))
        finally:
            new.unpersist()

    def read(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        schema = schema or self.schema
        rows = self._rows(spark, schema)
        if rows is None:
            return spark.createDataFrame([], schema)
        newest = {b: slot for b, (slot, _) in self._newest(rows).items()}
        return rows.where(self._in(newest)).select(*schema.fieldNames())

    def seed(self, df: DataFrame) -> None:
        """Install the rows of a migrated or backfilled state: every batch comes after them."""
        app, self.app_id = self.app_id, "seed"
        try:
            self(df, 0)
        finally:
            self.app_id = app


class UpsertTable(_Buckets):
    """Keyed upsert.

    ``order`` names the columns that decide which row of a key is newest (after the
    batch). ``op_col`` (optional) marks tombstones with ``'delete'``; they stay in the table, so
    that a late older row does not bring its key back. ``unique_keys`` declares that every
    batch already holds one row per key (the output of an ``update``-mode aggregate), which
    skips the in-batch fold; without it an ``order`` is required. With ``batch_first=False`` the
    data's own ``order`` decides before the batch, so a late-arriving older record never
    overwrites a newer one."""

    def __init__(self, root: str, key: Sequence[str], order: Sequence[str] = (),
                 op_col: str | None = None, delete_value: str = "delete",
                 unique_keys: bool = False, batch_first: bool = True, app_id: str | None = None, buckets: int = 8):
        super().__init__(root, key, buckets, app_id)
        if not order and not unique_keys:
            raise ValueError("an upsert needs an order of a key's rows, or batches with unique keys")
        self.order = list(order)
        self.op_col = op_col
        self.delete_value = delete_value
        self.unique_keys = unique_keys
        self.batch_first = batch_first

    def _latest(self, df: DataFrame) -> DataFrame:
        payload = [c for c in df.columns if c not in (*self.key, *self.order)]
        return latest_per_key(df, self.key, self.order, payload).select(*df.columns)

    def _fold(self, df: DataFrame) -> DataFrame:
        return df if self.unique_keys else self._latest(df)

    def _merge(self, old: DataFrame, new: DataFrame) -> DataFrame:
        if not self.batch_first:
            return self._latest(old.unionByName(new))
        now = new.select(*[F.col(k).alias(f"_new_{k}") for k in self.key])
        same = F.lit(True)
        for k in self.key:  # a null key is a key
            same = same & F.col(k).eqNullSafe(F.col(f"_new_{k}"))
        return old.join(now, same, "left_anti").unionByName(new)

    def read(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        rows = super().read(spark, schema)
        if self.op_col:  # null-safe: a row without an op is an assignment, not a delete
            rows = rows.where(~F.col(self.op_col).eqNullSafe(F.lit(self.delete_value)))
        return rows


class AccumulatingTable(_Buckets):
    """Running totals per key: ``t.m + s.m``. A replayed batch is not added again."""

    def __init__(self, root: str, key: Sequence[str], measures: Sequence[str], app_id: str | None = None,
                 buckets: int = 8):
        super().__init__(root, key, buckets, app_id)
        self.measures = list(measures)

    def _fold(self, df: DataFrame) -> DataFrame:
        return df.groupBy(*self.key).agg(*[F.sum(m).alias(m) for m in self.measures])

    def _merge(self, old: DataFrame, new: DataFrame) -> DataFrame:
        return self._fold(old.unionByName(new))


def append_writer(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Plain append of every batch: *not* replay-safe on its own (a replayed batch is
    written twice): dedup downstream."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("append").format(fmt).save(path)
    return write


def fan_out(df: DataFrame, batch_id: int,
            targets: Sequence[tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame, int], None]]]) -> None:
    """Write one micro-batch to several sinks, computing the batch once (``persist``)."""
    df.persist()
    try:
        for select, sink in targets:
            sink(select(df), batch_id)
    finally:
        df.unpersist()


def split_dead_letter(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that parsed (``ok`` true) and the rest, which go to a dead-letter sink
    instead of silently becoming nulls downstream."""
    flag = F.coalesce(ok, F.lit(False))
    return df.where(flag), df.where(~flag)
