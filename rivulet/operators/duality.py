"""Stream-table duality: changelog folds, the table at every point, snapshot diffs.

A changelog is ``(seq, key, op, value)``: ``op='set'`` assigns, ``op='delete'`` removes
the key (also the null key). Folds of fixed-width values are hash aggregates with partial
combine; the sum fold and the scan are two-level, so that one hot key is split into
chunks of the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.aggregate import latest_per_key

SET, DELETE = "set", "delete"


def as_changelog(df: DataFrame, key: str, value: str, seq: str, delete_when: Column) -> DataFrame:
    """Read any event stream as a changelog."""
    return df.select(F.col(seq).alias("seq"), F.col(key).alias("key"),
                     F.when(delete_when, F.lit(DELETE)).otherwise(F.lit(SET)).alias("op"),
                     F.col(value).alias("value"))


def fold_upsert(cl: DataFrame, upto_seq: Column | int | None = None) -> DataFrame:
    """Table = last assignment per key at log position ``upto_seq`` (inclusive);
    keys whose last record is a delete are absent. Output ``key, value, seq``."""
    if upto_seq is not None:
        cl = cl.where(F.col("seq") <= upto_seq)
    flat = cl.select("key", "seq", (F.col("op") == F.lit(SET)).alias("_set"), "value")
    last = latest_per_key(flat, ["key"], ["seq"], ["_set", "value"])
    return last.where("_set").select("key", "value", "seq")


def fold_two(cl: DataFrame, upto_seq: Column | int) -> DataFrame:
    """The upsert fold at ``upto_seq`` and at the end in one pass (whole numbers or other
    fixed-width values): ``key, old_set, old_value, new_set, new_value``."""
    early = F.when(F.col("seq") <= upto_seq, F.col("seq"))
    is_set = F.col("op") == F.lit(SET)
    flat = cl.select("key", "seq", early.alias("_early"), is_set.alias("_set"), "value")
    return flat.groupBy("key").agg(
        F.max_by("_set", "_early").alias("old_set"), F.max_by("value", "_early").alias("old_value"),
        F.max_by("_set", "seq").alias("new_set"), F.max_by("value", "seq").alias("new_value"))


def fold_sum(cl: DataFrame, chunk: int = 1 << 20) -> DataFrame:
    """Table = per key, sum of ``set`` values after the key's last delete.

    One shuffle of the raw rows, by ``(key, seq div chunk)``, so a hot key is spread over
    its chunks: each chunk's last delete and the sum and count after it. A key's chunks
    are then few: the sums from its last chunk with a delete on."""
    w = Window.partitionBy("key", "_chunk")
    c = cl.withColumn("_chunk", F.floor(F.col("seq") / F.lit(chunk)).cast("long")).withColumn(
        "_del", F.max(F.when(F.col("op") == F.lit(DELETE), F.col("seq"))).over(w))
    after = (F.col("op") == F.lit(SET)) & (F.col("_del").isNull() | (F.col("seq") > F.col("_del")))
    chunks = c.groupBy("key", "_chunk").agg(
        F.sum(F.when(after, F.col("value"))).alias("s"), F.count(F.when(after, 1)).alias("n"),
        F.max(F.when(F.col("_del").isNotNull(), F.col("_chunk"))).alias("_reset"))
    chunks = chunks.withColumn("_from", F.max("_reset").over(Window.partitionBy("key")))
    live = chunks.where(F.col("_from").isNull() | (F.col("_chunk") >= F.col("_from")))
    out = live.groupBy("key").agg(F.sum("s").alias("total"), F.sum("n").alias("n_sets"))
    return out.where("n_sets > 0")


def scan_sum(cl: DataFrame, chunk: int = 1 << 20) -> DataFrame:
    """Running sum-with-reset per key after every record (``scanLeft`` of the sum fold).

    Level 1: rows are grouped by ``(key, seq // chunk)``; inside a chunk a window gives
    the running sum since the chunk's last delete. Level 2: one summary row per chunk
    (sum since its last delete, whether it has one); a window over the small summary
    table per key gives each chunk's carry-in. A chunk never holds more than ``chunk``
    records, so no task holds a whole hot key. Output ``seq, key, op, value, running``.
    """
    set_value = F.when(F.col("op") == F.lit(SET), F.col("value")).otherwise(F.lit(0))
    # a key that is never null: the join at the end then asks for the very distribution
    # that the windows made
    blank = F.lit("0").cast(cl.schema["key"].dataType)
    c = cl.select("seq", "key", "op", "value", F.col("key").isNull().alias("_null"),
                  F.coalesce("key", blank).alias("_k"),
                  F.floor(F.col("seq") / F.lit(chunk)).cast("long").alias("_chunk"))
    by = ["_null", "_k", "_chunk"]
    w = Window.partitionBy(*by).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    step1 = c.withColumn("_cum", F.sum(set_value).over(w))
    step2 = step1.withColumn(
        "_at_reset", F.last(F.when(F.col("op") == F.lit(DELETE), F.col("_cum")), True).over(w))
    local = (step2.withColumn("_has_reset", F.col("_at_reset").isNotNull())
             .withColumn("_since", F.col("_cum") - F.coalesce(F.col("_at_reset"), F.lit(0))))
    # the hash keeps every column in this branch too, so both read one shuffle
    summary = local.groupBy(*by).agg(
        F.max_by("_since", "seq").alias("s"), F.max("_has_reset").alias("r"),
        F.max(F.hash("key", "op", "value")).alias("_all"))
    prior = Window.partitionBy("_null", "_k").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = (summary.where(F.col("_all").isNotNull())
             .withColumn("_prev_p", F.coalesce(F.sum("s").over(prior), F.lit(0)))
             .withColumn("_base", F.last(F.when(F.col("r"), F.col("_prev_p")), True).over(prior))
             .select(*by, (F.col("_prev_p") - F.coalesce(F.col("_base"), F.lit(0))).alias("_carry")))
    out = local.join(carry, by, "left")
    running = F.when(F.col("_has_reset"), F.col("_since")).otherwise(
        F.coalesce(F.col("_carry"), F.lit(0)) + F.col("_since"))
    return out.select("seq", "key", "op", "value", running.alias("running"))


def changes(both: DataFrame) -> DataFrame:
    """Net change per key from ``key, old_set, old_value, new_set, new_value`` (a set is true
    where the key is in the snapshot): ``insert``, ``update`` or ``delete`` with both
    values; unchanged keys are omitted."""
    was, now = F.coalesce("old_set", F.lit(False)), F.coalesce("new_set", F.lit(False))
    old_value, new_value = F.when(was, F.col("old_value")), F.when(now, F.col("new_value"))
    op = F.when(~was, F.lit("insert")).when(~now, F.lit("delete")).otherwise(F.lit("update"))
    changed = (was != now) | (was & ~old_value.eqNullSafe(new_value))
    return both.where(changed).select("key", op.alias("op"), old_value.alias("old_value"), new_value.alias("new_value"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Net change between two snapshots (one row per key each). One union and one
    aggregation (a single shuffle; a hash aggregate for fixed-width values), no join."""
    def side(df: DataFrame, is_new: bool) -> DataFrame:
        return df.select(F.col(key).alias("key"), F.lit(is_new).alias("_new"), F.col(value).alias("v"))

    g = side(old, False).unionByName(side(new, True)).groupBy("key").agg(
        F.max(~F.col("_new")).alias("old_set"), F.max(F.when(~F.col("_new"), F.col("v"))).alias("old_value"),
        F.max("_new").alias("new_set"), F.max(F.when(F.col("_new"), F.col("v"))).alias("new_value"))
    return changes(g)


def replay_changes(changes: DataFrame, upto_seq: Column | int | None = None) -> DataFrame:
    """The table at log position ``upto_seq`` (inclusive) from its full changes (``key, seq,
    kind, value``): a key's last change, unless it is a delete. Output ``key, value, seq``."""
    now = changes.where(F.col("kind") != "update_before")
    if upto_seq is not None:
        now = now.where(F.col("seq") <= upto_seq)
    last = latest_per_key(now.select("key", "seq", (F.col("kind") != "delete").alias("_there"), "value"),
                          ["key"], ["seq"], ["_there", "value"])
    return last.where("_there").select("key", "value", "seq")
