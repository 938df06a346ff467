"""Idempotent sinks: replays of a batch id never duplicate or double-count."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from given_tables import SF0001
from rivulet import schemas
from rivulet.operators import aggregate
from rivulet.session import run_dir
from rivulet.sources import files, tables
from rivulet.streaming import paths, runtime, transactional
from rivulet.streaming.sinks import AccumulatingTable, BatchPathSink, UpsertTable, split_dead_letter


def _kv(spark, rows, schema="k string, v long"):
    return spark.createDataFrame(rows, schema)


def _local(path):
    return Path(path.replace("file:", ""))


def _pairs(df):
    return sorted((r.k, r.v) for r in df.collect())


# ---------------------------------------------------------------- a folder per batch

def test_batch_path_replay_overwrites(spark):
    sink = BatchPathSink(run_dir(spark, "t_bp"))
    df = _kv(spark, [("a", 1), ("b", 2)])
    assert sink.read(spark, df.schema).count() == 0
    sink(df, 0)
    sink(df, 0)
    sink(_kv(spark, [("c", 3)]), 1)
    assert sorted((r.k, r.v, r.batch_id) for r in sink.read(spark, keep_batch=True).collect()) == \
        [("a", 1, 0), ("b", 2, 0), ("c", 3, 1)]
    assert [r.k for r in sink.read_latest(spark).collect()] == ["c"]


# ---------------------------------------------------------------- buckets

def _apps(make):
    return make("first"), make("second")


def test_a_new_checkpoint_brings_new_rows(spark):
    """Two queries count their batches from 0; an earlier one's replay still counts once."""
    root = run_dir(spark, "t_apps")
    one, two = _apps(lambda app: AccumulatingTable(f"{root}/acc", ["k"], ["v"], app_id=app))
    one(_kv(spark, [("a", 1)]), 0)
    one(_kv(spark, [("a", 2)]), 1)
    two(_kv(spark, [("a", 10), ("new", 1)]), 0)
    one(_kv(spark, [("a", 2)]), 1)
    assert _pairs(two.read(spark)) == [("a", 13), ("new", 1)]
    up, up2 = _apps(lambda app: UpsertTable(f"{root}/up", ["k"], order=["v"], app_id=app))
    up(_kv(spark, [("a", 5)]), 7)
    up2(_kv(spark, [("a", 3), ("new", 1)]), 0)
    assert _pairs(up2.read(spark)) == [("a", 3), ("new", 1)]
    raw, raw2 = _apps(lambda app: BatchPathSink(f"{root}/raw", app_id=app))
    raw(_kv(spark, [("a", 1)]), 0)
    raw2(_kv(spark, [("b", 1), ("c", 1)]), 0)
    assert raw2.read(spark).count() == 3


def test_streams_are_told_apart_by_their_query_id(spark):
    root = run_dir(spark, "t_query_ids")
    table = AccumulatingTable(f"{root}/t", ["event_type"], ["cnt"])
    rows = tables.events(spark, SF0001).select("event_type", F.lit(1).cast("long").alias("cnt"))
    n = tables.events(spark, SF0001, streaming=False).count()
    for k in (1, 2):
        runtime.run_to_end(rows, f"{root}/ck{k}", foreach_batch=table)
        assert table.read(spark).agg(F.sum("cnt")).first()[0] == k * n


def test_many_batches_leave_two_folders_a_bucket(spark):
    t = AccumulatingTable(run_dir(spark, "t_many"), ["k"], ["v"], buckets=3)
    for b in range(9):
        t(_kv(spark, [(f"k{i}", b) for i in range(b, b + 4)]), b)
    assert len(list(_local(t.root).glob("_bucket=*/_slot=*"))) <= 6
    want = {}
    for b in range(9):
        for i in range(b, b + 4):
            want[f"k{i}"] = want.get(f"k{i}", 0) + b
    assert _pairs(t.read(spark)) == sorted(want.items())


def test_a_batch_leaves_other_buckets_alone(spark):
    t = UpsertTable(run_dir(spark, "t_alone"), ["k"], order=["v"], buckets=64)
    t(_kv(spark, [(f"k{i}", i) for i in range(50)]), 0)
    before = {p: p.stat().st_mtime_ns for p in _local(t.root).glob("_bucket=*/_slot=*/*.parquet")}
    t(_kv(spark, [("k7", 700)]), 1)
    after = {p: p.stat().st_mtime_ns for p in _local(t.root).glob("_bucket=*/_slot=*/*.parquet")}
    assert all(after.get(p) == m for p, m in before.items()) and len(after) == len(before) + 1
    assert dict(_pairs(t.read(spark)))["k7"] == 700 and t.read(spark).count() == 50


@pytest.mark.parametrize("replay", [False, True])
def test_a_crash_in_the_middle_of_a_commit_keeps_old_rows(spark, replay):
    """Spark swaps a commit's folders one by one; here one bucket's new folder never came."""
    t = AccumulatingTable(run_dir(spark, "t_half"), ["k"], ["v"], buckets=4)
    keys = [f"k{i}" for i in range(12)]
    t(_kv(spark, [(k, 1) for k in keys]), 0)
    old = {p.parent.name: p.name for p in _local(t.root).glob("_bucket=*/_slot=*")}
    t(_kv(spark, [(k, 10) for k in keys]), 1)
    new = [p for p in _local(t.root).glob("_bucket=*/_slot=*") if old[p.parent.name] != p.name]
    shutil.rmtree(new[0])
    values = {r.v for r in t.read(spark).collect()}
    assert values == {1, 11}
    if replay:
        t(_kv(spark, [(k, 10) for k in keys]), 1)
        assert _pairs(t.read(spark)) == sorted((k, 11) for k in keys)


def test_upsert_without_an_order_is_refused(spark):
    with pytest.raises(ValueError):
        UpsertTable(run_dir(spark, "t_no_order"), ["k"])


def test_upsert_table_with_deletes(spark):
    t = UpsertTable(run_dir(spark, "t_ups"), ["k"], order=["seq"], op_col="op", batch_first=False)
    schema = "k string, seq long, op string, v long"
    t(_kv(spark, [("a", 1, "set", 1), ("b", 2, "set", 2), ("a", 3, "set", 9), (None, 1, "set", 7)], schema), 0)
    t(_kv(spark, [("b", 5, "delete", None), (None, 2, None, 8)], schema), 1)
    assert {(r.k, r.v) for r in t.read(spark).collect()} == {("a", 9), (None, 8)}
    t(_kv(spark, [("b", 4, "set", 4)], schema), 2)  # older than the delete
    assert {(r.k, r.v) for r in t.read(spark).collect()} == {("a", 9), (None, 8)}
    t(_kv(spark, [("b", 6, "set", 5)], schema), 3)
    assert {(r.k, r.v) for r in t.read(spark).collect()} == {("a", 9), ("b", 5), (None, 8)}


def test_upsert_of_null_and_equal_keys_by_batch(spark):
    t = UpsertTable(run_dir(spark, "t_null_key"), ["k"], unique_keys=True)
    t(_kv(spark, [(None, 1), ("a", 1)]), 0)
    t(_kv(spark, [(None, 2)]), 1)
    assert sorted((r.k or "", r.v) for r in t.read(spark).collect()) == [("", 2), ("a", 1)]


def test_upsert_by_sequence_ignores_late_older_records(spark):
    schema = "k string, seq long, v long"
    by_seq = UpsertTable(run_dir(spark, "t_ups_seq"), ["k"], order=["seq"], batch_first=False)
    by_batch = UpsertTable(run_dir(spark, "t_ups_batch"), ["k"], order=["seq"])
    for t in (by_seq, by_batch):
        t(_kv(spark, [("a", 5, 50)], schema), 0)
        t(_kv(spark, [("a", 3, 30)], schema), 1)  # older record arriving later
    assert [r.v for r in by_seq.read(spark).collect()] == [50]
    assert [r.v for r in by_batch.read(spark).collect()] == [30]


def test_accumulating_table_replay_does_not_double_count(spark):
    t = AccumulatingTable(run_dir(spark, "t_acc"), ["k"], ["v"])
    t.seed(_kv(spark, [("a", 1000), ("z", 1)]))
    t(_kv(spark, [("a", 1), ("a", 2)]), 0)
    t(_kv(spark, [("a", 1), ("a", 2)]), 0)
    t(_kv(spark, [("a", 10)]), 1)
    assert _pairs(t.read(spark)) == [("a", 1013), ("z", 1)]
    t(_kv(spark, [("a", 100), ("b", 1)]), 2)
    assert _pairs(t.read(spark)) == [("a", 1113), ("b", 1), ("z", 1)]


# ---------------------------------------------------------------- transactional folder

KV = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def _staged(root):
    return list(_local(root).glob("_staged/*"))


def test_write_once_applies_each_version_once_per_app(spark):
    root = run_dir(spark, "t_txn")
    df = _kv(spark, [("x", 1), ("y", 2)]).repartition(2)
    for _ in range(2):
        transactional.write_once(df, root, "a", 0)
        transactional.write_once(df, root, "b", 0)
    transactional.write_once(df, root, "a", 1)
    rows = transactional.published(spark, root, KV, keep_batch=True)
    assert sorted((r.app, r.batch_id, r.k) for r in rows.collect()) == sorted(
        (app, b, k) for app, b in (("a", 0), ("b", 0), ("a", 1)) for k in "xy")
    assert _staged(root) == []


def test_an_empty_batch_is_marked_as_processed(spark):
    root = run_dir(spark, "t_txn_empty")
    transactional.write_once(_kv(spark, []), root, "a", 0)
    transactional.write_once(_kv(spark, [("late", 1)]), root, "a", 0)
    transactional.write_once(_kv(spark, [("x", 1)]), root, "a", 1)
    assert _pairs(transactional.published(spark, root, KV)) == [("x", 1)]


def test_a_failed_batch_publishes_nothing_and_leaves_nothing(spark):
    root = run_dir(spark, "t_txn_abort")
    src = run_dir(spark, "t_txn_abort_in")
    files.write_slices(tables.events(spark, SF0001, streaming=False), src, 1, "event_id")
    ck = run_dir(spark, "t_txn_abort_ck")

    def run(broken):
        stream = files.parquet_stream(spark, f"{src}/slice-*", schemas.EVENTS_SLICED).select("event_id").repartition(4)
        if broken:
            bad = F.when(F.col("event_id") % 100 == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("event_id"))
            stream = stream.select(bad.cast("long").alias("event_id"))
        runtime.run_to_end(stream, ck, sink=root, fmt=transactional.register(spark), options={"appId": "q"})

    with pytest.raises(Exception, match="broken"):
        run(True)
    assert not paths.exists(spark, f"{root}/app=q")
    run(False)
    rows = transactional.published(spark, root, T.StructType([T.StructField("event_id", T.LongType())]))
    assert rows.count() == rows.distinct().count() == tables.events(spark, SF0001, streaming=False).count()


def test_replays_of_a_stateful_stream_keep_its_state(spark):
    """A replayed batch publishes nothing, but it runs, so the state store commits."""
    d = run_dir(spark, "t_txn_state")
    src = f"{d}/in"
    sliced = files.Slices(tables.events(spark, SF0001, streaming=False), 3, "event_id")
    for i in range(3):
        files.write_slice(sliced, src, i)
        for again in range(2):
            if again:
                done = max(int(n) for n in paths.list_names(spark, f"{d}/ck/commits") if n.isdigit())
                paths.delete(spark, f"{d}/ck/commits/{done}")
                paths.delete(spark, f"{d}/ck/commits/.{done}.crc")
            stream = files.parquet_stream(spark, f"{src}/slice-*", schemas.EVENTS_SLICED)
            users = stream.select("user_id").dropDuplicates(["user_id"])
            runtime.run_to_end(users, f"{d}/ck", sink=f"{d}/out", fmt=transactional.register(spark),
                               options={"appId": "q"})
    rows = transactional.published(spark, f"{d}/out", users.schema)
    assert rows.count() == tables.events(spark, SF0001, streaming=False).select("user_id").distinct().count()


def test_complete_mode_and_missing_options_are_refused(spark):
    counts = aggregate.group_count(tables.events(spark, SF0001), ["event_type"])
    d = run_dir(spark, "t_txn_refused")
    with pytest.raises(Exception, match="[Cc]omplete mode"):
        runtime.run_to_end(counts, f"{d}/ck", output_mode="complete", sink=f"{d}/out",
                           fmt=transactional.register(spark), options={"appId": "q"})
    with pytest.raises(Exception, match="appId"):
        _kv(spark, [("x", 1)]).write.format(transactional.register(spark)).mode("append").option("path", d).save()


def test_dead_letter_split(spark):
    df = _kv(spark, [("a", 1), ("b", None)])
    good, bad = split_dead_letter(df, F.col("v").isNotNull())
    assert [r.k for r in good.collect()] == ["a"] and [r.k for r in bad.collect()] == ["b"]


def test_partitioned_write_replay_replaces_only_its_partitions(spark):
    root = f"{run_dir(spark, 't_partw')}/table"

    def write(df, batch_id):
        (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", "day").parquet(root))

    write(_kv(spark, [(1, "a"), (2, "b")], "day long, k string"), 0)
    write(_kv(spark, [(1, "c")], "day long, k string"), 1)
    write(_kv(spark, [(1, "a"), (2, "b")], "day long, k string"), 0)  # replay of batch 0
    got = spark.read.parquet(root)
    assert sorted((r.batch_id, r.day, r.k) for r in got.collect()) == \
        [(0, 1, "a"), (0, 2, "b"), (1, 1, "c")]
    # a filter on a partition column prunes folders at the scan
    pruned = got.where(F.col("day") == 2)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert [r.k for r in pruned.collect()] == ["b"]
