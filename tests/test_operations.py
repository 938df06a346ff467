"""Operations: replay of a planned-but-uncommitted batch, pinned state partitions,
multi-stream watermark policy, state export/seed, compaction."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from given_tables import SF0001
from rivulet import schemas
from rivulet.operators import aggregate, windows
from rivulet.plans.materialize import append_to_parquet
from rivulet.session import run_dir
from rivulet.sources import files, state, tables
from rivulet.streaming import observe, operations, runtime
from rivulet.streaming.sinks import AccumulatingTable, BatchPathSink, UpsertTable


def _local(path: str) -> Path:
    return Path(path.replace("file:", ""))


def test_uncommitted_batch_is_replayed_with_same_id_and_rows(spark):
    root = run_dir(spark, "t_replay_in")
    files.write_slices(tables.events(spark, SF0001, streaming=False), root, 2, "event_id")
    stream = files.parquet_stream(spark, f"{root}/slice-*", schemas.EVENTS_SLICED, max_files=1)
    seen: dict[int, set] = {}

    def record(df, batch_id):
        seen.setdefault(batch_id, set()).update(r.event_id for r in df.select("event_id").collect())

    ck = run_dir(spark, "t_replay_ck")
    runtime.run_to_end(stream, ck, foreach_batch=record)
    first = {k: set(v) for k, v in seen.items()}
    assert sorted(first) == [0, 1]
    # a copy of the checkpoint in which batch 1 was planned (offset log) but never committed
    copy = run_dir(spark, "t_replay_ck_copy")
    shutil.copytree(_local(ck), _local(copy), ignore=lambda d, names: ["1", ".1.crc"]
                    if d.endswith("commits") else [])
    seen.clear()
    runtime.run_to_end(stream, copy, foreach_batch=record)
    assert list(seen) == [1] and seen[1] == first[1]


def test_shuffle_partitions_are_pinned_by_the_checkpoint(spark, conf):
    agg = aggregate.group_count(tables.events(spark, SF0001), ["event_type"])
    d = run_dir(spark, "t_pinned")
    conf("spark.sql.shuffle.partitions", "2")
    runtime.run_to_end(agg, f"{d}/ck", output_mode="update", foreach_batch=BatchPathSink(f"{d}/a"))
    conf("spark.sql.shuffle.partitions", "7")
    runtime.run_to_end(agg, f"{d}/ck", output_mode="update", foreach_batch=BatchPathSink(f"{d}/a"))
    meta = state.read_state_metadata(spark, f"{d}/ck").collect()
    assert {r.numPartitions for r in meta} == {2}


def _union_windows(spark, policy, conf):
    conf("spark.sql.streaming.multipleWatermarkPolicy", policy)
    a = tables.events(spark, SF0001).withWatermark("ts", "1 day")
    b = tables.events(spark, SF0001).withWatermark("ts", "3 days")
    agg = windows.windowed_agg(a.unionByName(b), "ts", "1 day", [F.count("*").alias("cnt")])
    return append_to_parquet(agg, f"t_policy_{policy}").count()


def test_multiple_watermark_policy_min_vs_max(spark, conf):
    ev = tables.events(spark, SF0001, streaming=False)
    mx = ev.agg(F.max("ts")).first()[0]
    days = ev.select(F.unix_seconds(F.col("ts")).alias("s")).select(
        (F.floor(F.col("s") / 86400) * 86400).alias("d")).distinct().collect()
    top = mx.timestamp()
    expect = {p: sum(1 for r in days if r.d + 86400 <= top - delay)
              for p, delay in (("min", 3 * 86400), ("max", 86400))}
    assert _union_windows(spark, "min", conf) == expect["min"]
    assert _union_windows(spark, "max", conf) == expect["max"]
    assert expect["max"] > expect["min"]


def test_migrated_totals_are_continued(spark):
    agg = aggregate.group_count(tables.events(spark, SF0001), ["event_type"])
    d = run_dir(spark, "t_migrate")
    runtime.run_to_end(agg, f"{d}/ck", output_mode="update",
                       foreach_batch=UpsertTable(f"{d}/t", ["event_type"], unique_keys=True))
    table = AccumulatingTable(f"{d}/t2", ["event_type"], ["cnt"])
    operations.migrate_totals(spark, f"{d}/ck", f"{d}/state", table, lambda st: st.select(
        "event_type", F.col("count").alias("cnt")))
    ones = tables.events(spark, SF0001).select("event_type", F.lit(1).cast("long").alias("cnt"))
    runtime.run_to_end(ones, f"{d}/ck2", foreach_batch=table)
    want = {r.event_type: 2 * r.cnt for r in aggregate.group_count(
        tables.events(spark, SF0001, streaming=False), ["event_type"]).collect()}
    assert {r.event_type: r.cnt for r in table.read(spark).collect()} == want


def test_reset_and_backfill_starts_over(spark):
    d = run_dir(spark, "t_backfill")
    table = AccumulatingTable(f"{d}/t", ["event_type"], ["cnt"])
    table(spark.createDataFrame([("click", 1_000_000)], "event_type string, cnt long"), 0)
    ones = lambda: tables.events(spark, SF0001).select("event_type", F.lit(1).cast("long").alias("cnt"))
    new = operations.reset_and_backfill(table, f"{d}/t-v2", ones, runtime.checkpoint_for(f"{d}/t-v2", 2))
    n = tables.events(spark, SF0001, streaming=False).count()
    assert new.read(spark).agg(F.sum("cnt")).first()[0] == n
    assert table.read(spark).first().cnt == 1_000_000  # still there for readers under way
    with pytest.raises(ValueError):
        operations.reset_and_backfill(table, f"{d}/t-v2", ones, runtime.checkpoint_for(f"{d}/t-v3"))


def test_state_partitions_are_the_callers_choice(spark, conf):
    conf("spark.sql.shuffle.partitions", "5")
    agg = aggregate.group_count(tables.events(spark, SF0001), ["event_type"])
    for asked, got in ((3, 3), (None, 5)):
        d = run_dir(spark, "t_parts")
        runtime.run_to_end(agg, f"{d}/ck", output_mode="update", foreach_batch=BatchPathSink(f"{d}/a"),
                           state_partitions=asked)
        assert {r.numPartitions for r in state.read_state_metadata(spark, f"{d}/ck").collect()} == {got}
    assert spark.conf.get("spark.sql.shuffle.partitions") == "5"


def test_audit_past_log_retention_and_manifest_compaction(spark, conf):
    conf("spark.sql.streaming.minBatchesToRetain", "2")
    conf("spark.sql.streaming.fileSink.log.compactInterval", "3")
    root, sink, ck = (run_dir(spark, f"t_audit_{x}") for x in ("in", "sink", "ck"))
    sliced = files.Slices(tables.events(spark, SF0001, streaming=False), 12, "event_id")
    for i in range(12):
        files.write_slice(sliced, root, i)
        stream = files.parquet_stream(spark, f"{root}/slice-*", schemas.EVENTS_SLICED)
        runtime.run_to_end(stream, ck, sink=sink)
    got = observe.audit_checkpoints(spark, {"q": (ck, sink)}).collect()
    assert got and all(r.aligned for r in got) and max(r.batch_id for r in got) == 11
    assert min(r.batch_id for r in got) > 0  # older offsets are gone and not judged
    shutil.rmtree(_local(f"{ck}/commits/11"), ignore_errors=True)
    _local(f"{ck}/commits/11").unlink(missing_ok=True)
    late = {r.batch_id: r.aligned for r in observe.audit_checkpoints(spark, {"q": (ck, sink)}).collect()}
    assert late[11] is False and all(v for k, v in late.items() if k != 11)


def test_arrivals_do_not_depend_on_the_number_of_files(spark, conf, monkeypatch):
    """Slices of several files are still one batch each."""
    from rivulet.plans import queries

    conf("spark.sql.files.maxRecordsPerFile", "100")
    seen = []
    queries._feed(spark, SF0001, "t_many_files", lambda df, b: seen.append((b, df.select("slice").distinct().count(), df.count())))
    assert [b for b, *_ in seen] == [0, 1, 2, 3] and all(s == 1 and n > 100 for _, s, n in seen)


def test_compaction_keeps_rows_and_reduces_files(spark):
    root = run_dir(spark, "t_compact_in")
    files.write_slices(tables.events(spark, SF0001, streaming=False), root, 4, "event_id")
    stream = files.parquet_stream(spark, f"{root}/slice-*", schemas.EVENTS_SLICED, max_files=1)
    sink = run_dir(spark, "t_compact_sink")
    runtime.run_to_end(stream, runtime.checkpoint_for(sink), sink=sink)
    dst = run_dir(spark, "t_compact_out")
    assert operations.compact_files(spark, sink, dst) == 1
    before = spark.read.parquet(sink)
    after = spark.read.parquet(dst)
    assert after.exceptAll(before).count() == 0 and after.count() == before.count()
    assert len(list(_local(dst).glob("*.parquet"))) < len(list(_local(sink).glob("*.parquet")))


def test_pacing_by_files_per_trigger(spark):
    root = run_dir(spark, "t_pacing_in")
    files.write_slices(tables.events(spark, SF0001, streaming=False), root, 4, "event_id")
    for per_trigger, batches in ((1, 4), (2, 2), (None, 1)):
        stream = files.parquet_stream(spark, f"{root}/slice-*", schemas.EVENTS_SLICED,
                                      max_files=per_trigger)
        seen = []
        runtime.run_to_end(stream, run_dir(spark, "t_pacing_ck"),
                           foreach_batch=lambda df, b: seen.append((b, df.count())))
        assert len([b for b, n in seen if n]) == batches


def test_memory_sink_is_a_named_table(spark):
    name = "rivulet_mem_test"
    q = (tables.events(spark, SF0001).groupBy("event_type").count()
         .writeStream.outputMode("complete").format("memory").queryName(name)
         .option("checkpointLocation", run_dir(spark, "t_mem_ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table(name).count() == 5
