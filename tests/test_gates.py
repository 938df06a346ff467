"""Plan-time gates: illegal streaming shapes are refused at start, not at run time."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from given_tables import SF0001
from rivulet.operators import windows
from rivulet.session import run_dir
from rivulet.sources import tables
from rivulet.streaming import runtime
from rivulet.streaming.sinks import BatchPathSink


def _start(df, mode):
    d = run_dir(df.sparkSession, "gate")
    return runtime.start(df, f"{d}/ck", output_mode=mode, foreach_batch=BatchPathSink(f"{d}/t"))


def test_global_sort_of_stream_is_refused(spark):
    with pytest.raises(AnalysisException):
        _start(tables.events(spark, SF0001).orderBy("ts"), "append")


def test_aggregation_without_watermark_refused_in_append(spark):
    agg = tables.events(spark, SF0001).groupBy("event_type").count()
    with pytest.raises(AnalysisException):
        _start(agg, "append")


def test_dedup_with_complete_mode_refused(spark):
    with pytest.raises(AnalysisException):
        _start(tables.events(spark, SF0001).dropDuplicates(["event_id"]), "complete")


def test_chained_windows_refused_in_update(spark):
    agg = windows.chained_windows(tables.events(spark, SF0001), "ts", "1 hour", "1 day", "1 day")
    with pytest.raises(AnalysisException):
        _start(agg, "update")


def test_outer_stream_stream_join_without_watermark_refused(spark):
    a = tables.events(spark, SF0001).select("event_id", "user_id")
    b = tables.events(spark, SF0001).select("event_id", "event_type")
    with pytest.raises(AnalysisException):
        _start(a.join(b, "event_id", "left_outer"), "append")


def test_session_window_needs_a_key(spark):
    with pytest.raises(ValueError):
        windows.session_agg(tables.events(spark, SF0001), "ts", "1 hour", [], [F.count("*")])


def test_output_mode_change_on_checkpoint_is_refused(spark):
    agg = tables.events(spark, SF0001).groupBy("event_type").count()
    d = run_dir(spark, "gate_mode")
    runtime.run_to_end(agg, f"{d}/ck", output_mode="update", foreach_batch=BatchPathSink(f"{d}/t"))
    with pytest.raises(ValueError, match="mode"):
        runtime.start(agg, f"{d}/ck", output_mode="complete", foreach_batch=BatchPathSink(f"{d}/t"))


def test_trigger_for_run_modes():
    assert runtime.trigger_for("catchup") == {"availableNow": True}
    assert runtime.trigger_for("steady", "5 seconds") == {"processingTime": "5 seconds"}
    with pytest.raises(ValueError):
        runtime.trigger_for("sometimes")


def test_watermark_without_window_refused_in_append(spark):
    ev = tables.events(spark, SF0001).withWatermark("ts", "1 day")
    with pytest.raises(AnalysisException):
        _start(ev.groupBy("event_type").count(), "append")


def test_changing_the_grouping_key_on_a_checkpoint_fails(spark):
    from rivulet import schemas
    from rivulet.sources import files

    root = run_dir(spark, "gate_key_in")
    sliced = files.with_slices(tables.events(spark, SF0001, streaming=False), 2, "event_id")
    d = run_dir(spark, "gate_key")

    def stream():
        return files.parquet_stream(spark, f"{root}/slice-*", schemas.EVENTS_SLICED)

    files.write_slice(sliced, root, 0)
    runtime.run_to_end(stream().groupBy("event_type").count(), f"{d}/ck", output_mode="update",
                       foreach_batch=BatchPathSink(f"{d}/t"))
    files.write_slice(sliced, root, 1)  # new data, so the restarted query reads its state
    with pytest.raises(Exception, match="(?i)schema|state"):
        runtime.run_to_end(stream().groupBy("user_id").count(), f"{d}/ck", output_mode="update",
                           foreach_batch=BatchPathSink(f"{d}/t2"))


def test_inner_stream_stream_join_without_watermark_runs(spark):
    a = tables.events(spark, SF0001).select("event_id", "user_id")
    b = tables.events(spark, SF0001).select("event_id", "event_type")
    d = run_dir(spark, "gate_inner")
    sink = BatchPathSink(f"{d}/t")
    runtime.run_to_end(a.join(b, "event_id"), f"{d}/ck", foreach_batch=sink)
    assert sink.read(spark).count() == tables.events(spark, SF0001, streaming=False).count()


# ---------------------------------------------------------------- the rest of the matrix

def test_stateless_query_in_complete_mode_is_refused(spark):
    with pytest.raises(AnalysisException):
        _start(tables.events(spark, SF0001).select("event_id"), "complete")


def test_stateless_query_in_update_mode_is_append(spark):
    d = run_dir(spark, "gate_stateless_update")
    sink = BatchPathSink(f"{d}/t")
    runtime.run_to_end(tables.events(spark, SF0001).select("event_id"), f"{d}/ck", output_mode="update",
                       foreach_batch=sink)
    assert sink.read(spark).count() == tables.events(spark, SF0001, streaming=False).count()


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_limit_outside_append_and_complete(spark, mode):
    """``limit`` of a stream counts rows for good: not in update; in complete it limits the
    result table of an aggregate."""
    ev = tables.events(spark, SF0001)
    if mode == "update":
        with pytest.raises(AnalysisException):
            _start(ev.select("event_id").limit(3), mode)
        return
    d = run_dir(spark, "gate_limit")
    sink = BatchPathSink(f"{d}/t")
    runtime.run_to_end(ev.groupBy("user_id").count().limit(3), f"{d}/ck", output_mode=mode, foreach_batch=sink)
    assert sink.read_latest(spark).count() == 3


def test_sort_on_an_aggregate_in_complete_mode_is_legal(spark):
    d = run_dir(spark, "gate_sort_complete")
    sink = BatchPathSink(f"{d}/t")
    agg = tables.events(spark, SF0001).groupBy("event_type").count().orderBy(F.desc("count"))
    runtime.run_to_end(agg, f"{d}/ck", output_mode="complete", foreach_batch=sink)
    assert sink.read_latest(spark).count() == 5


def test_session_window_in_update_mode_is_refused(spark):
    agg = windows.session_agg(tables.events(spark, SF0001), "ts", "1 hour", ["user_id"],
                              [F.count("*").alias("cnt")], delay="1 day")
    with pytest.raises(AnalysisException):
        _start(agg, "update")


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_outer_stream_stream_join_needs_append_mode(spark, mode):
    a = tables.events(spark, SF0001).select("event_id", F.col("ts").alias("t1")).withWatermark("t1", "1 day")
    b = tables.events(spark, SF0001).select(F.col("event_id").alias("e2"), F.col("ts").alias("t2")).withWatermark("t2", "1 day")
    j = a.join(b, (F.col("event_id") == F.col("e2")) & (F.col("t2") >= F.col("t1"))
               & (F.col("t2") <= F.col("t1") + F.expr("INTERVAL 1 HOUR")), "left_outer")
    with pytest.raises(AnalysisException):
        _start(j, mode)


def test_a_refused_start_leaves_the_checkpoint_usable(spark):
    d = run_dir(spark, "gate_refused")
    rows = tables.events(spark, SF0001).select("event_id")
    with pytest.raises(AnalysisException):
        runtime.start(rows, f"{d}/ck", output_mode="complete", foreach_batch=BatchPathSink(f"{d}/t"))
    sink = BatchPathSink(f"{d}/t")
    runtime.run_to_end(rows, f"{d}/ck", output_mode="append", foreach_batch=sink)
    assert sink.read(spark).count() > 0


def test_a_shared_folder_is_required_off_local_mode(monkeypatch):
    from rivulet import session

    class Nothing:
        def isDefined(self):  # noqa: N802
            return False

    class Fake:
        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            class _jsc:  # noqa: N801
                sc = staticmethod(lambda: type("SC", (), {"getCheckpointDir": staticmethod(lambda: Nothing())}))

    with pytest.raises(ValueError, match="checkpoint"):
        session.work_root(Fake)
