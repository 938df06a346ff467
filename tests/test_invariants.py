"""Invariants: batch = stream for stateless chains, sliding-window membership, and the
emission of update vs complete output modes."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from given_tables import SF0001
from rivulet.operators import stateless, windows
from rivulet.plans.materialize import append_to_parquet
from rivulet.sources import tables
from rivulet.streaming.harness import FileDropStream


def test_stateless_chain_same_on_read_and_readstream(spark):
    batch = stateless.enrich_events(tables.events(spark, SF0001, streaming=False))
    stream = append_to_parquet(stateless.enrich_events(tables.events(spark, SF0001)), "t_p10")
    assert batch.exceptAll(stream).count() == 0 and stream.exceptAll(batch).count() == 0


def test_sliding_window_count_per_event(spark):
    df = spark.createDataFrame([("2024-01-01 09:08:22",)], "t string") \
        .select(F.col("t").cast("timestamp").alias("ts"))
    out = windows.windowed_agg(df, "ts", "15 minutes", [F.count("*").alias("cnt")], slide="5 minutes")
    starts = sorted(r.win_start % 86400 for r in out.collect())
    # [08:55, 09:10), [09:00, 09:15), [09:05, 09:20): slide divides size -> size/slide windows
    assert starts == [8 * 3600 + 55 * 60, 9 * 3600, 9 * 3600 + 5 * 60]


def _mode_emissions(spark, conf, mode):
    conf("spark.sql.shuffle.partitions", "2")
    schema = T.StructType([T.StructField("k", T.StringType())])
    emitted = []

    def collect(df, batch_id):
        emitted.append(sorted((r.k, r.cnt) for r in df.collect()))

    h = FileDropStream(spark, schema, f"modes_{mode}")
    h.start(lambda s: s.groupBy("k").agg(F.count("*").alias("cnt")), mode, collect)
    try:
        for batch in (["A"] * 5 + ["B"] * 3, ["A"] * 2 + ["C"], ["B"] * 6 + ["D"] * 2):
            h.add([(k,) for k in batch])
            h.process()
    finally:
        h.stop()
    return [e for e in emitted if e]


def test_update_mode_emits_changed_rows_only(spark, conf):
    assert _mode_emissions(spark, conf, "update") == [
        [("A", 5), ("B", 3)], [("A", 7), ("C", 1)], [("B", 9), ("D", 2)]]


def test_complete_mode_emits_whole_table(spark, conf):
    assert _mode_emissions(spark, conf, "complete") == [
        [("A", 5), ("B", 3)], [("A", 7), ("B", 3), ("C", 1)],
        [("A", 7), ("B", 9), ("C", 1), ("D", 2)]]


def test_windows_align_to_utc_epoch_in_any_session_zone(spark, conf):
    conf("spark.sql.session.timeZone", "Asia/Kolkata")
    df = spark.createDataFrame([("2024-01-01T09:10:00Z",)], "t string") \
        .select(F.col("t").cast("timestamp").alias("ts"))
    out = windows.windowed_agg(df, "ts", "1 hour", [F.count("*").alias("cnt")]).collect()
    # 09:00 UTC = 14:30 in Kolkata: buckets follow the UTC epoch, not local hours
    assert [(r.win_start % 86400, r.win_end % 86400) for r in out] == [(9 * 3600, 10 * 3600)]


def test_event_time_of_stored_wall_clock_is_utc_in_any_session_zone(spark, conf):
    conf("spark.sql.session.timeZone", "America/Los_Angeles")
    ev = tables.events(spark, SF0001, streaming=False).select(F.unix_micros("ts").alias("us"))
    conf("spark.sql.session.timeZone", "UTC")
    ev_utc = tables.events(spark, SF0001, streaming=False).select(F.unix_micros("ts").alias("us"))
    assert ev.exceptAll(ev_utc).count() == 0


def test_ntz_wall_clock_becomes_utc_instant_across_dst_in_any_zone(spark, conf):
    conf("spark.sql.session.timeZone", "America/Los_Angeles")
    # 02:30 on 2024-03-10 does not exist in Los Angeles; 01:30 on 2024-11-03 occurs twice
    walls = ["2024-03-10 02:30:00.123456", "2024-11-03 01:30:00", "2024-01-01 00:00:07.179575"]
    df = spark.createDataFrame([(w,) for w in walls], "w string") \
        .select(F.col("w").cast("timestamp_ntz").alias("ts"))
    got = tables.with_event_time(df).select(F.unix_micros("ts").alias("us")).collect()
    assert [r.us for r in got] == [1710037800123456, 1730597400000000, 1704067207179575]


def test_events_read_as_utc_instants_whatever_the_session_zone(spark, conf):
    conf("spark.sql.session.timeZone", "Pacific/Chatham")
    ev = tables.events(spark, SF0001, streaming=False).orderBy("event_id").limit(1) \
        .select(F.unix_micros("ts").alias("us")).collect()
    import pyarrow.parquet as pq
    raw = pq.read_table(f"{SF0001}/events.parquet", columns=["event_id", "ts"]).to_pandas()
    first = raw.sort_values("event_id").iloc[0]["ts"]
    assert ev[0].us == first.value // 1000


def test_event_time_filter_is_pushed_and_exact(spark):
    import duckdb
    cut = "2024-01-01 12:00:00"
    q = tables.events(spark, SF0001, streaming=False).where(
        F.col("ts") >= F.to_timestamp(F.lit(cut + "Z"), "yyyy-MM-dd HH:mm:ssX"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan
    want = duckdb.connect().execute(
        f"SELECT count(*) FROM '{SF0001}/events.parquet' WHERE ts >= TIMESTAMP '{cut}'").fetchall()[0][0]
    assert q.count() == want
