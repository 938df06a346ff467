"""State that meets a second batch: dedup, idle periods, joins with a growing static table;
and the plans of the folds."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from given_tables import SF0001
from rivulet.functions.numeric import exact_sum
from rivulet.operators import aggregate, dedup, duality, joins, stateful
from rivulet.session import run_dir
from rivulet.sources import envelope, tables
from rivulet.streaming import runtime
from rivulet.streaming.harness import FileDropStream
from rivulet.streaming.sinks import BatchPathSink

COPIES = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.LongType()), T.StructField("copy", T.StringType())])


def _run(spark, batches, build, name):
    got = []
    h = FileDropStream(spark, COPIES, name)
    h.start(build, "append", lambda df, b: got.extend(tuple(r) for r in df.select("id", "copy").collect()))
    try:
        for rows in batches:
            h.add(rows)
            h.process()
    finally:
        h.stop()
    return sorted(got)


def test_dedup_keeps_the_first_batch_s_copy_forever(spark, conf):
    conf("spark.sql.shuffle.partitions", "1")
    got = _run(spark, [[(1, 0, "first")], [(1, 0, "second"), (2, 5, "first")], [(2, 500_000, "late"), (1, 900_000, "late")]],
               lambda df: dedup.dedup(df, ["id"]), "dedup")
    assert got == [(1, "first"), (2, "first")]


def test_dedup_within_watermark_forgets_beyond_it(spark, conf):
    conf("spark.sql.shuffle.partitions", "1")

    def build(df):
        ev = df.withColumn("ts", F.timestamp_seconds("t"))
        return dedup.dedup_within_watermark(ev, "ts", "10 seconds", ["id"])

    got = _run(spark, [[(1, 100, "first")], [(1, 105, "redelivered")], [(9, 200, "far")], [(8, 300, "farther")],
                       [(1, 310, "long after")]], build, "dedup_wm")
    assert got == [(1, "first"), (1, "long after"), (8, "farther"), (9, "far")]


def test_idle_periods_do_not_depend_on_the_batches(spark, conf):
    conf("spark.sql.shuffle.partitions", "2")
    hour = 3600
    events = [(1, k * hour) for k in (0, 1, 2, 9, 10, 20)] + [(2, 0), (2, 5 * hour), (3, 4 * hour + 1), (4, 60 * hour)]
    events.sort(key=lambda e: e[1])
    schema = T.StructType([T.StructField("user", T.LongType()), T.StructField("t", T.LongType())])
    seen = []
    for cuts in (1, 2, 4, len(events)):
        h = FileDropStream(spark, schema, f"idle{cuts}")
        ck = run_dir(spark, "idle_ck")
        got = []
        size = -(-len(events) // cuts)
        for k in range(0, len(events), size):
            h.add(events[k:k + size])
            h.run_available_now(
                lambda df: stateful.idle_keys(df.withColumn("ts", F.timestamp_seconds("t")), "user", "ts", 6 * hour * 1000, "1 hour"),
                "append", lambda df, b: got.extend((r.user, r.cnt, r.last_ts_us // 10**6 // hour) for r in df.collect()), ck)
        seen.append(sorted(got))
    assert seen[0] == [(1, 1, 20), (1, 2, 10), (1, 3, 2), (2, 2, 5), (3, 1, 4)]
    assert all(s == seen[0] for s in seen)


def test_stream_static_join_sees_a_growing_table(spark):
    d = run_dir(spark, "growing")
    static = spark.createDataFrame([(1, "one")], "id long, name string")
    static.write.mode("append").parquet(f"{d}/static")
    h = FileDropStream(spark, COPIES, "growing_in")
    sink = BatchPathSink(f"{d}/out")
    h.start(lambda df: df, "append", joins.stream_static_join(lambda: spark.read.parquet(f"{d}/static"), "id", sink))
    try:
        h.add([(1, 0, "a"), (2, 0, "a")])
        h.process()
        spark.createDataFrame([(2, "two")], "id long, name string").write.mode("append").parquet(f"{d}/static")
        h.add([(1, 0, "b"), (2, 0, "b")])
        h.process()
    finally:
        h.stop()
    assert sorted((r.copy, r.name) for r in sink.read(spark).collect()) == [("a", "one"), ("b", "one"), ("b", "two")]


def test_sums_keep_all_decimals(spark):
    df = spark.createDataFrame([("a", 0.004), ("a", 0.004), ("a", 0.0041), ("b", 1e18)], "k string, v double")
    got = {r.k: r.total_value for r in aggregate.sum_count(df, ["k"], "v").collect()}
    assert got["a"] == pytest.approx(0.0121) and got["b"] == 1e18
    means = {r.k: r.avg_v for r in aggregate.filtered_group(df, F.lit(True), ["k"], ["v"]).collect()}
    assert means["a"] == pytest.approx(0.0121 / 3)
    assert str(df.where("k = 'a'").agg(exact_sum("v", 4)).first()[0]) == "0.0121"


def test_latest_per_key_matches_brute_force(spark):
    rows = [(k, t, i, f"p{i % 3}", float(i)) for i, (k, t) in enumerate(
        [("a", 5), ("a", 7), ("b", None), ("b", -3), ("a", 7), (None, 1), (None, 0), ("c", None)])]
    df = spark.createDataFrame(rows, "k string, t long, i long, s string, v double")
    want = {}
    for k, t, i, s, v in rows:
        key = (t if t is not None else float("-inf"), i)
        if k not in want or key > want[k][0]:
            want[k] = (key, t, i, s, v)
    fixed = aggregate.latest_per_key(df.drop("s"), ["k"], ["t", "i"], ["v"]).collect()
    assert {r.k: r.v for r in fixed if r.k != "c"} == {k: w[4] for k, w in want.items() if k != "c"}
    text = aggregate.latest_per_key(df.where("t is not null"), ["k"], ["t", "i"], ["s", "v"]).collect()
    assert {r.k: (r.t, r.i, r.s, r.v) for r in text} == {k: w[1:] for k, w in want.items() if w[1] is not None}


def test_null_keys_are_deleted_like_others(spark):
    cl = spark.createDataFrame([(1, None, "set", 5), (2, None, "delete", None), (3, "k", "set", 1)],
                               "seq long, key string, op string, value int")
    assert {r.key for r in duality.fold_upsert(cl).collect()} == {"k"}
    assert {r.key for r in duality.fold_sum(cl).collect()} == {"k"}
    assert [r.running for r in duality.scan_sum(cl).orderBy("seq").collect()] == [5, 0, 1]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _changelog(spark):
    ev = tables.events(spark, SF0001, streaming=False)
    return duality.as_changelog(ev.withColumn("cents", F.round(F.col("value") * 100).cast("long")),
                                "user_id", "cents", "event_id", F.col("event_type") == "error")


def test_folds_of_fixed_width_values_use_hash_aggregation(spark):
    ev = tables.events(spark, SF0001, streaming=False)
    cl = _changelog(spark)
    for df in (aggregate.latest_per_key(ev, ["user_id"], ["ts", "event_id"], ["value"]), duality.fold_upsert(cl),
               duality.fold_two(cl, 100), duality.fold_sum(cl),
               duality.snapshot_diff(duality.fold_upsert(cl, 100), duality.fold_upsert(cl), "key", "value")):
        assert "SortAggregate" not in _plan(df)


def test_folds_shuffle_raw_rows_once(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    cl = _changelog(spark)
    plan = _plan(duality.scan_sum(cl))
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
    on_chunk = [x for x in plan.splitlines() if re.search(r"Exchange hashpartitioning\(_null\S+, _k\S+, _chunk", x)
                and "ReusedExchange" not in x]
    assert len(on_chunk) == 2  # the raw rows, and the chunk summaries before the join
    plan = _plan(duality.fold_sum(cl))
    assert len(re.findall(r"Exchange hashpartitioning\(key\S+, _chunk", plan)) == 1


def test_bus_sink_rows(spark):
    df = spark.createDataFrame([(7, "x", 1.5)], "id long, name string, v double")
    r = envelope.sink_rows(df, "id").first()
    assert r.key == "7" and r.value == '{"id":7,"name":"x","v":1.5}'
    assert envelope.sink_rows(df).columns == ["value"]


def test_processor_needs_no_package_on_the_workers():
    from pyspark import cloudpickle

    blob = cloudpickle.dumps(stateful.IdleCounter("k", 1000))
    assert b"handleExpiredTimer" in blob  # the class travels, not its module's name
