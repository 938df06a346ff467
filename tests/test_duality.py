"""Changelog folds, the scan, and snapshot diffs: fixtures from the duality notes and
brute-force checks on the driver tables (including a key holding a third of the rows)."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import functions as F

from given_tables import SF0001
from rivulet import schemas
from rivulet.operators import duality
from rivulet.sources import tables


def _cl(spark, recs):
    rows = [(i + 1, k, op, v) for i, (k, op, v) in enumerate(recs)]
    return spark.createDataFrame(rows, schemas.CHANGELOG)


def _as_dict(df, col="value"):
    return {r.key: r[col] for r in df.collect()}


def test_upsert_fold_and_position(spark):
    cl = _cl(spark, [("alice", "set", 100), ("bob", "set", 50), ("alice", "set", 120),
                     ("bob", "delete", None)])
    assert _as_dict(duality.fold_upsert(cl)) == {"alice": 120}
    assert _as_dict(duality.fold_upsert(cl, upto_seq=2)) == {"alice": 100, "bob": 50}


def test_sum_fold_vs_upsert_fold(spark):
    cl = _cl(spark, [("widget", "set", 5), ("gadget", "set", 3), ("widget", "set", 5),
                     ("widget", "set", 2), ("gadget", "delete", None)])
    assert _as_dict(duality.fold_upsert(cl)) == {"widget": 2}
    assert _as_dict(duality.fold_sum(cl), "total") == {"widget": 12}
    assert _as_dict(duality.fold_upsert(cl, upto_seq=3)) == {"widget": 5, "gadget": 3}


def _events_changelog(spark, hot: bool):
    ev = tables.events(spark, SF0001, streaming=False)
    key = F.col("user_id")
    if hot:  # every third event belongs to one key
        key = F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    ev = ev.withColumn("k", key).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    return duality.as_changelog(ev, "k", "cents", "event_id", F.col("event_type") == "error")


def _brute_scan(rows):
    run = defaultdict(int)
    out = {}
    for seq, key, op, value in sorted(rows):
        run[key] = 0 if op == "delete" else run[key] + value
        out[seq] = run[key]
    return out


def test_scan_matches_sequential_fold_across_chunks(spark):
    for hot in (False, True):
        cl = _events_changelog(spark, hot)
        rows = [(r.seq, r.key, r.op, r.value) for r in cl.collect()]
        expect = _brute_scan(rows)
        for chunk in (37, 1 << 20):
            got = {r.seq: r.running for r in duality.scan_sum(cl, chunk=chunk).collect()}
            assert got == expect, (hot, chunk)


def test_fold_sum_matches_brute_force_with_hot_key(spark):
    cl = _events_changelog(spark, hot=True)
    rows = sorted((r.seq, r.key, r.op, r.value) for r in cl.collect())
    state: dict = {}
    for _, key, op, value in rows:
        if op == "delete":
            state.pop(key, None)
        else:
            state[key] = state.get(key, 0) + value
    assert _as_dict(duality.fold_sum(cl), "total") == state


def test_snapshot_diff_reports_net_change_only(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "key string, value int")
    new = spark.createDataFrame([("a", 1), ("b", 5), ("d", 4)], "key string, value int")
    got = {(r.key, r.op, r.old_value, r.new_value)
           for r in duality.snapshot_diff(old, new, "key", "value").collect()}
    assert got == {("b", "update", 2, 5), ("c", "delete", 3, None), ("d", "insert", None, 4)}


def test_two_level_top_k_equals_full_sort(spark):
    from rivulet.operators.topk import top_k

    ev = tables.events(spark, SF0001, streaming=False)
    counts = ev.groupBy("event_type", "user_id").agg(F.count("*").alias("cnt"))
    rows = sorted((r.event_type, r.user_id, r.cnt) for r in counts.collect())
    expect = set()
    for et in {r[0] for r in rows}:
        grp = sorted((r for r in rows if r[0] == et), key=lambda r: (-r[2], r[1]))[:4]
        expect |= {(et, u, c, i + 1) for i, (_, u, c) in enumerate(grp)}
    order = [F.desc("cnt"), F.asc("user_id")]
    plain = top_k(counts, ["event_type"], order, 4, "user_id")
    assert {(r.event_type, r.user_id, r.cnt, r.rank) for r in plain.collect()} == expect
    assert "WindowGroupLimit" in plain._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2")  # force sub-groups
    try:
        spread = top_k(counts, ["event_type"], order, 4, "user_id", spread=7)
        assert {(r.event_type, r.user_id, r.cnt, r.rank) for r in spread.collect()} == expect
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
