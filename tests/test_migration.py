"""Moving to a changed query: cut-over, seeded state, verdicts before the start, state by name."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from given_tables import SF0001
from rivulet import schemas
from rivulet.operators import aggregate, duality, stateful, windows
from rivulet.plans import queries
from rivulet.session import run_dir
from rivulet.sources import files, state, tables
from rivulet.streaming import changes, migration, observe, runtime
from rivulet.streaming.sinks import BatchPathSink, UpsertTable



def _arrivals(spark, name, n, builds, which=None, replayed=(), **kwargs):
    """Run each of ``builds`` (name -> (build, kwargs)) after every arrival that ``which`` allows."""
    root = run_dir(spark, name)
    sliced = files.Slices(tables.events(spark, SF0001, streaming=False), n, "event_id")
    for i in range(n):
        files.write_slice(sliced, f"{root}/in", i)
        for q, (build, more) in builds.items():
            if which is None or i in which.get(q, range(n)):
                stream = files.parquet_stream(spark, f"{root}/in/slice-*", schemas.EVENTS_SLICED)
                runtime.run_to_end(build(stream), f"{root}/{q}_ck", **(more(root) | kwargs))
    return root


# ---------------------------------------------------------------- parallel cut-over

FIELDS = "win_start long, win_end long, event_type string, cnt long"


def _cut(spark, new_build, which):
    def daily(s):
        return windows.windowed_agg(s, "ts", "1 day", [F.count(F.lit(1)).alias("cnt")], delay="2 days", keys=["event_type"])

    builds = {"old": (daily, lambda root: {"sink": f"{root}/old"}),
              "new": (lambda s: daily(new_build(s)), lambda root: {"sink": f"{root}/new"})}
    root = _arrivals(spark, "t_cut", 3, builds, which)
    sides = [migration.Live(q, f"{root}/{q}_ck", lambda q=q: spark.read.schema(FIELDS).parquet(f"{root}/{q}"))
             for q in ("old", "new")]
    return migration.CutOver(spark, root, *sides, ["win_start", "win_end", "event_type"], "win_end")


def test_cut_over_is_agreed_when_the_new_query_has_caught_up(spark):
    cut = _cut(spark, lambda s: s.where(F.lit(True)), None)
    assert cut.current().name == "old"
    before = sorted(map(tuple, cut.read().collect()))
    v = cut.switch()
    assert (v.state, v.differences) == ("agreed", 0) and v.upto_ms == cut.common_ms() > 0
    assert cut.current().name == "new" and sorted(map(tuple, cut.read().collect())) == before != []


def test_cut_over_is_refused_while_the_new_query_is_behind(spark):
    cut = _cut(spark, lambda s: s, {"new": [0, 1]})
    old, new = (migration.watermark_ms(spark, q.checkpoint) for q in (cut.old, cut.new))
    assert 0 < new < old and cut.verdict() == migration.Verdict("behind", new, 0)
    with pytest.raises(migration.CutOverRefused, match="behind"):
        cut.switch()
    assert cut.current().name == "old"


def test_cut_over_is_refused_while_the_tables_differ(spark):
    cut = _cut(spark, lambda s: s.where("event_type != 'error' and not (event_type = 'view' and event_id % 2 = 0)"), None)
    found = {(r.event_type, r.what) for r in cut.differences().collect()}
    assert ("error", "missing") in found and ("view", "changed") in found
    assert {t for t, _ in found} == {"error", "view"}
    with pytest.raises(migration.CutOverRefused, match="differs"):
        cut.switch()


# ---------------------------------------------------------------- state by name

def _totals(root):
    return {"foreach_batch": UpsertTable(f"{root}/t", ["user_id"], unique_keys=True), "output_mode": "update",
            "confs": runtime.CHANGELOG, "state_partitions": 2}


def test_named_state_metadata_and_change_feed(spark):
    root = _arrivals(spark, "t_vars", 2, {"q": (lambda s: stateful.running_totals(s, "user_id", "event_type"), _totals)})
    ck = f"{root}/q_ck"
    ops = state.operators(spark, ck).collect()
    assert len(ops) == 1 and {"total", "kinds"} <= set(ops[0].variables) and ops[0].numPartitions == 2
    assert state.find_operator(spark, ck, "total") == 0
    with pytest.raises(ValueError):
        state.find_operator(spark, ck, "nothing")
    ev = files.with_slices(tables.events(spark, SF0001, streaming=False), 2, "event_id")
    first = {r.user_id: r["count"] for r in ev.where("slice = 0").groupBy("user_id").count().collect()}
    whole = {r.user_id: r["count"] for r in ev.groupBy("user_id").count().collect()}
    at = {b: {r.key.user_id: r.value.cnt for r in state.read_variable(spark, ck, "total", batch_id=b).collect()} for b in (0, 1)}
    assert at == {0: first, 1: whole}
    changed = state.read_changes(spark, ck, 0, 1, variable="total").collect()
    assert {(r.batch_id, r.key.user_id, r.value.cnt) for r in changed} == {
        (0, u, n) for u, n in first.items()} | {(1, r.user_id, whole[r.user_id]) for r in ev.where("slice = 1").select("user_id").distinct().collect()}


def test_seeded_state_goes_on_and_keeps_keys_without_arrivals(spark):
    seeds = spark.createDataFrame([(-5, "gone", 7), (-5, None, 1), (1, "click", 1000)], "user_id long, event_type string, cnt long")
    root = _arrivals(spark, "t_seed", 2, {"q": (lambda s: stateful.running_totals(
        s, "user_id", "event_type", initial=seeds), _totals)})
    want = {r.user_id: r["count"] for r in tables.events(spark, SF0001, streaming=False).groupBy("user_id").count().collect()}
    want = want | {-5: 8, 1: 1000 + want.get(1, 0)}
    assert {r.key.user_id: r.value.cnt for r in state.read_variable(spark, f"{root}/q_ck", "total").collect()} == want


def test_a_key_starts_anew_after_its_time_to_live(spark):
    d = run_dir(spark, "t_ttl")
    sink = BatchPathSink(f"{d}/out")

    def arrive(i, rows):
        spark.createDataFrame(rows, "user_id long, kind string").write.parquet(f"{d}/in/{i}")
        stream = spark.readStream.schema("user_id long, kind string").parquet(f"{d}/in/*")
        runtime.run_to_end(stateful.running_totals(stream, "user_id", "kind", ttl_ms=20_000), f"{d}/ck", output_mode="update",
                           foreach_batch=sink, confs=runtime.PROCESSOR, state_partitions=1, trigger={"once": True})

    arrive(0, [(1, "a"), (1, "a"), (2, "b")])
    arrive(1, [(1, "a")])
    time.sleep(21)
    arrive(2, [(1, "a"), (1, "b")])
    got = {(r.batch_id, r.user_id): r.cnt for r in sink.read(spark, keep_batch=True).collect()}
    assert got[0, 1] == 2 and got[0, 2] == 1 and got[1, 1] == 3
    assert [n for (b, u), n in sorted(got.items()) if b > 1 and u == 1] == [2]


# ---------------------------------------------------------------- full changes of a table

def test_changes_rebuild_every_table_and_deletes_shrink_the_state(spark):
    log = [("a", "set", 1), ("b", "set", 2), ("a", "set", 1), ("b", "delete", None), ("b", "delete", None), ("c", "delete", None),
           (None, "set", 9), ("a", "delete", None), ("a", "set", 4), ("c", "set", None), (None, "delete", None), ("d", "set", 5)]
    rows = [(i, k, op, v) for i, (k, op, v) in enumerate(log)]
    d = run_dir(spark, "t_changes")
    schema = "seq long, key string, op string, value long"
    progress = observe.ProgressTable(spark, f"{d}/progress")
    for i in range(0, len(rows), 4):
        spark.createDataFrame(rows[i:i + 4], schema).write.parquet(f"{d}/in/{i:03d}")
        stream = spark.readStream.schema(schema).parquet(f"{d}/in/*")
        q = runtime.run_to_end(stateful.changes(stream), f"{d}/ck", sink=f"{d}/out", confs=runtime.PROCESSOR, state_partitions=2)
    progress.close()
    got = spark.read.parquet(f"{d}/out")
    for upto in range(len(rows)):
        table, last = {}, {}
        for seq, k, op, v in rows[:upto + 1]:
            last[k] = seq
            if op == "set":
                table[k] = v
            else:
                table.pop(k, None)
        assert {(r.key, r.value, r.seq) for r in duality.replay_changes(got, upto).collect()} == {
            (k, v, last[k]) for k, v in table.items()}
    assert {r.key.key: r.value.value for r in state.read_variable(spark, f"{d}/ck", "current").collect()} == {"a": 4, "c": None, "d": 5}
    kinds = sorted((r.seq, r.kind, r.value) for r in got.where("key = 'a'").collect())
    assert kinds == [(0, "insert", 1), (2, "update_after", 1), (2, "update_before", 1), (7, "delete", 1), (8, "insert", 4)]
    trace = progress.read().where(F.col("queryId") == str(q.id)).orderBy("batchId").collect()
    assert [r.numRowsTotal for r in trace if r.numInputRows] == [1, 1, 3]
    assert sum(r.numRowsRemoved for r in trace) >= 2


# ---------------------------------------------------------------- verdict before the start

@pytest.fixture(scope="module")
def counted(spark):
    """Checkpoint of a running windowed sum per event type."""
    return _arrivals(spark, "t_verdict", 1, {"q": (_sums(), lambda root: {
        "foreach_batch": BatchPathSink(f"{root}/t"), "output_mode": "update"})}) + "/q_ck"


def _sums(agg="sum", keys=("event_type",), size="1 day", where="value is not null", value="value", delay="2 days"):
    def build(s):
        rows = s.where(where).withWatermark("ts", delay)
        return rows.groupBy(F.window("ts", size), *keys).agg(getattr(F, agg)(value).alias("x"))
    return build


def _verdict(spark, ck, build, mode="update"):
    return changes.verdict(spark, ck, build, schemas.EVENTS_SLICED, mode)


def test_the_same_query_and_changes_above_the_state_are_safe(spark, counted):
    assert changes.worst(_verdict(spark, counted, _sums())) == "safe"
    found = _verdict(spark, counted, lambda s: _sums()(s).where("x > 3").withColumn("y", F.col("x") * 2))
    assert [f.verdict for f in found] == ["safe"] and "above" in found[0].what


@pytest.mark.parametrize("build,column", [
    (_sums(keys=("event_type", "user_id")), "user_id"),  # another grouping key
    (_sums(keys=("user_id",)), "event_type"),  # a key of another type
    (_sums(agg="avg"), "count"),  # more state than before
    (_sums(value="event_id"), "sum"),  # a sum of another type
])
def test_other_state_columns_are_refused_by_name(spark, counted, build, column):
    found = _verdict(spark, counted, build)
    assert changes.worst(found) == "refused"
    assert column in {c for f in found if f.verdict == "refused" for c in f.columns}


def test_refusals_are_what_spark_does(spark, counted):
    root = counted.removesuffix("/q_ck")
    stream = files.parquet_stream(spark, f"{root}/in/slice-*", schemas.EVENTS_SLICED)
    with pytest.raises(Exception, match="STATE_STORE_(KEY|VALUE)_SCHEMA_NOT_COMPATIBLE|StateSchema"):
        files.write_slices(tables.events(spark, SF0001, streaming=False).limit(3), f"{root}/in2", 1, "event_id")
        spark.read.parquet(f"{root}/in2/slice-*").write.parquet(f"{root}/in/slice-9999")
        runtime.run_to_end(_sums(keys=("event_type", "user_id"))(stream), counted, output_mode="update",
                           foreach_batch=BatchPathSink(f"{root}/t"))


def test_other_operators_and_modes_are_refused(spark, counted):
    found = _verdict(spark, counted, lambda s: s.withWatermark("ts", "1 day").dropDuplicates(["event_id", "ts"]).select("event_id"), "append")
    assert any("output mode" in f.what for f in found) and any("gone" in f.what for f in found)
    found = _verdict(spark, counted, lambda s: _sums()(s.withWatermark("ts", "2 days").dropDuplicates(["event_id", "ts"])))
    assert changes.worst(found) == "refused"


@pytest.mark.parametrize("build,column", [
    (_sums(agg="max"), "sum -> max"),  # another aggregate of the same type
    (_sums(where="value > 10"), "value"),
    (_sums(size="12 hours"), "ts"),
    (_sums(delay="3 days"), "ts"),
])
def test_changes_that_spark_lets_through_are_called_dangerous(spark, counted, build, column):
    found = _verdict(spark, counted, build)
    assert changes.worst(found) == "dangerous"
    assert column in {c for f in found for c in f.columns}


# ---------------------------------------------------------------- processors over large tables

class _Held:
    """A value, a map or a handle of a state store that counts what it is asked."""

    def __init__(self):
        self.rows, self.asked = {}, []

    def __getattr__(self, name):
        def ask(*args):
            self.asked.append(name)
            if name in ("get", "getValue"):
                return self.rows.get(args[0] if args else ())
            if name in ("update", "updateValue"):
                self.rows[args[0] if len(args) > 1 else ()] = args[-1]
            if name == "clear":
                self.rows.clear()
            return self
        return ask


def test_idle_keys_ask_the_state_store_little():
    """rows in, rows out, one read and one write of a key's state in a batch."""
    p, hour = stateful.IdleCounter("k", 6 * 3_600_000), 3_600_000_000
    p.handle, p.acc = _Held(), _Held()
    bucket = Row("n", "lo_us", "hi_us")
    out = list(p.handleInputRows((7,), iter([bucket(1, 9 * hour, 9 * hour), bucket(2, 0, hour)]), None))
    assert [tuple(r) for r in out] == [(7, 2, hour)]
    out = list(p.handleInputRows((7,), iter([bucket(1, 10 * hour, 10 * hour)]), None))
    assert out == [] and p.acc.rows[()] == (2, 10 * hour)
    assert p.acc.asked == ["get", "update"] * 2 and p.handle.asked == ["registerTimer", "deleteTimer", "registerTimer"]
    assert [tuple(r) for r in p.handleExpiredTimer((7,), None, None)] == [(7, 2, 10 * hour)] and not p.acc.rows


def test_changes_ask_the_state_store_little():
    """F3, F5, F7."""
    p = stateful.ChangeEmitter()
    p.current = _Held()
    log = Row("seq", "is_set", "value")
    out = list(p.handleInputRows((None,), iter([log(3, True, None), log(1, True, 5), log(2, False, None), log(4, True, 6)]), None))
    assert [tuple(r) for r in out] == [(None, 1, "insert", 5), (None, 2, "delete", 5), (None, 3, "insert", None),
                                       (None, 4, "update_before", None), (None, 4, "update_after", 6)]
    assert p.current.asked == ["get", "update"] and p.current.rows[()] == (6, 4)


def test_totals_ask_the_state_store_little():
    """F4, F6."""
    p = stateful.RunningTotals("k")
    p.total, p.kinds = _Held(), _Held()
    p.handleInitialState((7,), Row(k=7, kinds=[{"kind": "a", "cnt": 4}, {"kind": "b", "cnt": 1}]), None)
    assert p.total.asked == ["get", "update"] and p.kinds.asked == ["updateValue"] * 2
    out = list(p.handleInputRows((7,), iter([Row(k=7, kind=x) for x in "aca"]), None))
    assert [tuple(r) for r in out] == [(7, 8)] and p.total.rows[()] == (8,)
    assert p.kinds.rows == {("a",): (6,), ("b",): (1,), ("c",): (1,)}


@pytest.mark.parametrize("name", ["x_idle_users", "s_state_vars", "x_initial_state", "o_changes_stream", "o_fold_stream",
                                  "o_changes_replay"])
def test_state_partitions_follow_the_input(spark, monkeypatch, name):
    """Four state partitions were four tasks, whatever the input and the cluster."""
    class Stop(Exception):
        pass

    def run(df, checkpoint, foreach_batch=None, state_partitions=None, **kwargs):
        if state_partitions:
            raise Stop(state_partitions)
        return None

    monkeypatch.setattr(queries.runtime, "run_to_end", run)
    monkeypatch.setattr(queries.operations, "export_state", lambda s, *a: s.createDataFrame(
        [], "user_id long, event_type string, count long"))
    found = []
    for each in (1 << 40, 1):
        monkeypatch.setattr(queries, "STATE_BYTES", each)
        with pytest.raises(Stop) as e:
            getattr(queries, name)(spark, SF0001)
        found.append(e.value.args[0])
    assert found == [queries.SMALL_STATE, max(queries.SMALL_STATE, 2 * spark.sparkContext.defaultParallelism)]
