"""Sources and parsing: envelope round trip, JSON timestamps, CSV null guard, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from given_tables import SF0001
from rivulet import schemas
from rivulet.functions import parse
from rivulet.operators import stateless
from rivulet.plans.materialize import append_to_parquet
from rivulet.session import run_dir
from rivulet.sources import envelope, files, tables


def test_envelope_round_trip_keeps_every_field(spark):
    ev = tables.events(spark, SF0001, streaming=False)
    env = envelope.encode(ev, "user_id", ["event_id", "ts", "user_id", "event_type", "value", "props"],
                          topic="events", offset_col="event_id", time_col="ts")
    assert env.columns == [f.name for f in schemas.ENVELOPE.fields]
    back = envelope.decode(env, schemas.EVENTS_TS)
    assert back.exceptAll(ev).count() == 0 and ev.exceptAll(back).count() == 0


def test_json_payload_keeps_microseconds(spark):
    ev = tables.events(spark, SF0001, streaming=False).select("event_id", "ts")
    js = ev.select("event_id", parse.to_json_payload(["event_id", "ts"]).alias("j"))
    schema = "event_id long, ts timestamp"
    back = js.select(parse.parse_json(F.col("j"), spark.createDataFrame([], schema).schema).alias("e"))
    assert back.select("e.*").exceptAll(ev).count() == 0


def test_csv_lines_null_guard(spark):
    lines = spark.createDataFrame([("a,1000",), ("b,notanumber",), ("c",), ("d,2000,extra",)], "value string")
    key, ms = parse.parse_csv_line(F.col("value"), [("key", "string"), ("ms", "long")])
    ok = lines.select(key, ms).where(F.col("key").isNotNull() & F.col("ms").isNotNull())
    assert sorted((r.key, r.ms) for r in ok.collect()) == [("a", 1000), ("d", 2000)]


def test_words_split_on_whitespace(spark):
    df = spark.createDataFrame([(" a  b\tc\nd ",)], "text string")
    assert [r.word for r in stateless.explode_words(df).collect()] == ["a", "b", "c", "d"]


def test_json_stream_equals_batch_read(spark):
    root = run_dir(spark, "t_json_in")
    ev = tables.events(spark, SF0001, streaming=False)
    files.write_slices(ev, root, 2, "event_id", fmt="json", options=parse.JSON_OPTIONS)
    stream = files.json_stream(spark, f"{root}/slice-*", schemas.EVENTS_SLICED, max_files=1,
                               options=parse.JSON_OPTIONS)
    out = append_to_parquet(stateless.project_events(stream), "t_json")
    assert out.exceptAll(stateless.project_events(ev)).count() == 0
    assert out.count() == ev.count()


def test_slices_are_consecutive_ranges(spark):
    ev = files.with_slices(tables.events(spark, SF0001, streaming=False), 4, "event_id")
    rng = ev.groupBy("slice").agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi"))
    spans = sorted((r.slice, r.lo, r.hi) for r in rng.collect())
    assert [s for s, _, _ in spans] == [0, 1, 2, 3]
    assert all(spans[i][2] < spans[i + 1][1] for i in range(3))


def test_slice_ranges_agree_with_slice_numbers(spark):
    sl = files.Slices(tables.events(spark, SF0001, streaming=False), 7, "event_id")
    for i in range(7):
        part = sl.part(i)
        assert part.where(F.col("slice") != i).count() == 0
        assert part.count() == sl.df.where(F.col("slice") == i).count()


def test_driven_source_replays_a_batch_as_it_was(spark):
    """A batch that ran and was not committed comes again with its own rows, although more
    was added since; an empty batch and one of several files count as one each."""
    from pyspark.sql import types as T

    from rivulet.plans.queries import _replay_last
    from rivulet.session import run_dir
    from rivulet.sources.driven import BatchLog
    from rivulet.streaming import runtime

    schema = T.StructType().add("k", "long").add("at", "timestamp").add("tags", T.ArrayType(T.StringType()))
    log = BatchLog(spark, run_dir(spark, "driven_in"), schema)
    ck, seen = run_dir(spark, "driven_ck"), []

    def rows(lo, hi):
        return spark.range(lo, hi, 1, 3).selectExpr(
            "id as k", "timestamp_seconds(id) as at", "array(string(id), null) as tags", "'extra' as other")

    def run():
        runtime.run_to_end(log.stream(), ck, foreach_batch=lambda df, b: seen.append((b, sorted(r.k for r in df.collect()))))

    log.add(rows(0, 3))
    log.add(rows(3, 5))
    run()
    assert seen == [(0, [0, 1, 2, 3, 4])]
    log.add(rows(5, 6))
    _replay_last(spark, ck)
    run()  # one batch a run: the one to be run again
    assert seen[1:] == [(0, [0, 1, 2, 3, 4])]
    run()
    assert seen[2:] == [(1, [5])]
    assert log.add(rows(9, 9)) == 3
    run()
    again = BatchLog(spark, log.path, schema)  # a caller that comes back goes on where it stopped
    assert again.add(rows(6, 8)) == 4
    run()
    assert [k for _, ks in seen[3:] for k in ks] == [6, 7]
    whole = []
    runtime.run_to_end(log.stream(), run_dir(spark, "driven_ck"), foreach_batch=lambda df, b: whole.extend(df.collect()))
    assert sorted(map(str, whole)) == sorted(map(str, rows(0, 8).select(*schema.fieldNames()).collect()))


def test_driven_source_reads_no_half_written_batch_and_misses_no_lost_one(spark):
    import pytest
    from pyspark.sql import types as T

    from rivulet.session import run_dir
    from rivulet.sources.driven import BatchLog
    from rivulet.streaming import paths, runtime

    schema = T.StructType().add("id", "long")
    log, ck, seen = BatchLog(spark, run_dir(spark, "driven_half"), schema), run_dir(spark, "driven_half_ck"), []

    def run():
        runtime.run_to_end(log.stream(), ck, foreach_batch=lambda df, b: seen.extend(r.id for r in df.collect()))

    log.add(spark.range(2))
    log.add(spark.range(2, 4))
    paths.delete(spark, f"{log.path}/n=1/_SUCCESS")  # as if the writer had died
    run()
    assert sorted(seen) == [0, 1]
    log.n = 1
    log.add(spark.range(2, 5))
    run()
    assert sorted(seen) == [0, 1, 2, 3, 4]
    paths.delete(spark, f"{log.path}/n=0")
    with pytest.raises(Exception):
        runtime.run_to_end(log.stream(), run_dir(spark, "driven_lost_ck"), foreach_batch=lambda df, b: None)
        assert seen == []


def test_a_table_of_many_files_is_streamed_whole(spark, tmp_path):
    """a table is a file or a folder of files with names of their own; tables beside it are left alone."""
    from rivulet.plans import queries
    from rivulet.streaming import runtime

    rows = [(i, t, "en", "web", len(t)) for i, t in enumerate(["a b", "b  c", "", "c a a"])]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for i, where in enumerate(("doc_id < 1", "doc_id >= 1")):
        given.where(where).coalesce(1).write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    given.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.p_flatmap(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [("a", 3), ("b", 2), ("c", 2)]
    batches = []
    for i in range(2):
        stream = tables.stream_table(spark, str(tmp_path), "documents", schemas.DOCUMENTS, max_files_per_trigger=1)
        runtime.run_to_end(stream, f"{tmp_path}/ck", foreach_batch=lambda df, b: batches.append(df.count()))
        given.coalesce(1).write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    assert sum(batches) == 8  # the folder is watched
