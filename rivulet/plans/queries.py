"""Driver queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Streaming queries read the driver tables through ``readStream``, drain with
``availableNow`` into a real sink under the shared work folder, and return a bounded
reader of that sink. Output columns use exact types: window bounds as epoch seconds,
instants as epoch microseconds, money-like sums as exact decimal sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet import schemas
from rivulet.functions import parse
from rivulet.functions.numeric import mean, total
from rivulet.functions.time import millis_to_timestamp
from rivulet.operators import aggregate, dedup, duality, joins, stateful, stateless, topk, windows
from rivulet.plans.materialize import append_to_parquet, through_batches
from rivulet.session import run_dir
from rivulet.sources import driven, envelope, files, state, tables
from rivulet.streaming import changes, migration, observe, operations, paths, runtime, transactional
from rivulet.streaming.sinks import (AccumulatingTable, BatchPathSink, UpsertTable, append_writer, fan_out,
                                     split_dead_letter)

#: Decimals that registered queries show of sums and means (float sums depend on their
#: order in the last digits).
DECIMALS = 6


def _cnt():
    """count(*) under the name ``cnt``."""
    return F.count(F.lit(1)).alias("cnt")


# ---------------------------------------------------------------- windows

def w_tumbling_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: 1-day tumbling counts per event type, 2-day watermark, append mode."""
    ev = tables.events(spark, sf_dir)
    agg = windows.windowed_agg(ev, "ts", "1 day", [_cnt(),
                                                   total("value", DECIMALS).alias("total_value")],
                               delay="2 days", keys=["event_type"])
    return append_to_parquet(agg, "w_tumbling_key")


def w_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly tumbling count, 1-day watermark."""
    ev = tables.events(spark, sf_dir)
    agg = windows.windowed_agg(ev, "ts", "1 hour", [_cnt()], delay="1 day")
    return append_to_parquet(agg, "w_tumbling")


def w_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """12-hour windows every 4 hours (each event lands in 3 windows), 1-day watermark."""
    ev = tables.events(spark, sf_dir)
    agg = windows.windowed_agg(ev, "ts", "12 hours", [_cnt(),
                                                      total("value", DECIMALS).alias("total_value")],
                               slide="4 hours", delay="1 day")
    return append_to_parquet(agg, "w_sliding")


def w_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user sessions closed after a 6-hour gap, 1-day watermark."""
    ev = tables.events(spark, sf_dir)
    agg = windows.session_agg(ev, "ts", "6 hours", ["user_id"],
                              [_cnt(), total("value", DECIMALS).alias("total_value")],
                              delay="1 day")
    return append_to_parquet(agg, "w_session")


def w_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events ingested per processing-time minute (complete mode, result table of the
    last batch). One catch-up batch stamps every row with the same instant, so the
    checkable facts are the total and the window length, not the wall-clock bounds."""
    ev = tables.events(spark, sf_dir)
    counts = windows.processing_time_counts(ev, "1 minute")
    sink = through_batches(counts, "w_processing_time", BatchPathSink, output_mode="complete")
    table = sink.read_latest(spark, counts.schema)
    return table.select(F.col("cnt"), (F.col("win_end") - F.col("win_start")).alias("win_seconds"))


def w_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts feeding a daily window (two stateful operators, append only)."""
    ev = tables.events(spark, sf_dir)
    agg = windows.chained_windows(ev, "ts", "1 hour", "1 day", delay="1 day")
    return append_to_parquet(agg, "w_chained")


# ---------------------------------------------------------------- helpers

EVENT_PAYLOAD = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _events_as_files(spark: SparkSession, sf_dir: str, root: str, fmt: str,
                     n: int = 1, options: dict | None = None) -> str:
    """Rewrite `events` (event time as an instant) as ``n`` ordered slices of ``fmt``
    files under ``root``; returns the glob a file stream should watch."""
    ev = tables.events(spark, sf_dir, streaming=False)
    files.write_slices(ev, root, n, "event_id", fmt=fmt, options=options)
    return f"{root}/slice-*"


def _upsert_through(agg: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Stream an aggregate in ``update`` mode into a keyed upsert table; the table read
    back is the full result (update rows replayed through an upsert = the result table)."""
    sink = through_batches(agg, name, lambda root: UpsertTable(root, keys, unique_keys=True),
                           output_mode="update")
    return sink.read(agg.sparkSession, agg.schema)


def _complete_through(agg: DataFrame, name: str) -> DataFrame:
    """Stream an aggregate in ``complete`` mode; each batch overwrites its own batch
    folder and the newest one is the result table."""
    sink = through_batches(agg, name, BatchPathSink, output_mode="complete")
    return sink.read_latest(agg.sparkSession, agg.schema)


def _shown(df: DataFrame) -> DataFrame:
    """Doubles with the decimals that results show."""
    return df.withColumns({c: F.round(c, DECIMALS) for c, t in df.dtypes if t == "double"})


# ---------------------------------------------------------------- sources

def s_parquet_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet folder stream over the driver table (``pathGlobFilter`` picks the file)."""
    return append_to_parquet(stateless.project_events(tables.events(spark, sf_dir)),
                             "s_parquet_stream")


def s_batch_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same projection on a bounded scan (batch = stream for stateless chains)."""
    return stateless.project_events(tables.events(spark, sf_dir, streaming=False))


def s_json_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON folder stream with an explicit schema (events rewritten as JSON files)."""
    root = run_dir(spark, "s_json_stream_in")
    glob = _events_as_files(spark, sf_dir, root, "json", n=2, options=parse.JSON_OPTIONS)
    stream = files.json_stream(spark, glob, schemas.EVENTS_TS, options=parse.JSON_OPTIONS)
    return append_to_parquet(stateless.project_events(stream), "s_json_stream")


def _write_envelopes(spark: SparkSession, sf_dir: str, root: str, n: int = 2,
                     payload: Column | None = None) -> str:
    """`events` as message envelopes in ``n`` ordered slices of files."""
    sl = files.Slices(tables.events(spark, sf_dir, streaming=False), n, "event_id")
    for i in range(n):
        env = envelope.encode(sl.part(i), "user_id", EVENT_PAYLOAD, topic="events",
                              offset_col="event_id", time_col="ts", payload=payload)
        env.write.mode("overwrite").parquet(f"{root}/slice-{i:04d}")
    return f"{root}/slice-*"


def s_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message envelopes (key/value bytes, topic, partition, offset, ...) parsed with
    ``from_json`` and flattened with ``select("e.*")``."""
    glob = _write_envelopes(spark, sf_dir, run_dir(spark, "s_envelope_in"))
    stream = files.parquet_stream(spark, glob, schemas.ENVELOPE)
    parsed = envelope.decode(stream, schemas.EVENTS_TS)
    return append_to_parquet(stateless.project_events(parsed), "s_envelope")


def s_bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries coupled only by a table: envelopes -> bronze (append, stamped with
    ingestion time) and bronze as a stream -> complete-mode dashboard."""
    glob = _write_envelopes(spark, sf_dir, run_dir(spark, "s_bronze_in"))
    raw = files.parquet_stream(spark, glob, schemas.ENVELOPE)
    bronze = windows.stamp_ingestion(envelope.decode(raw, schemas.EVENTS_TS), "ingestionTime")
    bronze_dir = run_dir(spark, "s_bronze_table")
    runtime.run_to_end(bronze, runtime.checkpoint_for(bronze_dir), sink=bronze_dir)
    silver = files.parquet_stream(spark, bronze_dir, bronze.schema)
    dash = aggregate.filtered_group(silver, F.col("event_type") == "purchase", ["user_id"], ["value"])
    return _shown(_complete_through(dash, "s_bronze_dashboard"))


def s_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key,epochMillis`` text lines: split, try_cast, null guard, millis -> timestamp,
    then a watermarked 1-day count per key."""
    root = run_dir(spark, "s_csv_lines_in")
    ev = tables.events(spark, sf_dir, streaming=False)
    lines = ev.select(F.concat_ws(",", "event_type", F.unix_millis("ts").cast("string")).alias("value"),
                      "event_id")
    sliced = files.Slices(lines, 2, "event_id")
    for i in range(2):
        files.write_slice(sliced, root, i, fmt="text", cols=["value"])
    text = files.text_stream(spark, f"{root}/slice-*")
    key, ms = parse.parse_csv_line(F.col("value"), [("key", "string"), ("ms", "long")])
    parsed = (text.select(key, ms).where(F.col("key").isNotNull() & F.col("ms").isNotNull())
              .withColumn("eventTime", millis_to_timestamp("ms")))
    agg = windows.windowed_agg(parsed, "eventTime", "1 day", [_cnt()], delay="2 days", keys=["key"])
    return append_to_parquet(agg, "s_csv_lines")


# ---------------------------------------------------------------- stateless

def p_stateless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """select / withColumn / filter / flatten / drop on a stream, file sink."""
    return append_to_parquet(stateless.enrich_events(tables.events(spark, sf_dir)), "p_stateless")


def p_flatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """flatMap of document texts into words (``explode``), counted per word: partial counts
    per batch into an accumulating table, so no state store holds the vocabulary."""
    docs = tables.stream_table(spark, sf_dir, "documents", schemas.DOCUMENTS)
    ones = stateless.explode_words(docs).withColumn("cnt", F.lit(1).cast("long"))
    sink = through_batches(ones, "p_flatmap", lambda root: AccumulatingTable(root, ["word"], ["cnt"]))
    return sink.read(spark)


# ---------------------------------------------------------------- aggregation

def a_sum_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user sum and count, update mode -> upsert."""
    agg = aggregate.sum_count(tables.events(spark, sf_dir), ["user_id"], "value")
    return _shown(_upsert_through(agg, "a_sum_count", ["user_id"]))


def a_filtered_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter then per-user mean and count (the dashboard), complete mode."""
    dash = aggregate.filtered_group(tables.events(spark, sf_dir),
                                    F.col("event_type") == "purchase", ["user_id"], ["value"])
    return _shown(_complete_through(dash, "a_filtered_group"))


def a_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``groupBy(event_type).count()``, update mode -> upsert."""
    agg = aggregate.group_count(tables.events(spark, sf_dir), ["event_type"])
    return _upsert_through(agg, "a_group_count", ["event_type"])


def a_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global min / max / count of the event id, complete mode."""
    agg = aggregate.min_max_count(tables.events(spark, sf_dir), "event_id")
    return _complete_through(agg, "a_min_max")


def a_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users: a streaming aggregate (partial step before the shuffle) in update
    mode into an upsert table, counted on read-back."""
    users = aggregate.distinct_values(tables.events(spark, sf_dir), ["user_id"])
    return _upsert_through(users, "a_distinct", ["user_id"]).agg(F.count(F.lit(1)).alias("n_distinct"))


def a_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per user (max by event time, then id): each batch folded by hash
    aggregation into an upsert table that the data's own order decides."""
    rows = tables.events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type", "value")
    sink = through_batches(rows, "a_latest_per_key", lambda root: UpsertTable(
        root, ["user_id"], order=["ts", "event_id"], batch_first=False))
    return sink.read(spark).select("user_id", F.unix_micros("ts").alias("ts_us"), "event_id",
                                   "event_type", "value")


# ---------------------------------------------------------------- dedup

def d_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of the stream and a full redelivery of it, deduplicated on event id
    (unbounded state)."""
    first = tables.events(spark, sf_dir)
    again = tables.events(spark, sf_dir)
    unique = dedup.dedup(first.unionByName(again), ["event_id"])
    return append_to_parquet(stateless.project_events(unique), "d_dedup")


def d_dedup_wm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redeliveries that arrive up to an hour later (event time shifted), dropped with
    bounded state: keys are forgotten once the 1-day watermark passes them."""
    first = tables.events(spark, sf_dir)
    late = tables.events(spark, sf_dir).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    unique = dedup.dedup_within_watermark(first.unionByName(late), "ts", "1 day", ["event_id"])
    out = unique.select("event_id", "user_id", "event_type", "value")
    return append_to_parquet(out, "d_dedup_wm")


# ---------------------------------------------------------------- joins (J1-J4), union

def j_stream_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stream joined to the customer table as it is when each batch runs."""
    ev = tables.events(spark, sf_dir).select("event_id", "user_id", "event_type")
    sink = BatchPathSink(run_dir(spark, "j_stream_static_out"))

    def customers() -> DataFrame:
        return tables.read_table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey", "c_mktsegment")

    runtime.run_to_end(ev, run_dir(spark, "j_stream_static_ck"),
                       foreach_batch=joins.stream_static_join(customers, "user_id", sink))
    return sink.read(spark)


def j_stream_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams joined on the event id (one partner each), watermarked on both sides
    with a time bound so join state is released."""
    a = tables.events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts")
    b = (tables.events(spark, sf_dir)
         .select(F.col("event_id"), F.col("ts").alias("props_ts"),
                 parse.parse_json(F.col("props"), schemas.PROPS)["k"].alias("k")))
    out = joins.stream_stream_join(a, b, ["event_id"], "ts", "props_ts", delay="1 day",
                                   within="1 hour")
    return append_to_parquet(out.select(F.col("l.event_id").alias("event_id"), "user_id",
                                        "event_type", "k"), "j_stream_stream")


def _views_purchases(spark: SparkSession, sf_dir: str):
    ev1 = tables.events(spark, sf_dir)
    ev2 = tables.events(spark, sf_dir)
    views = ev1.where(F.col("event_type") == "view").select(
        "user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    buys = ev2.where(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"))
    return views, buys


def _interval(spark: SparkSession, sf_dir: str, how: str, name: str) -> DataFrame:
    views, buys = _views_purchases(spark, sf_dir)
    j = joins.interval_join(views, buys, "user_id", "view_ts", "purchase_ts", 6 * 3600,
                            how=how, delay="1 day")
    out = j.select(F.col("l.user_id").alias("user_id"), "view_id", "purchase_id",
                   F.unix_micros("view_ts").alias("view_ts_us"),
                   F.unix_micros("purchase_ts").alias("purchase_ts_us"))
    return append_to_parquet(out, name)


def j_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views followed by a purchase of the same user within 6 hours (inner)."""
    return _interval(spark, sf_dir, "inner", "j_interval")


def j_interval_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same, left outer: a view without purchase is emitted (with nulls) once the
    watermark shows no purchase can still arrive."""
    return _interval(spark, sf_dir, "left_outer", "j_interval_left")


def j_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill a new `country` column onto per-user counts: dimension lookups with a
    default for misses."""
    counts = aggregate.group_count(tables.events(spark, sf_dir, streaming=False), ["user_id"])
    cust = tables.read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = tables.read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = joins.lookup(counts, cust, "user_id", "c_custkey")
    out = joins.lookup(out, nation, "c_nationkey", "n_nationkey")
    return out.select("user_id", "cnt", F.coalesce(F.col("n_name"), F.lit("unknown")).alias("country"))


def u_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams (interactions, everything else), each with its own watermark,
    unioned into one windowed count; the query watermark is the minimum of the two."""
    ev_a = tables.events(spark, sf_dir)
    ev_b = tables.events(spark, sf_dir)
    chosen = F.col("event_type").isin("click", "view")
    a = ev_a.where(chosen).withWatermark("ts", "2 days")
    b = ev_b.where(~chosen | F.col("event_type").isNull()).withWatermark("ts", "2 days")
    agg = windows.windowed_agg(a.unionByName(b), "ts", "1 day", [_cnt()], keys=["event_type"])
    return append_to_parquet(agg, "u_union")


# ---------------------------------------------------------------- duality

AS_OF = "2024-01-16T00:00:00Z"


def _changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` read as a changelog: key user, value in cents, errors delete the key."""
    return _as_changelog(tables.events(spark, sf_dir, streaming=False))


def _as_changelog(ev: DataFrame) -> DataFrame:
    return duality.as_changelog(ev.withColumn("cents", _cents()), "user_id", "cents", "event_id",
                                F.col("event_type") == F.lit("error"))


def o_fold_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream -> table: the upsert/delete fold of the whole changelog."""
    return duality.fold_upsert(_changelog(spark, sf_dir))


def _as_of(spark: SparkSession, sf_dir: str) -> Column:
    """Log position of ``AS_OF``: a scalar subquery inside the plan."""
    ev = tables.events(spark, sf_dir, streaming=False)
    return ev.where(F.col("ts") < F.lit(AS_OF).cast("timestamp")).select(F.max("event_id")).scalar()


def o_fold_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fold at an earlier log position (last event before ``AS_OF``)."""
    return duality.fold_upsert(_changelog(spark, sf_dir), upto_seq=_as_of(spark, sf_dir))


def o_fold_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum fold: per key, the sum of assignments after its last delete."""
    return duality.fold_sum(_changelog(spark, sf_dir))


def o_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table at every point: running sum-with-reset per key after each record."""
    return duality.scan_sum(_changelog(spark, sf_dir))


def o_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table -> stream: net changes between the snapshot as of ``AS_OF`` and now, both
    folded in one pass."""
    return duality.changes(duality.fold_two(_changelog(spark, sf_dir), _as_of(spark, sf_dir)))


def o_update_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update-mode output over 4 arrivals replayed through a keyed upsert rebuilds the
    result table (equal to the batch aggregate)."""
    table = UpsertTable(run_dir(spark, "o_update_replay_table"), ["user_id"], unique_keys=True)
    _arrivals(spark, sf_dir, "o_update_replay", N_SLICES,
              lambda s: aggregate.sum_count(s, ["user_id"], "value"), output_mode="update", foreach_batch=table)
    return _shown(table.read(spark))


# ---------------------------------------------------------------- sinks (K3-K19), top-k

N_SLICES = 4


def _replay_last(spark: SparkSession, checkpoint: str) -> None:
    """Make the checkpoint look as after a crash between a batch's sink and its commit: the
    next start runs the same batch again, with the same id and rows."""
    done = [int(n) for n in paths.list_names(spark, f"{checkpoint}/commits") if n.isdigit()]
    paths.delete(spark, f"{checkpoint}/commits/{max(done)}")
    paths.delete(spark, f"{checkpoint}/commits/.{max(done)}.crc")


def _feed(spark: SparkSession, sf_dir: str, name: str, fn, build=lambda s: s, replay: bool = False,
          output_mode: str = "append") -> None:
    """Run `events`, arriving in ``N_SLICES`` slices, through ``foreachBatch(fn)``. With
    ``replay`` every batch is run a second time, as after a crash before its commit, and
    the sink must absorb it."""
    _arrivals(spark, sf_dir, name, N_SLICES, build, replay=replay, foreach_batch=fn, output_mode=output_mode)


def _cents() -> Column:
    return F.round(F.col("value") * 100).cast("long")


def _arrivals(spark: SparkSession, sf_dir: str, name: str, n: int, build, replay: bool = False,
              **start_kwargs):
    """``n`` arrivals of `events` slices, each drained by one ``availableNow`` run on the
    same checkpoint (restart between arrivals): batch ``i`` is exactly slice ``i``,
    however many files a slice has."""
    root = run_dir(spark, f"{name}_in")
    sliced = files.Slices(tables.events(spark, sf_dir, streaming=False), n, "event_id")
    ck = runtime.checkpoint_for(run_dir(spark, name))
    runs = []
    for i in range(n):
        files.write_slice(sliced, root, i)
        for again in range(1 + replay):
            if again:
                _replay_last(spark, ck)
            stream = files.parquet_stream(spark, f"{root}/slice-*", schemas.EVENTS_SLICED)
            runs.append(runtime.run_to_end(build(stream), ck, **start_kwargs))
    return ck, runs


def k_file_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet file sink over 4 micro-batches (exactly-once via ``_spark_metadata``), the
    last of each run replayed."""
    sink = run_dir(spark, "k_file_sink_table")
    _arrivals(spark, sf_dir, "k_file_sink", N_SLICES, stateless.project_events, replay=True, sink=sink)
    return spark.read.schema(_projected(spark)).parquet(sink)


def _projected(spark: SparkSession):
    return stateless.project_events(spark.createDataFrame([], schemas.EVENTS_SLICED)).schema


def s_driven_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` slices as caller-set batches of a replayable source: two arrivals at a time,
    each run replayed as after a crash before its commit, so that a batch is its own two
    slices however often it runs. Counts per batch and slice."""
    ev = files.Slices(tables.events(spark, sf_dir, streaming=False), N_SLICES, "event_id")
    log = driven.BatchLog(spark, run_dir(spark, "s_driven_stream_in"), schemas.EVENTS_SLICED)
    sink = BatchPathSink(run_dir(spark, "s_driven_stream_out"))
    ck = runtime.checkpoint_for(run_dir(spark, "s_driven_stream"))

    def per_batch(df: DataFrame, batch_id: int) -> None:
        sink(df.groupBy("slice").agg(_cnt(), F.sum(_cents()).alias("total_cents")), batch_id)

    stream = log.stream()
    for i in range(N_SLICES):
        log.add(ev.part(i))
        if i % 2:
            runtime.run_to_end(stream, ck, foreach_batch=per_batch)
            _replay_last(spark, ck)
            runtime.run_to_end(stream, ck, foreach_batch=per_batch)
    return sink.read(spark, keep_batch=True).select("batch_id", "slice", "cnt", "total_cents")


def k_foreach_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``foreachBatch`` runs batch-only DataFrame code on each bounded micro-batch;
    here per-slice partial counts written to the batch's own folder."""
    sink = BatchPathSink(run_dir(spark, "k_foreach_batch_out"))

    def per_batch(df: DataFrame, batch_id: int) -> None:
        sink(df.groupBy("slice").agg(_cnt(), F.sum(_cents()).alias("total_cents")), batch_id)

    _feed(spark, sf_dir, "k_foreach_batch", per_batch)
    parts = sink.read(spark)
    return parts.groupBy("slice").agg(F.sum("cnt").alias("cnt"),
                                      F.sum("total_cents").alias("total_cents"))


def k_batch_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder per query and batch, replaced when the batch is replayed."""
    sink = BatchPathSink(run_dir(spark, "k_batch_path_out"))
    _feed(spark, sf_dir, "k_batch_path", sink, replay=True)
    return stateless.project_events(sink.read(spark))


def k_batch_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream sink whose commit publishes a batch with its marker in one rename: every
    batch is replayed and none is written twice."""
    out = run_dir(spark, "k_batch_marker_out")
    _arrivals(spark, sf_dir, "k_batch_marker", N_SLICES, lambda s: s, replay=True, sink=out,
              fmt=transactional.register(spark), options={"appId": "marker"})
    return stateless.project_events(transactional.published(spark, out, schemas.EVENTS_SLICED))


def k_txn_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers (app ids) fed by each micro-batch; each applies a batch once per
    ``(app_id, batch_id)`` although every batch is replayed."""
    out = run_dir(spark, "k_txn_guard_table")
    buys = F.col("event_type") == "purchase"

    def writer(app: str):
        return lambda df, batch_id: transactional.write_once(df, out, app, batch_id)

    targets = [(lambda d: d.where(buys), writer("a")), (lambda d: d.where(~buys | buys.isNull()), writer("b"))]
    _feed(spark, sf_dir, "k_txn_guard", lambda df, batch_id: fan_out(df, batch_id, targets),
          build=lambda s: s.select("event_id", "event_type", _cents().alias("cents")), replay=True)
    schema = schemas.T.StructType.fromDDL("event_id long, event_type string, cents long")
    rows = transactional.published(spark, out, schema, keep_batch=True).withColumnRenamed("app", "app_id")
    return rows.groupBy("app_id").agg(_cnt(), F.sum("cents").alias("total_cents"))


def k_accumulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accumulating merge (``t.cnt + s.cnt``) into a bucketed table whose buckets know the last
    batch they include, so a replay does not count twice."""
    table = AccumulatingTable(run_dir(spark, "k_accumulate_table"), ["event_type"], ["cnt", "total_cents"])
    _feed(spark, sf_dir, "k_accumulate", table, replay=True, build=lambda s: s.select(
        "event_type", F.lit(1).cast("long").alias("cnt"), _cents().alias("total_cents")))
    return table.read(spark)


def k_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed upsert per batch (newest event per user wins), replay-safe."""
    table = UpsertTable(run_dir(spark, "k_upsert_table"), ["user_id"], order=["event_id"],
                        batch_first=False)
    _feed(spark, sf_dir, "k_upsert", table, build=lambda s: s.select("user_id", "event_id", "event_type", "value"),
          replay=True)
    return table.read(spark)


def k_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One persisted batch written to two sinks (all rows, purchases only)."""
    all_rows = BatchPathSink(run_dir(spark, "k_fanout_all"))
    buys = BatchPathSink(run_dir(spark, "k_fanout_purchases"))

    def per_batch(df: DataFrame, batch_id: int) -> None:
        fan_out(df, batch_id, [(lambda d: d, all_rows),
                               (lambda d: d.where(F.col("event_type") == "purchase"), buys)])

    _feed(spark, sf_dir, "k_fanout", per_batch, build=lambda s: s.select("event_id", "user_id", "event_type"))
    a = all_rows.read(spark).groupBy().agg(_cnt()).withColumn("sink", F.lit("all"))
    b = buys.read(spark).groupBy().agg(_cnt()).withColumn("sink", F.lit("purchases"))
    return a.unionByName(b).select("sink", "cnt")


def k_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes whose payload does not parse (error events arrive truncated) go to a
    dead-letter sink with their raw bytes; the rest to the main sink."""
    js = parse.to_json_payload(EVENT_PAYLOAD)
    payload = F.when(F.col("event_type") == "error",
                     js.substr(F.lit(1), F.length(js) - F.lit(5))).otherwise(js)
    glob = _write_envelopes(spark, sf_dir, run_dir(spark, "k_dead_letter_in"), payload=payload)
    raw = files.parquet_stream(spark, glob, schemas.ENVELOPE)
    payload_schema = schemas.with_field(schemas.EVENTS_TS, "_corrupt_record", schemas.T.StringType())
    parsed = envelope.decode(raw, payload_schema, keep_envelope=True, corrupt_col="_corrupt_record")
    good_sink = BatchPathSink(run_dir(spark, "k_dead_letter_good"))
    bad_sink = BatchPathSink(run_dir(spark, "k_dead_letter_bad"))
    ok = F.col("_corrupt_record").isNull() & F.col("event_id").isNotNull()
    good_cols = ["event_id", "user_id", "event_type", "value"]
    bad_cols = ["topic", "partition", "offset", "raw_value"]

    def per_batch(df: DataFrame, batch_id: int) -> None:
        fan_out(df, batch_id, [(lambda d: split_dead_letter(d, ok)[0].select(*good_cols), good_sink),
                               (lambda d: split_dead_letter(d, ok)[1].select(*bad_cols), bad_sink)])

    runtime.run_to_end(parsed, run_dir(spark, "k_dead_letter_ck"), foreach_batch=per_batch)
    g = good_sink.read(spark).groupBy().agg(_cnt()).withColumn("sink", F.lit("main"))
    b = bad_sink.read(spark).groupBy().agg(_cnt()).withColumn("sink", F.lit("dead_letter"))
    return g.unionByName(b).select("sink", "cnt")


def k_dedup_downstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At-least-once delivery (a replay appends every batch again) made exact by a
    dedup on the event id when reading."""
    path = run_dir(spark, "k_dedup_downstream_table")
    _feed(spark, sf_dir, "k_dedup_downstream", append_writer(path), replay=True)
    delivered = spark.read.schema(schemas.EVENTS_SLICED).parquet(path)
    return stateless.project_events(dedup.dedup(delivered, ["event_id"]))


def k_topk_all_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-time top 10 users by events: per-batch counts merged into an external
    running table, then ranked (ties broken by user id). Half way a new checkpoint takes
    over: its batch ids start at 0 again, and count as what they are, new rows."""
    table = AccumulatingTable(run_dir(spark, "k_topk_all_time_table"), ["user_id"], ["cnt"])
    root = run_dir(spark, "k_topk_all_time_in")
    sliced = files.Slices(tables.events(spark, sf_dir, streaming=False), N_SLICES, "event_id")
    for i in range(N_SLICES):
        half = f"{root}/{2 * i // N_SLICES}"
        files.write_slice(sliced, half, i)
        stream = files.parquet_stream(spark, f"{half}/slice-*", schemas.EVENTS_SLICED).select(
            "user_id", F.lit(1).cast("long").alias("cnt"))
        runtime.run_to_end(stream, f"{half}-checkpoint", foreach_batch=table)
    return table.read(spark).orderBy(F.desc("cnt"), F.asc("user_id")).limit(10)


def t_topk_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 users of *each* micro-batch (sorting a stream is refused; sorting the
    bounded batch inside ``foreachBatch`` is not). Batches are the arrivals."""
    sink = BatchPathSink(run_dir(spark, "t_topk_batch_out"))

    def per_batch(df: DataFrame, batch_id: int) -> None:
        counts = df.groupBy("slice", "user_id").agg(_cnt())
        sink(topk.top_k(counts, ["slice"], [F.desc("cnt"), F.asc("user_id")], 3, "user_id"), batch_id)

    _arrivals(spark, sf_dir, "t_topk_batch", 2, lambda s: s, foreach_batch=per_batch)
    return sink.read(spark).select("slice", "user_id", "cnt", "rank")


# ---------------------------------------------------------------- operations

def s_rate_contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Restart from a checkpoint resumes contiguously: two runs on one checkpoint (the
    second after new data arrived) into one file sink; then rows = distinct =
    max - min + 1 on the monotone id, else DUPLICATES or GAPS."""
    sink = run_dir(spark, "s_rate_contiguity_table")
    _arrivals(spark, sf_dir, "s_rate_contiguity", 2, stateless.project_events, sink=sink)
    return aggregate.contiguity(spark.read.schema(_projected(spark)).parquet(sink), "event_id")


def s_state_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state store of a streaming count, read back as a table."""
    d = run_dir(spark, "s_state_reader")
    agg = aggregate.group_count(tables.events(spark, sf_dir), ["event_type"])
    ck = runtime.checkpoint_for(f"{d}/table")
    runtime.run_to_end(agg, ck, foreach_batch=UpsertTable(f"{d}/table", ["event_type"], unique_keys=True),
                       output_mode="update")
    st = state.read_state(spark, ck)
    return st.select(F.col("key.event_type").alias("event_type"), F.col("value.count").alias("cnt"))


def u_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch millis back to a timestamp (``timestamp_millis``)."""
    ev = tables.events(spark, sf_dir).select("event_id", F.unix_millis("ts").alias("ms"))
    out = ev.select("event_id", "ms", F.unix_micros(millis_to_timestamp("ms")).alias("ts_ms_us"))
    return append_to_parquet(out, "u_millis")


def b_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-batch trace of a watermarked windowed count fed by two arrivals, from the
    listener's progress table: the data batches (no-data batches left out) with their
    input rows and late rows dropped."""
    def build(stream: DataFrame) -> DataFrame:
        return windows.windowed_agg(stream, "ts", "1 day", [_cnt()], delay="2 days")

    progress = observe.ProgressTable(spark, run_dir(spark, "b_progress_rows"))
    _, runs = _arrivals(spark, sf_dir, "b_progress", 2, build, sink=run_dir(spark, "b_progress_out"))
    progress.close()
    data = progress.read().where((F.col("queryId") == str(runs[0].id)) & (F.col("numInputRows") > 0))
    arrival = F.row_number().over(Window.orderBy("batchId")) - 1  # a row per batch of one query
    return data.select(arrival.cast("long").alias("arrival"), "numInputRows", "numRowsDroppedByWatermark")


def b_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoint audit across two queries (a file sink and a foreachBatch sink): per
    batch, offset planned / commit written / sink manifest written, and aligned."""
    sink = run_dir(spark, "b_audit_file_sink")
    ck_file, _ = _arrivals(spark, sf_dir, "b_audit_file", 2, stateless.project_events, sink=sink)
    batches = BatchPathSink(run_dir(spark, "b_audit_batches"))
    ck_fb, _ = _arrivals(spark, sf_dir, "b_audit_fb", 2, stateless.project_events,
                         foreach_batch=batches)
    return observe.audit_checkpoints(spark, {"file_sink": (ck_file, sink),
                                             "foreach_batch": (ck_fb, None)})


# ---------------------------------------------------------------- late data

LATE_ORDER = [0, 2, 1, 3]


def w_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-order arrivals: `events` in 4 time slices arriving as 0, 2, 1, 3, each
    drained by its own ``availableNow`` run (so a no-data batch follows each data
    batch). Rows whose 1-day window already ended below the watermark (max event time
    seen so far minus 2 days) are dropped; windows are emitted once final."""
    root = run_dir(spark, "w_late_data_in")
    sliced = files.Slices(tables.events(spark, sf_dir, streaming=False), len(LATE_ORDER), "event_id")
    sink = run_dir(spark, "w_late_data_out")
    ck = runtime.checkpoint_for(sink)
    agg = None
    for s in LATE_ORDER:
        files.write_slice(sliced, root, s)
        stream = files.parquet_stream(spark, f"{root}/slice-*", schemas.EVENTS_SLICED)
        agg = windows.windowed_agg(stream, "ts", "1 day", [_cnt()], delay="2 days", keys=["event_type"])
        runtime.run_to_end(agg, ck, sink=sink)
    return spark.read.schema(agg.schema).parquet(sink)


# ---------------------------------------------------------------- arbitrary state

def x_idle_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 6-hour idle period of a user in event time, found by a stateful processor with
    event-time timers over hourly counts, in four arrivals."""
    sink = run_dir(spark, "x_idle_users_table")
    _arrivals(spark, sf_dir, "x_idle_users", N_SLICES, lambda s: stateful.idle_keys(
        s, "user_id", "ts", 6 * 3600 * 1000, "1 day"), sink=sink, confs=runtime.PROCESSOR,
        state_partitions=_state_partitions(spark, sf_dir))
    return spark.read.schema("user_id long, cnt long, last_ts_us long").parquet(sink)


#: Least state partitions of the processors here, and the bytes of `events` for each one more.
SMALL_STATE, STATE_BYTES = 4, 1 << 20


def _state_partitions(spark: SparkSession, sf_dir: str) -> int:
    """State partitions of a processor with a row per user: they are fixed for the life of its
    checkpoint and bound the tasks of every batch, so they follow the input, up to two for each
    core. A few are enough for a small table, as each costs every batch a Python worker and a
    commit."""
    size = joins.estimated_bytes(tables.events(spark, sf_dir, streaming=False))
    return max(SMALL_STATE, min(size // STATE_BYTES, 2 * spark.sparkContext.defaultParallelism))


def _totals_sink(root: str) -> UpsertTable:
    return UpsertTable(root, ["user_id"], unique_keys=True)


def s_state_vars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named state variables of a processor, a value and a map, after three arrivals, and what
    the last of them changed in the value (the state's change feed)."""
    d = run_dir(spark, "s_state_vars")
    ck, _ = _arrivals(spark, sf_dir, "s_state_vars", 3, lambda s: stateful.running_totals(s, "user_id", "event_type"),
                      output_mode="update", foreach_batch=_totals_sink(d), confs=runtime.CHANGELOG,
                      state_partitions=_state_partitions(spark, sf_dir))
    user = F.col("key.user_id").alias("user_id")
    whole = state.read_variable(spark, ck, "total").select(
        F.lit("total").alias("part"), user, F.lit(None).cast("string").alias("kind"), F.col("value.cnt").alias("cnt"))
    kinds = state.read_variable(spark, ck, "kinds").select(
        F.lit("kinds").alias("part"), user, F.col("user_map_key.kind").alias("kind"), F.col("user_map_value.cnt").alias("cnt"))
    last = state.read_changes(spark, ck, 2, 2, variable="total").where("change_type = 'update'").select(
        F.lit("changed").alias("part"), user, F.lit(None).cast("string").alias("kind"), F.col("value.cnt").alias("cnt"))
    return whole.unionByName(kinds).unionByName(last)


def x_initial_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State migration inside the state store: the state of an old aggregate (two arrivals)
    seeds the state of a new processor, which later arrivals go on from."""
    root = run_dir(spark, "x_initial_state")
    sliced = files.Slices(tables.events(spark, sf_dir, streaming=False), N_SLICES, "event_id")

    def arrival(name: str, i: int, build, **kwargs) -> None:
        files.write_slice(sliced, f"{root}/{name}_in", i)
        stream = files.parquet_stream(spark, f"{root}/{name}_in/slice-*", schemas.EVENTS_SLICED)
        runtime.run_to_end(build(stream), f"{root}/{name}_checkpoint", output_mode="update", **kwargs)

    for i in range(2):
        arrival("old", i, lambda s: aggregate.group_count(s, ["user_id", "event_type"]),
                foreach_batch=UpsertTable(f"{root}/old_table", ["user_id", "event_type"], unique_keys=True))
    parts = _state_partitions(spark, sf_dir)
    old = operations.export_state(spark, f"{root}/old_checkpoint", f"{root}/old_state")
    seeds = old.select("user_id", "event_type", F.col("count").alias("cnt"))
    for i in range(2, N_SLICES):
        arrival("new", i, lambda s: stateful.running_totals(s, "user_id", "event_type", initial=seeds),
                foreach_batch=_totals_sink(f"{root}/new_table"), confs=runtime.PROCESSOR, state_partitions=parts)
    return state.read_variable(spark, f"{root}/new_checkpoint", "kinds").select(
        F.col("key.user_id").alias("user_id"), F.col("user_map_key.kind").alias("event_type"),
        F.col("user_map_value.cnt").alias("cnt"))


def _change_stream(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str]:
    """Checkpoint and sink of the full changes of the changelog, in four arrivals."""
    sink = run_dir(spark, f"{name}_changes")
    ck, _ = _arrivals(spark, sf_dir, name, N_SLICES, lambda s: stateful.changes(_as_changelog(s)), sink=sink,
                      confs=runtime.PROCESSOR, state_partitions=_state_partitions(spark, sf_dir))
    return ck, sink


CHANGES = "key long, seq long, kind string, value long"


def o_changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table -> stream in full: every insert, update (before and after) and delete, from a
    processor that keeps the previous value of each key."""
    return spark.read.schema(CHANGES).parquet(_change_stream(spark, sf_dir, "o_changes_stream")[1])


def o_fold_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream -> table as a stream: the processor's state after four arrivals is the table; a
    delete has removed its key's row."""
    ck, _ = _change_stream(spark, sf_dir, "o_fold_stream")
    return state.read_variable(spark, ck, "current").select(
        F.col("key.key").alias("key"), F.col("value.value").alias("value"), F.col("value.seq").alias("seq"))


def o_changes_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full changes replayed up to ``AS_OF``: the table of that moment."""
    full = spark.read.schema(CHANGES).parquet(_change_stream(spark, sf_dir, "o_changes_replay")[1])
    return duality.replay_changes(full, _as_of(spark, sf_dir))


def x_change_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed versions of a running query would do on its checkpoint, found before they
    start: the daily sums per event type against another filter on the result, another key,
    another aggregate and another filter on the input. ``n_state`` is the state at stake."""
    def sums(agg="sum", keys=("event_type",), where="event_id >= 0"):
        return lambda s: s.where(where).groupBy(F.window("ts", "1 day"), *keys).agg(getattr(F, agg)("value").alias("x"))

    variants = {"result filter": lambda s: sums()(s).where("x > 10"), "key": sums(keys=("event_type", "user_id")),
                "aggregate": sums(agg="max"), "input filter": sums(where="event_id > 0")}
    d = run_dir(spark, "x_change_verdict")
    ck, _ = _arrivals(spark, sf_dir, "x_change_verdict", 2, sums(), output_mode="update", foreach_batch=BatchPathSink(d))
    rows = []
    for name, build in variants.items():
        found = changes.verdict(spark, ck, build, schemas.EVENTS_SLICED, "update")
        rows.append((name, changes.worst(found), ",".join(sorted({c for f in found for c in f.columns}))))
    verdicts = spark.createDataFrame(rows, "change string, verdict string, columns string")
    return verdicts.withColumn("n_state", state.read_state(spark, ck).select(F.count(F.lit(1))).scalar())


def x_cutover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallel cut-over: daily counts per event type move to daily counts per event type and
    size class. Both queries see the same arrivals, the new one an arrival later; a switch is
    refused while it is behind, and agreed once it has caught up and its sums are the old
    counts up to the smaller watermark. The result is the table that readers then see."""
    root = run_dir(spark, "x_cutover")
    sliced = files.Slices(tables.events(spark, sf_dir, streaming=False), N_SLICES, "event_id")

    def counts(keys):
        return lambda s: windows.windowed_agg(s.withColumn("big", F.coalesce(F.col("value") >= 50, F.lit(False))), "ts", "1 day",
                                              [_cnt()], delay="2 days", keys=keys)

    builds = {"old": counts(["event_type"]), "new": counts(["event_type", "big"])}

    def run(name: str) -> None:
        stream = files.parquet_stream(spark, f"{root}/in/slice-*", schemas.EVENTS_SLICED)
        runtime.run_to_end(builds[name](stream), f"{root}/{name}_checkpoint", sink=f"{root}/{name}")

    fields = "win_start long, win_end long, event_type string, cnt long"
    old = migration.Live("old", f"{root}/old_checkpoint", lambda: spark.read.schema(fields).parquet(f"{root}/old"))
    new = migration.Live(
        "new", f"{root}/new_checkpoint", lambda: spark.read.schema(f"{fields}, big boolean").parquet(f"{root}/new"),
        same=lambda df: df.groupBy("win_start", "win_end", "event_type").agg(F.sum("cnt").alias("cnt")))
    cut = migration.CutOver(spark, root, old, new, ["win_start", "win_end", "event_type"], "win_end")
    refused = 0
    for i in range(N_SLICES):
        files.write_slice(sliced, f"{root}/in", i)
        run("old")
        if i in (1, N_SLICES - 1):
            run("new")
        if i in (2, N_SLICES - 1):
            try:
                cut.switch()
            except migration.CutOverRefused:
                refused += 1
    return cut.read().select("win_start", "win_end", "event_type", "big", "cnt", F.lit(refused).alias("refused"))


def x_migrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State migration: counts per user (two arrivals, in the old query's state) become
    counts per user and country; the new query, on a checkpoint of its own, adds the
    later half of the input to them."""
    def countries(df: DataFrame) -> DataFrame:
        cust = tables.read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        nation = tables.read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        out = joins.lookup(joins.lookup(df, cust, "user_id", "c_custkey"), nation, "c_nationkey", "n_nationkey")
        return out.select("user_id", F.coalesce("n_name", F.lit("unknown")).alias("country"), "cnt")

    root = run_dir(spark, "x_migrate")
    sliced = files.Slices(tables.events(spark, sf_dir, streaming=False), N_SLICES, "event_id")

    def arrivals(name: str, which: range, build, **kwargs) -> None:
        for i in which:
            files.write_slice(sliced, f"{root}/{name}_in", i)
            stream = files.parquet_stream(spark, f"{root}/{name}_in/slice-*", schemas.EVENTS_SLICED)
            runtime.run_to_end(build(stream), f"{root}/{name}_checkpoint", **kwargs)

    arrivals("old", range(2), lambda s: aggregate.group_count(s, ["user_id"]), output_mode="update",
             foreach_batch=UpsertTable(f"{root}/old_table", ["user_id"], unique_keys=True))
    table = AccumulatingTable(f"{root}/new_table", ["user_id", "country"], ["cnt"])
    operations.migrate_totals(spark, f"{root}/old_checkpoint", f"{root}/old_state", table,
                              lambda st: countries(st.select("user_id", F.col("count").alias("cnt"))))
    arrivals("new", range(2, N_SLICES), lambda s: s.select("user_id", F.lit(1).cast("long").alias("cnt")),
             foreach_batch=lambda df, batch_id: table(countries(df), batch_id))
    return table.read(spark)


def k_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small-file compaction: a file sink fed by 4 micro-batches is rewritten through its
    manifest into fewer, larger files in a new folder."""
    sink = run_dir(spark, "k_compact_sink")
    _arrivals(spark, sf_dir, "k_compact", N_SLICES, stateless.project_events, sink=sink)
    out = run_dir(spark, "k_compact_out")
    operations.compact_files(spark, sink, out)
    return spark.read.parquet(out)


def a_avg_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mean kept as (sum, count) state: four arrivals, one restart between each, update
    mode into a keyed upsert. The last row per key is the mean over every row, not a
    mean of per-arrival means (the partial state is merged, never the finished mean)."""
    table = UpsertTable(run_dir(spark, "a_avg_partial_table"), ["event_type"], unique_keys=True)

    def build(stream: DataFrame) -> DataFrame:
        return stream.groupBy("event_type").agg(mean("value", DECIMALS).alias("avg_value"), _cnt())

    _arrivals(spark, sf_dir, "a_avg_partial", N_SLICES, build, output_mode="update",
              foreach_batch=table)
    return table.read(spark)


def k_partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch writes with ``mode`` and ``partitionBy`` inside ``foreachBatch``: each batch
    writes under ``batch_id=N/event_day=D`` with dynamic partition overwrite, so a
    replayed batch replaces exactly the partitions it wrote and nothing else. Readers
    filtering on ``event_day`` prune whole folders."""
    root = f"{run_dir(spark, 'k_partitioned_write')}/table"

    def day(stream: DataFrame) -> DataFrame:
        return stateless.project_events(stream).withColumn(
            "event_day", F.floor(F.col("ts_us") / F.lit(86_400_000_000)).cast("long"))

    def per_batch(df: DataFrame, batch_id: int) -> None:
        (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", "event_day").parquet(root))

    _feed(spark, sf_dir, "k_partitioned_write", per_batch, build=day, replay=True)
    schema = ("event_id long, user_id long, event_type string, value double, ts_us long, "
              "batch_id long, event_day long")
    return spark.read.schema(schema).parquet(root).drop("batch_id")
