"""Event-time and processing-time windows.

All windows are Spark's own (``window``, ``session_window``): half-open ``[start, end)``
intervals aligned to the UTC epoch (pass ``start_time`` to shift them). With a
watermark, ``append`` emits a window once ``end <= watermark`` and then frees its state;
without one, state grows forever, so streaming callers should always pass ``delay``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.time import epoch_micros, epoch_seconds


def _watermarked(df: DataFrame, ts: str, delay: str | None) -> DataFrame:
    return df.withWatermark(ts, delay) if delay else df


def windowed_agg(df: DataFrame, ts: str, size: str, aggs: Sequence[Column], *,
                 slide: str | None = None, delay: str | None = None,
                 keys: Sequence[str] = (), start_time: str | None = None) -> DataFrame:
    """Tumbling (``slide`` None) or sliding window aggregate per ``keys``.

    Output: ``win_start, win_end`` (epoch seconds), keys, aggregates. A sliding window
    writes each event into ``size/slide`` windows: that is the state and write cost.
    """
    src = _watermarked(df, ts, delay)
    if slide:
        w = F.window(ts, size, slide, start_time) if start_time else F.window(ts, size, slide)
    else:
        w = F.window(ts, size, startTime=start_time) if start_time else F.window(ts, size)
    out = src.groupBy(w.alias("window"), *keys).agg(*aggs)
    return out.select(epoch_seconds("window.start").alias("win_start"),
                      epoch_seconds("window.end").alias("win_end"),
                      *keys, *[a for a in out.columns if a not in ("window", *keys)])


def session_agg(df: DataFrame, ts: str, gap: str, keys: Sequence[str], aggs: Sequence[Column],
                *, delay: str | None = None) -> DataFrame:
    """Gap-based sessions per key. A session closes ``gap`` after its last event; in
    streaming it is emitted once that end passes the watermark. Spark refuses session
    windows with no other grouping key, so ``keys`` must not be empty."""
    if not keys:
        raise ValueError("session windows need at least one key besides the session")
    src = _watermarked(df, ts, delay)
    out = src.groupBy(F.session_window(ts, gap).alias("session"), *keys).agg(*aggs)
    return out.select(*keys,
                      epoch_micros("session.start").alias("session_start_us"),
                      epoch_micros("session.end").alias("session_end_us"),
                      *[a for a in out.columns if a not in ("session", *keys)])


def stamp_ingestion(df: DataFrame, col: str = "ingest_ts") -> DataFrame:
    """Processing-time stamp taken once when rows enter (constant within a micro-batch)."""
    return df.withColumn(col, F.current_timestamp())


def processing_time_counts(df: DataFrame, size: str = "1 minute", col: str = "ingest_ts") -> DataFrame:
    """Rows ingested per processing-time window (monitoring counts). Not reproducible:
    a replay lands in other windows. No watermark is possible on the wall clock here,
    so run it in ``update``/``complete`` mode."""
    stamped = df if col in df.columns else stamp_ingestion(df, col)
    out = stamped.groupBy(F.window(col, size).alias("window")).agg(F.count(F.lit(1)).alias("cnt"))
    return out.select(epoch_seconds("window.start").alias("win_start"),
                      epoch_seconds("window.end").alias("win_end"), "cnt")


def chained_windows(df: DataFrame, ts: str, inner: str, outer: str, delay: str,
                    keys: Sequence[str] = ()) -> DataFrame:
    """Two stateful window operators in a row: count per ``inner`` window, then the
    busiest inner window per ``outer`` window. ``window_time`` carries event time into
    the second operator; the watermark propagates per operator (append mode only)."""
    first = (df.withWatermark(ts, delay)
             .groupBy(F.window(ts, inner).alias("w1"), *keys)
             .agg(F.count(F.lit(1)).alias("inner_cnt"))
             .select(F.window_time("w1").alias("t1"), *keys, "inner_cnt"))
    second = (first.groupBy(F.window("t1", outer).alias("w2"), *keys)
              .agg(F.max("inner_cnt").alias("max_inner_cnt"),
                   F.sum("inner_cnt").alias("cnt")))
    return second.select(epoch_seconds("w2.start").alias("win_start"),
                         epoch_seconds("w2.end").alias("win_end"),
                         *keys, "max_inner_cnt", "cnt")
