"""Joins: stream-static, stream-stream, time-bounded interval joins, lookups.

* ``checked_broadcast`` broadcasts a side only when the optimizer's size estimate is
  under a limit; above it the plain DataFrame is returned and Spark shuffles both sides.
* ``interval_join`` pairs rows of one key whose times are within a bound. Besides the
  key it joins on a time bucket of the bound's width (the right side is written into
  its bucket and the one before), so one hot key is spread over its time buckets
  instead of landing in a single task, and each pair still meets exactly once. With
  watermarks on both sides Spark derives when state can be dropped from the time
  condition; left-outer rows without a partner are emitted once that happens.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of a (batch) plan, in bytes."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size if isinstance(size, int) else str(size.toString()))


def checked_broadcast(df: DataFrame, limit_bytes: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """``F.broadcast(df)`` if its estimated size is within ``limit_bytes``, else ``df``
    unchanged (a shuffle join). The check is made once, when the plan is built: for
    bounded plans, not for the static side of a long-running stream."""
    try:
        size = estimated_bytes(df)
    except Exception:  # noqa: BLE001 - no estimate: do not risk a broadcast
        return df
    return F.broadcast(df) if size <= limit_bytes else df


def stream_static_join(read_static: Callable[[], DataFrame], on: Column | Sequence[str] | str,
                       sink: Callable[[DataFrame, int], None], how: str = "inner",
                       select: Callable[[DataFrame], DataFrame] = lambda df: df) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: each micro-batch meets the static table as it is then.
    ``read_static`` is called per batch (a plan built once would keep the file listing of
    its start), so Spark's own threshold decides about a broadcast by today's size."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        sink(select(batch.join(read_static(), on, how)), batch_id)

    return per_batch


def _bucket(micros: Column, width: Column) -> Column:
    """Number of the time bucket, in whole numbers (also before 1970)."""
    return F.call_function("div", micros - F.pmod(micros, width), width)


def stream_stream_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                       left_ts: str | None = None, right_ts: str | None = None,
                       delay: str | None = None, within: str | None = None,
                       how: str = "inner", spread_by_time: bool = False) -> DataFrame:
    """Equi join of two streams. Without ``delay``/``within`` state is unbounded (inner
    only); with them both sides get a watermark and a time bound that frees state.

    ``spread_by_time`` (for keys that may be hot) also joins on a time bucket of width
    ``within``: a pair with ``|r - l| <= within`` has ``r``'s bucket within one of
    ``l``'s, so the right side is written into its bucket and both neighbours and each
    pair still meets exactly once, while a hot key is spread over its buckets."""
    if delay is None:
        return left.join(right, list(keys), how)
    lw = left.withWatermark(left_ts, delay)
    rw = right.withWatermark(right_ts, delay)
    cond = []
    if spread_by_time:
        width = F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {within}"))
        lb, rb = (_bucket(F.unix_micros(F.col(c)), width) for c in (left_ts, right_ts))
        lw = lw.withColumn("_bucket", lb)
        rw = rw.withColumn("_bucket", F.explode(F.array(rb - F.lit(1), rb, rb + F.lit(1))))
        cond.append(F.col("l._bucket") == F.col("r._bucket"))
    lw, rw = lw.alias("l"), rw.alias("r")
    cond += [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    cond.append(F.col(f"r.{right_ts}").between(
        F.col(f"l.{left_ts}") - F.expr(f"INTERVAL {within}"),
        F.col(f"l.{left_ts}") + F.expr(f"INTERVAL {within}")))
    on = cond[0]
    for c in cond[1:]:
        on = on & c
    return lw.join(rw, on, how)


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                  bound_seconds: int, how: str = "inner", delay: str | None = None) -> DataFrame:
    """Pairs with ``left.ts <= right.ts <= left.ts + bound`` on the same ``key``.

    Inputs are aliased ``l`` and ``r``; the output keeps both sides' columns under those
    aliases. ``delay`` (streaming) puts a watermark on both sides."""
    if how not in ("inner", "left_outer", "leftouter", "left"):
        raise ValueError("interval_join supports inner and left outer")
    if delay:
        left = left.withWatermark(left_ts, delay)
        right = right.withWatermark(right_ts, delay)
    width = F.lit(bound_seconds * 1_000_000).cast("long")
    lb, rb = (_bucket(F.unix_micros(F.col(c)), width) for c in (left_ts, right_ts))
    l2 = left.withColumn("_bucket", lb).alias("l")
    r2 = right.withColumn("_bucket", F.explode(F.array(rb, rb - F.lit(1)))).alias("r")
    on = ((F.col(f"l.{key}") == F.col(f"r.{key}"))
          & (F.col("l._bucket") == F.col("r._bucket"))
          & (F.col(f"r.{right_ts}") >= F.col(f"l.{left_ts}"))
          & (F.col(f"r.{right_ts}") <= F.col(f"l.{left_ts}") + F.expr(f"INTERVAL {bound_seconds} SECONDS")))
    return l2.join(r2, on, how)


def lookup(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str,
           fill: dict[str, object] | None = None, limit_bytes: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Left join against a dimension, filling misses (backfilling a new column)."""
    out = df.join(checked_broadcast(dim, limit_bytes), F.col(left_key) == F.col(dim_key), "left")
    if fill:
        out = out.fillna(fill)
    return out
