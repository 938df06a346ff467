"""Grouped aggregates that run unchanged on bounded and streaming inputs.

All of these are Spark aggregates with partial (map-side) combine: a hot key sends one
partial row per input partition through the shuffle, not its raw rows. In streaming the
partial state is the state-store row per key (``avg`` is kept as (sum, count)).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.numeric import mean, total


def sum_count(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per-key sum and count (A1)."""
    return df.groupBy(*keys).agg(total(value).alias("total_value"),
                                 F.count(F.lit(1)).alias("cnt"))


def filtered_group(df: DataFrame, condition: Column, keys: Sequence[str],
                   means: Sequence[str]) -> DataFrame:
    """Filter then per-key means and a count: the dashboard shape (A2)."""
    aggs = [mean(m).alias(f"avg_{m}") for m in means]
    return df.where(condition).groupBy(*keys).agg(*aggs, F.count(F.lit(1)).alias("cnt"))


def group_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``groupBy(k).count()`` under the name ``cnt`` (A3)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))


def min_max_count(df: DataFrame, col: str) -> DataFrame:
    """Global min / max / count in one pass (A4)."""
    return df.agg(F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"),
                  F.count(F.lit(1)).alias("cnt"))


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct tuples with how often each occurs. An aggregate, not ``dropDuplicates``: its
    partial step sends one row per tuple and partition, so a hot tuple stays cheap; on a
    stream run it in ``update`` mode."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("cnt"))


def contiguity(df: DataFrame, col: str) -> DataFrame:
    """Rows = distinct = max - min + 1 means no duplicates and no gaps (A6). Distinct
    numbers are counted by bitmaps of about 32,000 ids each: the shuffle carries bitmaps,
    not ids."""
    ids = df.groupBy(F.expr(f"bitmap_bucket_number({col})").alias("_bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"bitmap_count(bitmap_construct_agg(bitmap_bit_position({col})))").alias("d"),
        F.min(col).alias("lo"), F.max(col).alias("hi"))
    known = F.col("_bucket").isNotNull()  # null ids are rows, but no numbers
    stats = ids.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                    F.coalesce(F.sum(F.when(known, F.col("d"))), F.lit(0)).alias("n_distinct"),
                    F.min("lo").alias("min_value"), F.max("hi").alias("max_value"))
    span = F.col("max_value") - F.col("min_value") + 1
    verdict = (F.when(F.col("n_rows") == 0, F.lit("EMPTY"))
               .when(F.col("n_rows") != F.col("n_distinct"), F.lit("DUPLICATES"))
               .when(F.col("n_distinct") != span, F.lit("GAPS"))
               .otherwise(F.lit("PASS")))
    return stats.withColumn("verdict", verdict)


_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _one_number(df: DataFrame, order: Sequence[str]) -> Column | None:
    """The order columns as one fixed-width number, if they are at most two and whole
    (a timestamp counts in microseconds; of two, the first is under 5e18), else None. A
    null makes a row the oldest."""
    def whole(c: str) -> Column | None:
        kind = df.schema[c].dataType
        if isinstance(kind, T.TimestampType):
            return F.unix_micros(c)
        return F.col(c).cast("long") if isinstance(kind, T.IntegralType) else None

    parts = [whole(c) for c in order]
    if any(p is None for p in parts) or len(parts) > 2:
        return None
    if len(parts) == 1:
        return F.coalesce(parts[0], F.lit(-(1 << 63)))
    first, second = (p.cast("decimal(19,0)") for p in parts)
    packed = first * F.lit(str(1 << 64)).cast("decimal(20,0)") + second
    return F.coalesce(packed.cast("decimal(38,0)"), F.lit(str(1 - 10**38)).cast("decimal(38,0)"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   payload: Sequence[str]) -> DataFrame:
    """Newest row per key by ``order`` (ties broken by the later order columns).

    With fixed-width columns and at most two whole order columns this is one hash
    aggregate with partial combine: ``max_by`` per column over the order packed into one
    number. A bounded table with other payload (text) hash-aggregates the order alone and
    meets its rows again by key and order. Otherwise (text on a stream, other orders) the
    newest row is the maximum of a struct, which Spark aggregates by sorting."""
    at = _one_number(df, order)
    columns = [c for c in df.columns if c in (*order, *payload)]
    if at is not None and all(isinstance(df.schema[c].dataType, _FIXED) for c in columns):
        newest = df.withColumn("_at", at).groupBy(*keys).agg(*[F.max_by(c, "_at").alias(c) for c in columns])
    elif at is not None and not df.isStreaming:
        rows = df.withColumn("_at", at)
        top = rows.groupBy(*keys).agg(F.max("_at").alias("_top")).select(
            *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "_top")
        on = F.col("_at").eqNullSafe(F.col("_top"))
        for i, k in enumerate(keys):
            on = on & F.col(k).eqNullSafe(F.col(f"_key{i}"))
        newest = rows.join(top, on).dropDuplicates(list(keys))
    else:
        pick = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload]))
        newest = df.groupBy(*keys).agg(pick.alias("_r")).select(*keys, "_r.*")
    return newest.select(*keys, *order, *[c for c in payload if c not in order])


def sensor_dashboard(readings: DataFrame) -> DataFrame:
    """Occupied rooms: mean temperature and humidity and the reading count per room
    (the dashboard of the sensor demos, with its column names)."""
    return (readings.where(F.col("occupied"))
            .groupBy("roomId")
            .agg(F.avg("temperature").alias("avgTemperature"),
                 F.avg("humidity").alias("avgHumidity"),
                 F.count(F.lit(1)).alias("readingCount")))
