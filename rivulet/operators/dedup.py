"""Deduplication.

``dedup`` keeps the first occurrence of each key forever (unbounded state in
streaming). ``dedup_within_watermark`` bounds the state: a key is remembered until the
watermark passes its event time plus the delay, which is right whenever duplicates
arrive within the delay of each other (redeliveries of one event).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def dedup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropDuplicates(list(keys))


def dedup_within_watermark(df: DataFrame, ts: str, delay: str, keys: Sequence[str]) -> DataFrame:
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
