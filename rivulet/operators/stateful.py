"""Arbitrary stateful processing (``transformWithState``) with timers and TTL.

``running_totals`` counts per key in two state variables, a value and a map, which an old
query's totals can seed and which expire if asked. ``changes`` turns a changelog stream into
the full changes of its table, keeping a key's current value and removing it with its delete.

``idle_keys`` reports every idle period: a stretch of ``gap_ms`` of event time without an
event of the key. Events are first counted on the JVM per key and short time bucket (a
windowed aggregate with partial combine), so a hot key reaches the Python processor as a
row per bucket. The aggregate hands over a bucket once the watermark has passed it, so
buckets arrive in time order however the input is cut into batches, and the processor
walks them: a gap between two buckets ends an idle period, and so does a timer when the
key stays silent. An optional TTL drops the state of keys without a watermark.

Needs the RocksDB state store provider. The processor is pickled by value: workers need
no copy of this package. Keys are many and have few rows each in a batch, so the processors
take and give rows: a pandas frame per key costs more than the key's work. For the same
reason they ask the state store no more than once for what they need.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Width of the buckets; no gap shorter than this can be asked for.
BUCKET_MS = 3_600_000


class IdleCounter(StatefulProcessor):
    def __init__(self, key_col: str, gap_ms: int, bucket_ms: int = BUCKET_MS, ttl_ms: int | None = None):
        self.key_col = key_col
        self.gap_ms = gap_ms
        self.bucket_ms = bucket_ms
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.acc = handle.getValueState("acc", "cnt long, last_us long", self.ttl_ms)

    def _report(self, key, cnt: int, last_us: int) -> Row:
        return Row(**{self.key_col: key[0], "cnt": cnt, "last_ts_us": last_us})

    def _due(self, last_us: int) -> int:
        # events up to a bucket's width behind the watermark may still be on their way
        return last_us // 1000 + self.gap_ms + self.bucket_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802
        held = self.acc.get()
        cnt, last_us = held or (0, None)
        for n, lo, hi in sorted(((r.n, r.lo_us, r.hi_us) for r in rows), key=lambda b: b[1]):  # a row per bucket of the batch
            if last_us is not None and lo - last_us >= self.gap_ms * 1000:
                yield self._report(key, cnt, last_us)
                cnt = 0
            cnt, last_us = cnt + n, hi
        due = self._due(last_us)
        if held and self._due(held[1]) != due:
            self.handle.deleteTimer(self._due(held[1]))
        self.handle.registerTimer(due)
        self.acc.update((cnt, last_us))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        held = self.acc.get()
        if held:
            self.acc.clear()
            yield self._report(key, *held)

    def close(self) -> None:
        pass


def idle_keys(df: DataFrame, key: str, ts: str, gap_ms: int, delay: str,
              ttl_ms: int | None = None) -> DataFrame:
    """Every idle period of ``gap_ms`` or more: ``key, cnt, last_ts_us``, with the number of
    the key's events since its last idle period and the time of the last one."""
    if gap_ms < BUCKET_MS:
        raise ValueError("the gap must be at least a bucket long")
    us = F.unix_micros(F.col(ts))
    buckets = (df.withWatermark(ts, delay)
               .groupBy(F.window(ts, f"{BUCKET_MS} milliseconds").alias("_w"), key)
               .agg(F.count(F.lit(1)).alias("n"), F.min(us).alias("lo_us"), F.max(us).alias("hi_us"))
               .select(key, "n", "lo_us", "hi_us"))
    key_type = dict(df.dtypes)[key]
    return buckets.groupBy(key).transformWithState(
        statefulProcessor=IdleCounter(key, gap_ms, ttl_ms=ttl_ms),
        outputStructType=f"{key} {key_type}, cnt long, last_ts_us long",
        outputMode="Append", timeMode="EventTime")


class RunningTotals(StatefulProcessor):
    """Rows per key (``total``) and per key and kind (``kinds``)."""

    def __init__(self, key_col: str, ttl_ms: int | None = None):
        self.key_col, self.ttl_ms = key_col, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "cnt long", self.ttl_ms)
        self.kinds = handle.getMapState("kinds", "kind string", "cnt long", self.ttl_ms)

    def _add(self, n: int, kinds: dict[str, int]) -> int:
        held = self.total.get()
        cnt = n + (held[0] if held else 0)
        self.total.update((cnt,))
        for kind, m in kinds.items():
            before = self.kinds.getValue((kind,)) if held else None  # a key's kinds come with its total
            self.kinds.updateValue((kind,), (m + (before[0] if before else 0),))
        return cnt

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        kinds = {k["kind"]: k["cnt"] for k in initialState.kinds}
        self._add(sum(kinds.values()), kinds)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802
        kinds = Counter(r.kind for r in rows)
        cnt = self._add(sum(kinds.values()), kinds)
        yield Row(**{self.key_col: key[0], "cnt": cnt})

    def close(self) -> None:
        pass


def running_totals(df: DataFrame, key: str, kind: str, initial: DataFrame | None = None,
                   ttl_ms: int | None = None) -> DataFrame:
    """``key, cnt`` in update mode: how many rows a key has had so far. ``initial`` (``key, kind,
    cnt``) are totals of an old query to go on from. With ``ttl_ms`` a key's state expires so
    long after it last changed, and the key starts anew; such a query follows the clock and has no
    last batch, so an ``availableNow`` run of it does not end. A null kind counts as the empty one."""
    key_type = dict(df.dtypes)[key]
    kinds = F.coalesce(F.col(kind), F.lit("")).alias("kind")
    seeds = None
    if initial is not None:  # a row per key
        sums = initial.groupBy(key, kinds).agg(F.coalesce(F.sum("cnt"), F.lit(0)).cast("long").alias("cnt"))
        seeds = sums.groupBy(key).agg(F.collect_list(F.struct("kind", "cnt")).alias("kinds")).groupBy(key)
    return df.select(key, kinds).groupBy(key).transformWithState(
        statefulProcessor=RunningTotals(key, ttl_ms), outputStructType=f"{key} {key_type}, cnt long",
        outputMode="Update", timeMode="ProcessingTime" if ttl_ms else "None", initialState=seeds)


class ChangeEmitter(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getValueState("current", "value long, seq long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802
        held = self.current.get()
        change = Row("key", "seq", "kind", "value")
        for seq, is_set, value in sorted(((r.seq, r.is_set, r.value) for r in rows), key=lambda r: r[0]):
            if is_set:
                if held:
                    yield change(key[0], seq, "update_before", held[0])
                yield change(key[0], seq, "update_after" if held else "insert", value)
                held = (value, seq)
            elif held:
                yield change(key[0], seq, "delete", held[0])
                held = None
        if held:
            self.current.update(held)
        else:
            self.current.clear()

    def close(self) -> None:
        pass


def changes(changelog: DataFrame) -> DataFrame:
    """Full changes of the table that a changelog stream (``seq, key, op, value``, in order of
    ``seq`` from batch to batch) describes: ``key, seq, kind, value``, with ``insert``,
    ``update_before`` and ``update_after``, and ``delete`` with the value that goes; a delete of an
    absent key changes nothing. Replaying them up to any ``seq`` rebuilds the table of that
    moment. State holds a row per key of the table (``current``) and loses it with its delete."""
    key_type = dict(changelog.dtypes)["key"]
    rows = changelog.select("key", "seq", (F.col("op") == "set").alias("is_set"), F.col("value").cast("long").alias("value"))
    return rows.groupBy("key").transformWithState(
        statefulProcessor=ChangeEmitter(), outputStructType=f"key {key_type}, seq long, kind string, value long",
        outputMode="Append", timeMode="None")
