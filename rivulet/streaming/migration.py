"""Parallel cut-over: an old and a new query run side by side on the same arrivals until
the new one may take over.

Both write tables of their own. Each is final up to its own watermark, so they are compared
per key up to the smaller of the two. The switch is refused while the new query is behind
(its watermark is smaller) or while the tables differ; until then readers keep the old one.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.streaming import paths


class CutOverRefused(ValueError):
    """The new query may not take over yet."""


@dataclass
class Live:
    """A running query: its checkpoint, its table, and ``same``, which brings the table into
    the shape that both are compared in (keys and values of the old table)."""

    name: str
    checkpoint: str
    read: Callable[[], DataFrame]
    same: Callable[[DataFrame], DataFrame] = lambda df: df


@dataclass(frozen=True)
class Verdict:
    state: str  # agreed, behind, differs
    upto_ms: int
    differences: int


def watermark_ms(spark: SparkSession, checkpoint: str) -> int:
    """The watermark of the newest planned batch, from the offset log; 0 before the first."""
    folder = f"{checkpoint.rstrip('/')}/offsets"
    batches = [int(n) for n in paths.list_names(spark, folder) if n.isdigit()]
    if not batches:
        return 0
    meta = paths.read_text(spark, f"{folder}/{max(batches)}").splitlines()[1]
    return int(json.loads(meta)["batchWatermarkMs"])


class CutOver:
    """``end`` is the column (epoch seconds) up to which a row is final: its window's end. The
    current table's name is kept in a small file under ``root``."""

    def __init__(self, spark: SparkSession, root: str, old: Live, new: Live, keys: Sequence[str], end: str):
        self.spark, self.pointer = spark, f"{root.rstrip('/')}/current"
        self.old, self.new = old, new
        self.keys, self.end = list(keys), end

    def common_ms(self) -> int:
        return min(watermark_ms(self.spark, q.checkpoint) for q in (self.old, self.new))

    def _final(self, df: DataFrame, upto_ms: int) -> DataFrame:
        return df.where(F.col(self.end) * 1000 <= upto_ms)

    def differences(self, upto_ms: int | None = None) -> DataFrame:
        """Rows that are final in both and not the same: keys, what is wrong, and the values of
        either side. A key that either table holds twice counts as different."""
        upto_ms = self.common_ms() if upto_ms is None else upto_ms
        sides = []
        for q, tag in ((self.old, "old"), (self.new, "new")):
            df = self._final(q.same(q.read()), upto_ms)
            values = [c for c in df.columns if c not in self.keys]
            row = F.struct(*[F.col(c) for c in sorted(values)])
            sides.append(df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias(f"{tag}_rows"), F.min(row).alias(tag))
                         .withColumnsRenamed({k: f"{tag}_{k}" for k in self.keys}))
        same = F.lit(True)
        for k in self.keys:  # a null key is a key
            same = same & F.col(f"old_{k}").eqNullSafe(F.col(f"new_{k}"))
        both = sides[0].join(sides[1], same, "full")
        what = (F.when(F.col("new_rows").isNull(), "missing").when(F.col("old_rows").isNull(), "extra")
                .when((F.col("old_rows") > 1) | (F.col("new_rows") > 1), "repeated")
                .when(~F.col("old").eqNullSafe(F.col("new")), "changed"))
        keys = [F.when(F.col("old_rows").isNotNull(), F.col(f"old_{k}")).otherwise(F.col(f"new_{k}")).alias(k)
                for k in self.keys]
        return both.select(*keys, what.alias("what"), "old", "new").where("what is not null")

    def verdict(self) -> Verdict:
        old, new = (watermark_ms(self.spark, q.checkpoint) for q in (self.old, self.new))
        n = self.differences(min(old, new)).count()
        return Verdict("differs" if n else "behind" if new < old else "agreed", min(old, new), n)

    def switch(self) -> Verdict:
        """Make the new table the current one, or refuse."""
        v = self.verdict()
        if v.state != "agreed":
            raise CutOverRefused(f"{self.new.name} is not ready to replace {self.old.name}: {v.state} "
                                 f"({v.differences} differences up to {v.upto_ms} ms)")
        paths.write_text(self.spark, self.pointer, json.dumps({"name": self.new.name, "upto_ms": v.upto_ms}))
        return v

    def current(self) -> Live:
        if not paths.exists(self.spark, self.pointer):
            return self.old
        name = json.loads(paths.read_text(self.spark, self.pointer))["name"]
        return next(q for q in (self.old, self.new) if q.name == name)

    def read(self) -> DataFrame:
        """The current table, as far as it is final."""
        q = self.current()
        return self._final(q.read(), watermark_ms(self.spark, q.checkpoint))
