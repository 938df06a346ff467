"""Top-k per group without putting a whole group in one task.

``row_number() <= k`` over ``partitionBy(group)`` is planned by Catalyst with a
*partial* ``WindowGroupLimit`` before the shuffle: every map partition keeps only its
best ``k`` rows per group, so the final ranking sees at most ``k`` rows per group per
partition. That holds for ``k`` up to ``spark.sql.optimizer.windowGroupLimitThreshold``;
above it, rows are first ranked inside ``(group, hash(spread_key) % spread)`` sub-groups
(exact: a global top-k row is in the top k of its own sub-group). A global top-k (no
group) is ``orderBy().limit()``, planned as per-partition top-k plus a merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int,
          spread_key: str | None = None, spread: int = 64, rank_col: str = "rank") -> DataFrame:
    """Best ``k`` rows per ``groups`` by ``order`` (a total order, e.g. ending in a
    unique tie-break), with the 1-based rank in ``rank_col``."""
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > threshold and spread_key is not None:
        sub = F.pmod(F.xxhash64(F.col(spread_key)), F.lit(spread))
        local_w = Window.partitionBy(*groups, "_sub").orderBy(*order)
        df = (df.withColumn("_sub", sub).withColumn("_r", F.row_number().over(local_w))
              .where(F.col("_r") <= k).drop("_r", "_sub"))
    final_w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(final_w)).where(F.col(rank_col) <= k)
