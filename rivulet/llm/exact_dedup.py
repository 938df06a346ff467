"""Operator 8, exact dedup (native): heavy-hitter split.

Every text is reduced to the SHA-256 of its whitespace-normalised form. The Misra-Gries
counters behind ``DataFrame.freqItems`` (Karp, Schenker and Papadimitriou's form, at most
``1/support`` counters, merged map-side) propose frequent digests; one exact count over
those candidates alone gives each frequent digest's winner. The winners (at most
``1/support`` rows, so a proven bound) are broadcast: their copies are decided map-side
and never shuffled, however many they are. The other digests take the ordinary shuffle,
where no group holds more than ``support`` of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import WS, stored, whole_text

#: A digest with more than this share of all rows is surely found by Misra-Gries.
SUPPORT = 0.001


def digest(text_col: str = "text") -> Column:
    """Lowercase hex SHA-256 of the text with each white-space run turned into a space."""
    return F.sha2(F.regexp_replace(whole_text(text_col), WS, " "), 256)


def _summary():
    """Winner and size of a group: all primitive buffers, so a hash aggregate."""
    return [F.min("_id").alias("_keep"),
            F.coalesce(F.min_by("_uid", "_id"), F.min("_uid")).alias("_keep_uid"),
            F.count(F.lit(1)).alias("_n")]


def heavy_winners(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Exact winner and size of each digest that Misra-Gries proposes: at most
    ``1/support`` rows of ``(_digest, _keep, _keep_uid, _n)``."""
    found = rows.freqItems(["_digest"], support).select(
        F.explode(F.array_distinct("_digest_freqItems")).alias("_digest"))
    return (rows.join(F.broadcast(found), "_digest")
            .groupBy("_digest").agg(*_summary()))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                support: float = SUPPORT) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the smallest id stays (null ids last; of rows that share
    the smallest id exactly one stays). A null text is an empty one, and empty texts are
    equal to each other. Other columns are ignored, whatever their names; an empty table
    gives an empty result.
    """
    rows = stored(docs.select(F.col(id_col).alias("_id"), digest(text_col).alias("_digest"))
                  .withColumn("_uid", F.monotonically_increasing_id()), "exact-digests")
    heavy = stored(heavy_winners(rows, support), "exact-heavy")
    marked = rows.join(F.broadcast(heavy), "_digest", "left")
    by_digest = Window.partitionBy("_digest")
    rest = marked.where(F.col("_n").isNull()).drop("_keep", "_keep_uid", "_n")
    rest = rest.select("*", *[c.over(by_digest).alias(n) for c, n in (
        (F.min("_id"), "_keep"), (F.min_by("_uid", "_id"), "_by"), (F.min("_uid"), "_first"),
        (F.count(F.lit(1)), "_n"))]
    ).withColumn("_keep_uid", F.coalesce("_by", "_first")).select(marked.columns)
    return marked.where(F.col("_n").isNotNull()).unionByName(rest).select(
        F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"), (F.col("_uid") == F.col("_keep_uid")).alias("kept"),
        F.col("_digest").alias("text_sha256"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns (same rule as ``exact_dedup``).

    Copies of frequent texts are dropped map-side unless they carry the winner's id; what
    is left, at most ``support`` of all rows in a group and those winners, is shuffled
    once by digest."""
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
                        F.col(id_col).alias("_id"), digest(text_col).alias("_digest"))
    ids = stored(whole.select("_id", "_digest", F.lit(0).alias("_uid")), "exact-digests")
    heavy = stored(heavy_winners(ids, support), "exact-heavy")
    left = whole.join(F.broadcast(heavy), "_digest", "left").where(
        F.col("_n").isNull() | F.col("_id").eqNullSafe(F.col("_keep")))
    first = Window.partitionBy("_digest").orderBy(F.col("_id").asc_nulls_last())
    return (left.select("_row", "_id", "_digest", F.row_number().over(first).alias("_nth"))
            .where("_nth = 1").select("_row.*"))
