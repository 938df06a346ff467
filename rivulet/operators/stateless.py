"""Stateless transformations: projection, derivation, filters, flatMap.

A stateless chain runs per micro-batch without touching the state store, and the
same function applied to ``spark.read`` and ``spark.readStream`` gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet import schemas
from rivulet.functions.parse import parse_json, words
from rivulet.functions.time import epoch_micros


def enrich_events(df: DataFrame) -> DataFrame:
    """select + derive + filter + flatten + drop, all plain column expressions:
    parse the ``props`` payload, price in cents, drop error events."""
    return (df.select("event_id", "ts", "user_id", "event_type", "value", "props")
            .withColumn("p", parse_json(F.col("props"), schemas.PROPS))
            .withColumn("amount_cents", F.round(F.col("value") * 100).cast("long"))
            .where(F.col("event_type") != F.lit("error"))
            .select("event_id", "user_id", "event_type", "amount_cents", "p.*",
                    epoch_micros("ts").alias("ts_us"))
            .drop("p"))


def project_events(df: DataFrame) -> DataFrame:
    """Plain projection with exact instants (the check form of a passthrough stream)."""
    return df.select("event_id", "user_id", "event_type", "value",
                     epoch_micros("ts").alias("ts_us"))


def explode_words(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """flatMap: one row per whitespace token of ``text``."""
    return df.select(*keep, F.explode(words(F.col(text))).alias("word")).where(F.col("word") != "")
