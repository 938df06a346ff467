"""Thin adapters for connectors that are not on this classpath (Delta, JDBC).

They carry the same semantics as the tested Parquet forms in ``sinks.py``; here only their
options and statements are tested (no Delta jars, no JDBC driver). Each raises a clear error when the
connector is missing instead of failing deep inside a query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def delta_available(spark: SparkSession) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("io.delta.tables.DeltaTable")
        return True
    except Exception:  # noqa: BLE001
        return False


def _require_delta(spark: SparkSession) -> None:
    if not delta_available(spark):
        raise RuntimeError("Delta Lake is not on the classpath; use rivulet.streaming.sinks "
                           "(UpsertTable, AccumulatingTable) and rivulet.streaming.transactional for the Parquet form")


def delta_idempotent_write(df: DataFrame, path: str, app_id: str, batch_id: int,
                           mode: str = "append") -> None:
    """Write a micro-batch once per ``(app_id, batch_id)`` (Delta skips a repeat)."""
    _require_delta(df.sparkSession)
    (df.write.format("delta").option("txnAppId", app_id).option("txnVersion", batch_id)
     .mode(mode).save(path))


def delta_upsert(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """``MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *`` on the keys."""
    spark = df.sparkSession
    _require_delta(spark)
    from delta.tables import DeltaTable  # noqa: PLC0415 - optional dependency

    cond = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    (DeltaTable.forPath(spark, path).alias("t").merge(df.alias("s"), cond)
     .whenMatchedUpdateAll().whenNotMatchedInsertAll().execute())


def delta_accumulate(df: DataFrame, path: str, keys: Sequence[str], measures: Sequence[str]) -> None:
    """``t.m = t.m + s.m`` merge; not idempotent, so give it a transaction id and version."""
    spark = df.sparkSession
    _require_delta(spark)
    from delta.tables import DeltaTable  # noqa: PLC0415

    cond = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    (DeltaTable.forPath(spark, path).alias("t").merge(df.alias("s"), cond)
     .whenMatchedUpdate(set={m: f"t.{m} + s.{m}" for m in measures})
     .whenNotMatchedInsertAll().execute())


def jdbc_stage(df: DataFrame, url: str, staging_table: str, properties: dict) -> None:
    """Append a micro-batch to a staging table; the database then applies it with
    ``INSERT ... ON CONFLICT DO NOTHING`` keyed on the event id (at-least-once safe)."""
    df.write.mode("append").jdbc(url, staging_table, properties=properties)


def jdbc_apply_statement(staging_table: str, table: str, columns: Sequence[str], key: str) -> str:
    """The statement that the database runs after ``jdbc_stage``: rows whose ``key`` is not
    there yet, once each, whatever was staged or applied before."""
    cols = ", ".join(columns)
    return (f"INSERT INTO {table} ({cols}) SELECT {cols} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {key}) AS nth FROM {staging_table}) AS s "
            f"WHERE nth = 1 ON CONFLICT ({key}) DO NOTHING")
