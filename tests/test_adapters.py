"""Adapters for connectors that are absent here: the options they set, the statements they
make, and their errors."""

from __future__ import annotations

import duckdb
import pytest

from rivulet.sources import envelope
from rivulet.streaming import adapters


class Recorder:
    """Records chained reader or writer calls."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, *args, *kwargs.items()))
            return self
        return call

    def options(self):
        return {c[1]: c[2] for c in self.calls if c[0] == "option"}


class Frame:
    def __init__(self):
        self.write = Recorder()
        self.sparkSession = None


def test_kafka_source_options():
    spark = type("Spark", (), {})()
    spark.readStream = Recorder()
    envelope.kafka_stream(spark, "h:9092", topic="t", starting_offsets="latest", max_offsets_per_trigger=7,
                          fail_on_data_loss=False)
    assert spark.readStream.options() == {
        "kafka.bootstrap.servers": "h:9092", "startingOffsets": "latest", "failOnDataLoss": "false", "subscribe": "t",
        "maxOffsetsPerTrigger": 7}
    assert ("format", "kafka") in spark.readStream.calls and spark.readStream.calls[-1] == ("load",)


def test_kafka_sink_options():
    assert envelope.kafka_sink_options("h:9092", "out") == {"kafka.bootstrap.servers": "h:9092", "topic": "out"}


def test_delta_write_names_its_transaction(monkeypatch):
    monkeypatch.setattr(adapters, "_require_delta", lambda spark: None)
    df = Frame()
    adapters.delta_idempotent_write(df, "/t", "app", 3)
    assert df.write.options() == {"txnAppId": "app", "txnVersion": 3}
    assert ("format", "delta") in df.write.calls and ("mode", "append") in df.write.calls


def test_delta_is_asked_for(spark):
    df = spark.range(1)
    for call in (lambda: adapters.delta_idempotent_write(df, "/t", "a", 0), lambda: adapters.delta_upsert(df, "/t", ["id"]),
                 lambda: adapters.delta_accumulate(df, "/t", ["id"], ["n"])):
        with pytest.raises(RuntimeError, match="Delta"):
            call()


def test_staged_rows_are_applied_once():
    """The apply statement, run in a database inside this process."""
    con = duckdb.connect()
    con.execute("create table target (id int primary key, v text); create table staging (id int, v text)")
    con.execute("insert into staging values (1, 'a'), (2, 'b'), (2, 'b')")
    statement = adapters.jdbc_apply_statement("staging", "target", ["id", "v"], "id")
    for _ in range(2):
        con.execute(statement)
    con.execute("insert into staging values (3, 'c')")
    con.execute(statement)
    assert con.sql("select * from target order by id").fetchall() == [(1, "a"), (2, "b"), (3, "c")]


def test_staging_appends():
    df = Frame()
    adapters.jdbc_stage(df, "jdbc:x", "staging", {"user": "u"})
    assert df.write.calls[0] == ("mode", "append") and df.write.calls[1][:3] == ("jdbc", "jdbc:x", "staging")
