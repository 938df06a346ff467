"""The demo pipeline on the sensor schema: envelopes -> bronze (append, ingestion time)
-> bronze as a stream -> complete-mode dashboard, over two arrivals."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import functions as F

from rivulet import schemas
from rivulet.operators.aggregate import sensor_dashboard
from rivulet.operators.windows import stamp_ingestion
from rivulet.session import run_dir
from rivulet.sources import envelope, files
from rivulet.streaming import runtime
from rivulet.streaming.sinks import BatchPathSink

T0 = datetime(2024, 1, 1, 9, 0, tzinfo=timezone.utc)


def _readings(tick: int):
    rows = []
    for room in range(1, 21):
        for s in range(1, 4):
            i = tick * 60 + room * 3 + s
            rows.append((f"sensor-room-{room:03d}-{s}", f"room-{room:03d}", "bldg-A",
                         T0 + timedelta(seconds=5 * tick), 16.0 + (i * 37 % 1600) / 100,
                         25.0 + (i * 53 % 4500) / 100, (i + room) % 3 != 0))
    return rows


def test_bronze_to_dashboard(spark):
    root = run_dir(spark, "sensor_in")
    payload_cols = [f.name for f in schemas.SENSOR.fields]
    all_rows = []
    for tick in range(2):
        rows = _readings(tick)
        all_rows += rows
        df = spark.createDataFrame(rows, schemas.SENSOR).withColumn("seq", F.monotonically_increasing_id())
        env = envelope.encode(df, "roomId", payload_cols, topic="sensors", offset_col="seq",
                              time_col="eventTime")
        env.write.mode("overwrite").parquet(f"{root}/arrival-{tick}")

    raw = files.parquet_stream(spark, f"{root}/arrival-*", schemas.ENVELOPE, max_files=1)
    bronze = stamp_ingestion(envelope.decode(raw, schemas.SENSOR), "ingestionTime")
    bronze_dir = run_dir(spark, "sensor_bronze")
    runtime.run_to_end(bronze, runtime.checkpoint_for(bronze_dir), sink=bronze_dir)
    assert "ingestionTime" in spark.read.parquet(bronze_dir).columns

    dash = sensor_dashboard(files.parquet_stream(spark, bronze_dir, bronze.schema))
    sink = BatchPathSink(run_dir(spark, "sensor_dash"))
    runtime.run_to_end(dash, runtime.checkpoint_for(sink.root), output_mode="complete",
                       foreach_batch=sink)
    got = sink.read_latest(spark, dash.schema).toPandas().set_index("roomId").sort_index()

    pdf = pd.DataFrame(all_rows, columns=payload_cols)
    want = (pdf[pdf.occupied].groupby("roomId")
            .agg(avgTemperature=("temperature", "mean"), avgHumidity=("humidity", "mean"),
                 readingCount=("temperature", "size")).sort_index())
    assert list(got.index) == list(want.index)
    assert (got.readingCount.values == want.readingCount.values).all()
    assert abs(got.avgTemperature - want.avgTemperature).max() < 1e-9
    assert abs(got.avgHumidity - want.avgHumidity).max() < 1e-9
