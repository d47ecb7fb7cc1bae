"""Incremental bars equal batch bars for every day the watermark closed."""

import os
import shutil
import tempfile

from pyspark.sql import functions as F

from barlab.sources.bars import bars_from_events, load_bars
from barlab.streaming import stream_bars, write_bars_stream
from conftest import SF0001


def _stream_dir() -> str:
    """A folder holding the events table, as a file stream source reads folders."""
    d = tempfile.mkdtemp(prefix="barlab-ticks-", dir="/tmp")
    shutil.copy(f"{SF0001}/events.parquet", d)
    return d


def test_stream_bars_match_batch_for_closed_days(spark):
    src = f"{SF0001}/events.parquet"
    schema = spark.read.parquet(src).schema
    ticks = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(_stream_dir())
    bars = stream_bars(ticks, "event_type", "ts", "value", "event_id", lateness="1 day")
    base = tempfile.mkdtemp(prefix="barlab-stream-", dir="/tmp")
    out = os.path.join(base, "bars")
    q = write_bars_stream(bars, out, name="test_bars", checkpoint=os.path.join(base, "ckpt"), available_now=True)
    q.awaitTermination(120)
    assert q.exception() is None
    got = load_bars(spark, out)
    batch = bars_from_events(spark, SF0001)
    last_day = batch.agg(F.max("date")).collect()[0][0]
    assert got.count() > 0
    # every emitted bar is final and equal to the batch bar of that day
    assert got.exceptAll(batch).count() == 0
    # only days not yet closed by the watermark are still open
    missing = batch.exceptAll(got).agg(F.min("date")).collect()[0][0]
    assert missing is None or (last_day - missing).days <= 1


def test_complete_mode_gives_all_bars(spark):
    src = f"{SF0001}/events.parquet"
    schema = spark.read.parquet(src).schema
    ticks = spark.readStream.schema(schema).parquet(_stream_dir())
    q = (
        stream_bars(ticks, "event_type", "ts", "value", "event_id", lateness="1 day")
        .writeStream.format("memory")
        .queryName("all_bars")
        .outputMode("complete")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(120)
    got = spark.table("all_bars")
    batch = bars_from_events(spark, SF0001)
    assert got.count() == batch.count()
    assert got.exceptAll(batch).count() == 0


def test_days_follow_the_data_in_any_session_time_zone(spark):
    """Day boundaries come from ``to_date`` of the event time, as in batch."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        src = f"{SF0001}/events.parquet"
        ticks = spark.readStream.schema(spark.read.parquet(src).schema).parquet(_stream_dir())
        q = (
            stream_bars(ticks, "event_type", "ts", "value", "event_id", lateness="1 day")
            .writeStream.format("memory")
            .queryName("bars_la")
            .outputMode("complete")
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination(120)
        got = spark.table("bars_la")
        batch = bars_from_events(spark, SF0001)
        assert got.count() == batch.count() == 150
        assert got.exceptAll(batch).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
