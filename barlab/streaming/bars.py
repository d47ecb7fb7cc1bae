"""Daily bars built incrementally from a stream of ticks.

The same aggregates as ``bars_from_ticks`` run as a Structured Streaming
aggregation keyed by (ticker, day), where the day is ``to_date`` of the
event time exactly as in the batch builder, so both agree in any session
time zone.  The watermark is set on the day's start: a day's bar is final,
and emitted in append mode, once a tick dated more than ``lateness`` after
that day has been seen; later ticks for it are dropped.  State per open
day holds one row per ticker (the partial aggregates), not the ticks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlab.plans.materialize import checkpoint_dir
from barlab.sources.bars import finished_bars, tick_aggregates, tick_events


def stream_bars(
    ticks: DataFrame,
    ticker: str | Column,
    ts: str | Column,
    price: str | Column,
    seq: str | Column,
    volume: str | Column | None = None,
    *,
    lateness: str,
) -> DataFrame:
    """Streaming DataFrame of daily bars (schema of ``BARS``) from ticks.

    ``lateness`` (for instance ``"1 day"``) is the caller's promise: ticks that
    come later than that are not in their bar.  Rebuild the days with
    ``bars_from_ticks`` if the source breaks it."""
    events = tick_events(ticks, ticker, ts, price, seq, volume)
    # Watermarks need a TIMESTAMP: the start of the event's calendar day.
    events = events.withColumn("_day", F.col("date").cast("timestamp"))
    daily = events.withWatermark("_day", lateness).groupBy("ticker", "_day").agg(*tick_aggregates(volume))
    return finished_bars(daily.withColumn("date", F.to_date("_day")))


def write_bars_stream(
    bars: DataFrame, path: str, name: str = "bars", checkpoint: str | None = None, available_now: bool = False
) -> StreamingQuery:
    """Append final bars to year-partitioned parquet at ``path``.

    The query's progress is kept under ``checkpoint`` or, by default, under
    the shared folder named in ``spark.checkpoint.dir``, so a restarted
    driver resumes exactly where it stopped.
    """
    if checkpoint is None:
        root = checkpoint_dir(bars.sparkSession)
        if root is None:
            raise RuntimeError("set spark.checkpoint.dir or pass checkpoint=")
        checkpoint = f"{root.rstrip('/')}/streams/{name}"
    writer = (
        bars.withColumn("year", F.year("date"))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("year")
        .queryName(name)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
