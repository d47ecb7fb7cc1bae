"""Returns and streaks on a stream equal the batch rows; late ticks come out beside."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from barlab import operators as ops
from barlab.sources.bars import bars_from_ticks
from barlab.streaming.series import final_bars, late_ticks, stream_series
from conftest import SF0001

SCHEMA = "ticker string, ts timestamp_ntz, price double, seq long"
KEY = ["ticker", "date"]


def _feed(spark, batches, base, name):
    """Run the batches, one file a micro-batch, stopping the query after each."""
    src = os.path.join(base, "ticks")
    for i, batch in enumerate(batches):
        batch.coalesce(1).write.mode("append").parquet(src)
        ticks = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
        series = stream_series(ticks, "ticker", "ts", "price", "seq", lateness_days=1)
        writer = series.writeStream.format("parquet").option("path", os.path.join(base, "out"))
        q = writer.option("checkpointLocation", os.path.join(base, "ckpt")).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None
    return spark.read.parquet(os.path.join(base, "out"))


def _streaks(rows):
    out, last = {}, {}
    for r in sorted(rows, key=lambda r: (r.ticker, r.date)):
        sign = 0 if r.open is None or r.close is None else (r.close > r.open) - (r.close < r.open)
        before = last.get(r.ticker)
        last[r.ticker] = (sign, before[1] + 1 if before and before[0] == sign else 1)
        out[r.ticker, r.date] = last[r.ticker]
    return out


@pytest.fixture
def base():
    return tempfile.mkdtemp(prefix="barlab-series-", dir="/tmp")


def test_replayed_events_equal_batch(spark, base):
    """The events in five parts by time, the query restarted between them."""
    events = spark.read.parquet(f"{SF0001}/events.parquet").select(F.col("event_type").alias("ticker"), "ts", F.col("value").alias("price"), F.col("event_id").alias("seq"))
    day = F.dayofmonth("ts")
    batches = [events.where((day > 6 * i) & (day <= 6 * i + 6)) for i in range(5)] + [events.where(day > 30)]
    got = _feed(spark, batches, base, "replay")
    assert late_ticks(got).count() == 0
    batch = bars_from_ticks(events, "ticker", "ts", "price", "seq")
    last = batch.groupBy("ticker").agg(F.max("date").alias("last"))
    closed = batch.join(last, "ticker").where(F.datediff("last", "date") > 1).select(*batch.columns)
    bars = final_bars(got)
    assert bars.count() == closed.count() > 100
    assert bars.select(*closed.columns).exceptAll(closed).count() == 0
    want = {(r.ticker, r.date): (r.daily_return, r.daily_change) for r in ops.daily_returns(batch).collect()}
    streaks = _streaks(batch.collect())
    for r in bars.collect():
        assert (r.daily_return, r.daily_change) == pytest.approx(want[r.ticker, r.date])
        assert (r.sign, r.streak) == streaks[r.ticker, r.date]


def test_late_ticks_come_out_beside(spark, base):
    def part(*rows):
        return spark.createDataFrame([(t, d, p, s) for t, d, p, s in rows], "ticker string, d string, price double, seq long").select(
            "ticker", F.col("d").cast("timestamp_ntz").alias("ts"), "price", "seq"
        )

    got = _feed(
        spark,
        [
            part(("A", "2024-01-01 10:00", 10.0, 1), ("A", "2024-01-02 10:00", 12.0, 2), ("B", "2024-01-01 09:00", 1.0, 1)),
            # Jan 1 is still open (one day after it only), so this tick counts; then it becomes final.
            part(("A", "2024-01-01 11:00", 11.0, 3), ("A", "2024-01-04 10:00", 6.0, 4)),
            # Too late for A's Jan 1 and 2, not for B's, whose own clock stands at Jan 1.
            part(("A", "2024-01-01 12:00", 99.0, 5), ("A", "2024-01-02 12:00", None, None), ("B", "2024-01-01 10:00", 2.0, 2), ("A", "2024-01-09 10:00", 7.0, 6)),
        ],
        base,
        "late",
    )
    bars = {(r.ticker, str(r.date)): r for r in final_bars(got).collect()}
    assert sorted(bars) == [("A", "2024-01-01"), ("A", "2024-01-02"), ("A", "2024-01-04")]
    first = bars["A", "2024-01-01"]
    assert (first.open, first.close, first.volume, first.daily_return, first.sign, first.streak) == (10.0, 11.0, 2.0, None, 1, 1)
    assert bars["A", "2024-01-04"].daily_return == pytest.approx((6.0 - 12.0) / 12.0)
    late = sorted((r.ticker, str(r.date), r.price) for r in late_ticks(got).collect())
    assert late == [("A", "2024-01-01", 99.0), ("A", "2024-01-02", None)]
