"""Daily returns and running streaks on a stream of ticks, late ticks in a side output.

A window's ``lag`` is refused on streams, and a watermarked aggregation drops ticks
that come too late without a trace.  Here each ticker has a state of its own in the
state store (``transformWithStateInPandas``): its open days' prices, and of its last
final day the close, the sign and the length of the streak.

A day is final once the ticker has had a tick dated more than ``lateness_days`` days after
it.  Final days come out in date order as rows of kind ``bar``, each once, with the return
against the day before and the streak so far.  A tick for a day that is final already
changes nothing and comes out as a row of kind ``late``; what is late is decided against the
state before the micro-batch, so it does not depend on the order of rows inside.
:func:`final_bars` and :func:`late_ticks` are the two outputs.

Replay-safe: state and output offsets are in the query's checkpoint, so a restarted
query goes on where it stopped.  All ticks of a ticker in one micro-batch meet in one
task; bound them by the source's rate limit (``maxFilesPerTrigger`` or the like).  The state
holds a ticker's open days, whatever the history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from barlab.schema import BAR_COLUMNS
from barlab.sources.bars import finished_bars, tick_events

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PRICES = ["open", "high", "low", "close", "volume"]
_FOLLOWS = ["daily_return", "daily_change", "sign", "streak"]
SERIES = (
    "kind string, ticker string, date date, seq long, price double, qty double, "
    "open double, high double, low double, close double, volume double, "
    "daily_return double, daily_change double, sign int, streak long"
)
_COLUMNS = [c.split()[0] for c in SERIES.split(", ")]


def _none(x):
    return None if x is None or pd.isna(x) else float(x)


class _TickerSeries(StatefulProcessor):
    def __init__(self, lateness_days: int):
        self.lateness = dt.timedelta(days=lateness_days)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getMapState("days", "date date", "first long, last long, open double, high double, low double, close double, volume double")
        self.past = handle.getValueState("past", "newest date, final date, close double, sign int, streak long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest, final, close, sign, streak = self.past.get() if self.past.exists() else (None, None, None, 0, 0)
        for ticks in rows:
            late = ticks["date"].map(lambda d: final is not None and d <= final).astype(bool)
            if late.any():
                out = ticks[late].assign(kind="late")
                yield out.reindex(columns=_COLUMNS)
            for day, part in ticks[~late].groupby("date"):
                self._add(day, part)
                newest = day if newest is None else max(newest, day)
        done = sorted(k[0] for k in self.days.keys() if newest is not None and newest - k[0] > self.lateness)
        bars = []
        for day in done:
            _, _, *prices = self.days.getValue((day,))
            self.days.removeKey((day,))
            o, _, _, c, _ = prices
            known = c is not None and close is not None
            now = 0 if o is None or c is None else (c > o) - (c < o)
            streak = streak + 1 if final is not None and now == sign else 1
            bars.append(("bar", key[0], day, *prices, (c - close) / close if known and close != 0 else None, c - close if known else None, now, streak))
            final, close, sign = day, c, now
        self.past.update((newest, final, close, sign, streak))
        if bars:
            yield pd.DataFrame(bars, columns=["kind", "ticker", "date", *_PRICES, *_FOLLOWS]).reindex(columns=_COLUMNS)

    def _add(self, day: dt.date, part: pd.DataFrame) -> None:
        old = self.days.getValue((day,)) if self.days.containsKey((day,)) else (None, None, None, None, None, None, 0.0)
        first, last, open_, high, low, close, volume = old
        priced = part[part["price"].notna()]
        if len(priced):
            a, b = priced.loc[priced["seq"].idxmin()], priced.loc[priced["seq"].idxmax()]
            if first is None or a["seq"] < first:
                first, open_ = int(a["seq"]), float(a["price"])
            if last is None or b["seq"] > last:
                last, close = int(b["seq"]), float(b["price"])
            top, bottom = float(priced["price"].max()), float(priced["price"].min())
            high, low = (top, bottom) if high is None else (max(high, top), min(low, bottom))
        self.days.updateValue((day,), (first, last, _none(open_), _none(high), _none(low), _none(close), volume + float(part["qty"].fillna(0).sum())))

    def close(self) -> None:
        pass


def stream_series(
    ticks: DataFrame,
    ticker: str | Column,
    ts: str | Column,
    price: str | Column,
    seq: str | Column,
    volume: str | Column | None = None,
    *,
    lateness_days: int,
) -> DataFrame:
    """Streaming rows (:data:`SERIES`) of final days and late ticks; ticks as in
    ``bars_from_ticks``, those without a ticker or a date left out.  The state store
    must be RocksDB; the session is set to it."""
    events = tick_events(ticks, ticker, ts, price, seq, volume).dropna(subset=["ticker", "date"])
    events = events.withColumn("seq", events["seq"].cast("long"))
    ticks.sparkSession.conf.set(_PROVIDER, _ROCKSDB)
    return events.groupBy("ticker").transformWithStateInPandas(
        statefulProcessor=_TickerSeries(lateness_days), outputStructType=SERIES, outputMode="Append", timeMode="None"
    )


def final_bars(series: DataFrame) -> DataFrame:
    """Columns of ``BARS`` and daily_return, daily_change, sign, streak of the final days."""
    rows = series.where("kind = 'bar'")
    return finished_bars(rows, _FOLLOWS).select(*BAR_COLUMNS, *_FOLLOWS)


def late_ticks(series: DataFrame) -> DataFrame:
    """ticker, date, seq, price, qty of the ticks that came after their day was final."""
    return series.where("kind = 'late'").select("ticker", "date", "seq", "price", "qty")
