"""Daily returns and price changes (close-to-close), and the intraday return
(open-to-close).

All lags run over ``Window.partitionBy("ticker").orderBy(...)``: one hash
exchange on ``ticker``, then a sort inside each partition.  Several windows
with the same partitioning share that exchange, and a later ``groupBy`` whose
keys include ``ticker`` adds none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.functions.columns import intraday_return, pct_change, series


def with_key(bars: DataFrame) -> DataFrame:
    """Bars that have their key; a row without ticker or date is in no series."""
    return bars.where(F.col("ticker").isNotNull() & F.col("date").isNotNull())


def with_returns(bars: DataFrame, drop_missing_first: bool = False) -> DataFrame:
    """Add ``prev_close``, ``daily_return`` and ``daily_change``.

    The first row of each ticker has no previous close, so both are NULL
    there; a zero previous close gives a NULL return, not an error.  By
    default a bar with a missing close stays in the series, so the returns
    on it and on the next day are NULL; ``drop_missing_first`` drops bars
    without open or close before the lag, bridging the gap.
    """
    src = bars.dropna(subset=["open", "close"]) if drop_missing_first else bars
    out = src.withColumn("prev_close", F.lag("close", 1).over(series()))
    return out.withColumns(
        {
            "daily_return": pct_change(F.col("close"), F.col("prev_close")),
            "daily_change": F.col("close") - F.col("prev_close"),
        }
    )


def daily_returns(bars: DataFrame) -> DataFrame:
    """ticker, date, close, daily_return, daily_change."""
    return with_returns(bars).select("ticker", "date", "close", "daily_return", "daily_change")


def daily_returns_year_split(bars: DataFrame) -> DataFrame:
    """``daily_returns`` for series too long, or tickers too hot, for one
    window task: each ticker's history is split by calendar year.

    The lag runs within (ticker, year) partitions, so no task holds more
    than one ticker-year.  The first bar of a year takes the last close of
    the ticker's previous year with bars, from a per-(ticker, year) table
    (one row per ticker-year, built with a partial aggregation and a lag
    over years) joined on (ticker, year): the rows are where the window put
    them, so the join moves none.  Same rows and the same arithmetic as
    ``daily_returns``, for bars that have their key.  Columns: ticker, date,
    close, daily_return, daily_change.
    """
    prev, rows = previous_close_year_split(bars)
    change = F.col("close") - prev
    return rows.select("ticker", "date", "close", pct_change(F.col("close"), prev).alias("daily_return"), change.alias("daily_change"))


def by_year(df: DataFrame) -> DataFrame:
    """``df`` with its calendar year, ``_y``, dealt by (ticker, year).  Windows and
    group-bys on that key, and joins with its results, move no row again; what is
    derived twice from these rows reuses the one exchange."""
    return df.withColumn("_y", F.year("date")).repartition("ticker", "_y")


def with_year_rows(rows: DataFrame, years: DataFrame) -> DataFrame:
    """``rows`` with the columns of their (ticker, year) in ``years``: equality on the
    key that the rows are dealt by."""
    years = years.withColumnsRenamed({"ticker": "_ct", "_y": "_cy"})
    return rows.join(years, (F.col("ticker") == F.col("_ct")) & (F.col("_y") == F.col("_cy")), "left").drop("_ct", "_cy")


def previous_close_year_split(bars: DataFrame) -> tuple[Column, DataFrame]:
    """The expression of the previous close, and the rows (ticker, date, close, _y) to
    use it on: a lag within (ticker, year), and on a year's first bar the last close
    of the ticker's year before."""
    df = by_year(with_key(bars).select("ticker", "date", "close"))
    in_year = Window.partitionBy("ticker", "_y").orderBy("date")
    rows = df.select("*", F.lag("close", 1).over(in_year).alias("_prev"), F.lag("date", 1).over(in_year).isNull().alias("_first"))
    last = df.groupBy("ticker", "_y").agg(F.max_by("close", "date").alias("_last"))
    carry = last.select("ticker", "_y", F.lag("_last", 1).over(Window.partitionBy("ticker").orderBy("_y")).alias("_carry"))
    return F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_prev")), with_year_rows(rows, carry)


def with_monthly_change(df: DataFrame) -> DataFrame:
    """Add ``monthly_change``: close minus the close of the previous row in
    month-number order.

    Rows are ordered by (month number, date), so within a month it compares
    neighbouring days, and the first row of a month of one year follows the
    last row of the same month of the year before; the first January row
    of the series follows nothing.  The date tie-break makes the order total.
    """
    w = Window.partitionBy("ticker").orderBy(F.month("date"), "date")
    return df.withColumn("monthly_change", F.col("close") - F.lag("close", 1).over(w))


def monthly_price_change(bars: DataFrame) -> DataFrame:
    """ticker, date, close, monthly_change."""
    return with_monthly_change(bars).select("ticker", "date", "close", "monthly_change")


def calendar_month_change(bars: DataFrame) -> DataFrame:
    """Change between calendar months: last close of each month with bars
    minus the last close of the month before it.  The month-number-ordered
    change above is the analysis's own definition; this is the calendar one.
    Columns: ticker, month (first day), last_close, monthly_change.
    """
    last = (
        bars.filter(F.col("close").isNotNull())
        .groupBy("ticker", F.trunc("date", "month").alias("month"))
        .agg(F.max_by("close", "date").alias("last_close"))
    )
    w = Window.partitionBy("ticker").orderBy("month")
    return last.withColumn("monthly_change", F.col("last_close") - F.lag("last_close", 1).over(w))


def intraday_returns(bars: DataFrame) -> DataFrame:
    """ticker, date, return_rate = (close - open) / open."""
    return bars.select("ticker", "date", intraday_return().alias("return_rate"))
