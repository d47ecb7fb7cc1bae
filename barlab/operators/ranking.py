"""Top-1 and extreme-value analyses.

Per ticker, a top-1 is an aggregate (``max_by``/``min_by`` over a struct
ordering key that makes the winner unique), so it runs as partial + final
aggregation.  A struct key makes Spark pick a sort-based aggregate: after
the series window the data is already sorted by ticker, elsewhere only
bars-sized data is sorted.  Over all tickers, ``orderBy(...).limit(k)``
plans as TakeOrderedAndProject: a top-k per partition, then a merge of
k rows per partition.

Ties are broken so results are deterministic, which also makes task retries
return the same rows: the earlier date wins, then the smaller ticker.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.functions.columns import intraday_return, later_first
from barlab.operators.returns import with_returns


def highest_daily_return(bars: DataFrame) -> DataFrame:
    """Per ticker, the day with the largest daily return (earliest on ties;
    a ticker whose returns are all NULL reports its first day).
    Columns: ticker, date, daily_return.
    """
    r = F.col("daily_return")
    order = F.struct(r.isNotNull(), F.coalesce(r, F.lit(0.0)), later_first())
    best = F.max_by(F.struct("date", "daily_return"), order)
    return (
        with_returns(bars)
        .groupBy("ticker")
        .agg(best.alias("_b"))
        .select("ticker", F.col("_b.date").alias("date"), F.col("_b.daily_return").alias("daily_return"))
    )


def highest_daily_return_overall(bars: DataFrame) -> DataFrame:
    """The single (ticker, day) with the largest daily return over all tickers."""
    return (
        highest_daily_return(bars)
        .orderBy(F.desc_nulls_last("daily_return"), F.asc("date"), F.asc("ticker"))
        .limit(1)
    )


def best_intraday(bars: DataFrame, month: int | None = None, year: int | None = None) -> DataFrame:
    """The one bar with the largest intraday return, among bars of a month
    number (all years pooled) and/or a calendar year.  This is the best
    *day*, not the best period.  Columns: date, ticker, return_rate.
    """
    df = bars
    if year is not None:
        # A range on the date itself, so the predicate can reach the scan.
        df = df.filter(F.col("date").between(F.lit(_dt.date(year, 1, 1)), F.lit(_dt.date(year, 12, 31))))
    if month is not None:
        df = df.filter(F.month("date") == F.lit(month))
    return (
        df.select("date", "ticker", intraday_return().alias("return_rate"))
        .orderBy(F.desc_nulls_last("return_rate"), F.asc("date"), F.asc("ticker"))
        .limit(1)
    )


def close_extremes(bars: DataFrame) -> DataFrame:
    """Highest and lowest close per ticker with their (earliest) dates.
    NULL closes are skipped.  Columns: ticker, max_close, max_close_date,
    min_close, min_close_date.
    """
    has = F.col("close").isNotNull()
    return bars.groupBy("ticker").agg(
        F.max("close").alias("max_close"),
        F.max_by("date", F.when(has, F.struct("close", later_first()))).alias("max_close_date"),
        F.min("close").alias("min_close"),
        F.min_by("date", F.when(has, F.struct("close", F.unix_date("date")))).alias("min_close_date"),
    )
