"""Period group-bys: averages, "return rates", overall means, volumes.

Periods are pooled across years by default: week 1 of every year forms one
group (ISO week numbers), as do all Januaries.  ``calendar=True`` groups by
the period's start date instead.

Every group-by is keyed on ``ticker`` first.  When the input comes out of a
ticker-partitioned window, Spark reuses that partitioning and plans no new
exchange; otherwise a partial aggregate runs before the shuffle, so the
shuffle carries one row per (task, group), never raw rows of a hot group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.functions.columns import pct_change, series
from barlab.operators.returns import with_key, with_monthly_change, with_returns

_POOLED = {"week": F.weekofyear, "month": F.month, "year": F.year}
_CALENDAR = {"week": "week", "month": "month", "year": "year"}


def period_key(period: str, calendar: bool = False) -> Column:
    if period not in _POOLED:
        raise ValueError(f"period must be one of {sorted(_POOLED)}, got {period!r}")
    if calendar:
        return F.trunc("date", _CALENDAR[period])
    return _POOLED[period]("date")


def period_averages(bars: DataFrame, period: str, calendar: bool = False) -> DataFrame:
    """Average open, close and daily return per period, plus the average
    change: daily change for weeks, month-ordered change for months, none for
    years.  Columns: ticker, period, avg_open, avg_close, avg_return[, avg_change].
    """
    rets = with_returns(bars)
    aggs = [
        F.avg("open").alias("avg_open"),
        F.avg("close").alias("avg_close"),
        F.avg("daily_return").alias("avg_return"),
    ]
    if period == "week":
        aggs.append(F.avg("daily_change").alias("avg_change"))
    elif period == "month":
        rets = with_monthly_change(rets)
        aggs.append(F.avg("monthly_change").alias("avg_change"))
    return rets.groupBy("ticker", period_key(period, calendar).alias("period")).agg(*aggs)


def return_rates(bars: DataFrame, period: str, calendar: bool = False) -> DataFrame:
    """Average daily return per period, and ``return_rate`` = avg(close) -
    avg(open) over the period: a price difference, not a ratio, kept as the
    analysis defines it.  Columns: ticker, period, avg_return, return_rate.
    """
    return (
        with_returns(bars)
        .groupBy("ticker", period_key(period, calendar).alias("period"))
        .agg(
            F.avg("daily_return").alias("avg_return"),
            (F.avg("close") - F.avg("open")).alias("return_rate"),
        )
    )


def _mean_of_period_means(df: DataFrame, group_value: Column, calendar: bool) -> DataFrame:
    """For each ticker, the unweighted mean over weeks, months and years of a
    per-period value, in one pass: rows are tagged with all three period keys
    (a generator, no extra scan), aggregated per (ticker, kind, period), then
    per ticker.
    """
    kinds = [
        F.struct(F.lit(p).alias("kind"), period_key(p, calendar).cast("string").alias("period"))
        for p in ("week", "month", "year")
    ]
    tagged = df.select("*", F.explode(F.array(*kinds)).alias("_k")).select(
        "*", F.col("_k.kind").alias("_kind"), F.col("_k.period").alias("_period")
    )
    per_period = tagged.groupBy("ticker", "_kind", "_period").agg(group_value.alias("_v"))
    return per_period.groupBy("ticker").agg(
        *[F.avg(F.when(F.col("_kind") == p, F.col("_v"))).alias(f"avg_{p}ly") for p in ("week", "month", "year")]
    )


def overall_average_return(bars: DataFrame, calendar: bool = False) -> DataFrame:
    """Mean of the per-period average daily returns (mean of means, not of
    rows).  Columns: ticker, avg_weekly, avg_monthly, avg_yearly.
    """
    return _mean_of_period_means(with_returns(bars), F.avg("daily_return"), calendar)


def overall_return_rate(bars: DataFrame, calendar: bool = False) -> DataFrame:
    """Mean of the per-period ``return_rate`` (avg close - avg open).
    Columns: ticker, avg_weekly, avg_monthly, avg_yearly.
    """
    return _mean_of_period_means(bars, F.avg("close") - F.avg("open"), calendar)


def average_volume(bars: DataFrame, period: str = "day", calendar: bool = False) -> DataFrame:
    """Average volume per ticker: over days, or the mean of per-period means.
    Columns: ticker, avg_volume.
    """
    if period == "day":
        return bars.groupBy("ticker").agg(F.avg("volume").alias("avg_volume"))
    per = bars.groupBy("ticker", period_key(period, calendar).alias("_p")).agg(F.avg("volume").alias("_v"))
    return per.groupBy("ticker").agg(F.avg("_v").alias("avg_volume"))


def highest_volume(bars: DataFrame, period: str = "day", calendar: bool = False) -> DataFrame:
    """The ticker with the largest average volume (ties: smaller ticker)."""
    return (
        average_volume(bars, period, calendar)
        .orderBy(F.desc_nulls_last("avg_volume"), F.asc("ticker"))
        .limit(1)
    )


_KEPT = ["open", "close", "daily_return", "daily_change"]


@dataclass(frozen=True)
class PeriodState:
    """What is kept of all bars seen so far, to bring period averages up to date.

    ``sums``: ticker, period and a count and sum of each of open, close, daily_return and
    daily_change (one row per period).  ``last``: ticker, last_date, last_close (one
    row per ticker).  Both are plain tables to be written between updates.
    """

    sums: DataFrame
    last: DataFrame
    period: str
    calendar: bool = False


def _sums(rets: DataFrame, period: str, calendar: bool) -> DataFrame:
    each = [a for c in _KEPT for a in (F.count(c).alias(f"n_{c}"), F.sum(c).alias(f"sum_{c}"))]
    return rets.groupBy("ticker", period_key(period, calendar).alias("period")).agg(*each)


def period_state(bars: DataFrame, period: str, calendar: bool = False) -> PeriodState:
    """The state after ``bars``; rows without ticker or date are in no series."""
    bars = with_key(bars)
    last = bars.groupBy("ticker").agg(F.max("date").alias("last_date"), F.max_by("close", "date").alias("last_close"))
    return PeriodState(_sums(with_returns(bars), period, calendar), last, period, calendar)


def advance(state: PeriodState, bars: DataFrame) -> PeriodState:
    """``state`` brought up to date with new bars, reading nothing of the old ones.

    A ticker's bars count if they are later than the last one seen, so an update that
    runs twice changes nothing; older bars that come late need a new state.  The first new
    return of a ticker is taken from its last close.
    """
    late = F.col("last_date").isNull() | (F.col("date") > F.col("last_date"))
    new = with_key(bars).join(state.last, "ticker", "left").where(late)
    rets = with_returns(new)
    first = F.col("last_date").isNotNull() & (F.row_number().over(series()) == 1)
    rets = rets.withColumn("prev_close", F.when(first, F.col("last_close")).otherwise(F.col("prev_close")))
    rets = rets.withColumns({"daily_return": pct_change(F.col("close"), F.col("prev_close")), "daily_change": F.col("close") - F.col("prev_close")})
    both = state.sums.unionByName(_sums(rets, state.period, state.calendar))
    totals = [F.sum(c).alias(c) for c in state.sums.columns if c not in ("ticker", "period")]
    seen = new.select("ticker", F.col("date").alias("last_date"), F.col("close").alias("last_close"))
    last = state.last.unionByName(seen).groupBy("ticker").agg(F.max_by("last_close", "last_date").alias("last_close"), F.max("last_date").alias("last_date"))
    return PeriodState(both.groupBy("ticker", "period").agg(*totals), last.select(*state.last.columns), state.period, state.calendar)


def _mean(column: str) -> Column:
    return F.try_divide(F.col(f"sum_{column}"), F.col(f"n_{column}"))


def averages_of(state: PeriodState) -> DataFrame:
    """``period_averages`` of all bars seen, for weeks and years (the month-ordered change of
    a month's bars depends on later years, so months have no mergeable form)."""
    if state.period == "month":
        raise ValueError("the month-ordered change cannot be brought up to date; use return_rates_of")
    change = [_mean("daily_change").alias("avg_change")] if state.period == "week" else []
    return state.sums.select("ticker", "period", _mean("open").alias("avg_open"), _mean("close").alias("avg_close"), _mean("daily_return").alias("avg_return"), *change)


def return_rates_of(state: PeriodState) -> DataFrame:
    """``return_rates`` of all bars seen."""
    return state.sums.select("ticker", "period", _mean("daily_return").alias("avg_return"), (_mean("close") - _mean("open")).alias("return_rate"))
