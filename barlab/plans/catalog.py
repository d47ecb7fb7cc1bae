"""Registered queries: each reads the test tables of an ``sf_dir``, builds
bars from them (``bars_from_orders`` by order priority; the ``_events``
keys with ``bars_from_events``; the ``_by_customer`` keys from ``orders``
with one series per customer) and runs one operator over the whole table.

Parameters are fixed so the DuckDB oracle (``barlab.plans.oracle``) can state
the same query: date range 1996-01-01..1998-12-31 (closed, or half-open for
the loader), n = 20 for moving averages, 10 rows for first/last rows,
month = 1, year = 1997, feature = close, 50 bins, all tickers.

Every double column is rounded half away from zero at 6 decimals on the way
out (``round6``); the oracle rounds the same way.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from barlab.functions.columns import round6
from barlab.operators import correlation, patterns, periods, profile, ranking, returns, risk, smoothing, zoned
from barlab.schema import PRICE_COLUMNS
from barlab.sources.bars import bars_from_events, bars_from_orders, bars_from_ticks, filter_bars, load_bars, union_bars
from barlab.sources.table import save_bars_table
from barlab.sources.zones import Zones, save_zones

START = _dt.date(1996, 1, 1)
END = _dt.date(1998, 12, 31)
N_AVG = 20
N_ROWS = 10
MONTH = 1
YEAR = 1997
FEATURE = "close"
BINS = 50
EVENTS_START = _dt.date(2024, 1, 5)
EVENTS_END = _dt.date(2024, 1, 25)

Query = Callable[[SparkSession, str], DataFrame]


def finish(df: DataFrame) -> DataFrame:
    """Round every double column at 6 decimals, keeping names and order."""
    return df.select(
        *[round6(f.name).alias(f.name) if isinstance(f.dataType, DoubleType) else f.name for f in df.schema.fields]
    )


# One bar per order: its key is unique, so the loader's check holds.
BY_ORDER = {"ticker": "o_orderkey", "date": "o_orderdate"} | {c: "o_totalprice" for c in PRICE_COLUMNS}
# Orders of one priority share days, so their keys repeat.
BY_PRIORITY = BY_ORDER | {"ticker": "o_orderpriority"}


def load_orders(spark: SparkSession, sf_dir: str, columns: dict[str, str] = BY_ORDER, **options) -> DataFrame:
    """``load_bars`` on the orders file, its columns mapped to bar columns."""
    return load_bars(spark, f"{sf_dir}/orders.parquet", columns=columns, **options)


def event_series(spark: SparkSession, sf_dir: str, ticker: Column) -> DataFrame:
    """Bars from the events, with the series told by an expression."""
    return bars_from_ticks(spark.read.parquet(f"{sf_dir}/events.parquet"), ticker, "ts", "value", "event_id")


def _q(op: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(op(bars_from_orders(spark, sf_dir)))

    run.__doc__ = op.__doc__
    return run


def updated_state(bars: DataFrame, period: str) -> periods.PeriodState:
    """The period state of the bars before START, updated twice (END's year by itself,
    and all later bars; the first update runs twice, as after a retry)."""
    cut = _dt.date(END.year, 1, 1)
    state = periods.period_state(bars.where(F.col("date") < F.lit(START)), period)
    days = bars.where((F.col("date") >= F.lit(START)) & (F.col("date") < F.lit(cut)))
    return periods.advance(periods.advance(periods.advance(state, days), days), bars.where(F.col("date") >= F.lit(cut)))


QUERIES: dict[str, Query] = {
    # sources (S1, S10)
    "bars": _q(lambda b: b),
    "load_bars_range": _q(lambda b: filter_bars(b, start=START, end=END)),
    "load_bars_mapped": lambda spark, d: finish(load_orders(spark, d)),
    "load_bars_tickers": lambda spark, d: finish(
        load_orders(spark, d, columns=BY_PRIORITY, tickers=["1-URGENT", "5-LOW"], start=START, end=END, duplicates="greatest")
    ),
    "union_bars": lambda spark, d: finish(
        union_bars(load_orders(spark, d, start=START, end=END), bars_from_orders(spark, d), bars_from_events(spark, d))
    ),
    # profile (C1, C2)
    "first_rows": _q(lambda b: profile.first_rows(b, N_ROWS)),
    "last_rows": _q(lambda b: profile.last_rows(b, N_ROWS)),
    "describe_stats": _q(profile.describe_stats),
    "describe_stats_selected": _q(profile.describe_stats_selected),
    "describe_strings": _q(profile.describe_strings),
    "bar_coverage": _q(profile.bar_coverage),
    # correlations (C3, J1, C10)
    "feature_correlation": _q(correlation.feature_correlation),
    "aligned_closes": _q(lambda b: correlation.aligned_closes(b, None, FEATURE)),
    "aligned_closes_bitmap": _q(lambda b: correlation.aligned_closes_bitmap(b, None, FEATURE)),
    "aligned_wide": _q(lambda b: correlation.aligned_wide(b, ["1-URGENT", "5-LOW"], FEATURE)),
    "ticker_correlation": _q(lambda b: correlation.ticker_correlation(b, None, FEATURE)),
    "ticker_correlation_open": _q(lambda b: correlation.ticker_correlation(b, ["1-URGENT", "5-LOW"], "open")),
    "ticker_correlation_volume": _q(lambda b: correlation.ticker_correlation(b, ["1-URGENT", "5-LOW"], "volume")),
    "ticker_correlation_12_series": lambda spark, d: finish(correlation.ticker_correlation(event_series(spark, d, F.col("user_id") % 12))),
    "ticker_correlation_no_shared_date": lambda spark, d: finish(correlation.ticker_correlation(event_series(spark, d, F.dayofmonth("ts") % 9))),
    # returns (C4)
    "daily_returns": _q(returns.daily_returns),
    "daily_returns_year_split": _q(returns.daily_returns_year_split),
    "monthly_price_change": _q(returns.monthly_price_change),
    "calendar_month_change": _q(returns.calendar_month_change),
    "intraday_returns": _q(returns.intraday_returns),
    # period averages (C5, C7)
    "weekly_averages": _q(lambda b: periods.period_averages(b, "week")),
    "weekly_averages_updated": _q(lambda b: periods.averages_of(updated_state(b, "week"))),
    "return_rate_monthly_updated": _q(lambda b: periods.return_rates_of(updated_state(b, "month"))),
    "monthly_averages": _q(lambda b: periods.period_averages(b, "month")),
    "yearly_averages": _q(lambda b: periods.period_averages(b, "year")),
    "overall_average_return": _q(periods.overall_average_return),
    "monthly_averages_calendar": _q(lambda b: periods.period_averages(b, "month", calendar=True)),
    # return rates (C11)
    "return_rate_weekly": _q(lambda b: periods.return_rates(b, "week")),
    "return_rate_monthly": _q(lambda b: periods.return_rates(b, "month")),
    "return_rate_yearly": _q(lambda b: periods.return_rates(b, "year")),
    "overall_return_rate": _q(periods.overall_return_rate),
    # top-1 (C6, C12, C16)
    "highest_daily_return": _q(ranking.highest_daily_return),
    "highest_daily_return_overall": _q(ranking.highest_daily_return_overall),
    "best_intraday_month": _q(lambda b: ranking.best_intraday(b, month=MONTH)),
    "best_intraday_year": _q(lambda b: ranking.best_intraday(b, year=YEAR)),
    "close_extremes": _q(ranking.close_extremes),
    # moving averages (C8)
    "sma": _q(lambda b: smoothing.sma(b, N_AVG)),
    "sma_full_window": _q(lambda b: smoothing.sma(b, N_AVG, min_periods=N_AVG)),
    "ema_one_step": _q(lambda b: smoothing.ema_one_step(b, N_AVG)),
    "ema_recursive": _q(lambda b: smoothing.ema_recursive(b, N_AVG)),
    # The same averages with each series split by (ticker, year).
    "sma_year_split": _q(lambda b: smoothing.sma(b, N_AVG, year_split=True)),
    "sma_full_window_year_split": _q(lambda b: smoothing.sma(b, N_AVG, min_periods=N_AVG, year_split=True)),
    "ema_one_step_year_split": _q(lambda b: smoothing.ema_one_step(b, N_AVG, year_split=True)),
    "ema_recursive_year_split": _q(lambda b: smoothing.ema_recursive(b, N_AVG, year_split=True)),
    # dispersion (C9, C13, C14)
    "return_histogram": _q(lambda b: risk.return_histogram(b, START, END, BINS)),
    "return_consistency": _q(lambda b: risk.return_consistency(b, START, END)),
    "most_consistent_top3": _q(lambda b: risk.most_consistent(b, START, END, 3)),
    "outlier_summary": _q(risk.outlier_summary),
    "outlier_days": _q(risk.outlier_days),
    "outlier_summary_year_split": _q(lambda b: risk.outlier_summary(b, year_split=True)),
    "outlier_days_year_split": _q(lambda b: risk.outlier_days(b, year_split=True)),
    # volumes (C15)
    "avg_volume_daily": _q(lambda b: periods.average_volume(b, "day")),
    "avg_volume_weekly": _q(lambda b: periods.average_volume(b, "week")),
    "avg_volume_monthly": _q(lambda b: periods.average_volume(b, "month")),
    "avg_volume_yearly": _q(lambda b: periods.average_volume(b, "year")),
    "highest_volume": _q(lambda b: periods.highest_volume(b, "day")),
    "highest_volume_weekly": _q(lambda b: periods.highest_volume(b, "week")),
    "highest_volume_monthly": _q(lambda b: periods.highest_volume(b, "month")),
    "highest_volume_yearly": _q(lambda b: periods.highest_volume(b, "year")),
    # day classes and calendar profiles (C17-C20)
    "trend_days": _q(patterns.trend_days),
    "weekday_returns": _q(patterns.weekday_returns),
    "weekday_returns_weekdays_only": _q(lambda b: patterns.weekday_returns(b, weekdays_only=True)),
    "best_weekday": _q(patterns.best_weekday),
    "seasonal_close": _q(lambda b: patterns.seasonal_close(b, START, END)),
    "streak_runs": _q(patterns.streak_runs),
    "longest_streaks": _q(patterns.longest_streaks),
    "longest_streaks_joined": _q(lambda b: patterns.longest_streaks(b, join_first_row=True)),
    # The same streaks with each series split by (ticker, year).
    "streak_runs_year_split": _q(lambda b: patterns.streak_runs(b, year_split=True)),
    "longest_streaks_year_split": _q(lambda b: patterns.longest_streaks(b, year_split=True)),
    # And from mergeable summaries of months, without a window.
    "longest_streaks_merged": _q(patterns.longest_streaks_merged),
    "longest_streaks_joined_merged": _q(lambda b: patterns.longest_streaks_merged(b, join_first_row=True)),
}


def _q_events(op: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(op(bars_from_events(spark, sf_dir)))

    run.__doc__ = op.__doc__
    return run


# The same operators on the second fixture: bars from the events table
# (five event types over 30 days, every day shared by all of them).
EVENT_QUERIES: dict[str, Query] = {
    "bars_events": _q_events(lambda b: b),
    "daily_returns_events": _q_events(returns.daily_returns),
    "daily_returns_year_split_events": _q_events(returns.daily_returns_year_split),
    "describe_stats_events": _q_events(profile.describe_stats),
    "describe_stats_selected_events": _q_events(profile.describe_stats_selected),
    "aligned_closes_bitmap_events": _q_events(lambda b: correlation.aligned_closes_bitmap(b, None, FEATURE)),
    "aligned_closes_events": _q_events(lambda b: correlation.aligned_closes(b, None, FEATURE)),
    "ticker_correlation_events": _q_events(lambda b: correlation.ticker_correlation(b, None, FEATURE)),
    "weekly_averages_events": _q_events(lambda b: periods.period_averages(b, "week")),
    "sma_events": _q_events(lambda b: smoothing.sma(b, N_AVG)),
    "ema_recursive_events": _q_events(lambda b: smoothing.ema_recursive(b, N_AVG)),
    "outlier_summary_events": _q_events(risk.outlier_summary),
    "trend_days_events": _q_events(patterns.trend_days),
    "longest_streaks_merged_events": _q_events(patterns.longest_streaks_merged),
    "longest_streaks_events": _q_events(patterns.longest_streaks),
    "close_extremes_events": _q_events(ranking.close_extremes),
    "first_rows_events": _q_events(lambda b: profile.first_rows(b, N_ROWS)),
    "feature_correlation_events": _q_events(correlation.feature_correlation),
    "monthly_price_change_events": _q_events(returns.monthly_price_change),
    "highest_daily_return_events": _q_events(ranking.highest_daily_return),
    "best_intraday_month_events": _q_events(lambda b: ranking.best_intraday(b, month=MONTH)),
    "best_weekday_events": _q_events(patterns.best_weekday),
    "streak_runs_events": _q_events(patterns.streak_runs),
    # The events span January 2024, so the range analyses use that month.
    "return_histogram_events": _q_events(lambda b: risk.return_histogram(b, EVENTS_START, EVENTS_END, BINS)),
    "return_consistency_events": _q_events(lambda b: risk.return_consistency(b, EVENTS_START, EVENTS_END)),
    "seasonal_close_events": _q_events(lambda b: patterns.seasonal_close(b, EVENTS_START, EVENTS_END)),
}
QUERIES.update(EVENT_QUERIES)


def _q_customers(op: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(op(bars_from_orders(spark, sf_dir, ticker="o_custkey")))

    run.__doc__ = op.__doc__
    return run


# Many tickers with short histories: one series per customer of ``orders``
# (about 1,000 at sf0.01, 10,000 at sf0.1).  Same plans, same job counts.
CUSTOMER_QUERIES: dict[str, Query] = {
    "bars_by_customer": _q_customers(lambda b: b),
    "daily_returns_by_customer": _q_customers(returns.daily_returns),
    "daily_returns_year_split_by_customer": _q_customers(returns.daily_returns_year_split),
    "weekly_averages_updated_by_customer": _q_customers(lambda b: periods.averages_of(updated_state(b, "week"))),
    "weekly_averages_by_customer": _q_customers(lambda b: periods.period_averages(b, "week")),
    "highest_daily_return_by_customer": _q_customers(ranking.highest_daily_return),
    "close_extremes_by_customer": _q_customers(ranking.close_extremes),
    "ema_recursive_by_customer": _q_customers(lambda b: smoothing.ema_recursive(b, N_AVG)),
    "sma_year_split_by_customer": _q_customers(lambda b: smoothing.sma(b, N_AVG, year_split=True)),
    "ema_recursive_year_split_by_customer": _q_customers(lambda b: smoothing.ema_recursive(b, N_AVG, year_split=True)),
    "return_histogram_by_customer": _q_customers(lambda b: risk.return_histogram(b, START, END, BINS)),
    "return_consistency_by_customer": _q_customers(lambda b: risk.return_consistency(b, START, END)),
    "outlier_summary_by_customer": _q_customers(risk.outlier_summary),
    "outlier_summary_year_split_by_customer": _q_customers(lambda b: risk.outlier_summary(b, year_split=True)),
    "trend_days_by_customer": _q_customers(patterns.trend_days),
    "best_weekday_by_customer": _q_customers(patterns.best_weekday),
    "longest_streaks_by_customer": _q_customers(patterns.longest_streaks),
    "longest_streaks_merged_by_customer": _q_customers(patterns.longest_streaks_merged),
    "longest_streaks_year_split_by_customer": _q_customers(lambda b: patterns.longest_streaks(b, year_split=True)),
}
QUERIES.update(CUSTOMER_QUERIES)

def _q_table(op: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = save_bars_table(bars_from_orders(spark, sf_dir, ticker="o_custkey"), "bars_by_customer", buckets=16)
        return finish(op(table))

    run.__doc__ = op.__doc__
    return run


# Analyses on the bars table, bucketed and sorted by ticker, written first.
TABLE_QUERIES: dict[str, Query] = {
    "bars_table": _q_table(lambda b: b),
    "daily_returns_table": _q_table(returns.daily_returns),
    "outlier_summary_table": _q_table(risk.outlier_summary),
    "longest_streaks_table": _q_table(patterns.longest_streaks),
    "ema_recursive_table": _q_table(lambda b: smoothing.ema_recursive(b, N_AVG)),
    "close_extremes_table": _q_table(ranking.close_extremes),
}
QUERIES.update(TABLE_QUERIES)


def _q_zones(op: Callable[[Zones], DataFrame], ticker: str = "o_orderpriority") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(op(save_zones(bars_from_orders(spark, sf_dir, ticker=ticker), parts=8)))

    run.__doc__ = op.__doc__
    return run


# Searches for single days on returns kept with zone statistics, written first.
ZONE_QUERIES: dict[str, Query] = {
    "outlier_days_zoned": _q_zones(zoned.outlier_days_zoned),
    "highest_daily_return_zoned": _q_zones(zoned.highest_daily_return_zoned),
    "highest_daily_return_zoned_by_customer": _q_zones(zoned.highest_daily_return_zoned, "o_custkey"),
    "best_intraday_year_zoned": _q_zones(lambda z: zoned.best_intraday_zoned(z, YEAR)),
}
QUERIES.update(ZONE_QUERIES)

# The flagship query: which series has the steadiest daily returns.
FLAGSHIP = "most_consistent_top3"
