"""Every page of the dashboard the analyses come from, for one bars table.

``pages(bars, ...)`` returns the results each page shows, as lazy
DataFrames keyed ``"<page>/<result>"``; nothing runs until the caller acts
on one (``show``, ``write``, ...).  The page parameters (row count, moving
average window, selected month and year, date range, compared feature,
histogram bins, selected tickers) are arguments, as the page widgets were.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from barlab.operators import correlation, patterns, periods, profile, ranking, returns, risk, smoothing
from barlab.sources.table import save_bars_table


def pages(
    bars: DataFrame,
    *,
    rows: int = 10,
    window: int = 20,
    start,
    end,
    month: int,
    year: int,
    feature: str = "close",
    bins: int = 50,
    tickers: Iterable[str] | None = None,
    volume_period: str = "day",
    table: str | None = None,
) -> dict[str, DataFrame]:
    """All page results for ``bars``.  ``tickers`` is the selection of the
    cross-ticker correlation page (all tickers when None; a list needs two at
    least); every other page covers all tickers at once.  Nothing is run here, unless
    ``table`` names a table to keep the bars in: then they are written once
    (:func:`barlab.sources.table.save_bars_table`), and every page reads that table, without
    going back to what the bars were made from."""
    if table is not None:
        bars = save_bars_table(bars, table)
    out: dict[str, DataFrame] = {
        "data_exploration/first_rows": profile.first_rows(bars, rows),
        "data_exploration/last_rows": profile.last_rows(bars, rows),
        "descriptive_statistics/describe": profile.describe_stats(bars),
        "descriptive_statistics/coverage": profile.bar_coverage(bars),
        "descriptive_statistics/feature_correlation": correlation.feature_correlation(bars),
        "data_preparation/daily_returns": returns.daily_returns(bars),
        "data_preparation/monthly_price_change": returns.monthly_price_change(bars),
        "data_preparation/highest_daily_return": ranking.highest_daily_return(bars),
        "data_preparation/highest_daily_return_overall": ranking.highest_daily_return_overall(bars),
        "data_preparation/overall_average_return": periods.overall_average_return(bars),
        "moving_averages/sma": smoothing.sma(bars, window),
        "moving_averages/ema_one_step": smoothing.ema_one_step(bars, window),
        "moving_averages/ema_recursive": smoothing.ema_recursive(bars, window),
        "ticker_correlation/aligned": correlation.aligned_closes(bars, tickers, feature),
        "ticker_correlation/matrix": correlation.ticker_correlation(bars, tickers, feature),
        "return_rates/overall": periods.overall_return_rate(bars),
        "return_rates/best_day_of_month": ranking.best_intraday(bars, month=month),
        "return_rates/best_day_of_year": ranking.best_intraday(bars, year=year),
        "consistent_returns/std_dev": risk.return_consistency(bars, start, end),
        "consistent_returns/top3": risk.most_consistent(bars, start, end, 3),
        "consistent_returns/histogram": risk.return_histogram(bars, start, end, bins),
        "trading_volume/average": periods.average_volume(bars, volume_period),
        "trading_volume/highest": periods.highest_volume(bars, volume_period),
        "close_extremes/extremes": ranking.close_extremes(bars),
        "up_down_days/counts": patterns.trend_days(bars),
        "weekday_returns/by_day": patterns.weekday_returns(bars),
        "weekday_returns/best_day": patterns.best_weekday(bars),
        "seasonal_performance/average_close": patterns.seasonal_close(bars, start, end),
        "outliers/summary": risk.outlier_summary(bars),
        "outliers/days": risk.outlier_days(bars),
        "momentum/longest_streaks": patterns.longest_streaks(bars),
        "momentum/runs": patterns.streak_runs(bars),
    }
    for period in ("week", "month", "year"):
        out[f"data_preparation/{period}ly_averages"] = periods.period_averages(bars, period)
        out[f"return_rates/{period}ly"] = periods.return_rates(bars, period)
    return out
