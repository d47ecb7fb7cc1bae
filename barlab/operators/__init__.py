"""The analyses, one module per family; each function maps bars to a DataFrame."""

from barlab.operators.correlation import (
    aligned_closes,
    aligned_closes_bitmap,
    aligned_wide,
    feature_correlation,
    ticker_correlation,
)
from barlab.operators.patterns import (
    best_weekday,
    longest_streaks,
    longest_streaks_merged,
    seasonal_close,
    streak_runs,
    trend_days,
    weekday_returns,
)
from barlab.operators.periods import (
    average_volume,
    highest_volume,
    overall_average_return,
    overall_return_rate,
    PeriodState,
    advance,
    averages_of,
    period_averages,
    period_state,
    return_rates_of,
    return_rates,
)
from barlab.operators.profile import bar_coverage, describe_stats, describe_stats_selected, describe_strings, first_rows, last_rows
from barlab.operators.ranking import best_intraday, close_extremes, highest_daily_return, highest_daily_return_overall
from barlab.operators.returns import calendar_month_change, daily_returns, daily_returns_year_split, intraday_returns, monthly_price_change, with_monthly_change, with_returns
from barlab.operators.risk import (
    flag_outliers,
    most_consistent,
    outlier_days,
    outlier_summary,
    return_consistency,
    return_histogram,
)
from barlab.operators.smoothing import ema_one_step, ema_recursive, sma
from barlab.operators.zoned import best_intraday_zoned, highest_daily_return_zoned, outlier_days_zoned

__all__ = [
    "best_intraday_zoned",
    "highest_daily_return_zoned",
    "outlier_days_zoned",
    "aligned_closes",
    "aligned_closes_bitmap",
    "aligned_wide",
    "average_volume",
    "bar_coverage",
    "best_intraday",
    "best_weekday",
    "calendar_month_change",
    "close_extremes",
    "daily_returns",
    "daily_returns_year_split",
    "describe_stats",
    "describe_stats_selected",
    "describe_strings",
    "ema_one_step",
    "ema_recursive",
    "feature_correlation",
    "first_rows",
    "flag_outliers",
    "highest_daily_return",
    "highest_daily_return_overall",
    "highest_volume",
    "intraday_returns",
    "last_rows",
    "longest_streaks",
    "longest_streaks_merged",
    "monthly_price_change",
    "most_consistent",
    "outlier_days",
    "outlier_summary",
    "overall_average_return",
    "overall_return_rate",
    "PeriodState",
    "advance",
    "averages_of",
    "period_averages",
    "period_state",
    "return_rates_of",
    "return_consistency",
    "return_histogram",
    "return_rates",
    "seasonal_close",
    "sma",
    "streak_runs",
    "ticker_correlation",
    "trend_days",
    "weekday_returns",
    "with_monthly_change",
    "with_returns",
]
