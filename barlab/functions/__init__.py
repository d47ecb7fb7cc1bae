"""Column-level building blocks (built-in Catalyst expressions only)."""

from barlab.functions.columns import (
    SEASONS,
    day_sign,
    intraday_return,
    later_first,
    masked_corr,
    pct_change,
    ratio,
    round6,
    season,
    series,
    weekday_name,
    whole_series,
)

__all__ = [
    "SEASONS",
    "day_sign",
    "intraday_return",
    "later_first",
    "masked_corr",
    "pct_change",
    "ratio",
    "round6",
    "season",
    "series",
    "weekday_name",
    "whole_series",
]
