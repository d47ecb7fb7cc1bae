"""Column expressions shared by the operators.  All are built-in Catalyst
expressions, so they compile into whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def series() -> WindowSpec:
    """One ticker's history in date order.  A hash exchange on ``ticker`` feeds it."""
    return Window.partitionBy("ticker").orderBy("date")


def whole_series() -> WindowSpec:
    """All rows of one ticker, unordered (for per-ticker stats kept on each row)."""
    return Window.partitionBy("ticker")


def ratio(num: Column, den: Column) -> Column:
    """``num / den``; NULL (not an ANSI error) when ``den`` is 0 or NULL."""
    return F.try_divide(num, den)


def pct_change(cur: Column, before: Column) -> Column:
    return ratio(cur - before, before)


def intraday_return() -> Column:
    """(close - open) / open."""
    return ratio(F.col("close") - F.col("open"), F.col("open"))


def day_sign() -> Column:
    """+1 up day, -1 down day, 0 otherwise; measured open-to-close."""
    return (
        F.when(F.col("close") > F.col("open"), F.lit(1))
        .when(F.col("close") < F.col("open"), F.lit(-1))
        .otherwise(F.lit(0))
    )


# Meteorological seasons of the seasonal analysis, in display order.
SEASONS = (
    ("Winter", (12, 1, 2)),
    ("Spring", (3, 4, 5)),
    ("Summer", (6, 7, 8)),
    ("Autumn", (9, 10, 11)),
)


def season(date: str | Column = "date") -> Column:
    m = F.month(c(date))
    expr = None
    for name, months in SEASONS:
        expr = F.when(m.isin(*months), F.lit(name)) if expr is None else expr.when(m.isin(*months), F.lit(name))
    return expr


def weekday_name(date: str | Column = "date") -> Column:
    return F.date_format(c(date), "EEEE")


def masked_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over rows where both are present.

    ``F.corr`` raises DIVIDE_BY_ZERO under ANSI on a constant column; here the
    pair moments are taken on masked inputs and the quotient is a
    ``try_divide``, so a constant or a single pair gives NULL.
    """
    xv, yv = c(x), c(y)
    xm = F.when(yv.isNotNull(), xv)
    ym = F.when(xv.isNotNull(), yv)
    return F.try_divide(F.covar_pop(xm, ym), F.stddev_pop(xm) * F.stddev_pop(ym))


def round6(col: str | Column) -> Column:
    """Round half away from zero at 6 decimals: ``round(x * 1e6) / 1e6``.

    Spelled as arithmetic so any engine that rounds the scaled double the same
    way returns the same bits.
    """
    return F.round(c(col) * F.lit(1e6)) / F.lit(1e6)


def later_first(date: str | Column = "date") -> Column:
    """Order key that prefers the earlier date under ``max``."""
    return -F.unix_date(c(date))
