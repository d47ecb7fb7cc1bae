"""Return dispersion: consistency ranking, histogram, 3-sigma outliers.

Order of steps matters and differs per analysis, as in the analyses these
reproduce:

* consistency and histogram keep the date range and drop bars without open
  or close *before* the lag, so the range's first day has no return and a
  gap is bridged;
* outliers use the full history and keep gaps (a missing close gives two
  NULL returns).

Per-ticker statistics stay on the rows through unordered windows on
``ticker``: they reuse the exchange of the lag window, so there is no join
and no second shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.functions.columns import pct_change, ratio, series, whole_series
from barlab.operators._tickers import of_universe
from barlab.operators.returns import by_year, with_key, with_returns, with_year_rows
from barlab.sources.bars import filter_bars


def return_consistency(
    bars: DataFrame, start=None, end=None, drop_missing_first: bool = True, universe: DataFrame | None = None
) -> DataFrame:
    """Sample standard deviation of daily returns per ticker, over bars in
    ``[start, end]`` (with open and close present, unless
    ``drop_missing_first=False``); +inf when there are fewer than two
    returns.  The range filter runs before the lag and reaches the scan.

    Tickers without a return in the range are absent, unless ``universe`` (a
    table with a ticker column) lists them: then they have +inf.  A ticker with
    one return has +inf.  Columns: ticker, std_dev.
    """
    stats = (
        _selected_returns(bars, start, end, drop_missing_first)
        .groupBy("ticker")
        .agg(F.stddev_samp("ret").alias("_sd"))
    )
    return of_universe(universe, stats).select("ticker", F.coalesce(F.col("_sd"), F.lit(float("inf"))).alias("std_dev"))


def most_consistent(
    bars: DataFrame, start=None, end=None, k: int = 3, drop_missing_first: bool = True, universe: DataFrame | None = None
) -> DataFrame:
    """The ``k`` tickers with the steadiest returns (smallest std_dev)."""
    return return_consistency(bars, start, end, drop_missing_first, universe).orderBy(F.asc("std_dev"), F.asc("ticker")).limit(k)


def _selected_returns(bars: DataFrame, start, end, drop_missing_first: bool) -> DataFrame:
    sel = filter_bars(bars, start=start, end=end, end_inclusive=True)
    if drop_missing_first:
        sel = sel.dropna(subset=["open", "close"])
    ret = pct_change(F.col("close"), F.lag("close", 1).over(series()))
    return sel.select("ticker", ret.alias("ret")).filter(F.col("ret").isNotNull())


def return_histogram(
    bars: DataFrame, start=None, end=None, bins: int = 50, drop_missing_first: bool = True
) -> DataFrame:
    """Equal-width histogram of daily returns per ticker, ``bins`` bins from
    the ticker's smallest to largest return, empty bins reported as 0.

    Bin ``i`` holds ``lo + i*w <= x < lo + (i+1)*w`` (the last bin also holds
    the maximum); a ticker whose returns are all equal has one full bin 0.
    Columns: ticker, bin, bin_low, bin_high, n.
    """
    if bins < 1:
        raise ValueError("bins must be >= 1")
    rets = _selected_returns(bars, start, end, drop_missing_first)
    w = whole_series()
    lo, hi = F.min("ret").over(w), F.max("ret").over(w)
    width = F.col("hi") - F.col("lo")
    idx = F.when(
        F.col("hi") > F.col("lo"),
        F.least(F.floor(ratio(F.col("ret") - F.col("lo"), width) * F.lit(bins)), F.lit(bins - 1)),
    ).otherwise(F.lit(0))
    binned = rets.select("ticker", "ret", lo.alias("lo"), hi.alias("hi")).select(
        "ticker", "lo", "hi", idx.cast("int").alias("bin")
    )
    counts = binned.groupBy("ticker", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi")
    )
    # At most ``bins`` entries per ticker: the empty bins are filled from a
    # small per-ticker map, in the same partitions (no join, no new exchange).
    per_ticker = counts.groupBy("ticker").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_counts"),
        F.first("lo").alias("lo"),
        F.first("hi").alias("hi"),
    )
    grid = per_ticker.select("ticker", "lo", "hi", "_counts", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    edge = lambda i: F.col("lo") + i * width / F.lit(bins)
    return grid.select(
        "ticker",
        "bin",
        edge(F.col("bin")).alias("bin_low"),
        edge(F.col("bin") + F.lit(1)).alias("bin_high"),
        F.coalesce(F.try_element_at("_counts", F.col("bin")), F.lit(0).cast("bigint")).alias("n"),
    )


def _returns_and_moments_year_split(bars: DataFrame) -> DataFrame:
    """ticker, date, daily_return, and the mean and sample deviation (_m, _s) of the
    ticker's returns.  One row per (ticker, year) has the moments of the returns
    inside the year, and its first and last close; over a ticker's years these give
    the return of each year's first bar and the moments of all, joined back once."""
    df = by_year(with_key(bars).select("ticker", "date", "close"))
    prev = F.lag("close", 1).over(Window.partitionBy("ticker", "_y").orderBy("date"))
    rows = df.withColumn("_r", pct_change(F.col("close"), prev))
    years = rows.groupBy("ticker", "_y").agg(
        F.count("_r").alias("_n"),
        F.avg("_r").alias("_my"),
        F.var_pop("_r").alias("_vy"),
        F.min("date").alias("_start"),
        F.min_by("close", "date").alias("_open"),
        F.max_by("close", "date").alias("_last"),
    )
    over_years, all_years = Window.partitionBy("ticker").orderBy("_y"), Window.partitionBy("ticker")
    years = years.withColumn("_r0", pct_change(F.col("_open"), F.lag("_last", 1).over(over_years)))
    n = F.sum(F.col("_n") + F.col("_r0").isNotNull().cast("int")).over(all_years)
    total = F.sum(F.coalesce(F.col("_n") * F.col("_my"), F.lit(0.0)) + F.coalesce("_r0", F.lit(0.0))).over(all_years)
    years = years.withColumns({"_all": n, "_m": ratio(total, n.cast("double"))})
    square = lambda x: (x - F.col("_m")) * (x - F.col("_m"))
    apart = F.coalesce(F.col("_n") * (F.col("_vy") + square(F.col("_my"))), F.lit(0.0)) + F.coalesce(square(F.col("_r0")), F.lit(0.0))
    spread = F.sqrt(ratio(F.sum(apart).over(all_years), (F.col("_all") - 1).cast("double")))
    stats = years.select("ticker", "_y", "_start", "_r0", "_m", spread.alias("_s"))
    ret = F.when(F.col("date") == F.col("_start"), F.col("_r0")).otherwise(F.col("_r"))
    return with_year_rows(rows, stats).select("ticker", "date", ret.alias("daily_return"), "_m", "_s")


def flag_outliers(
    bars: DataFrame, k: float = 3.0, drop_missing_first: bool = False, year_split: bool = False
) -> DataFrame:
    """Daily returns over full history, flagged when outside mean ± k·stddev
    of the ticker's returns.

    By default the ticker's mean and stddev are unordered windows over the
    series partition.  ``year_split`` (for series too long or tickers too
    hot for one task) makes one row per ticker and year, combines them over a
    ticker's years (a window over one row per year) and joins them back once on
    (ticker, year), where the rows already are.
    Columns: ticker, date, daily_return, is_outlier.
    """
    r = F.col("daily_return")
    if year_split:
        flagged = _returns_and_moments_year_split(bars.dropna(subset=["open", "close"]) if drop_missing_first else bars)
    else:
        w = whole_series()
        flagged = with_returns(bars, drop_missing_first).select(
            "ticker", "date", "daily_return", F.avg(r).over(w).alias("_m"), F.stddev_samp(r).over(w).alias("_s")
        )
    lim = F.lit(float(k)) * F.col("_s")
    is_out = (r > F.col("_m") + lim) | (r < F.col("_m") - lim)
    return flagged.select("ticker", "date", "daily_return", F.coalesce(is_out, F.lit(False)).alias("is_outlier"))


def outlier_summary(
    bars: DataFrame, k: float = 3.0, drop_missing_first: bool = False, year_split: bool = False
) -> DataFrame:
    """Number of outlier days per ticker (0 included).  Columns: ticker, n_outliers."""
    return (
        flag_outliers(bars, k, drop_missing_first, year_split)
        .groupBy("ticker")
        .agg(F.count_if("is_outlier").alias("n_outliers"))
    )


def outlier_days(
    bars: DataFrame, k: float = 3.0, drop_missing_first: bool = False, year_split: bool = False
) -> DataFrame:
    """The outlier days.  Columns: ticker, date, daily_return."""
    return flag_outliers(bars, k, drop_missing_first, year_split).filter("is_outlier").select(
        "ticker", "date", "daily_return"
    )


__all__ = [
    "flag_outliers",
    "most_consistent",
    "outlier_days",
    "outlier_summary",
    "return_consistency",
    "return_histogram",
]
