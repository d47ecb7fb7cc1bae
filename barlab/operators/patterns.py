"""Day classes and calendar profiles: up/down days, weekday returns, seasons,
gain/loss streaks.

Up/down days and streaks compare close with open of the same day
(open-to-close); weekday returns use close-to-close daily returns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.functions.columns import SEASONS, day_sign, season, series, weekday_name
from barlab.operators._tickers import of_universe
from barlab.operators.returns import by_year, with_key, with_returns, with_year_rows
from barlab.sources.bars import filter_bars


def trend_days(bars: DataFrame) -> DataFrame:
    """Counts of up (close > open), down (close < open) and neutral days,
    where neutral is every other bar, including ones with a missing price.
    Columns: ticker, upward_days, downward_days, neutral_days.
    """
    sign = day_sign()
    return bars.groupBy("ticker").agg(
        F.count_if(sign == 1).alias("upward_days"),
        F.count_if(sign == -1).alias("downward_days"),
        F.count_if(sign == 0).alias("neutral_days"),
    )


def _weekday_means(bars: DataFrame, weekdays_only: bool, drop_missing_first: bool) -> DataFrame:
    rets = with_returns(bars, drop_missing_first).filter(F.col("daily_return").isNotNull())
    if weekdays_only:
        rets = rets.filter(F.weekday("date") < 5)
    return rets.groupBy(
        "ticker", F.weekday("date").alias("_dow"), weekday_name("date").alias("day_of_week")
    ).agg(F.avg("daily_return").alias("avg_return"))


def weekday_returns(bars: DataFrame, weekdays_only: bool = False, drop_missing_first: bool = False) -> DataFrame:
    """Average daily return per weekday name.  Weekend dates keep their own
    names unless ``weekdays_only``.  ``day_index`` (0 for Monday) is the order to
    show them in.  Columns: ticker, day_index, day_of_week, avg_return.
    """
    return _weekday_means(bars, weekdays_only, drop_missing_first).select("ticker", F.col("_dow").alias("day_index"), "day_of_week", "avg_return")


def best_weekday(bars: DataFrame, weekdays_only: bool = False, drop_missing_first: bool = False) -> DataFrame:
    """Per ticker, the weekday with the highest average return; on ties the
    earlier day of the week (Monday first, weekend last).
    Columns: ticker, day_of_week, avg_return.
    """
    best = F.max_by(F.struct("day_of_week", "avg_return"), F.struct("avg_return", -F.col("_dow")))
    return (
        _weekday_means(bars, weekdays_only, drop_missing_first)
        .groupBy("ticker")
        .agg(best.alias("_b"))
        .select("ticker", "_b.day_of_week", "_b.avg_return")
    )


def seasonal_close(bars: DataFrame, start=None, end=None, universe: DataFrame | None = None) -> DataFrame:
    """Average close per meteorological season over bars in ``[start, end]``
    (the range reaches the scan); a season without bars is NULL.
    Conditional aggregates give the wide row in one group-by, no pivot.

    Tickers with no bar in the range are absent, unless ``universe`` (a table
    with a ``ticker`` column) lists them: then they have all seasons NULL.
    Columns: ticker, winter, spring, summer, autumn.
    """
    sel = filter_bars(bars, start=start, end=end, end_inclusive=True)
    per = (
        sel.select("ticker", "close", season("date").alias("_season"))
        .groupBy("ticker")
        .agg(*[F.avg(F.when(F.col("_season") == name, F.col("close"))).alias(name.lower()) for name, _ in SEASONS])
    )
    return of_universe(universe, per)


def _signed_days(bars: DataFrame, join_first_row: bool) -> DataFrame:
    """Gaps-and-islands numbering of runs of equal day sign.

    ``change`` is 1 where the sign differs from the previous day's; the
    running sum of it numbers the runs.  On a ticker's first day ``change``
    is NULL, so that day's run number is NULL and the first run is split
    after its first day, as the analysis computes it; ``join_first_row``
    treats the first day as unchanged instead.
    """
    w = series()
    signed = bars.select("ticker", "date", day_sign().alias("sign"))
    change = (F.col("sign") != F.lag("sign", 1).over(w)).cast("int")
    if join_first_row:
        change = F.coalesce(change, F.lit(0))
    run_id = F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return signed.withColumn("_chg", change).withColumn("streak_id", run_id)


def _signed_days_year_split(bars: DataFrame, join_first_row: bool) -> DataFrame:
    """The same numbering with each ticker's series split by calendar year.

    Within (ticker, year): the sign changes and their running count.  Per
    (ticker, year), one small row: first and last sign and the count of
    changes inside the year.  Over a ticker's years (a window over one row
    per year): whether the year's first day changes sign from the previous
    year's last day, and the changes of all earlier years, which offset the
    run numbers.  A run crossing New Year keeps one number.  The ticker's
    very first day keeps its NULL number (or 0 with ``join_first_row``).
    """
    df = by_year(with_key(bars).select("ticker", "date", day_sign().alias("sign")))
    in_year = Window.partitionBy("ticker", "_y").orderBy("date")
    rows = df.withColumn("_c", (F.col("sign") != F.lag("sign", 1).over(in_year)).cast("int")).withColumn(
        "_cum", F.sum("_c").over(in_year.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    years = rows.groupBy("ticker", "_y").agg(
        F.min_by("sign", "date").alias("_fs"),
        F.max_by("sign", "date").alias("_ls"),
        F.coalesce(F.sum("_c"), F.lit(0).cast("bigint")).alias("_inner"),
    )
    over_years = Window.partitionBy("ticker").orderBy("_y")
    prev_last = F.lag("_ls", 1).over(over_years)
    first_chg = F.when(prev_last.isNull(), F.lit(0) if join_first_row else F.lit(None)).otherwise(
        (F.col("_fs") != prev_last).cast("int")
    )
    years = years.withColumn("_fc", first_chg.cast("bigint"))
    carry = years.select(
        "ticker",
        "_y",
        "_fc",
        F.coalesce(
            F.sum(F.coalesce("_fc", F.lit(0)) + F.col("_inner")).over(
                over_years.rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0).cast("bigint"),
        ).alias("_off"),
    )
    first_day = F.col("_c").isNull()
    run_id = F.when(first_day, F.col("_off") + F.col("_fc")).otherwise(
        F.col("_off") + F.coalesce(F.col("_fc"), F.lit(0)) + F.col("_cum")
    )
    return with_year_rows(rows, carry).select("ticker", "date", "sign", run_id.alias("streak_id"))


def _all_runs(bars: DataFrame, join_first_row: bool, year_split: bool = False) -> DataFrame:
    days = _signed_days_year_split(bars, join_first_row) if year_split else _signed_days(bars, join_first_row)
    return days.groupBy("ticker", "streak_id", "sign").agg(F.count(F.lit(1)).alias("n"))


def streak_runs(bars: DataFrame, join_first_row: bool = False, year_split: bool = False) -> DataFrame:
    """Runs of consecutive gains (+1) or losses (-1); neutral days break a run
    and are not runs themselves.  ``year_split`` partitions each ticker's
    series by (ticker, year) for series too long or tickers too hot for one
    task; the runs are the same.  Columns: ticker, streak_id, sign, n.
    """
    return _all_runs(bars, join_first_row, year_split).filter(F.col("sign") != 0)


def longest_streaks(bars: DataFrame, join_first_row: bool = False, year_split: bool = False) -> DataFrame:
    """Longest gain and loss run per ticker, 0 when there is none
    (``year_split`` as in ``streak_runs``).
    Columns: ticker, longest_gain, longest_loss.
    """
    runs = _all_runs(bars, join_first_row, year_split)
    zero = F.lit(0).cast("bigint")
    return runs.groupBy("ticker").agg(
        F.coalesce(F.max(F.when(F.col("sign") == 1, F.col("n"))), zero).alias("longest_gain"),
        F.coalesce(F.max(F.when(F.col("sign") == -1, F.col("n"))), zero).alias("longest_loss"),
    )



# Longest streaks from mergeable summaries.  A span of days is summed up by its first and
# last run (sign, length), whether these are one run, and the longest gain and loss
# strictly inside; two neighbouring spans' summaries give that of both together, so spans
# are merged in any grouping and no window runs over a history.
_SPAN = "struct<fs:int,fl:bigint,ls:int,ll:bigint,whole:boolean,gain:bigint,loss:bigint>"
_DAY = "named_struct('fs', sign, 'fl', 1L, 'ls', sign, 'll', 1L, 'whole', true, 'gain', 0L, 'loss', 0L)"
# Span a followed by span b.  Runs that lie strictly inside both together, but in neither
# alone: the one across the border, or, where the signs differ, the two at it.
_MEET = "a.ls = b.span.fs"
_ACROSS = f"CASE WHEN {_MEET} THEN CASE WHEN NOT a.whole AND NOT b.span.whole THEN a.ll + b.span.fl END WHEN NOT a.whole THEN a.ll END"
_BEGUN = f"CASE WHEN NOT {_MEET} AND NOT b.span.whole THEN b.span.fl END"
_JOINED = f"""named_struct(
  'fs', a.fs, 'fl', a.fl + CASE WHEN {_MEET} AND a.whole THEN b.span.fl ELSE 0L END,
  'ls', b.span.ls, 'll', b.span.ll + CASE WHEN {_MEET} AND b.span.whole THEN a.ll ELSE 0L END,
  'whole', {_MEET} AND a.whole AND b.span.whole,
  'gain', greatest(a.gain, b.span.gain, CASE WHEN a.ls = 1 THEN {_ACROSS} END, CASE WHEN b.span.fs = 1 THEN {_BEGUN} END),
  'loss', greatest(a.loss, b.span.loss, CASE WHEN a.ls = -1 THEN {_ACROSS} END, CASE WHEN b.span.fs = -1 THEN {_BEGUN} END))"""


def _span() -> Column:
    """Aggregate of (at, span): the summary of all, neighbours in the order of ``at``."""
    step = f"(a, b) -> CASE WHEN a IS NULL THEN b.span ELSE {_JOINED} END"
    return F.expr(f"aggregate(sort_array(collect_list(struct(at, span))), CAST(NULL AS {_SPAN}), {step})").alias("span")


def longest_streaks_merged(bars: DataFrame, join_first_row: bool = False) -> DataFrame:
    """The rows of ``longest_streaks`` (for bars that have their key) from partial
    aggregates: days are summed up by (ticker, month), months by ticker.  A group is
    31 days or a ticker's months; the only exchange of rows is by (ticker, month).
    Columns: ticker, longest_gain, longest_loss.
    """
    days = with_key(bars).select("ticker", F.col("date").alias("at"), day_sign().alias("sign"))
    days = days.select("ticker", F.trunc("at", "month").alias("_m"), "at", F.expr(_DAY).alias("span"))
    months = days.groupBy("ticker", "_m").agg(_span()).withColumnRenamed("_m", "at")
    whole = months.groupBy("ticker").agg(_span())
    first, rest = (F.col("span.fl"), F.lit(0)) if join_first_row else (F.lit(1).cast("bigint"), F.col("span.fl") - 1)

    def longest(sign: int, inside: str) -> Column:
        ends = [F.when(F.col("span.fs") == sign, F.greatest(first, rest)), F.when((F.col("span.ls") == sign) & ~F.col("span.whole"), F.col("span.ll"))]
        return F.greatest(F.col(f"span.{inside}"), *ends)

    return whole.select("ticker", longest(1, "gain").alias("longest_gain"), longest(-1, "loss").alias("longest_loss"))
