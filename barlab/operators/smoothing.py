"""Moving averages of the close.

* ``sma``            — mean of the last ``n`` rows (fewer at the start).
* ``ema_one_step``   — ``close*a + previous close*(1-a)``, ``a = 2/(n+1)``: the
  one-step blend the analysis computes (NULL on a ticker's first row).
* ``ema_recursive``  — the true exponential average ``e_t = a*c_t + (1-a)*e_{t-1}``,
  seeded with the first close.  A recurrence has no built-in window
  function, so it runs in Python over Spark-partitioned, Spark-sorted data
  (``mapInPandas``): one pass over each partition's (ticker, date) stream.

All three have a ``year_split`` for series too long, or tickers too hot, for one task:
rows are partitioned by (ticker, year) only, and what a year needs of the years before
it comes from one small row per ticker and year, joined back where the rows are.

* ``sma``: the last ``n - 1`` closes before the year (halo rows, as an array), so that a
  frame that reaches over New Year adds its missing part from there.
* ``ema_one_step``: the last close before the year.
* ``ema_recursive``: a blocked scan of the linear recurrence.  A year maps the average
  before it, e, to ``decay * e + gain`` (decay ``(1-a)**k`` for k closes, gain the year's
  own average from 0); the maps are chained over a ticker's years, and each row takes
  ``(1-a)**k * e`` of its year's start besides its own year's part.  That part is a
  running sum of closes weighted by ``(1-a)**-k``, so no Python is needed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.functions.columns import series
from barlab.operators.returns import by_year, previous_close_year_split, with_key, with_year_rows
from barlab.schema import nan_to_null

_IN_YEAR = ("ticker", "_y")


def _check_n(n: int) -> None:
    if int(n) < 1:
        raise ValueError(f"window size must be >= 1, got {n}")


def ema_alpha(n: int) -> float:
    return 2 / (n + 1)


def _sma_year_split(bars: DataFrame, n: int, min_periods: int) -> DataFrame:
    df = by_year(with_key(bars).select("ticker", "date", "close"))
    in_year = Window.partitionBy(*_IN_YEAR).orderBy("date")
    frame = in_year.rowsBetween(-(n - 1), Window.currentRow)
    rows = df.select(
        "*",
        F.row_number().over(in_year).alias("_r"),
        F.sum("close").over(frame).alias("_s"),
        F.count("close").over(frame).alias("_n"),
    )
    # A year's last closes, as (place, close); every year has a row, so n - 1 years before are enough.
    tail = F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("date", "close")))), 1, max(n - 1, 1))
    years = df.groupBy(*_IN_YEAR).agg(tail.alias("_tail"))
    before = Window.partitionBy("ticker").orderBy(F.desc("_y")).rowsBetween(1, max(n - 1, 1))
    halo = F.slice(F.flatten(F.collect_list("_tail").over(before)), 1, max(n - 1, 1))
    years = years.select(*_IN_YEAR, halo["close"].alias("_halo"))
    # The newest n - r closes of the halo belong to the frame of the year's r-th row.
    joined = with_year_rows(rows, years).withColumn("_part", F.slice("_halo", 1, F.greatest(F.lit(n) - F.col("_r"), F.lit(0))))
    some = F.filter("_part", lambda v: v.isNotNull())
    more = F.aggregate(F.reverse(some), F.lit(0.0), lambda a, v: a + v)
    count = F.col("_n") + F.size(some)
    total = F.coalesce(F.col("_s"), F.lit(0.0)) + more
    mean = F.when(count >= max(min_periods, 1), total / F.nullif(count, F.lit(0)))
    return joined.select("ticker", "date", "close", mean.alias("sma"))


def sma(bars: DataFrame, n: int = 20, min_periods: int = 1, year_split: bool = False) -> DataFrame:
    """ticker, date, close, sma over rows ``[t-n+1, t]``.

    With ``min_periods`` > 1 the first rows, which have fewer closes, give NULL.
    ``year_split`` gives the same averages for bars that have their key.
    """
    _check_n(n)
    if year_split:
        return _sma_year_split(bars, n, min_periods)
    frame = series().rowsBetween(-(n - 1), Window.currentRow)
    mean = F.avg("close").over(frame)
    if min_periods > 1:
        mean = F.when(F.count("close").over(frame) >= min_periods, mean)
    return bars.select("ticker", "date", "close", mean.alias("sma"))


def ema_one_step(bars: DataFrame, n: int = 20, year_split: bool = False) -> DataFrame:
    """ticker, date, close, ema = close*a + previous close*(1-a).  ``year_split`` as in
    :func:`sma`."""
    _check_n(n)
    alpha = ema_alpha(n)
    if year_split:
        prev, rows = previous_close_year_split(bars)
        return rows.select("ticker", "date", "close", (F.col("close") * F.lit(alpha) + prev * F.lit(1.0 - alpha)).alias("ema"))
    ema = F.col("close") * F.lit(alpha) + F.lag("close", 1).over(series()) * F.lit(1.0 - alpha)
    return bars.select("ticker", "date", "close", ema.alias("ema"))


def _recursive_ema(alpha: float):
    """Per partition: rows arrive sorted by (ticker, date) in Arrow batches.  All
    series of a batch advance together, one day a step, each step on arrays over
    the series; a series that a batch cuts takes its state to the next one."""
    beta = 1.0 - alpha

    def run(batches):
        last, carried = None, np.nan
        for pdf in batches:
            if pdf.empty:
                continue
            names = pdf["ticker"].fillna("").to_numpy()
            close = pdf["close"].to_numpy("float64", na_value=np.nan)
            start = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
            size = np.diff(np.append(start, len(names)))
            state = np.full(len(start), np.nan)
            if names[0] == last:
                state[0] = carried
            out = np.full(len(names), np.nan)
            longest_first = np.argsort(-size, kind="stable")
            alive = np.searchsorted(-size[longest_first], -np.arange(size.max()), "left")
            for day, n in enumerate(alive):
                live = longest_first[:n]
                x, e = close[start[live] + day], state[live]
                e = np.where(np.isnan(x), e, np.where(np.isnan(e), x, alpha * x + beta * e))
                state[live] = e
                out[start[live] + day] = np.where(np.isnan(x), np.nan, e)
            last, carried = names[-1], state[-1]
            yield pdf.assign(ema=out)

    return run


def _ema_year_split(bars: DataFrame, n: int) -> DataFrame:
    alpha = ema_alpha(n)
    beta = 1.0 - alpha
    df = by_year(with_key(bars).select("ticker", "date", nan_to_null(F.col("close")).alias("close")))
    if beta == 0:
        return df.select("ticker", "date", "close", F.col("close").alias("ema"))
    so_far = Window.partitionBy(*_IN_YEAR).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    decay = lambda k: F.pow(F.lit(beta), k)
    rows = df.withColumn("_k", F.count("close").over(so_far))
    rows = rows.withColumn("_own", decay(F.col("_k")) * F.sum(F.lit(alpha) * F.col("close") / decay(F.col("_k"))).over(so_far))
    years = rows.groupBy(*_IN_YEAR).agg(
        F.max("_k").alias("k"),
        F.max_by("_own", "date").alias("own"),
        F.min_by("close", F.when(F.col("close").isNotNull(), F.col("date"))).alias("seed"),
    )
    # The seed is the first close, as if the average before it had been that.
    link = F.struct(F.col("_y").alias("y"), "k", "own", "seed")
    chain = years.groupBy("ticker").agg(F.array_sort(F.collect_list(link)).alias("chain"))

    def step(state, year):
        start = F.coalesce(state["e"], year["seed"])
        end = F.when(year["k"] > 0, decay(year["k"]) * start + year["own"]).otherwise(state["e"])
        done = F.concat(state["starts"], F.array(F.struct(year["y"].alias("_y"), start.alias("_start"))))
        return F.struct(end.alias("e"), done.alias("starts"))

    zero = F.struct(F.lit(None).cast("double").alias("e"), F.array().cast("array<struct<_y:int,_start:double>>").alias("starts"))
    starts = chain.select("ticker", F.inline(F.aggregate("chain", zero, step)["starts"]))
    ema = F.when(F.col("close").isNotNull(), decay(F.col("_k")) * F.col("_start") + F.col("_own"))
    return with_year_rows(rows, starts).select("ticker", "date", "close", ema.alias("ema"))


def ema_recursive(bars: DataFrame, n: int = 20, year_split: bool = False) -> DataFrame:
    """ticker, date, close, ema with ``e_0 = c_0`` and ``e_t = a*c_t + (1-a)*e_{t-1}``.

    A recurrence has no built-in window function.  Spark hash-partitions the
    bars by ticker (the exchange every series window uses) and sorts each
    partition by (ticker, date); ``mapInPandas`` then advances all series of a
    batch together, a day a step, so the interpreter's steps follow the days and
    not the rows.  Only the three needed columns cross to Python, in Arrow
    batches, and no per-ticker pandas frame is built.  A ticker's whole series is
    in one task, unless ``year_split`` (see above; for one bar a day at most, and bars
    that have their key).  NULL closes yield NULL and
    leave the running state unchanged.
    """
    _check_n(n)
    if year_split:
        return _ema_year_split(bars, n)
    out = (
        bars.select("ticker", "date", "close")
        .repartition("ticker")
        .sortWithinPartitions("ticker", "date")
        .mapInPandas(_recursive_ema(ema_alpha(n)), schema="ticker string, date date, close double, ema double")
    )
    return out.withColumns({"close": nan_to_null(F.col("close")), "ema": nan_to_null(F.col("ema"))})
