"""Pearson correlations.

* ``feature_correlation`` — between price columns, per ticker: one group-by on
  ticker and column pair.  (The dashboard this reproduces ran one job per pair.)
* ``aligned_closes`` — the bars on dates on which *every* chosen ticker has one
  (inner join of the series on date), long: date, ticker, value.
* ``aligned_wide`` — the same with one column per ticker, for a given list.
* ``ticker_correlation`` — the k×k matrix between tickers over those dates,
  each pair over the dates where both values are present.

The plans are the same for any number of tickers, and building them runs no job.

``aligned_closes``: one group-by on date makes a row per date with its (ticker, value)
pairs, at most one entry per ticker; shared dates have all k of them.

``ticker_correlation``: a group-by on ticker packs each series into one row (as long as
the calendar, whatever the number of tickers).  The shared dates are counted from
these rows and reach the tasks as one array.  Tickers are dealt by hash to blocks of
about ``block``; each pair of blocks is a group of its own, whose task takes the
moments of all its pairs at once as products of (ticker x date) matrices.  So the
work on k x k cells is spread over pairs of blocks, no date's or ticker's row is
ever joined with another, and a task holds two blocks of series.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.functions.columns import masked_corr
from barlab.schema import numeric_columns

def feature_correlation(bars: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Full matrix (both orders and the diagonal) of correlations between
    the given columns (default: every double column), per ticker.

    Each bar gives one (x, y) row per pair of columns to a group-by on ticker and
    pair, whose partial step sums them up in the same task: what is shuffled is one row
    per task, ticker and pair, and three aggregates are compiled whatever the number of
    columns.  Columns: ticker, feature_x, feature_y, corr.
    """
    feats = list(features) if features is not None else numeric_columns(bars)
    if not feats:
        raise ValueError("at least one feature is needed")
    # As one SQL text: some 100 calls to the JVM less than as columns.
    text = lambda c: "'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'"
    value = lambda c: "CAST(`" + c.replace("`", "``") + "` AS DOUBLE)"
    pairs = [f"named_struct('fx', {text(a)}, 'fy', {text(b)}, 'x', {value(a)}, 'y', {value(b)})" for i, a in enumerate(feats) for b in feats[i:]]
    rows = bars.select("ticker", F.expr(f"inline(array({', '.join(pairs)}))"))
    moments = rows.groupBy("ticker", "fx", "fy").agg(masked_corr("x", "y").alias("c"), F.stddev_pop("x").alias("s"))
    same = F.col("fx") == F.col("fy")
    # A column correlates with itself by 1, unless it is constant.
    corr = F.when(same, F.when(F.col("s") > 0, F.lit(1.0))).otherwise(F.col("c"))
    order = lambda x, y: F.struct(F.col(x).alias("feature_x"), F.col(y).alias("feature_y"))
    both = F.when(same, F.array(order("fx", "fy"))).otherwise(F.array(order("fx", "fy"), order("fy", "fx")))
    return moments.select("ticker", F.inline(both), corr.alias("corr"))


def _chosen(tickers: Iterable[str] | None) -> list[str] | None:
    return None if tickers is None else sorted(set(tickers))


def _per_date(bars: DataFrame, chosen: list[str] | None, feature: str) -> DataFrame:
    """date, ``names`` (the distinct tickers with a bar, in order) and ``vals``
    (their values; the largest non-NULL one if a key is not unique)."""
    rows = bars.where(F.col("ticker").isNotNull() & F.col("date").isNotNull())
    if chosen is not None:
        rows = rows.where(F.col("ticker").isin(chosen))
    entry = F.struct(F.col("ticker").alias("t"), F.col(feature).alias("v"))
    dates = rows.groupBy("date").agg(F.array_sort(F.collect_list(entry)).alias("_e"))
    dates = dates.withColumn("names", F.array_distinct(F.transform("_e", lambda e: e["t"])))
    of = lambda n: F.array_max(F.transform(F.filter("_e", lambda e: e["t"] == n), lambda e: e["v"]))
    unique = F.size("_e") == F.size("names")
    return dates.select("date", "names", F.when(unique, F.transform("_e", lambda e: e["v"])).otherwise(F.transform("names", of)).alias("vals"))


def _index(dates: DataFrame, chosen: list[str] | None) -> DataFrame:
    """One row: ``names``, all tickers in order (those given, or all that have a bar)."""
    if chosen is None:
        return dates.select(F.explode("names").alias("t")).distinct().agg(F.array_sort(F.collect_set("t")).alias("all"))
    # The given names as one row of the plan itself.
    return dates.sparkSession.range(1).select(F.array(*[F.lit(t) for t in chosen]).alias("all"))


def _shared(dates: DataFrame, index: DataFrame) -> DataFrame:
    """The per-date rows that have every ticker of ``index``."""
    return dates.where(F.size("names") == index.select(F.size("all")).scalar())


def aligned_closes(bars: DataFrame, tickers: Iterable[str] | None = None, feature: str = "close") -> DataFrame:
    """date, ticker and ``feature`` on the dates where every chosen ticker (all of
    them when None) has a bar.  A bar whose value is NULL counts as present."""
    chosen = _chosen(tickers)
    dates = _per_date(bars, chosen, feature)
    pairs = F.inline(F.arrays_zip(F.col("names").alias("ticker"), F.col("vals").alias(feature)))
    return _shared(dates, _index(dates, chosen)).select("date", pairs)


_DAY0 = 1_000_000  # keeps day numbers of all dates after 0768 BC positive


def aligned_closes_bitmap(bars: DataFrame, tickers: Iterable[str] | None = None, feature: str = "close") -> DataFrame:
    """``aligned_closes`` for very many tickers: no row holds a date's tickers.

    Each ticker's dates become a bitmap of 4 KB per 32,768 days; the bitmaps are combined
    by a bitwise-and aggregate, one row per task before the shuffle.  The shared days
    are one bitmap per 32,768 days whatever the number of tickers or bars, so they are
    broadcast and each bar looks up its own bit.  The bitmaps' branch carries the
    feature along, as a count, so that all branches reuse one exchange of the bars.
    """
    chosen = _chosen(tickers)
    rows = bars.where(F.col("ticker").isNotNull() & F.col("date").isNotNull())
    if chosen is not None:
        rows = rows.where(F.col("ticker").isin(chosen))
    # Never NULL, so that no branch filters on it and the exchange stays the same.
    day = F.coalesce(F.unix_date("date").cast("long"), F.lit(0)) + F.lit(_DAY0)
    rows = rows.select("date", "ticker", feature, F.coalesce(F.bitmap_bucket_number(day), F.lit(0)).alias("bucket"), F.coalesce(F.bitmap_bit_position(day), F.lit(0)).alias("bit"))
    dates = rows.groupBy("ticker", "bucket").agg(F.bitmap_construct_agg("bit").alias("days"), F.count(feature).alias("n_values"))
    dates = dates.where((F.length("days") > 0) & (F.col("n_values") >= 0))
    all_ = F.lit(len(chosen)) if chosen is not None else dates.select("ticker").distinct().agg(F.count("ticker")).scalar()
    shared = dates.groupBy("bucket").agg(F.bitmap_and_agg("days").alias("days"), F.count("ticker").alias("n")).where(F.col("n") == all_)
    kept = rows.join(F.broadcast(shared), "bucket")
    byte = F.conv(F.hex(F.substring("days", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    kept = kept.where(F.getbit(byte, F.pmod("bit", F.lit(8)).cast("int")) == 1)
    return kept.groupBy("date", "ticker").agg(F.max(feature).alias(feature))


def aligned_wide(bars: DataFrame, tickers: Iterable[str], feature: str = "close") -> DataFrame:
    """date and one column ``{ticker}_{feature}`` per given ticker, on the dates
    where every one of them has a bar."""
    chosen = _chosen(tickers)
    rows = bars.where(F.col("ticker").isin(chosen))
    is_ = [F.col("ticker") == F.lit(t) for t in chosen]
    wide = rows.groupBy("date").agg(
        *[F.max(F.when(p, F.col(feature))).alias(f"{t}_{feature}") for t, p in zip(chosen, is_)],
        *[F.count_if(p).alias(f"_n{i}") for i, p in enumerate(is_)],
    )
    for i in range(len(chosen)):
        wide = wide.where(F.col(f"_n{i}") > 0)
    return wide.drop(*[f"_n{i}" for i in range(len(chosen))])


def _packed(bars: DataFrame, chosen: list[str] | None, feature: str) -> DataFrame:
    """One row per ticker: its dates in order and its values on them (the largest
    non-NULL one if a key is not unique)."""
    rows = bars.where(F.col("ticker").isNotNull() & F.col("date").isNotNull())
    if chosen is not None:
        rows = rows.where(F.col("ticker").isin(chosen))
    unique = rows.groupBy("ticker", "date").agg(F.max(F.col(feature).cast("double")).alias("v"))
    series = unique.groupBy("ticker").agg(F.sort_array(F.collect_list(F.struct("date", "v"))).alias("_s"))
    return series.select("ticker", F.transform("_s.date", F.unix_date).alias("days"), F.col("_s.v").alias("vals"))


def _cells(group: pa.Table) -> pa.Table:
    """Correlations between the tickers of two blocks.  The row without a ticker has
    the shared dates."""
    names, days, vals = (group[c].to_pylist() for c in ("ticker", "days", "vals"))
    lo, hi = group["lo"][0].as_py(), group["hi"][0].as_py()
    side = group["side"].to_numpy()
    shared = np.array(days[names.index(None)] if None in names else [], np.int32)

    def matrix(block: int) -> tuple[list[str], np.ndarray]:
        rows = [i for i, n in enumerate(names) if n is not None and side[i] == block]
        out = np.full((len(rows), len(shared)), np.nan)
        for r, i in enumerate(rows):
            if len(shared) and days[i]:
                at = np.searchsorted(shared, days[i])
                ok = at < len(shared)
                ok[ok] = shared[at[ok]] == np.array(days[i])[ok]
                out[r, at[ok]] = np.array(vals[i], float)[ok]
        return [names[i] for i in rows], out

    left, x = matrix(lo)
    right, y = (left, x) if lo == hi else matrix(hi)
    corr = _correlations(x, y)
    if lo == hi:
        corr = (corr + corr.T) / 2  # the two orders of a pair agree to the last bit
    cells = [(left, right, corr)] if lo == hi else [(left, right, corr), (right, left, corr.T)]
    cols = [np.concatenate([np.repeat(np.array(a, object), len(b)) for a, b, _ in cells]), np.concatenate([np.tile(np.array(b, object), len(a)) for a, b, _ in cells])]
    value = np.concatenate([c.ravel() for _, _, c in cells])
    arrays = [*[pa.array(c, pa.string()) for c in cols], pa.array(value, pa.float64(), mask=np.isnan(value))]
    return pa.Table.from_arrays(arrays, names=["ticker_x", "ticker_y", "corr"])


def _correlations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Pearson correlation of each row of ``x`` with each of ``y`` over the columns where
    both are numbers; NaN where there are not two, or one side is constant there."""

    def parts(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        there = ~np.isnan(m)
        # Moments of small numbers: each series less its first value.
        first = np.array([row[t][0] if t.any() else 0.0 for row, t in zip(m, there)]).reshape(-1, 1)
        return there.astype(float), np.where(there, m - first, 0.0)

    (mx, vx), (my, vy) = parts(x), parts(y)
    n = mx @ my.T
    some = np.maximum(n, 1)
    sx, sy, qx, qy = vx @ my.T, mx @ vy.T, (vx * vx) @ my.T, mx @ (vy * vy).T
    spread_x, spread_y = qx - sx * sx / some, qy - sy * sy / some
    # What is left of a constant is rounding.
    ok = (n > 1) & (spread_x > 1e-13 * qx) & (spread_y > 1e-13 * qy)
    both = np.sqrt(np.where(ok, spread_x, 1.0)) * np.sqrt(np.where(ok, spread_y, 1.0))
    return np.where(ok, (vx @ vy.T - sx * sy / some) / both, np.nan)


def ticker_correlation(
    bars: DataFrame,
    tickers: Iterable[str] | None = None,
    feature: str = "close",
    block: int = 128,
) -> DataFrame:
    """Correlation of ``feature`` between every pair of chosen tickers (both
    orders and the diagonal), over the dates shared by all of them; each pair
    skips dates where either value is NULL.  A pair without two such dates, or
    with a constant value, is NULL; with no shared date every cell is.  A list
    of fewer than two tickers is an error.  Columns: ticker_x, ticker_y, corr.
    """
    chosen = _chosen(tickers)
    if chosen is not None and len(chosen) < 2:
        raise ValueError("select at least two tickers for a correlation matrix")
    if block < 1:
        raise ValueError("block must be >= 1")
    packed = _packed(bars, chosen, feature)
    if chosen is None:
        # By the series, so that this count comes from the same exchange.
        k = packed.agg(F.count_if(F.size("days") > 0)).scalar()
        series = packed
    else:
        # The given names as rows of the plan itself; those without a bar share no date.
        k = F.lit(len(chosen))
        names = packed.sparkSession.range(1).select(F.explode(F.array(*[F.lit(t) for t in chosen])).alias("ticker"))
        series = names.join(packed, "ticker", "left")
    dates = packed.select(F.explode("days").alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
    shared = dates.agg(F.sort_array(F.collect_list("day")).alias("days"))

    last = (F.ceil(k / block) - 1).cast("int")
    dealt = series.withColumn("side", F.pmod(F.xxhash64("ticker"), last + 1).cast("int"))
    dealt = dealt.select("ticker", "days", "vals", "side", F.explode(F.sequence(F.lit(0), last)).alias("other"))
    dealt = dealt.select(F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", "ticker", "days", "vals")
    each = shared.select("days", F.explode(F.sequence(F.lit(0), last)).alias("lo"))
    each = each.select("days", "lo", F.explode(F.sequence("lo", last)).alias("hi"))
    none = F.lit(None)
    each = each.select("lo", "hi", none.cast("int").alias("side"), none.cast("string").alias("ticker"), "days", none.cast("array<double>").alias("vals"))
    return dealt.unionByName(each).groupBy("lo", "hi").applyInArrow(_cells, "ticker_x string, ticker_y string, corr double")
