"""Analyses that look for single days, on :class:`~barlab.sources.zones.Zones`: the
statistics of each ticker's years tell which years can hold such a day, and only those
are read.  Results are those of the analyses on bars, for bars that have their key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.functions.columns import ratio
from barlab.sources.zones import ZONE, Zones


def outlier_days_zoned(zones: Zones, k: float = 3.0) -> DataFrame:
    """:func:`~barlab.operators.risk.outlier_days`: a ticker's mean and deviation come
    from its zones' moments; zones whose returns all lie inside mean ± k·stddev are
    skipped.  Columns: ticker, date, daily_return."""
    years = Window.partitionBy("ticker")
    n = F.col("n").cast("double")
    stats = zones.stats.where("n > 0").withColumn("_n", F.sum(n).over(years))
    stats = stats.withColumn("_m", ratio(F.sum(n * F.col("mean")).over(years), F.col("_n")))
    apart = F.col("mean") - F.col("_m")
    spread = F.sum(n * (F.col("variance") + apart * apart)).over(years)
    lim = F.lit(float(k)) * F.sqrt(ratio(spread, F.col("_n") - 1))
    bounds = stats.select(*ZONE, "least", "most", (F.col("_m") - lim).alias("_lo"), (F.col("_m") + lim).alias("_hi"))
    wanted = bounds.where((F.col("most") > F.col("_hi")) | (F.col("least") < F.col("_lo"))).select(*ZONE, "_lo", "_hi")
    r = F.col("daily_return")
    return zones.read(wanted).where((r > F.col("_hi")) | (r < F.col("_lo"))).select("ticker", "date", "daily_return")


def highest_daily_return_zoned(zones: Zones) -> DataFrame:
    """:func:`~barlab.operators.ranking.highest_daily_return`: only zones that reach their
    ticker's largest return are read; a ticker without any return takes its first day
    from the statistics.  Columns: ticker, date, daily_return."""
    best = F.max("most").over(Window.partitionBy("ticker"))
    wanted = zones.stats.withColumn("_best", best).where(F.col("most") == F.col("_best")).select(*ZONE, "_best")
    found = zones.read(wanted).where(F.col("daily_return") == F.col("_best"))
    found = found.groupBy("ticker").agg(F.min("date").alias("date"), F.first("_best").alias("daily_return"))
    none = zones.stats.groupBy("ticker").agg(F.min("first_date").alias("date"), F.max("most").alias("daily_return"))
    return found.unionByName(none.where(F.col("daily_return").isNull()))


def best_intraday_zoned(zones: Zones, year: int | None = None) -> DataFrame:
    """:func:`~barlab.operators.ranking.best_intraday` of a year or of all years: only zones
    that reach the largest intraday return are read (all of the year's where none has
    any).  Columns: date, ticker, return_rate."""
    stats = zones.stats if year is None else zones.stats.where(F.col("year") == F.lit(year))
    best = stats.orderBy(F.desc_nulls_last("most_intraday")).select("most_intraday").limit(1).scalar()
    wanted = stats.where(F.col("most_intraday").eqNullSafe(best)).select(*ZONE, F.col("most_intraday").alias("_best"))
    found = zones.read(wanted).where(F.col("intraday_return").eqNullSafe(F.col("_best")))
    return found.select("date", "ticker", F.col("intraday_return").alias("return_rate")).orderBy("date", "ticker").limit(1)


__all__ = ["best_intraday_zoned", "highest_daily_return_zoned", "outlier_days_zoned"]
