"""Daily returns kept with zone statistics, so that later analyses skip files.

A zone is one ticker's calendar year: at most 366 bars.  :func:`save_zones` writes the
bars with their daily and intraday returns to folders by (year, part), ``part`` being a
hash of the ticker, and beside them one row of statistics per zone (dates, counts,
smallest and largest return, mean and variance).  An analysis decides from the
statistics which zones can hold a row of its result and reads the folders of those
only (dynamic partition pruning on year and part).

What goes to every task is the set of (year, part) to read: years times ``parts`` rows at
most, whatever the number of tickers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.functions.columns import intraday_return, pct_change, series
from barlab.plans.materialize import shared_folder

PARTS = 64
ZONE = ["ticker", "year", "part"]
ROWS = "ticker string, date date, daily_return double, intraday_return double, year int, part int"
STATS = "ticker string, year int, part int, first_date date, n long, least double, most double, mean double, variance double, most_intraday double"


@dataclass(frozen=True)
class Zones:
    """``rows``: (ticker, date, daily_return, intraday_return, year, part); ``stats``: a row
    per zone."""

    rows: DataFrame
    stats: DataFrame

    def read(self, wanted: DataFrame) -> DataFrame:
        """The rows of the zones in ``wanted`` (ticker, year, part and further columns),
        with those columns; folders without such a zone are not read."""
        folders = F.broadcast(wanted.select("year", "part").distinct())
        return self.rows.join(folders, ["year", "part"], "left_semi").join(wanted, ZONE)


def save_zones(bars: DataFrame, path: str | None = None, parts: int = PARTS) -> Zones:
    """Write ``bars`` with their returns under ``path`` (by default a new folder under
    ``spark.checkpoint.dir``) and return them as :func:`open_zones` does.  Bars without
    ticker or date are in no zone; a bar with a missing price has a NULL return.
    Take as many ``parts`` as make a folder some 100 MB."""
    spark = bars.sparkSession
    path = path or shared_folder(spark, "zones")
    keyed = bars.where(F.col("ticker").isNotNull() & F.col("date").isNotNull())
    rows = keyed.select(
        F.col("ticker").cast("string").alias("ticker"),
        "date",
        pct_change(F.col("close"), F.lag("close", 1).over(series())).alias("daily_return"),
        intraday_return().alias("intraday_return"),
        F.year("date").alias("year"),
        F.pmod(F.xxhash64("ticker"), F.lit(parts)).cast("int").alias("part"),
    )
    dealt = rows.repartition("year", "part").sortWithinPartitions("ticker", "date")
    dealt.write.partitionBy("year", "part").parquet(f"{path}/rows")
    r, day = F.col("daily_return"), F.col("intraday_return")
    stats = spark.read.schema(ROWS).parquet(f"{path}/rows").groupBy(*ZONE).agg(
        F.min("date").alias("first_date"),
        F.count(r).alias("n"),
        F.min(r).alias("least"),
        F.max(r).alias("most"),
        F.avg(r).alias("mean"),
        F.var_pop(r).alias("variance"),
        F.max(day).alias("most_intraday"),
    )
    stats.write.parquet(f"{path}/stats")
    return open_zones(spark, path)


def open_zones(spark: SparkSession, path: str) -> Zones:
    """The zones that :func:`save_zones` wrote under ``path``."""
    return Zones(spark.read.schema(ROWS).parquet(f"{path}/rows"), spark.read.schema(STATS).parquet(f"{path}/stats"))
