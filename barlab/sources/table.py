"""One physical bars table for all analyses: bucketed by ticker, sorted by
(ticker, date) in each bucket, one file a bucket.

Every analysis over a ticker's series wants its rows together and in date order.  On
this table they are: a window over ``partitionBy("ticker").orderBy("date")`` plans
without Exchange and without Sort, a group-by on ticker without Exchange, and ticks
are aggregated to bars once, when the table is written.

Spark trusts the order of a bucket's only file where
``spark.sql.legacy.bucketedTableScan.outputOrdering`` is set; :func:`bars_table` sets it
for its session.  (Buckets of several files, as appends make them, are not relied on: Spark
then sorts.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlab.plans.materialize import shared_folder
from barlab.schema import BAR_COLUMNS

BUCKETS = 200


def save_bars_table(bars: DataFrame, name: str, buckets: int = BUCKETS, path: str | None = None) -> DataFrame:
    """Write ``bars`` as table ``name`` of the session's catalog, its files under ``path`` (a
    new folder under ``spark.checkpoint.dir`` by default), and return it as
    :func:`bars_table` does.  An existing table of that name is replaced.

    A bucket is a task of every later analysis: take as many as the cluster has
    cores, or enough for some 100 MB each, and no more than there are tickers."""
    spark = bars.sparkSession
    rows = bars.select(*BAR_COLUMNS).repartition(buckets, "ticker").sortWithinPartitions("ticker", "date")
    writer = rows.write.mode("overwrite").bucketBy(buckets, "ticker").sortBy("ticker", "date")
    writer.option("path", path or shared_folder(spark, "bars")).saveAsTable(name)
    return bars_table(spark, name)


def bars_table(spark: SparkSession, name: str) -> DataFrame:
    """The bars of a table that :func:`save_bars_table` wrote."""
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    return spark.table(name)
