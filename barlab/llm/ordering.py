"""Places of rows in an order, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm.scratch import stored


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str | Column], what: str) -> DataFrame:
    """``rows`` with ``pos``, the place from 0 of each row in its group, and
    ``total``, the group's size.  ``rows`` is a stored table of small rows and its
    group columns hold no null.

    Rows are dealt by ranges of (group, order, place in the table), so a group
    that holds most rows, or rows that tie in everything, spread over many tasks.
    The sorted table is written; each of its partitions holds a run of a few
    groups, and the sizes of the runs before it say where a run begins.  Rows of
    one run are joined on (group, partition), which no group makes large."""
    keys = [*group, *order, "_tie"]
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    placed = stored(dealt.withColumns({"_part": F.spark_partition_id(), "_nth": F.monotonically_increasing_id()}), what)
    runs = placed.groupBy(*group, "_part").agg(F.count("*").alias("_size"), F.min("_nth").alias("_from"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_from")
    runs = runs.select(*group, "_part", begin.alias("_shift"), F.sum("_size").over(whole).alias("total"))
    out = placed.join(runs, [*group, "_part"]).withColumn("pos", F.col("_nth") + F.col("_shift"))
    return out.drop("_part", "_nth", "_shift")
