"""First/last rows and descriptive statistics per ticker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.functions.columns import series
from barlab.schema import BAR_COLUMNS, numeric_columns


def first_rows(bars: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` bars of each ticker by date, numbered ``rn`` from 1.

    ``row_number() <= n`` plans as a WindowGroupLimit, which also runs before
    the exchange, so at most ``n`` rows per ticker and task are shuffled.
    """
    return bars.select(*BAR_COLUMNS, F.row_number().over(series()).alias("rn")).filter(F.col("rn") <= n)


def last_rows(bars: DataFrame, n: int = 10) -> DataFrame:
    """The last ``n`` bars of each ticker, ``rn`` = 1 for the latest."""
    w = Window.partitionBy("ticker").orderBy(F.desc("date"))
    return bars.select(*BAR_COLUMNS, F.row_number().over(w).alias("rn")).filter(F.col("rn") <= n)


def describe_stats(bars: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample stddev, min, max and median of each numeric column
    (default: every double column) per ticker, as typed numbers in long form.

    The columns are unpivoted (an Expand, no extra scan) and aggregated in
    one group-by.  Median is exact; it keeps the values of a (ticker, column)
    group, which is bounded by the ticker's number of days.
    Columns: ticker, column_name, n, mean, stddev, min, max, median.
    """
    cols = list(columns) if columns is not None else numeric_columns(bars)
    long = bars.unpivot(["ticker"], cols, "column_name", "value")
    v = F.col("value")
    return long.groupBy("ticker", "column_name").agg(
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("stddev"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.median(v).alias("median"),
    )


ACCURACY = 10_000
SALTS = 32


def describe_stats_selected(bars: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``describe_stats`` for groups of any size: the median is exact, yet no task
    or aggregate holds the values of a group.

    A mergeable quantile sketch brackets the middle ranks in the same pass as the other
    statistics; its error is at most n / ``ACCURACY`` ranks, the bracket four times
    that on each side.  A second pass counts the values below the bracket and each
    different value inside it, summed up before the shuffle; the middle ranks are then found
    among those.  The brackets, one row per group, are joined on the group and a
    salt of the date, so a hot ticker is spread over ``SALTS`` tasks.  A bracket that
    missed the middle would be an error, never a wrong median.
    Columns: ticker, column_name, n, mean, stddev, min, max, median.
    """
    cols = list(columns) if columns is not None else numeric_columns(bars)
    long = bars.select("ticker", F.pmod(F.hash("date"), F.lit(SALTS)).alias("salt"), *cols)
    long = long.unpivot(["ticker", "salt"], cols, "column_name", "value")
    v, group = F.col("value"), ["ticker", "column_name"]
    stats = long.groupBy(*group).agg(
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("stddev"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.percentile_approx(v, [0.5 - 4 / ACCURACY, 0.5 + 4 / ACCURACY], ACCURACY).alias("bracket"),
    )
    brackets = stats.select(
        F.col("ticker").alias("t"),
        F.col("column_name").alias("c"),
        F.col("bracket")[0].alias("lo"),
        F.col("bracket")[1].alias("hi"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"),
    )
    on = F.col("ticker").eqNullSafe(F.col("t")) & (F.col("column_name") == F.col("c")) & (F.col("salt") == F.col("s"))
    near = long.join(brackets, on).where(v <= F.col("hi"))
    # One row for all values below the bracket (inside NULL), one for each value in it.
    counted = near.groupBy(*group, F.when(v >= F.col("lo"), v).alias("inside")).agg(F.count(F.lit(1)).alias("k"))
    upto = Window.partitionBy(*group).orderBy(F.asc_nulls_first("inside")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("rank", F.sum("k").over(upto))
    summary = stats.select(F.col("ticker").alias("t"), F.col("column_name").alias("c"), "n", "mean", "stddev", "min", "max")
    both = summary.join(ranked, F.col("t").eqNullSafe(F.col("ticker")) & (F.col("c") == F.col("column_name")), "left")
    reached = lambda r: F.min_by("inside", F.when(F.col("rank") >= r, F.col("rank")))
    lower, upper = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    facts = ["n", "mean", "stddev", "min", "max"]
    found = both.groupBy(F.col("t").alias("ticker"), F.col("c").alias("column_name"), *facts).agg(reached(lower).alias("a"), reached(upper).alias("b"))
    missed = F.raise_error(F.lit("the quantile sketch missed the median"))
    middle = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), (F.col("a") + F.col("b")) / 2).when(F.col("n") > 0, missed.cast("double"))
    return found.select(*group, *facts, middle.alias("median"))


def describe_strings(bars: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, number of different values, least and greatest value (by UTF-8 bytes)
    of each string column (default: all) per ticker; a column's different values are
    shuffled, not held.  Columns: ticker, column_name, n, n_distinct, min, max."""
    cols = list(columns) if columns is not None else [f.name for f in bars.schema.fields if f.dataType.typeName() == "string"]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in cols])
    long = bars.select("ticker", F.inline(pairs))
    values = long.groupBy("ticker", "column_name", "value").agg(F.count("value").alias("k"))
    return values.groupBy("ticker", "column_name").agg(
        F.sum("k").alias("n"), F.count("value").alias("n_distinct"), F.min("value").alias("min"), F.max("value").alias("max")
    )


def bar_coverage(bars: DataFrame) -> DataFrame:
    """Number of bars and first/last date per ticker.
    Columns: ticker, n_bars, first_date, last_date.
    """
    return bars.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_bars"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )
