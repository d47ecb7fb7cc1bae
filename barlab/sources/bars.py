"""Sources and sinks for the ``bars`` table.

* ``load_bars``      — read bars from any Spark file source (parquet, csv, json,
  orc, ...), map the usual column labels, cast, and filter on tickers and a
  half-open date range.  Filters are plain column predicates on the scan so
  they reach the reader as pushed filters.
* ``bars_from_ticks`` — build daily bars from any per-event price table with a
  single partial+final hash aggregation (map-side combine, so a hot ticker/day
  never lands whole in one shuffle task).
* ``bars_from_orders`` / ``bars_from_events`` — the two test-table recipes.
* ``write_bars``     — parquet sink partitioned by year for partition pruning.
"""

from __future__ import annotations

import datetime as _dt
import functools
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StructType

from barlab.schema import BAR_COLUMNS, BARS, DAILY_HISTORY, PRICE_COLUMNS, SOURCE_NAMES, nan_to_null


def _as_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))


def filter_bars(
    bars: DataFrame,
    tickers: Iterable[str] | None = None,
    start=None,
    end=None,
    end_inclusive: bool = False,
) -> DataFrame:
    """Keep chosen tickers and dates in ``[start, end)`` (or ``[start, end]``).

    The provider the analyses were written for treats ``end`` as exclusive, so
    that is the default.  Date bounds become DATE literals, which Parquet can
    push down and use for row-group skipping.
    """
    out = bars
    if tickers is not None:
        out = out.filter(F.col("ticker").isin(list(tickers)))
    if start is not None:
        out = out.filter(F.col("date") >= F.lit(_as_date(start)))
    if end is not None:
        e = F.lit(_as_date(end))
        out = out.filter(F.col("date") <= e if end_inclusive else F.col("date") < e)
    return out


def normalize_bars(df: DataFrame, ticker: str | None = None, columns: dict[str, str] | None = None) -> DataFrame:
    """Rename the usual labels, cast to the ``BARS`` schema, NaN → NULL.

    ``ticker`` gives a constant label for a table that holds one series only;
    ``columns`` names the source column of a bar column, before the labels.
    """
    by_lower = {c.lower(): c for c in df.columns}
    aliases = {k.lower(): v for k, v in SOURCE_NAMES.items()}
    found: dict[str, str] = {}
    for lower, original in by_lower.items():
        target = aliases.get(lower, lower.replace(" ", "_"))
        if target in BAR_COLUMNS and target not in found:
            found[target] = original
    for name, source in (columns or {}).items():
        if name not in BAR_COLUMNS or source not in df.columns:
            raise ValueError(f"cannot take {name!r} from {source!r}; columns: {df.columns}")
        found[name] = source
    cols = []
    for field in BARS.fields:
        name = field.name
        if name == "ticker" and ticker is not None:
            cols.append(F.lit(ticker).alias("ticker"))
            continue
        if name not in found:
            raise ValueError(f"bars source has no column for {name!r}; columns: {df.columns}")
        src = F.col(f"`{found[name]}`")
        if name == "date":
            cols.append(F.to_date(src).alias("date"))
        elif name == "ticker":
            cols.append(src.cast("string").alias("ticker"))
        else:
            cols.append(nan_to_null(src.cast("double")).alias(name))
    return df.select(*cols)


def load_bars(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    tickers: Iterable[str] | None = None,
    start=None,
    end=None,
    options: dict | None = None,
    ticker_from_path: bool | str = False,
    ticker: str | None = None,
    columns: dict[str, str] | None = None,
    schema: StructType | str | None = None,
    year_partitioned: bool = False,
    duplicates: str = "error",
) -> DataFrame:
    """Read bars from files of any Spark-supported format.

    ``ticker_from_path`` is for one-series-per-file layouts, where the files
    hold no ticker column: ``"file"`` (or True) takes the file name without
    extension, ``"dir"`` the name of the folder holding the file (as Spark
    writes ``ABC.parquet/part-*``).  The path comes from the hidden
    ``_metadata`` column, so no extra listing job runs.  ``ticker`` labels a
    source that holds a single series with a constant.

    ``columns`` names the source column of a bar column (``{"close": "px"}``);
    others go by the usual labels.  CSV and JSON are read with ``schema``, by
    default the labels of :data:`DAILY_HISTORY`; they are never inferred, and a
    CSV header must agree with it.  ``year_partitioned=True`` says that the
    source is a :func:`write_bars` folder, whose ``year`` folders are pruned by
    the range; any other column of that name is left alone.

    ``duplicates`` says what a second row of one ``(ticker, date)`` means: an
    error when the query runs (``"error"``), the row with the greatest prices in
    column order (``"greatest"``), or that the caller vouches for the key
    (``"trust"``, which spares the group-by).
    """
    if duplicates not in ("error", "greatest", "trust"):
        raise ValueError(f"duplicates must be error, greatest or trust, got {duplicates!r}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("enforceSchema", "false")
    if options:
        reader = reader.options(**options)
    if schema is None and fmt in ("csv", "json"):
        own = ticker is not None or ticker_from_path
        schema = StructType([f for f in DAILY_HISTORY.fields if not (own and f.name == "Ticker")])
    if schema is not None:
        reader = reader.schema(schema)
    raw = reader.load(path)
    if ticker_from_path:
        pattern = r"([^/]+?)(\.[^./]*)?/[^/]+$" if ticker_from_path == "dir" else r"([^/]+?)(\.[^./]*)?$"
        raw = raw.withColumn("ticker", F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))
    if year_partitioned:
        if start is not None:
            raw = raw.filter(F.col("year") >= _as_date(start).year)
        if end is not None:
            raw = raw.filter(F.col("year") <= _as_date(end).year)
    bars = filter_bars(normalize_bars(raw, ticker, columns), tickers, start, end)
    return bars if duplicates == "trust" else one_per_key(bars, duplicates)


def one_per_key(bars: DataFrame, duplicates: str = "error") -> DataFrame:
    """Bars with the key ``(ticker, date)`` made sure of: one partial-aggregated
    group-by on it.  ``duplicates`` as in :func:`load_bars`."""
    kept = bars.groupBy("ticker", "date").agg(F.max(F.struct(*PRICE_COLUMNS)).alias("_bar"), F.count(F.lit(1)).alias("_n"))
    if duplicates == "error":
        said = F.format_string("more than one bar for (%s, %s)", F.col("ticker"), F.col("date").cast("string"))
        kept = kept.where(F.when(F.col("_n") > 1, F.raise_error(said).cast("boolean")).otherwise(F.lit(True)))
    return kept.select("ticker", "date", *[F.col(f"_bar.{c}").alias(c) for c in PRICE_COLUMNS])


def tick_events(ticks: DataFrame, ticker, ts, price, seq, volume) -> DataFrame:
    """ticker, date, price, qty, and ``seq`` of the events that have a price (NULL
    for the others, so that they are no first or last price)."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    value = nan_to_null(col(price).cast("double"))
    return ticks.select(
        col(ticker).cast("string").alias("ticker"),
        F.to_date(col(ts)).alias("date"),
        value.alias("price"),
        F.when(value.isNotNull(), col(seq)).alias("seq"),
        (nan_to_null(col(volume).cast("double")) if volume is not None else F.lit(1.0)).alias("qty"),
    )


def tick_aggregates(volume) -> list[Column]:
    """Aggregates of one ticker-day of :func:`tick_events`; events without a price
    count for the volume only."""
    # A primitive ordering key keeps min_by/max_by in the hash aggregate (a
    # struct key would force a sort of every tick before the partial step).
    return [
        F.min_by("price", "seq").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "seq").alias("close"),
        (F.sum("qty") if volume is not None else F.count(F.lit(1)).cast("double")).alias("volume"),
    ]


def finished_bars(daily: DataFrame, others: Iterable[str] = ()) -> DataFrame:
    """Columns of ``BARS`` from the aggregates of a ticker-day, and ``others`` as they are."""
    typical = (F.col("high") + F.col("low") + F.col("close")) / F.lit(3.0)
    return daily.select("ticker", "date", "open", "high", "low", "close", typical.alias("adj_close"), "volume", *others)


def bars_from_ticks(
    ticks: DataFrame,
    ticker: str | Column,
    ts: str | Column,
    price: str | Column,
    seq: str | Column,
    volume: str | Column | None = None,
) -> DataFrame:
    """Daily bars from per-event prices.

    open/close are the first and last price that is not NULL, by ``seq``
    (``min_by``/``max_by``; ``seq`` is a per-event sequence number, unique
    within a ticker and day, so open and close are the same on every re-run),
    high/low the extremes, volume the summed
    ``volume`` column or, without one, the event count; ``adj_close`` is the
    typical price ``(high + low + close) / 3`` as no adjustment data exists.
    All aggregates are partial-aggregatable, so the shuffle carries at most
    one row per (map task, ticker, day).
    """
    events = tick_events(ticks, ticker, ts, price, seq, volume)
    return finished_bars(events.groupBy("ticker", "date").agg(*tick_aggregates(volume)))


def bars_from_orders(spark: SparkSession, sf_dir: str, ticker: str = "o_orderpriority") -> DataFrame:
    """Test recipe F2: ticker = order priority, price = order total, seq = order
    key.  ``ticker="o_custkey"`` gives the many-ticker variant: one series per
    customer, thousands of short histories from the same table."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_totalprice", "o_orderdate", ticker
    )
    return bars_from_ticks(orders, ticker, "o_orderdate", "o_totalprice", "o_orderkey")


def bars_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test recipe F3: ticker = event type, price = event value, seq = event id."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "event_type", "value")
    return bars_from_ticks(events, "event_type", "ts", "value", "event_id")


def union_bars(*frames: DataFrame) -> DataFrame:
    """Stack bars from several sources by column name (a Union node, no shuffle)."""
    if not frames:
        raise ValueError("no bars to union")
    return functools.reduce(DataFrame.unionByName, [f.select(*BAR_COLUMNS) for f in frames])


def write_bars(bars: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet sink, partitioned by year so later date ranges prune directories."""
    (
        bars.select(*BAR_COLUMNS)
        .withColumn("year", F.year("date"))
        .repartition("year", "ticker")
        .sortWithinPartitions("ticker", "date")
        .write.mode(mode)
        .partitionBy("year")
        .parquet(path)
    )


__all__ = [
    "PRICE_COLUMNS",
    "bars_from_events",
    "bars_from_orders",
    "bars_from_ticks",
    "filter_bars",
    "load_bars",
    "normalize_bars",
    "one_per_key",
    "union_bars",
    "write_bars",
]
