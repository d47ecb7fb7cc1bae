"""Sources and sinks: file round trips, label mapping, pushdown, pruning."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from barlab.plans.inspect import physical_plan
from barlab.sources.bars import bars_from_orders, filter_bars, load_bars, write_bars
import pytest

from conftest import SF0001, SF001


def _tmp():
    return tempfile.mkdtemp(prefix="barlab-test-", dir="/tmp")


def test_parquet_round_trip_with_pruning(spark):
    bars = bars_from_orders(spark, SF001)
    out = os.path.join(_tmp(), "bars")
    write_bars(bars, out)
    back = load_bars(spark, out, start="1996-01-01", end="1997-01-01", tickers=["2-HIGH"], year_partitioned=True, duplicates="trust")
    plan = physical_plan(back)
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "PushedFilters" in plan and "ticker" in plan.split("PushedFilters")[1].split("]")[0]
    want = filter_bars(bars, ["2-HIGH"], "1996-01-01", "1997-01-01")
    assert back.count() == want.count() > 0
    assert back.exceptAll(want).count() == 0


def test_csv_with_original_labels(spark):
    rows = [("XYZ", "2020-01-02", 1.0, 2.0, 0.5, 1.5, 1.4, 100.0), ("XYZ", "2020-01-03", 1.5, 2.5, 1.0, 2.0, 1.9, 200.0)]
    df = spark.createDataFrame(rows, "Ticker string, Date string, Open double, High double, Low double, Close double, `Adj Close` double, Volume double")
    out = os.path.join(_tmp(), "csv")
    df.coalesce(1).write.option("header", "true").csv(out)
    back = load_bars(spark, out, fmt="csv")
    assert back.columns == ["ticker", "date", "open", "high", "low", "close", "adj_close", "volume"]
    got = back.orderBy("date").collect()
    assert got[0].date == dt.date(2020, 1, 2) and got[1].adj_close == 1.9


def test_ticker_from_file_name(spark):
    base = _tmp()
    for t, c in (("ABC", 10.0), ("DEF", 20.0)):
        spark.createDataFrame([("2020-01-02", c, c, c, c, c, 1.0)], "Date string, Open double, High double, Low double, Close double, `Adj Close` double, Volume double").write.json(os.path.join(base, f"{t}.json"))
    back = load_bars(spark, [os.path.join(base, "ABC.json"), os.path.join(base, "DEF.json")], fmt="json", ticker_from_path="dir")
    assert {(r.ticker, r.close) for r in back.collect()} == {("ABC", 10.0), ("DEF", 20.0)}


def test_half_open_range(spark):
    bars = bars_from_orders(spark, SF001)
    got = filter_bars(bars, start="1996-01-01", end="1996-02-01").agg(F.min("date"), F.max("date")).collect()[0]
    assert got[0] >= dt.date(1996, 1, 1) and got[1] <= dt.date(1996, 1, 31)


def test_materialize_cuts_lineage(spark):
    from barlab.plans.materialize import checkpoint_dir, materialize

    assert checkpoint_dir(spark) is not None
    bars = bars_from_orders(spark, SF001)
    cut = materialize(bars)
    plan = physical_plan(cut)
    assert "orders.parquet" not in plan and "HashAggregate" not in plan
    assert cut.count() == bars.count()
    assert cut.exceptAll(bars).count() == 0


def test_bars_from_ticks_with_volume(spark):
    from barlab.sources.bars import bars_from_ticks

    ticks = spark.createDataFrame(
        [
            ("A", dt.datetime(2020, 1, 1, 10, 0), 10.0, 2, 5.0),
            ("A", dt.datetime(2020, 1, 1, 9, 0), 11.0, 1, 3.0),
            ("A", dt.datetime(2020, 1, 1, 11, 0), float("nan"), 3, 1.0),
            ("A", dt.datetime(2020, 1, 2, 9, 0), 12.0, 4, 1.0),
        ],
        "sym string, ts timestamp_ntz, px double, seq long, size double",
    )
    got = {r.date: r for r in bars_from_ticks(ticks, "sym", "ts", "px", "seq", volume="size").collect()}
    d1 = got[dt.date(2020, 1, 1)]
    # the last tick of day 1 has a NaN price: the close is the last price there is
    assert (d1.open, d1.high, d1.low, d1.close, d1.volume) == (11.0, 11.0, 10.0, 10.0, 9.0)
    d2 = got[dt.date(2020, 1, 2)]
    assert (d2.open, d2.close, d2.adj_close, d2.volume) == (12.0, 12.0, 12.0, 1.0)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_formats_round_trip(spark, fmt):
    bars = bars_from_orders(spark, SF0001)
    out = os.path.join(_tmp(), fmt)
    writer = bars.coalesce(2).write.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(out)
    back = load_bars(spark, out, fmt=fmt, schema=bars.schema if fmt in ("csv", "json") else None)
    assert back.schema == bars.schema or back.dtypes == bars.dtypes
    assert back.count() == bars.count()
    assert back.exceptAll(bars).count() == 0


def test_single_series_with_constant_label(spark):
    out = os.path.join(_tmp(), "one")
    spark.createDataFrame(
        [("2020-01-02", 1.0, 2.0, 0.5, 1.5, 1.4, 100.0)],
        "Date string, Open double, High double, Low double, Close double, `Adj Close` double, Volume double",
    ).write.parquet(out)
    back = load_bars(spark, out, ticker="XYZ", tickers=["XYZ"])
    assert [(r.ticker, r.close) for r in back.collect()] == [("XYZ", 1.5)]


BAR = "Ticker string, Date string, Open double, High double, Low double, Close double, `Adj Close` double, Volume double"


def test_fiscal_year_column_is_no_partition(spark):
    out = os.path.join(_tmp(), "fiscal")
    rows = [("A", f"2020-0{m}-01", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 2021) for m in (1, 2)]
    spark.createDataFrame(rows, BAR + ", year int").write.parquet(out)
    assert load_bars(spark, out, start="2020-01-01", end="2020-12-31").count() == 2


def test_duplicate_keys_are_an_error_or_defined(spark):
    out = os.path.join(_tmp(), "twice")
    rows = [("A", "2020-01-01", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0), ("A", "2020-01-01", 2.0, 1.0, 1.0, 1.0, 1.0, 1.0)]
    spark.createDataFrame(rows, BAR).write.parquet(out)
    with pytest.raises(Exception, match="more than one bar"):
        load_bars(spark, out).collect()
    assert [r.open for r in load_bars(spark, out, duplicates="greatest").collect()] == [2.0]
    assert load_bars(spark, out, duplicates="trust").count() == 2


def test_missing_first_and_last_prices_of_a_day(spark, duck_sf001):
    """open and close are the first and last price there is, as in the oracle."""
    import duckdb

    from barlab.plans.oracle import BARS_BODY
    from barlab.sources.bars import bars_from_ticks

    day = dt.datetime(2020, 1, 1, 9)
    ticks = [("A", day, None, 1), ("A", day, 5.0, 2), ("A", day, 7.0, 3), ("A", day, None, 4), ("B", day, None, 1)]
    df = spark.createDataFrame(ticks, "o_orderpriority string, o_orderdate timestamp_ntz, o_totalprice double, o_orderkey long")
    got = {r.ticker: (r.open, r.close, r.volume) for r in bars_from_ticks(df, "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey").collect()}
    assert got == {"A": (5.0, 7.0, 4.0), "B": (None, None, 1.0)}
    con = duckdb.connect()
    con.execute("CREATE TABLE orders (o_orderpriority VARCHAR, o_orderdate TIMESTAMP, o_totalprice DOUBLE, o_orderkey BIGINT)")
    con.executemany("INSERT INTO orders VALUES (?, ?, ?, ?)", ticks)
    want = {r[0]: r[1:] for r in con.sql(f"SELECT ticker, open, close, volume FROM ({BARS_BODY})").fetchall()}
    assert got == want
