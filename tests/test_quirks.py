"""Literal-row fixtures, one per documented quirk (FIXTURES.md F4)."""

import math

import pytest
from pyspark.sql import functions as F

from barlab import operators as ops
from barlab.sources.bars import normalize_bars


def rows(df, *cols, order=("ticker", "date")):
    return [tuple(r) for r in df.orderBy(*[c for c in order if c in df.columns]).select(*cols).collect()]


def test_first_streak_is_split_by_default(make_bars):
    # signs + + + - +
    bars = make_bars([("A", f"2020-01-0{i + 1}", o, c) for i, (o, c) in enumerate([(1, 2), (1, 2), (1, 2), (2, 1), (1, 2)])])
    runs = sorted(
        (r.streak_id if r.streak_id is not None else -1, r.n) for r in ops.streak_runs(bars).collect()
    )
    assert runs == [(-1, 1), (0, 2), (1, 1), (2, 1)]
    assert rows(ops.longest_streaks(bars), "longest_gain", "longest_loss") == [(2, 1)]
    assert rows(ops.longest_streaks(bars, join_first_row=True), "longest_gain", "longest_loss") == [(3, 1)]


def test_neutral_day_breaks_a_streak(make_bars):
    bars = make_bars([("A", "2020-01-01", 1, 2), ("A", "2020-01-02", 1, 1), ("A", "2020-01-03", 1, 2)])
    assert rows(ops.longest_streaks(bars), "longest_gain", "longest_loss") == [(1, 0)]
    assert all(r.sign != 0 for r in ops.streak_runs(bars).collect())


def test_zero_close_gives_null_return_not_error(make_bars):
    bars = make_bars([("A", "2020-01-01", 1, 0.0), ("A", "2020-01-02", 1, 1.0)])
    assert rows(ops.daily_returns(bars), "daily_return") == [(None,), (None,)]


def test_constant_column_correlation_is_null(make_bars, spark):
    df = spark.createDataFrame([("A", 1.0, 2.0), ("A", 1.0, 3.0), ("A", 1.0, 5.0)], "ticker string, x double, y double")
    got = {(r.feature_x, r.feature_y): r.corr for r in ops.feature_correlation(df, ["x", "y"]).collect()}
    assert got[("x", "y")] is None and got[("y", "x")] is None
    assert got[("y", "y")] == pytest.approx(1.0)


def test_correlation_skips_incomplete_pairs(spark):
    df = spark.createDataFrame(
        [("A", 1.0, None), ("A", 2.0, 2.0), ("A", 3.0, 3.0), ("A", 9.0, None)], "ticker string, x double, y double"
    )
    got = {(r.feature_x, r.feature_y): r.corr for r in ops.feature_correlation(df, ["x", "y"]).collect()}
    assert got[("x", "y")] == pytest.approx(1.0)


def test_nan_price_becomes_null(spark):
    import datetime as dt

    raw = spark.createDataFrame(
        [("A", dt.date(2020, 1, d), 1.0, 1.0, 1.0, c, c, 1.0) for d, c in zip(range(1, 5), [10.0, float("nan"), 12.0, 9.0])],
        "Ticker string, Date date, Open double, High double, Low double, Close double, `Adj Close` double, Volume double",
    )
    bars = normalize_bars(raw)
    assert rows(bars, "close")[1] == (None,)
    got = [r[0] for r in rows(ops.daily_returns(bars), "daily_return")]
    assert got[:3] == [None, None, None] and got[3] == pytest.approx(-0.25)


def test_consistency_bridges_a_gap_outliers_do_not(make_bars):
    bars = make_bars([("A", f"2020-01-0{d}", 1, c) for d, c in zip(range(1, 5), [10, None, 12, 9])])
    # consistency drops the missing bar before the lag: returns 0.2, -0.25
    sd = ops.return_consistency(bars).collect()[0].std_dev
    assert sd == pytest.approx(math.sqrt(2 * 0.225**2))
    # full-history returns keep the gap: only -0.25 is a return
    assert [r[0] for r in rows(ops.daily_returns(bars), "daily_return")][:3] == [None, None, None]


def test_null_close_and_ties_in_extremes(make_bars):
    bars = make_bars([("A", "2020-01-01", 1, None), ("A", "2020-01-02", 1, 1), ("A", "2020-01-03", 1, 1),
                      ("A", "2020-01-04", 1, 7), ("A", "2020-01-05", 1, 7)])
    r = ops.close_extremes(bars).collect()[0]
    assert (r.max_close, str(r.max_close_date), r.min_close, str(r.min_close_date)) == (7.0, "2020-01-04", 1.0, "2020-01-02")


def test_iso_week_numbers(make_bars):
    bars = make_bars([("A", d, 1, 2) for d in ("2020-12-31", "2021-01-01", "2022-01-01")])
    assert sorted(r.period for r in ops.period_averages(bars, "week").collect()) == [52, 53]
    assert [r[0] for r in rows(bars.select("date", F.weekofyear("date").alias("w")), "w", order=("date",))] == [53, 53, 52]


def test_range_filter_runs_before_lag(make_bars):
    bars = make_bars([("A", "2020-01-01", 1, 1), ("A", "2020-01-02", 1, 2), ("A", "2020-01-03", 1, 4)])
    h = ops.return_histogram(bars, "2020-01-02", "2020-01-03", bins=5)
    assert sum(r.n for r in h.collect()) == 1


def test_one_return_gives_infinite_stddev(make_bars):
    bars = make_bars([("A", "2020-01-01", 1, 1), ("A", "2020-01-02", 1, 2)])
    assert ops.return_consistency(bars).collect()[0].std_dev == float("inf")


def test_ticker_without_selected_bars_is_still_reported(make_bars):
    bars = make_bars([("A", "2020-01-01", 1, 1), ("A", "2020-01-02", 1, 2), ("B", "2019-01-01", 1, 2)])
    listed = bars.select("ticker")
    got = {r.ticker: r.std_dev for r in ops.return_consistency(bars, "2020-01-01", "2020-12-31", universe=listed).collect()}
    assert got == {"A": float("inf"), "B": float("inf")}
    seasons = {r.ticker: tuple(r)[1:] for r in ops.seasonal_close(bars, "2020-01-01", "2020-12-31", universe=listed).collect()}
    assert seasons == {"A": (1.5, None, None, None), "B": (None, None, None, None)}
    # without a universe, only tickers with selected bars appear
    assert [r.ticker for r in ops.return_consistency(bars, "2020-01-01", "2020-12-31").collect()] == ["A"]
    assert [r.ticker for r in ops.seasonal_close(bars, "2020-01-01", "2020-12-31").collect()] == ["A"]


def test_shared_dates_need_a_bar_of_every_ticker(make_bars):
    # two rows of A on a day without B do not make it a shared date
    bars = make_bars([("A", "2020-01-01", 1, 2), ("A", "2020-01-01", 1, 3), ("A", "2020-01-02", 1, 4), ("B", "2020-01-02", 1, 5)])
    got = [tuple(r) for r in ops.aligned_closes(bars).select("ticker", "close").collect()]
    assert sorted(got) == [("A", 4.0), ("B", 5.0)]
    assert [tuple(r)[1:] for r in ops.aligned_wide(bars, ["A", "B"]).collect()] == [(4.0, 5.0)]


def test_no_shared_date_gives_the_whole_grid_of_nulls(make_bars):
    bars = make_bars([(f"T{i}", f"2020-01-{i + 1:02d}", 1, i + 1) for i in range(11)])
    got = [tuple(r) for r in ops.ticker_correlation(bars).collect()]
    assert len(got) == 121 and {c for _, _, c in got} == {None}


def test_dotted_ticker_names(make_bars):
    bars = make_bars([(t, f"2020-01-0{d}", 1, d + k) for d in (1, 2, 3) for k, t in enumerate(("BRK.B", "date"))])
    assert ops.aligned_closes(bars).count() == 6
    assert ops.aligned_wide(bars, ["BRK.B", "date"]).columns == ["date", "BRK.B_close", "date_close"]
    assert len(ops.ticker_correlation(bars).collect()) == 4


def test_missing_season_is_null(make_bars):
    bars = make_bars([("A", "2020-01-02", 1, 2), ("A", "2020-01-03", 1, 4)])
    r = ops.seasonal_close(bars).collect()[0]
    assert (r.winter, r.spring, r.summer, r.autumn) == (3.0, None, None, None)


def test_missing_trend_class_counts_zero(make_bars):
    bars = make_bars([("A", "2020-01-02", 1, 2), ("A", "2020-01-03", 1, 4)])
    assert rows(ops.trend_days(bars), "upward_days", "downward_days", "neutral_days") == [(2, 0, 0)]


def test_short_sma_averages_available_rows(make_bars):
    bars = make_bars([("A", f"2020-01-0{d}", 1, c) for d, c in zip(range(1, 4), [1, 3, 5])])
    assert [r[0] for r in rows(ops.sma(bars, 2), "sma")] == [1.0, 2.0, 4.0]
    assert [r[0] for r in rows(ops.sma(bars, 2, min_periods=2), "sma")] == [None, 2.0, 4.0]


def test_ema_one_step_and_recursive(make_bars):
    bars = make_bars([("A", f"2020-01-0{d}", 1, c) for d, c in zip(range(1, 5), [1, 2, 3, 4])])
    assert [r[0] for r in rows(ops.ema_one_step(bars, 3), "ema")] == [None, 1.5, 2.5, 3.5]
    assert [r[0] for r in rows(ops.ema_recursive(bars, 3), "ema")] == [1.0, 1.5, 2.25, 3.125]


def test_weekend_day_keeps_its_name(make_bars):
    # 2020-01-03 is a Friday, 2020-01-04 a Saturday with the best return
    bars = make_bars([("A", "2020-01-02", 1, 10), ("A", "2020-01-03", 1, 11), ("A", "2020-01-04", 1, 20)])
    assert rows(ops.best_weekday(bars), "day_of_week") == [("Saturday",)]
    assert rows(ops.best_weekday(bars, weekdays_only=True), "day_of_week") == [("Friday",)]


def test_month_ordered_change(make_bars):
    bars = make_bars([("A", "2020-01-31", 1, 1), ("A", "2020-02-03", 1, 5), ("A", "2021-01-04", 1, 3)])
    got = {str(r.date): r.monthly_change for r in ops.monthly_price_change(bars).collect()}
    assert got == {"2020-01-31": None, "2021-01-04": 2.0, "2020-02-03": 2.0}


def test_ticker_correlation_needs_two_tickers(make_bars):
    bars = make_bars([("A", "2020-01-01", 1, 2)])
    with pytest.raises(ValueError):
        ops.ticker_correlation(bars, ["A"])


def test_calendar_month_change(make_bars):
    bars = make_bars([("A", "2020-01-30", 1, 5), ("A", "2020-01-31", 1, 6), ("A", "2020-03-02", 1, 9)])
    got = [(str(r.month), r.last_close, r.monthly_change) for r in ops.calendar_month_change(bars).orderBy("month").collect()]
    assert got == [("2020-01-01", 6.0, None), ("2020-03-01", 9.0, 3.0)]


def test_drop_missing_first_is_a_choice_per_analysis(make_bars):
    bars = make_bars([("A", f"2020-01-0{d}", 1, c) for d, c in zip(range(1, 6), [10, None, 12, 9, 9])])
    bridged = ops.return_consistency(bars, drop_missing_first=True).collect()[0].std_dev
    kept = ops.return_consistency(bars, drop_missing_first=False).collect()[0].std_dev
    assert bridged == pytest.approx(ops.return_consistency(bars.dropna(subset=["close"])).collect()[0].std_dev)
    assert kept == pytest.approx(math.sqrt(0.5 * 0.25**2))  # returns -0.25 and 0.0 only
    n_full = ops.flag_outliers(bars).filter("daily_return is not null").count()
    n_bridged = ops.flag_outliers(bars, drop_missing_first=True).filter("daily_return is not null").count()
    assert (n_full, n_bridged) == (2, 3)


def test_defaults_pick_double_columns(make_bars):
    bars = make_bars([("A", "2020-01-02", 1, 2), ("A", "2020-01-03", 2, 4), ("A", "2020-01-06", 3, 5)])
    names = {r.column_name for r in ops.describe_stats(bars).collect()}
    assert names == {"open", "high", "low", "close", "adj_close", "volume"}
    assert ops.feature_correlation(bars).count() == 36


def test_union_of_sources(make_bars):
    from barlab.sources import union_bars

    a = make_bars([("A", "2020-01-02", 1, 2)])
    b = make_bars([("B", "2020-01-02", 1, 2)]).select("volume", *[c for c in a.columns if c != "volume"])
    assert sorted(r.ticker for r in union_bars(a, b).collect()) == ["A", "B"]


def test_calendar_periods_split_years(make_bars):
    # ISO week 2 of 2020 and of 2021
    bars = make_bars([("A", "2020-01-06", 1, 2), ("A", "2021-01-11", 1, 4), ("A", "2021-01-12", 1, 6)])
    pooled = ops.period_averages(bars, "week")
    cal = ops.period_averages(bars, "week", calendar=True)
    assert pooled.count() == 1 and cal.count() == 2
    assert sorted(str(r.period) for r in cal.collect()) == ["2020-01-06", "2021-01-11"]
    assert ops.return_rates(bars, "month", calendar=True).count() == 2
    assert ops.period_averages(bars, "year", calendar=True).count() == 2
    assert ops.overall_average_return(bars, calendar=True).count() == 1


def test_top1_ties_take_earliest_date_then_ticker(make_bars):
    bars = make_bars([
        ("B", "2020-01-01", 1, 1), ("B", "2020-01-02", 1, 2), ("B", "2020-01-03", 1, 1), ("B", "2020-01-04", 1, 2),
        ("A", "2020-01-01", 1, 1), ("A", "2020-01-04", 1, 2),
    ])
    per = {r.ticker: (str(r.date), r.daily_return) for r in ops.highest_daily_return(bars).collect()}
    assert per == {"B": ("2020-01-02", 1.0), "A": ("2020-01-04", 1.0)}
    top = ops.highest_daily_return_overall(bars).collect()[0]
    assert (top.ticker, str(top.date)) == ("B", "2020-01-02")
    # intraday return 1.0 on 01-02 (B) and on 01-04 (A and B): the earliest wins
    best = ops.best_intraday(bars).collect()[0]
    assert (best.ticker, str(best.date)) == ("B", "2020-01-02")
    later = ops.best_intraday(bars.filter("date > '2020-01-02'")).collect()[0]
    assert (later.ticker, str(later.date)) == ("A", "2020-01-04")


def test_ticker_with_only_null_returns_reports_first_day(make_bars):
    bars = make_bars([("A", "2020-01-01", 1, 1)])
    r = ops.highest_daily_return(bars).collect()[0]
    assert (str(r.date), r.daily_return) == ("2020-01-01", None)


def test_volume_leader_tie_goes_to_smaller_ticker(make_bars):
    bars = make_bars([("B", "2020-01-01", 1, 1), ("A", "2020-01-01", 1, 1)])
    assert ops.highest_volume(bars).collect()[0].ticker == "A"


def test_year_split_returns_equal_plain_returns(make_bars):
    bars = make_bars([
        ("A", "2018-06-01", 1, 4), ("A", "2019-12-30", 1, 5), ("A", "2019-12-31", 1, None),
        ("A", "2021-01-04", 1, 8), ("A", "2021-01-05", 1, 10), ("B", "2021-01-04", 1, 2), ("B", "2022-03-01", 1, 3),
    ])
    want = sorted(map(tuple, ops.daily_returns(bars).collect()))
    got = sorted(map(tuple, ops.daily_returns_year_split(bars).collect()))
    assert got == want
    by_date = {(r[0], str(r[1])): r[3] for r in got}
    assert by_date[("A", "2019-12-30")] == 0.25 and by_date[("A", "2021-01-04")] is None  # previous close NULL
    assert by_date[("B", "2022-03-01")] == 0.5
