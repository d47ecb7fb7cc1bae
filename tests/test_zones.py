"""Zone statistics: same days as the plain analyses, and folders that cannot hold one are skipped."""

import datetime as dt
import random

import pytest

from barlab.operators import ranking, risk, zoned
from barlab.sources.zones import open_zones, save_zones


def rows_of(df):
    """Rows without order, doubles to 12 digits."""
    plain = [tuple(float(f"{v:.12g}") if isinstance(v, float) else v for v in r) for r in df.collect()]
    return sorted(plain, key=lambda r: [str(v) for v in r])


@pytest.fixture
def bars(make_bars):
    """Six years of small steps for four tickers; jumps in two of them only, a tie among
    the best days, a missing close, a zero close; one ticker without any return."""
    rnd, rows = random.Random(3), []
    for t in "ABCD":
        close = 100.0
        for i in range(6 * 50):
            day = dt.date(2010 + i // 50, 1, 1) + dt.timedelta(days=6 * (i % 50))
            step = rnd.choice([-0.01, 0.0, 0.01])
            if t in "AB" and i in (60, 70):
                close, step = 100.0, 0.0
            if t in "AB" and i in (61, 71):
                step = 1.0
            close = close * (1 + step)
            rows.append((t, day.isoformat(), close * 0.99, None if t == "C" and i == 30 else 0.0 if t == "D" and i == 40 else close))
    rows += [("E", "2012-05-01", 5.0, 5.0), ("F", "2012-05-01", None, None), ("F", "2013-05-01", None, 3.0)]
    return make_bars(rows)


def test_same_days_as_on_bars(spark, bars, tmp_path):
    zones = save_zones(bars, f"file://{tmp_path}/zones", parts=3)
    for z in (zones, open_zones(spark, f"file://{tmp_path}/zones")):
        assert rows_of(zoned.outlier_days_zoned(z)) == rows_of(risk.outlier_days(bars))
        assert rows_of(zoned.highest_daily_return_zoned(z)) == rows_of(ranking.highest_daily_return(bars))
        assert rows_of(zoned.best_intraday_zoned(z)) == rows_of(ranking.best_intraday(bars))
        for year in (2011, 2013, 2050):
            assert rows_of(zoned.best_intraday_zoned(z, year)) == rows_of(ranking.best_intraday(bars, year=year))
    assert rows_of(zoned.outlier_days_zoned(zones, 1.0)) == rows_of(risk.outlier_days(bars, 1.0))


def files_read(spark, df):
    """Files that the scans of the rows' folders read, by the scans' own metrics."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "FileSourceScanExec" and "/rows" in node.relation().location().rootPaths().head().toString():
            found.append(node.metrics().apply("numFiles").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_folders_without_such_a_day_are_not_read(spark, make_bars):
    """Twelve years of one ticker, its jumps in one of them."""
    rows = [("A", f"{2000 + i // 40}-{1 + i % 40 // 4:02d}-{1 + 7 * (i % 4):02d}", 1.0, 100.0 + i % 2 + (50.0 if i == 205 else 0.0)) for i in range(480)]
    zones = save_zones(make_bars(rows), parts=4)
    assert len(zones.rows.inputFiles()) == 12
    for df in (zoned.outlier_days_zoned(zones), zoned.highest_daily_return_zoned(zones), zoned.best_intraday_zoned(zones)):
        assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString().lower()
        assert files_read(spark, df) == [1]


def test_empty_and_keyless_bars(spark, bars, make_bars):
    none = bars.where("false")
    zones = save_zones(none)
    assert zoned.outlier_days_zoned(zones).count() == zoned.highest_daily_return_zoned(zones).count() == zoned.best_intraday_zoned(zones).count() == 0
