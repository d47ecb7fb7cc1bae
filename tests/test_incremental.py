"""Period averages brought up to date, medians by selection and shared dates by bitmaps, against
the plain operators on small tables."""

import datetime as dt
import random
import statistics

import pytest

from barlab import operators as ops
from barlab.plans.inspect import physical_plan
from barlab.schema import BARS
from barlab.sources.bars import bars_from_orders
from conftest import SF001

DAY0 = dt.date(2019, 11, 20)


def frame(spark, rows):
    return spark.createDataFrame(rows, BARS)


def walk(ticker, days, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in days:
        p = [round(rnd.uniform(5, 50), 2) for _ in range(5)]
        close = None if rnd.random() < 0.1 else p[3]
        out.append((ticker, DAY0 + dt.timedelta(days=i), p[0], p[1], p[2], close, p[4], float(rnd.randint(1, 9))))
    return out


def as_dict(df):
    return {(r[0], r[1]): [None if x is None else round(x, 9) for x in r[2:]] for r in df.collect()}


@pytest.mark.parametrize("period", ["week", "year"])
@pytest.mark.parametrize("calendar", [False, True])
def test_state_equals_recomputation_after_every_update(spark, tmp_path, period, calendar):
    days = walk("a", range(0, 120)) + walk("b", range(3, 120, 4), 2) + walk("new", range(90, 100), 3)
    cuts = [DAY0 + dt.timedelta(days=d) for d in (40, 41, 95, 120)]
    seen = [r for r in days if r[1] < cuts[0]]
    state = ops.period_state(frame(spark, seen), period, calendar)
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        new = [r for r in days if a <= r[1] < b]
        seen += new
        state = ops.advance(state, frame(spark, new))
        state = ops.advance(state, frame(spark, new))  # a replay changes nothing
        for name, table in (("sums", state.sums), ("last", state.last)):
            table.write.parquet(f"{tmp_path}/{k}/{name}")
        state = ops.PeriodState(*[spark.read.parquet(f"{tmp_path}/{k}/{n}") for n in ("sums", "last")], period, calendar)
        plain = frame(spark, seen)
        assert as_dict(ops.averages_of(state)) == as_dict(ops.period_averages(plain, period, calendar))
        assert as_dict(ops.return_rates_of(state)) == as_dict(ops.return_rates(plain, period, calendar))


def test_empty_updates_and_months(spark):
    rows = frame(spark, walk("a", range(50)))
    none = frame(spark, [])
    state = ops.advance(ops.period_state(none, "month"), rows)
    assert as_dict(ops.return_rates_of(ops.advance(state, none))) == as_dict(ops.return_rates(rows, "month"))
    assert ops.return_rates_of(ops.period_state(none, "month")).collect() == []
    with pytest.raises(ValueError, match="month"):
        ops.averages_of(state)


def test_median_by_selection(spark):
    rnd = random.Random(5)
    values = {
        "one": [3.0],
        "two": [1.0, 2.0],
        "ties": [7.0] * 999 + [1.0, 9.0],
        "halves": [1.0] * 500 + [2.0] * 500,
        "hot": [rnd.lognormvariate(0, 3) for _ in range(60_001)],
        "even": [rnd.uniform(-1e9, 1e9) for _ in range(40_000)],
        "null": [None, None],
        None: [4.0, 6.0, None],
    }
    rows = [(t, DAY0 + dt.timedelta(days=i), v) for t, vs in values.items() for i, v in enumerate(vs)]
    bars = spark.createDataFrame(rows, "ticker string, date date, close double").repartition(9)
    got = {r.ticker: r for r in ops.describe_stats_selected(bars, ["close"]).collect()}
    assert set(got) == set(values)
    for t, vs in values.items():
        some = [v for v in vs if v is not None]
        assert got[t].n == len(some)
        assert got[t].median == (pytest.approx(statistics.median(some), rel=1e-12) if some else None), t
    assert ops.describe_stats_selected(bars.where("false"), ["close"]).collect() == []


def test_median_by_selection_keeps_no_value_lists_and_spreads_a_ticker(spark):
    plan = physical_plan(ops.describe_stats_selected(bars_from_orders(spark, SF001)))
    assert "percentile_approx" in plan and "median(" not in plan and "collect_list" not in plan
    assert "salt" in plan


def test_strings(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), ("a", "é"), ("b", None)], "ticker string, sector string")
    got = {(r.ticker, r.column_name): tuple(r[2:]) for r in ops.describe_strings(df).collect()}
    assert got == {("a", "ticker"): (4, 1, "a", "a"), ("a", "sector"): (3, 2, "x", "é"), ("b", "ticker"): (1, 1, "b", "b"), ("b", "sector"): (0, 0, None, None)}


@pytest.mark.parametrize("chosen", [None, ["a", "b"], ["a", "nowhere"], ["b"]])
def test_shared_dates_by_bitmaps(spark, chosen):
    rows = walk("a", [*range(-40_000, -39_950), *range(0, 300)]) + walk("b", [*range(-39_990, -39_940), *range(7, 400, 3)], 2) + walk("c", range(5, 300, 2), 3)
    rows += [("a", DAY0 + dt.timedelta(days=10), 1.0, 1.0, 1.0, 99.0, 1.0, 1.0), (None, DAY0, *[1.0] * 6), ("a", None, *[1.0] * 6)]
    bars = frame(spark, rows).repartition(5)
    plain = sorted(((r.date, r.ticker, r.close) for r in ops.aligned_closes(bars, chosen).collect()), key=repr)
    got = sorted(((r.date, r.ticker, r.close) for r in ops.aligned_closes_bitmap(bars, chosen).collect()), key=repr)
    assert got == plain and (len(got) > 0) == (chosen != ["a", "nowhere"])
    assert "collect_list" not in physical_plan(ops.aligned_closes_bitmap(bars, chosen))
