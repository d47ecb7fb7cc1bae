"""Operators against a plain-Python statement of their semantics on random
bars with the cases the test tables lack: NULL prices, zero closes, equal
closes, gaps and weekend dates.  Many small tickers go through one Spark job
per operator; each ticker is an independent case."""

from __future__ import annotations

import datetime as dt
import math
import random
from collections import defaultdict

import pytest

from barlab import operators as ops
from barlab.schema import BARS

START, END = dt.date(2020, 1, 10), dt.date(2020, 2, 10)


@pytest.fixture(scope="module")
def cases(spark):
    rnd = random.Random(7)
    prices = [0.0, 1.0, 2.0, 2.0, 3.0, 5.0, 8.0, 8.0, 13.0]
    rows = []
    for t in range(300):
        n = rnd.randint(1, 25)
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 20))
        for _ in range(n):
            day += dt.timedelta(days=rnd.choice([1, 1, 1, 2, 3]))
            o = None if rnd.random() < 0.08 else rnd.choice(prices)
            c = None if rnd.random() < 0.08 else rnd.choice(prices)
            rows.append((f"T{t:03d}", day, o, 13.0, 0.0, c, c, float(rnd.randint(0, 3))))
    # Five dense series on one calendar (D4 skips some days) for correlations.
    for t in range(5):
        for d in range(40):
            if t == 4 and d % 7 == 3:
                continue
            c = None if rnd.random() < 0.1 else rnd.uniform(1, 100)
            rows.append((f"D{t}", dt.date(2020, 1, 1) + dt.timedelta(days=d), 1.0, 100.0, 1.0, c, c, 1.0))
    df = spark.createDataFrame(rows, BARS).cache()
    series = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        series[r[0]].append(r)
    return df, dict(series)


def _close(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    if math.isinf(a) or math.isinf(b):
        return a == b
    return abs(a - b) <= tol * max(1.0, abs(a), abs(b))


def _div(a, b):
    return None if a is None or b is None or b == 0 else a / b


def _returns(rs, drop_missing=False):
    rs = [r for r in rs if not drop_missing or (r[2] is not None and r[5] is not None)]
    out, prev = [], None
    for i, r in enumerate(rs):
        c = r[5]
        out.append((r, None if i == 0 or c is None or prev is None else _div(c - prev, prev)))
        prev = c
    return out


def _stdev(xs):
    xs = [x for x in xs if x is not None]
    if len(xs) < 2:
        return None
    m = sum(xs) / len(xs)
    return math.sqrt(sum((x - m) ** 2 for x in xs) / (len(xs) - 1))


def _sign(r):
    o, c = r[2], r[5]
    if o is None or c is None:
        return 0
    return 1 if c > o else -1 if c < o else 0


def test_daily_returns(cases):
    df, series = cases
    got = {(r.ticker, r.date): r.daily_return for r in ops.daily_returns(df).collect()}
    for rs in series.values():
        for r, want in _returns(rs):
            assert _close(got[(r[0], r[1])], want)


def test_trend_days(cases):
    df, series = cases
    got = {r.ticker: (r.upward_days, r.downward_days, r.neutral_days) for r in ops.trend_days(df).collect()}
    for t, rs in series.items():
        s = [_sign(r) for r in rs]
        assert got[t] == (s.count(1), s.count(-1), s.count(0))


@pytest.mark.parametrize("joined", [False, True])
def test_longest_streaks(cases, joined):
    df, series = cases
    got = {r.ticker: (r.longest_gain, r.longest_loss) for r in ops.longest_streaks(df, join_first_row=joined).collect()}
    for t, rs in series.items():
        runs, run_id, prev = defaultdict(int), None, None
        for i, r in enumerate(rs):
            s = _sign(r)
            if i == 0:
                chg = 0 if joined else None
            else:
                chg = int(s != prev)
            if chg is not None:
                run_id = (run_id or 0) + chg
            runs[(run_id, s)] += 1
            prev = s
        gain = max([n for (_, s), n in runs.items() if s == 1], default=0)
        loss = max([n for (_, s), n in runs.items() if s == -1], default=0)
        assert got[t] == (gain, loss), t


def test_moving_averages(cases):
    df, series = cases
    sma = {(r.ticker, r.date): r.sma for r in ops.sma(df, 3).collect()}
    one = {(r.ticker, r.date): r.ema for r in ops.ema_one_step(df, 3).collect()}
    rec = {(r.ticker, r.date): r.ema for r in ops.ema_recursive(df, 3).collect()}
    for rs in series.values():
        state = None
        for i, r in enumerate(rs):
            window = [x[5] for x in rs[max(0, i - 2) : i + 1] if x[5] is not None]
            assert _close(sma[(r[0], r[1])], sum(window) / len(window) if window else None)
            p = rs[i - 1][5] if i else None
            assert _close(one[(r[0], r[1])], None if r[5] is None or p is None else r[5] * 0.5 + p * 0.5)
            if r[5] is not None:
                state = r[5] if state is None else 0.5 * r[5] + 0.5 * state
                assert _close(rec[(r[0], r[1])], state)
            else:
                assert rec[(r[0], r[1])] is None


@pytest.mark.parametrize("drop", [True, False])
def test_return_consistency(cases, drop):
    df, series = cases
    got = {r.ticker: r.std_dev for r in ops.return_consistency(df, START, END, drop_missing_first=drop, universe=df).collect()}
    for t, rs in series.items():
        sel = [r for r in rs if START <= r[1] <= END]
        sd = _stdev([x for _, x in _returns(sel, drop_missing=drop)])
        assert _close(got[t], float("inf") if sd is None else sd), t


def test_return_histogram(cases):
    df, series = cases
    got = defaultdict(dict)
    for r in ops.return_histogram(df, START, END, bins=5).collect():
        got[r.ticker][r.bin] = r.n
    for t, rs in series.items():
        sel = [r for r in rs if START <= r[1] <= END]
        xs = [x for _, x in _returns(sel, drop_missing=True) if x is not None]
        if not xs:
            assert t not in got
            continue
        lo, hi = min(xs), max(xs)
        want = defaultdict(int)
        for x in xs:
            want[min(math.floor((x - lo) / (hi - lo) * 5), 4) if hi > lo else 0] += 1
        assert got[t] == {b: want.get(b, 0) for b in range(5)}, t


def test_close_extremes(cases):
    df, series = cases
    got = {r.ticker: tuple(r)[1:] for r in ops.close_extremes(df).collect()}
    for t, rs in series.items():
        cs = [(r[5], r[1]) for r in rs if r[5] is not None]
        if not cs:
            assert got[t] == (None, None, None, None)
            continue
        mx = max(c for c, _ in cs)
        mn = min(c for c, _ in cs)
        want = (mx, min(d for c, d in cs if c == mx), mn, min(d for c, d in cs if c == mn))
        assert got[t] == want, t


def test_highest_daily_return(cases):
    df, series = cases
    got = {r.ticker: (r.date, r.daily_return) for r in ops.highest_daily_return(df).collect()}
    for t, rs in series.items():
        rets = _returns(rs)
        valid = [(x, r[1]) for r, x in rets if x is not None]
        if valid:
            best = max(x for x, _ in valid)
            want = (min(d for x, d in valid if x == best), best)
        else:
            want = (rs[0][1], None)
        assert got[t] == want, t


def test_outliers(cases):
    df, series = cases
    got = {r.ticker: r.n_outliers for r in ops.outlier_summary(df, k=1.0).collect()}
    for t, rs in series.items():
        xs = [x for _, x in _returns(rs)]
        vals = [x for x in xs if x is not None]
        sd = _stdev(vals)
        if sd is None:
            assert got[t] == 0
            continue
        m = sum(vals) / len(vals)
        assert got[t] == sum(1 for x in vals if x > m + sd or x < m - sd), t


def test_seasonal_close(cases):
    df, series = cases
    got = {r.ticker: (r.winter, r.spring) for r in ops.seasonal_close(df, START, END, universe=df).collect()}
    assert set(got) == set(series)
    for t, rs in series.items():
        w = [r[5] for r in rs if START <= r[1] <= END and r[5] is not None and r[1].month in (12, 1, 2)]
        assert _close(got[t][0], sum(w) / len(w) if w else None) and got[t][1] is None


def test_best_weekday(cases):
    df, series = cases
    got = {r.ticker: (r.day_of_week, r.avg_return) for r in ops.best_weekday(df).collect()}
    for t, rs in series.items():
        by_day = defaultdict(list)
        for r, x in _returns(rs):
            if x is not None:
                by_day[r[1].weekday()].append(x)
        if not by_day:
            assert t not in got
            continue
        means = {d: sum(v) / len(v) for d, v in by_day.items()}
        best = max(means.values())
        day = min(d for d, m in means.items() if m == best)
        assert got[t][0] == dt.date(2024, 1, 1 + day).strftime("%A") and _close(got[t][1], best), t


def test_ticker_correlation_blocked(cases):
    df, series = cases
    chosen = [f"D{t}" for t in range(5)]
    got = {(r.ticker_x, r.ticker_y): r.corr for r in ops.ticker_correlation(df, chosen, block=2).collect()}
    dates = set.intersection(*[{r[1] for r in series[t]} for t in chosen])
    assert len(dates) == 34
    vals = {t: {r[1]: r[5] for r in series[t]} for t in chosen}
    for a in chosen:
        for b in chosen:
            pairs = [(vals[a][d], vals[b][d]) for d in dates if vals[a][d] is not None and vals[b][d] is not None]
            want = None
            if len(pairs) >= 2:
                mx = sum(x for x, _ in pairs) / len(pairs)
                my = sum(y for _, y in pairs) / len(pairs)
                sxy = sum((x - mx) * (y - my) for x, y in pairs)
                sx = math.sqrt(sum((x - mx) ** 2 for x, _ in pairs))
                sy = math.sqrt(sum((y - my) ** 2 for _, y in pairs))
                want = None if sx * sy == 0 else sxy / (sx * sy)
            assert _close(got[(a, b)], want, 1e-7), (a, b)
            assert want is not None
    single = {(r.ticker_x, r.ticker_y): r.corr for r in ops.ticker_correlation(df, chosen).collect()}
    assert all(_close(single[k], got[k], 1e-12) for k in got)


def _corr(pairs):
    if len(pairs) < 2:
        return None
    mx = sum(x for x, _ in pairs) / len(pairs)
    my = sum(y for _, y in pairs) / len(pairs)
    sx = math.sqrt(sum((x - mx) ** 2 for x, _ in pairs))
    sy = math.sqrt(sum((y - my) ** 2 for _, y in pairs))
    if sx == 0 or sy == 0:
        return None
    return sum((x - mx) * (y - my) for x, y in pairs) / (sx * sy)


def test_describe_stats(cases):
    df, series = cases
    got = {(r.ticker, r.column_name): r for r in ops.describe_stats(df, ["open", "close", "volume"]).collect()}
    pos = {"open": 2, "close": 5, "volume": 7}
    for t, rs in series.items():
        for name, i in pos.items():
            xs = sorted(r[i] for r in rs if r[i] is not None)
            g = got[(t, name)]
            assert g.n == len(xs)
            if not xs:
                assert (g.mean, g.min, g.max, g.median) == (None, None, None, None)
                continue
            mid = len(xs) // 2
            median = xs[mid] if len(xs) % 2 else (xs[mid - 1] + xs[mid]) / 2
            assert _close(g.mean, sum(xs) / len(xs)) and _close(g.stddev, _stdev(xs))
            assert (g.min, g.max) == (xs[0], xs[-1]) and _close(g.median, median), (t, name)


def test_feature_correlation(cases):
    df, series = cases
    got = {(r.ticker, r.feature_x, r.feature_y): r.corr for r in ops.feature_correlation(df, ["open", "close", "volume"]).collect()}
    pos = {"open": 2, "close": 5, "volume": 7}
    for t, rs in series.items():
        for a, i in pos.items():
            for b, j in pos.items():
                pairs = [(r[i], r[j]) for r in rs if r[i] is not None and r[j] is not None]
                assert _close(got[(t, a, b)], _corr(pairs), 1e-7), (t, a, b)


def test_year_split_returns_over_many_years(cases):
    df, _ = cases
    from pyspark.sql import functions as F

    # Spread each random series over several years (day n -> n * 40 days later).
    spread = df.withColumn("date", F.date_add(F.lit("2015-01-01").cast("date"), F.datediff("date", F.lit("2020-01-01")) * 40))
    want = sorted(map(tuple, ops.daily_returns(spread).collect()))
    got = sorted(map(tuple, ops.daily_returns_year_split(spread).collect()))
    assert got == want


@pytest.mark.parametrize("joined", [False, True])
def test_year_split_streaks_over_many_years(cases, joined):
    df, _ = cases
    from pyspark.sql import functions as F

    spread = df.withColumn("date", F.date_add(F.lit("2015-01-01").cast("date"), F.datediff("date", F.lit("2020-01-01")) * 40))
    want = sorted(map(tuple, ops.streak_runs(spread, joined).collect()), key=str)
    got = sorted(map(tuple, ops.streak_runs(spread, joined, year_split=True).collect()), key=str)
    assert got == want
    a = sorted(map(tuple, ops.longest_streaks(spread, joined).collect()))
    b = sorted(map(tuple, ops.longest_streaks(spread, joined, year_split=True).collect()))
    assert a == b


def test_year_split_outliers_over_many_years(cases):
    df, _ = cases
    from pyspark.sql import functions as F

    spread = df.withColumn("date", F.date_add(F.lit("2015-01-01").cast("date"), F.datediff("date", F.lit("2020-01-01")) * 40))
    want = sorted(map(tuple, ops.outlier_summary(spread, k=1.0).collect()))
    got = sorted(map(tuple, ops.outlier_summary(spread, k=1.0, year_split=True).collect()))
    assert got == want
