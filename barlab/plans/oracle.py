"""DuckDB SQL stating each registered query independently of Spark.

Tables ``orders`` etc. are views over the same parquet files.  Rounding is
``round(x * 1e6) / 1e6`` (half away from zero), plus ``0.0`` so a negative
zero prints as zero, matching Spark's ``round6``.  Integer results are cast
to the widths Spark returns (INTEGER for period numbers and row numbers,
BIGINT for counts and run ids).  DuckDB's ``corr`` gives NaN where Spark's
guarded form gives NULL, so NaN maps to NULL.
"""

from __future__ import annotations

from barlab.plans.catalog import BINS, END, EVENTS_END, EVENTS_START, MONTH, N_AVG, N_ROWS, START, YEAR
from barlab.schema import PRICE_COLUMNS

S, E = f"DATE '{START.isoformat()}'", f"DATE '{END.isoformat()}'"
ALPHA = f"(CAST(2 AS DOUBLE) / {N_AVG + 1})"


def r6(x: str) -> str:
    return f"(round(({x}) * 1000000.0) / 1000000.0 + 0.0)"


def avg_d(x: str) -> str:
    """Average summed in date order: Spark aggregates a window's output, which
    holds each ticker in one partition sorted by date, so that is its order."""
    return f"avg({x} ORDER BY date)"


def nan_null(x: str) -> str:
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"


BARS_BODY = """
  SELECT o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS date,
         arg_min(p, o_orderkey) AS open, max(p) AS high, min(p) AS low,
         arg_max(p, o_orderkey) AS close,
         (max(p) + min(p) + arg_max(p, o_orderkey)) / 3.0 AS adj_close,
         CAST(count(*) AS DOUBLE) AS volume
  FROM (SELECT o_orderpriority, o_orderdate, o_orderkey,
               CASE WHEN isnan(o_totalprice) THEN NULL ELSE o_totalprice END AS p
        FROM orders)
  GROUP BY 1, 2"""

EVENTS_BODY = """
  SELECT event_type AS ticker, CAST(ts AS DATE) AS date,
         arg_min(p, event_id) AS open, max(p) AS high, min(p) AS low,
         arg_max(p, event_id) AS close,
         (max(p) + min(p) + arg_max(p, event_id)) / 3.0 AS adj_close,
         CAST(count(*) AS DOUBLE) AS volume
  FROM (SELECT event_type, ts, event_id,
               CASE WHEN isnan(value) THEN NULL ELSE value END AS p
        FROM events)
  GROUP BY 1, 2"""

BARS = f"bars AS ({BARS_BODY})"
RETS = """rets AS (
  SELECT *, (close - prev_close) / nullif(prev_close, 0) AS daily_return,
         close - prev_close AS daily_change
  FROM (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY date) AS prev_close FROM bars))"""
MCHG = """mchg AS (
  SELECT *, close - lag(close) OVER (PARTITION BY ticker ORDER BY month(date), date) AS monthly_change
  FROM rets)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _bar_cols() -> str:
    return "ticker, date, " + ", ".join(f"{r6(c)} AS {c}" for c in PRICE_COLUMNS)


_PERIOD = {"week": "weekofyear(date)", "month": "month(date)", "year": "year(date)"}


def _period_averages(period: str) -> str:
    key = _PERIOD[period]
    src = "mchg" if period == "month" else "rets"
    change = {"week": f", {r6(avg_d('daily_change'))} AS avg_change", "month": f", {r6(avg_d('monthly_change'))} AS avg_change"}
    ctes = [BARS, RETS] + ([MCHG] if period == "month" else [])
    return with_(*ctes) + (
        f"SELECT ticker, CAST({key} AS INTEGER) AS period, {r6(avg_d('open'))} AS avg_open, "
        f"{r6(avg_d('close'))} AS avg_close, {r6(avg_d('daily_return'))} AS avg_return{change.get(period, '')} "
        f"FROM {src} GROUP BY ticker, {key}"
    )


def _return_rates(period: str) -> str:
    key = _PERIOD[period]
    return with_(BARS, RETS) + (
        f"SELECT ticker, CAST({key} AS INTEGER) AS period, {r6(avg_d('daily_return'))} AS avg_return, "
        f"{r6(avg_d('close') + ' - ' + avg_d('open'))} AS return_rate FROM rets GROUP BY ticker, {key}"
    )


def _mean_of_means(src: str, value: str, ctes: list[str]) -> str:
    parts = [
        f"{p} AS (SELECT ticker, avg(v) AS m FROM (SELECT ticker, {value} AS v FROM {src} GROUP BY ticker, {_PERIOD[p]}) GROUP BY ticker)"
        for p in ("week", "month", "year")
    ]
    return with_(*ctes, *parts) + (
        f"SELECT ticker, {r6('week.m')} AS avg_weekly, {r6('month.m')} AS avg_monthly, {r6('year.m')} AS avg_yearly "
        "FROM week JOIN month USING (ticker) JOIN year USING (ticker)"
    )


def _avg_volume(period: str) -> str:
    if period == "day":
        return with_(BARS) + f"SELECT ticker, {r6('avg(volume)')} AS avg_volume FROM bars GROUP BY ticker"
    return with_(BARS) + (
        f"SELECT ticker, {r6('avg(v)')} AS avg_volume FROM "
        f"(SELECT ticker, avg(volume) AS v FROM bars GROUP BY ticker, {_PERIOD[period]}) GROUP BY ticker"
    )


def _feature_correlation() -> str:
    feats = list(PRICE_COLUMNS)
    pairs = [(a, b) for i, a in enumerate(feats) for b in feats[i:]]
    moments = ", ".join(f"corr({a}, {b}) AS c{i}" for i, (a, b) in enumerate(pairs))
    selects = []
    for i, (a, b) in enumerate(pairs):
        val = r6(nan_null(f"c{i}"))
        selects.append(f"SELECT ticker, '{a}' AS feature_x, '{b}' AS feature_y, {val} AS corr FROM m")
        if a != b:
            selects.append(f"SELECT ticker, '{b}' AS feature_x, '{a}' AS feature_y, {val} AS corr FROM m")
    return with_(BARS, f"m AS (SELECT ticker, {moments} FROM bars GROUP BY ticker)") + "\nUNION ALL\n".join(selects)


def _streaks(join_first_row: bool) -> str:
    chg = "CAST(sign <> lag(sign) OVER (PARTITION BY ticker ORDER BY date) AS INTEGER)"
    if join_first_row:
        chg = f"coalesce({chg}, 0)"
    return [
        BARS,
        "s AS (SELECT ticker, date, CASE WHEN close > open THEN 1 WHEN close < open THEN -1 ELSE 0 END AS sign FROM bars)",
        f"c AS (SELECT *, {chg} AS chg FROM s)",
        "i AS (SELECT *, sum(chg) OVER (PARTITION BY ticker ORDER BY date "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM c)",
        "runs AS (SELECT ticker, CAST(sid AS BIGINT) AS streak_id, sign, count(*) AS n FROM i GROUP BY ticker, sid, sign)",
    ]


def _longest(join_first_row: bool) -> str:
    return with_(*_streaks(join_first_row)) + (
        "SELECT ticker, coalesce(max(n) FILTER (WHERE sign = 1), 0) AS longest_gain, "
        "coalesce(max(n) FILTER (WHERE sign = -1), 0) AS longest_loss FROM runs GROUP BY ticker"
    )


# Shared pieces of the dispersion queries.
SEL_RETS = [
    BARS,
    f"sel AS (SELECT * FROM bars WHERE date BETWEEN {S} AND {E} AND open IS NOT NULL AND close IS NOT NULL)",
    "sr AS (SELECT ticker, (close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) AS ret FROM sel "
    "WINDOW w AS (PARTITION BY ticker ORDER BY date))",
    "rr AS (SELECT * FROM sr WHERE ret IS NOT NULL)",
]
CONSISTENCY = SEL_RETS + [
    "cons AS (SELECT ticker, coalesce(stddev_samp(ret), CAST('inf' AS DOUBLE)) AS std_dev FROM rr GROUP BY ticker)"
]
OUTLIERS = [
    BARS,
    RETS,
    "st AS (SELECT *, avg(daily_return) OVER (PARTITION BY ticker) AS m, "
    "stddev_samp(daily_return) OVER (PARTITION BY ticker) AS s FROM rets)",
    "fl AS (SELECT *, coalesce((daily_return > m + 3 * s) OR (daily_return < m - 3 * s), false) AS is_out FROM st)",
]
WEEKDAY = [
    BARS,
    RETS,
    "wd AS (SELECT ticker, dayname(date) AS day_of_week, isodow(date) AS dow, avg(daily_return ORDER BY date) AS avg_return "
    "FROM rets WHERE daily_return IS NOT NULL GROUP BY ticker, dayname(date), isodow(date))",
]


SHARED_DATES = "SELECT date FROM sel GROUP BY date HAVING count(DISTINCT ticker) = (SELECT count(DISTINCT ticker) FROM sel)"


def _ticker_correlation(feature: str = "close", where: str = "") -> str:
    return with_(
        BARS,
        f"sel AS (SELECT ticker, date, {feature} AS v FROM bars {where})",
        f"a AS (SELECT * FROM sel WHERE date IN ({SHARED_DATES}))",
        "pc AS (SELECT x.ticker AS tx, y.ticker AS ty, corr(x.v, y.v) AS c FROM a x JOIN a y USING (date) GROUP BY x.ticker, y.ticker)",
        "t AS (SELECT DISTINCT ticker FROM sel)",
    ) + (
        # The full k x k grid, NULL where a pair has no shared dates.
        f"SELECT t1.ticker AS ticker_x, t2.ticker AS ticker_y, {r6(nan_null('pc.c'))} AS corr "
        "FROM t t1 CROSS JOIN t t2 LEFT JOIN pc ON pc.tx = t1.ticker AND pc.ty = t2.ticker"
    )


TWO = "WHERE ticker IN ('1-URGENT', '5-LOW')"


def _event_bars(ticker: str) -> str:
    """Bars of the events with the series told by a SQL expression."""
    body = EVENTS_BODY.replace("event_type AS ticker", "series AS ticker").replace("SELECT event_type, ts", f"SELECT CAST({ticker} AS VARCHAR) AS series, ts")
    return body


def _orders_as_bars(ticker: str) -> str:
    cols = ", ".join(f"max(o_totalprice) AS {c}" for c in PRICE_COLUMNS)
    return f"SELECT CAST({ticker} AS VARCHAR) AS ticker, CAST(o_orderdate AS DATE) AS date, {cols} FROM orders GROUP BY 1, 2"


def _seasonal() -> str:
    seasons = {"winter": "12, 1, 2", "spring": "3, 4, 5", "summer": "6, 7, 8", "autumn": "9, 10, 11"}
    cols = ", ".join(
        f"{r6(f'avg(close) FILTER (WHERE month(date) IN ({m}))')} AS {name}" for name, m in seasons.items()
    )
    return with_(BARS) + f"SELECT ticker, {cols} FROM bars WHERE date BETWEEN {S} AND {E} GROUP BY ticker"


ORACLE_SQL: dict[str, str] = {
    "bars": with_(BARS) + f"SELECT {_bar_cols()} FROM bars",
    "load_bars_range": with_(BARS) + f"SELECT {_bar_cols()} FROM bars WHERE date >= {S} AND date < {E}",
    "first_rows": with_(BARS)
    + f"SELECT {_bar_cols()}, CAST(rn AS INTEGER) AS rn FROM "
    f"(SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn FROM bars) WHERE rn <= {N_ROWS}",
    "last_rows": with_(BARS)
    + f"SELECT {_bar_cols()}, CAST(rn AS INTEGER) AS rn FROM "
    f"(SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM bars) WHERE rn <= {N_ROWS}",
    "describe_stats": with_(
        BARS,
        "long AS ("
        + " UNION ALL ".join(f"SELECT ticker, '{c}' AS column_name, {c} AS value FROM bars" for c in PRICE_COLUMNS)
        + ")",
    )
    + (
        f"SELECT ticker, column_name, count(value) AS n, {r6('avg(value)')} AS mean, "
        f"{r6('stddev_samp(value)')} AS stddev, {r6('min(value)')} AS min, {r6('max(value)')} AS max, "
        f"{r6('median(value)')} AS median FROM long GROUP BY ticker, column_name"
    ),
    "bar_coverage": with_(BARS)
    + "SELECT ticker, count(*) AS n_bars, min(date) AS first_date, max(date) AS last_date FROM bars GROUP BY ticker",
    "feature_correlation": _feature_correlation(),
    "load_bars_mapped": with_(f"bars AS ({_orders_as_bars('o_orderkey')})") + f"SELECT {_bar_cols()} FROM bars",
    "load_bars_tickers": with_(f"bars AS ({_orders_as_bars('o_orderpriority')})")
    + f"SELECT {_bar_cols()} FROM bars {TWO} AND date >= {S} AND date < {E}",
    "union_bars": f"WITH o AS ({_orders_as_bars('o_orderkey')}),\nbars AS (SELECT * FROM o WHERE date >= {S} AND date < {E} "
    f"UNION ALL BY NAME {BARS_BODY} UNION ALL BY NAME {EVENTS_BODY})\nSELECT {_bar_cols()} FROM bars",
    "aligned_closes": with_(BARS, "sel AS (SELECT ticker, date, close FROM bars)")
    + f"SELECT date, ticker, {r6('close')} AS close FROM sel WHERE date IN ({SHARED_DATES})",
    "aligned_wide": with_(BARS, f"sel AS (SELECT * FROM bars {TWO})")
    + "SELECT date, "
    + ", ".join(f"""{r6(f"max(close) FILTER (WHERE ticker = '{t}')")} AS "{t}_close\"""" for t in ("1-URGENT", "5-LOW"))
    + " FROM sel GROUP BY date HAVING count(DISTINCT ticker) = 2",
    "ticker_correlation": _ticker_correlation(),
    "ticker_correlation_open": _ticker_correlation("open", TWO),
    "ticker_correlation_volume": _ticker_correlation("volume", TWO),
    "ticker_correlation_12_series": _ticker_correlation().replace(BARS_BODY, _event_bars("user_id % 12")),
    "ticker_correlation_no_shared_date": _ticker_correlation().replace(BARS_BODY, _event_bars("day(ts) % 9")),
    "daily_returns": with_(BARS, RETS)
    + f"SELECT ticker, date, {r6('close')} AS close, {r6('daily_return')} AS daily_return, "
    f"{r6('daily_change')} AS daily_change FROM rets",
    "monthly_price_change": with_(BARS, RETS, MCHG)
    + f"SELECT ticker, date, {r6('close')} AS close, {r6('monthly_change')} AS monthly_change FROM mchg",
    "calendar_month_change": with_(BARS, "lc AS (SELECT ticker, CAST(date_trunc('month', date) AS DATE) AS month, arg_max(close, date) AS last_close "
    "FROM bars WHERE close IS NOT NULL GROUP BY 1, 2)")
    + f"SELECT ticker, month, {r6('last_close')} AS last_close, "
    + r6("last_close - lag(last_close) OVER (PARTITION BY ticker ORDER BY month)")
    + " AS monthly_change FROM lc",
    "intraday_returns": with_(BARS) + f"SELECT ticker, date, {r6('(close - open) / nullif(open, 0)')} AS return_rate FROM bars",
    "weekly_averages": _period_averages("week"),
    "monthly_averages": _period_averages("month"),
    "yearly_averages": _period_averages("year"),
    "monthly_averages_calendar": _period_averages("month")
    .replace("CAST(month(date) AS INTEGER)", "CAST(date_trunc('month', date) AS DATE)")
    .replace("GROUP BY ticker, month(date)", "GROUP BY ticker, date_trunc('month', date)"),
    "overall_average_return": _mean_of_means("rets", avg_d("daily_return"), [BARS, RETS]),
    "return_rate_weekly": _return_rates("week"),
    "return_rate_monthly": _return_rates("month"),
    "return_rate_yearly": _return_rates("year"),
    "overall_return_rate": _mean_of_means("bars", "avg(close) - avg(open)", [BARS]),
    "highest_daily_return": with_(BARS, RETS)
    + f"SELECT ticker, date, {r6('daily_return')} AS daily_return FROM "
    "(SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY daily_return DESC NULLS LAST, date) AS rn FROM rets) "
    "WHERE rn = 1",
    "highest_daily_return_overall": with_(BARS, RETS)
    + f"SELECT ticker, date, {r6('daily_return')} AS daily_return FROM rets "
    "ORDER BY daily_return DESC NULLS LAST, date, ticker LIMIT 1",
    "best_intraday_month": with_(BARS)
    + f"SELECT date, ticker, {r6('rr')} AS return_rate FROM "
    f"(SELECT date, ticker, (close - open) / nullif(open, 0) AS rr FROM bars WHERE month(date) = {MONTH}) "
    "ORDER BY rr DESC NULLS LAST, date, ticker LIMIT 1",
    "best_intraday_year": with_(BARS)
    + f"SELECT date, ticker, {r6('rr')} AS return_rate FROM "
    f"(SELECT date, ticker, (close - open) / nullif(open, 0) AS rr FROM bars "
    f"WHERE date BETWEEN DATE '{YEAR}-01-01' AND DATE '{YEAR}-12-31') "
    "ORDER BY rr DESC NULLS LAST, date, ticker LIMIT 1",
    "close_extremes": with_(
        BARS,
        "mx AS (SELECT ticker, close AS max_close, date AS max_close_date FROM (SELECT *, row_number() OVER "
        "(PARTITION BY ticker ORDER BY close DESC, date) AS rn FROM bars WHERE close IS NOT NULL) WHERE rn = 1)",
        "mn AS (SELECT ticker, close AS min_close, date AS min_close_date FROM (SELECT *, row_number() OVER "
        "(PARTITION BY ticker ORDER BY close ASC, date) AS rn FROM bars WHERE close IS NOT NULL) WHERE rn = 1)",
    )
    + f"SELECT ticker, {r6('max_close')} AS max_close, max_close_date, {r6('min_close')} AS min_close, "
    "min_close_date FROM mx JOIN mn USING (ticker)",
    "sma": with_(BARS)
    + f"SELECT ticker, date, {r6('close')} AS close, "
    + r6(f"avg(close) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN {N_AVG - 1} PRECEDING AND CURRENT ROW)")
    + " AS sma FROM bars",
    "sma_full_window": with_(BARS)
    + f"SELECT ticker, date, {r6('close')} AS close, CASE WHEN count(close) OVER w >= {N_AVG} THEN {r6('avg(close) OVER w')} END AS sma FROM bars "
    f"WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN {N_AVG - 1} PRECEDING AND CURRENT ROW)",
    "ema_one_step": with_(BARS)
    + f"SELECT ticker, date, {r6('close')} AS close, "
    + r6(f"close * {ALPHA} + lag(close) OVER (PARTITION BY ticker ORDER BY date) * (1 - {ALPHA})")
    + " AS ema FROM bars",
    "ema_recursive": "WITH RECURSIVE "
    + ",\n".join(
        [
            BARS,
            "s AS (SELECT ticker, date, close, row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn FROM bars)",
            "e(ticker, rn, date, close, ema) AS (SELECT ticker, rn, date, close, close FROM s WHERE rn = 1 "
            f"UNION ALL SELECT s.ticker, s.rn, s.date, s.close, {ALPHA} * s.close + (1 - {ALPHA}) * e.ema "
            "FROM e JOIN s ON s.ticker = e.ticker AND s.rn = e.rn + 1)",
        ]
    )
    + f"\nSELECT ticker, date, {r6('close')} AS close, {r6('ema')} AS ema FROM e",
    "return_histogram": with_(
        *SEL_RETS,
        "st AS (SELECT ticker, min(ret) AS lo, max(ret) AS hi FROM rr GROUP BY ticker)",
        f"b AS (SELECT rr.ticker, CASE WHEN hi > lo THEN CAST(least(floor((ret - lo) / nullif(hi - lo, 0) * {BINS}), "
        f"{BINS - 1}) AS INTEGER) ELSE 0 END AS bin FROM rr JOIN st USING (ticker))",
        "cnt AS (SELECT ticker, bin, count(*) AS n FROM b GROUP BY ticker, bin)",
        f"grid AS (SELECT ticker, lo, hi, CAST(unnest(range({BINS})) AS INTEGER) AS bin FROM st)",
    )
    + (
        f"SELECT g.ticker, g.bin, {r6(f'lo + bin * (hi - lo) / {BINS}')} AS bin_low, "
        f"{r6(f'lo + (bin + 1) * (hi - lo) / {BINS}')} AS bin_high, coalesce(n, 0) AS n "
        "FROM grid g LEFT JOIN cnt USING (ticker, bin)"
    ),
    "return_consistency": with_(*CONSISTENCY) + f"SELECT ticker, {r6('std_dev')} AS std_dev FROM cons",
    "most_consistent_top3": with_(*CONSISTENCY)
    + f"SELECT ticker, {r6('std_dev')} AS std_dev FROM cons ORDER BY std_dev, ticker LIMIT 3",
    "outlier_summary": with_(*OUTLIERS) + "SELECT ticker, count(*) FILTER (WHERE is_out) AS n_outliers FROM fl GROUP BY ticker",
    "outlier_days": with_(*OUTLIERS) + f"SELECT ticker, date, {r6('daily_return')} AS daily_return FROM fl WHERE is_out",
    "avg_volume_daily": _avg_volume("day"),
    "avg_volume_weekly": _avg_volume("week"),
    "avg_volume_monthly": _avg_volume("month"),
    "avg_volume_yearly": _avg_volume("year"),
    "highest_volume": with_(BARS)
    + f"SELECT ticker, {r6('v')} AS avg_volume FROM (SELECT ticker, avg(volume) AS v FROM bars GROUP BY ticker) "
    "ORDER BY v DESC NULLS LAST, ticker LIMIT 1",
    **{f"highest_volume_{p}ly": f"SELECT * FROM ({_avg_volume(p)}) ORDER BY avg_volume DESC NULLS LAST, ticker LIMIT 1" for p in ("week", "month", "year")},
    "trend_days": with_(BARS)
    + "SELECT ticker, count(*) FILTER (WHERE close > open) AS upward_days, "
    "count(*) FILTER (WHERE close < open) AS downward_days, "
    "count(*) FILTER (WHERE NOT coalesce(close > open OR close < open, false)) AS neutral_days "
    "FROM bars GROUP BY ticker",
    "weekday_returns": with_(*WEEKDAY)
    + f"SELECT ticker, CAST(dow - 1 AS INTEGER) AS day_index, day_of_week, {r6('avg_return')} AS avg_return FROM wd",
    "weekday_returns_weekdays_only": with_(*WEEKDAY)
    + f"SELECT ticker, CAST(dow - 1 AS INTEGER) AS day_index, day_of_week, {r6('avg_return')} AS avg_return FROM wd WHERE dow <= 5",
    "best_weekday": with_(*WEEKDAY)
    + f"SELECT ticker, day_of_week, {r6('avg_return')} AS avg_return FROM "
    "(SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY avg_return DESC, dow) AS rn FROM wd) WHERE rn = 1",
    "seasonal_close": _seasonal(),
    "streak_runs": with_(*_streaks(False)) + "SELECT ticker, streak_id, sign, n FROM runs WHERE sign <> 0",
    "longest_streaks": _longest(False),
    "longest_streaks_joined": _longest(True),
}


# Second fixture: the same statements over bars built from the events table.
for _name in (
    "bars", "daily_returns", "describe_stats", "aligned_closes", "ticker_correlation", "weekly_averages",
    "sma", "ema_recursive", "outlier_summary", "trend_days", "longest_streaks", "close_extremes",
    "first_rows", "feature_correlation", "monthly_price_change", "highest_daily_return", "best_intraday_month",
    "best_weekday", "streak_runs", "return_histogram", "return_consistency", "seasonal_close",
):
    ORACLE_SQL[f"{_name}_events"] = (
        ORACLE_SQL[_name]
        .replace(BARS_BODY, EVENTS_BODY)
        .replace(S, f"DATE '{EVENTS_START.isoformat()}'")
        .replace(E, f"DATE '{EVENTS_END.isoformat()}'")
    )


# Many-ticker variant: one series per customer.
CUSTOMER_BODY = BARS_BODY.replace(
    "SELECT o_orderpriority AS ticker", "SELECT CAST(o_custkey AS VARCHAR) AS ticker"
).replace("FROM (SELECT o_orderpriority, o_orderdate", "FROM (SELECT o_custkey, o_orderdate")
for _name in (
    "bars", "daily_returns", "weekly_averages", "highest_daily_return", "close_extremes", "ema_recursive", "sma",
    "return_histogram", "return_consistency", "outlier_summary", "trend_days", "best_weekday", "longest_streaks",
):
    ORACLE_SQL[f"{_name}_by_customer"] = ORACLE_SQL[_name].replace(BARS_BODY, CUSTOMER_BODY)


# The year-split variant computes the same rows as the plain daily returns.
for _suffix in ("", "_events", "_by_customer"):
    ORACLE_SQL[f"daily_returns_year_split{_suffix}"] = ORACLE_SQL[f"daily_returns{_suffix}"]
# So do the year-split streaks, run numbers included.
ORACLE_SQL["streak_runs_year_split"] = ORACLE_SQL["streak_runs"]
ORACLE_SQL["longest_streaks_year_split"] = ORACLE_SQL["longest_streaks"]
ORACLE_SQL["longest_streaks_year_split_by_customer"] = ORACLE_SQL["longest_streaks_by_customer"]
# And the year-split outliers.
ORACLE_SQL["outlier_summary_year_split"] = ORACLE_SQL["outlier_summary"]
ORACLE_SQL["outlier_days_year_split"] = ORACLE_SQL["outlier_days"]
ORACLE_SQL["outlier_summary_year_split_by_customer"] = ORACLE_SQL["outlier_summary_by_customer"]
# And the year-split moving averages.
for _name in ("sma", "sma_full_window", "ema_one_step", "ema_recursive"):
    ORACLE_SQL[f"{_name}_year_split"] = ORACLE_SQL[_name]
for _name in ("sma", "ema_recursive"):
    ORACLE_SQL[f"{_name}_year_split_by_customer"] = ORACLE_SQL[f"{_name}_by_customer"]
del ORACLE_SQL["sma_by_customer"]
# And the streaks from merged summaries.
for _name in ("longest_streaks", "longest_streaks_joined"):
    ORACLE_SQL[f"{_name}_merged"] = ORACLE_SQL[_name]
for _suffix in ("_events", "_by_customer"):
    ORACLE_SQL[f"longest_streaks_merged{_suffix}"] = ORACLE_SQL[f"longest_streaks{_suffix}"]
# Analyses on the bars table.
for _name in ("bars", "daily_returns", "outlier_summary", "longest_streaks", "ema_recursive", "close_extremes"):
    ORACLE_SQL[f"{_name}_table"] = ORACLE_SQL[f"{_name}_by_customer"]
# Averages kept up to date: sums of the three parts that the query adds one after the other.
def _updated(period: str, select: str) -> str:
    key, kept = _PERIOD[period], ("open", "close", "daily_return", "daily_change")
    part = f"CASE WHEN date < {S} THEN 0 WHEN year(date) < {END.year} THEN 1 ELSE 2 END"
    inner = ", ".join(f"sum({c} ORDER BY date) AS s_{c}, count({c}) AS n_{c}" for c in kept)
    outer = ", ".join(f"sum(s_{c} ORDER BY part) / nullif(sum(n_{c}), 0) AS m_{c}" for c in kept)
    return with_(
        BARS,
        RETS,
        f"parts AS (SELECT ticker, CAST({key} AS INTEGER) AS period, {part} AS part, {inner} FROM rets GROUP BY ALL)",
        f"means AS (SELECT ticker, period, {outer} FROM parts GROUP BY ticker, period)",
    ) + f"SELECT ticker, period, {select} FROM means"


ORACLE_SQL["weekly_averages_updated"] = _updated(
    "week", ", ".join(f"{r6('m_' + c)} AS avg_{c.removeprefix('daily_')}" for c in ("open", "close", "daily_return", "daily_change"))
)
ORACLE_SQL["weekly_averages_updated_by_customer"] = ORACLE_SQL["weekly_averages_updated"].replace(BARS_BODY, CUSTOMER_BODY)
ORACLE_SQL["return_rate_monthly_updated"] = _updated("month", f"{r6('m_daily_return')} AS avg_return, {r6('m_close - m_open')} AS return_rate")
# Medians by selection and shared dates by bitmaps give the plain rows.
for _suffix in ("", "_events"):
    ORACLE_SQL[f"describe_stats_selected{_suffix}"] = ORACLE_SQL[f"describe_stats{_suffix}"]
    ORACLE_SQL[f"aligned_closes_bitmap{_suffix}"] = ORACLE_SQL[f"aligned_closes{_suffix}"]
ORACLE_SQL["describe_strings"] = with_(BARS) + (
    "SELECT ticker, 'ticker' AS column_name, count(ticker) AS n, count(DISTINCT ticker) AS n_distinct, min(ticker) AS min, max(ticker) AS max FROM bars GROUP BY ticker"
)
# Days found by way of zone statistics.
for _name in ("outlier_days", "highest_daily_return", "best_intraday_year"):
    ORACLE_SQL[f"{_name}_zoned"] = ORACLE_SQL[_name]
ORACLE_SQL["highest_daily_return_zoned_by_customer"] = ORACLE_SQL["highest_daily_return_by_customer"]
