"""Plan shape: windows are partitioned by ticker (never a single-partition
exchange under a window), scans read only needed columns, predicates reach
the Parquet reader, aggregates after a window reuse its partitioning."""

import re

import pytest

from barlab.plans.inspect import physical_plan
from barlab.sources.bars import bars_from_orders
from barlab import operators as ops
from conftest import SF001

from barlab.plans.catalog import QUERIES, finish
from barlab.plans.pages import pages
from barlab.sources.table import save_bars_table

# One partial row per task with the ticker names meets in one task.
GLOBAL_AGG_OK = {q for q in QUERIES if q.startswith(("ticker_correlation", "aligned_closes"))}


def _exchanges(plan: str) -> list[str]:
    return [line.strip() for line in plan.splitlines() if "Exchange" in line]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_single_partition_exchange(spark, name):
    plan = physical_plan(QUERIES[name](spark, SF001))
    single = [e for e in _exchanges(plan) if "SinglePartition" in e]
    if name in GLOBAL_AGG_OK:
        # only under the final merge of partial aggregates, never below a Window
        for line in plan.splitlines():
            if "SinglePartition" in line:
                assert "Window" not in plan.split(line)[1].split("Exchange")[0]
    else:
        assert single == [], plan


def test_scan_reads_only_needed_columns(spark):
    plan = physical_plan(QUERIES["trend_days"](spark, SF001))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan
    assert "o_custkey" not in plan and "o_orderstatus" not in plan


def test_ticker_filter_reaches_parquet(spark):
    bars = bars_from_orders(spark, SF001)
    plan = physical_plan(ops.ticker_correlation(bars, ["1-URGENT", "2-HIGH"]))
    pushed = [part.split("]]")[0] for part in plan.split("PushedFilters: [")[1:]]
    assert pushed and all("In(o_orderpriority, [1-URGENT,2-HIGH" in p for p in pushed), pushed


@pytest.mark.parametrize("name", sorted(GLOBAL_AGG_OK))
def test_cross_ticker_queries_scan_once(spark, name):
    df = QUERIES[name](spark, SF001)
    df.collect()
    final = executed(physical_plan(df))
    assert final.count("FileScan") == 1, final


def executed(plan: str) -> str:
    """The final plans, subqueries included, without the initial ones."""
    out, skip = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth >= skip:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        if skip is None:
            out.append(line)
    return "\n".join(out)


def test_building_the_matrix_runs_no_job(spark):
    bars = bars_from_orders(spark, SF001)
    spark.sparkContext.setJobGroup("build", "build")
    ops.ticker_correlation(bars)
    ops.aligned_closes(bars)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("build")) == 0
    spark.sparkContext.setJobGroup("tests", "tests")


@pytest.mark.parametrize("name", ["return_consistency", "most_consistent_top3", "seasonal_close"])
def test_range_queries_scan_once(spark, name):
    assert physical_plan(QUERIES[name](spark, SF001)).count("FileScan") == 1


YEAR_SPLITS = sorted(q for q in QUERIES if "year_split" in q and not q.endswith(("_events", "_by_customer")))


@pytest.mark.parametrize("name", YEAR_SPLITS)
def test_year_split_moves_no_rows_by_ticker_alone(spark, name):
    """Without broadcasts, only per-year rows meet by ticker; the bars' rows stay
    where (ticker, year) put them."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical_plan(QUERIES[name](spark, SF001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = plan.splitlines()
    at = [i for i, x in enumerate(lines) if "hashpartitioning(ticker#" in x and x.split("hashpartitioning(")[1].split(")")[0].count("#") == 1]
    assert at, plan
    for i in at:
        # What moves by ticker comes out of an aggregate by (ticker, year).
        below = [x for x in lines[i + 1 : i + 4] if "Project" not in x]
        assert re.search(r"Aggregate\(keys=\[ticker#\d+(, _y#\d+\]|\].*functions=\[partial_)", below[0]), plan


def test_merged_streaks_move_days_by_month_only(spark):
    plan = physical_plan(QUERIES["longest_streaks_merged"](spark, SF001))
    keys = [x.split("hashpartitioning(")[1].split(", 8)")[0] for x in plan.splitlines() if "hashpartitioning(" in x]
    assert "Window" not in plan and len(keys) == 3 and "_m#" in keys[1], plan


def test_series_analyses_on_the_bars_table_need_no_exchange_and_no_sort(spark):
    bars = save_bars_table(bars_from_orders(spark, SF001, ticker="o_custkey"), "bars_plan_test", buckets=8)
    windowed = [ops.daily_returns, ops.sma, ops.ema_one_step, ops.outlier_days, ops.streak_runs, ops.longest_streaks, ops.weekday_returns, ops.highest_daily_return]
    for op in [*windowed, ops.close_extremes, ops.trend_days]:
        plan = physical_plan(op(bars))
        assert "Exchange" not in plan and "Bucketed: true" in plan, plan
        if op in (ops.daily_returns, ops.sma, ops.ema_one_step, ops.outlier_days):
            assert "Sort" not in plan, plan
    # The same rows as without the table.
    want = ops.longest_streaks(bars_from_orders(spark, SF001, ticker="o_custkey"))
    assert sorted(map(tuple, ops.longest_streaks(bars).collect())) == sorted(map(tuple, want.collect()))


def test_pages_on_a_table_read_the_ticks_once(spark):
    """The table is written by one scan of the ticks; no page has another."""
    ticks = bars_from_orders(spark, SF001)
    assert physical_plan(ticks).count("FileScan") == 1
    out = pages(ticks, start="1996-01-01", end="1998-12-31", month=1, year=1997, table="bars_pages_test")
    plain = pages(ticks, start="1996-01-01", end="1998-12-31", month=1, year=1997)
    for name, df in out.items():
        plan = physical_plan(df)
        assert "bars_pages_test" in plan and "o_totalprice" not in plan, name
        assert finish(df).count() == plain[name].count(), name


def test_window_then_aggregate_shuffles_bars_once(spark):
    plan = physical_plan(QUERIES["weekly_averages"](spark, SF001))
    ex = _exchanges(plan)
    # ticks -> bars (ticker, date), bars -> series (ticker); the group-by reuses it
    assert len(ex) == 2, ex
    assert "hashpartitioning(ticker" in ex[0] and "date" not in ex[0].split("hashpartitioning")[1].split(")")[0]


def test_windows_of_one_series_share_a_sort(spark):
    plan = physical_plan(QUERIES["longest_streaks"](spark, SF001))
    assert plan.count("Window") == 2
    assert plan.count("Sort [") == 1


def test_top_k_per_ticker_uses_group_limit(spark):
    plan = physical_plan(QUERIES["first_rows"](spark, SF001))
    assert "WindowGroupLimit" in plan


def test_overall_top1_is_take_ordered(spark):
    plan = physical_plan(QUERIES["best_intraday_month"](spark, SF001))
    assert "TakeOrderedAndProject" in plan


def test_bars_aggregate_is_hash_based(spark):
    """min_by/max_by on a primitive key stay in HashAggregate: no sort of ticks."""
    plan = physical_plan(QUERIES["bars"](spark, SF001))
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2


@pytest.mark.parametrize(
    "name",
    ["load_bars_range", "return_histogram", "best_intraday_year", "return_consistency", "most_consistent_top3", "seasonal_close"],
)
def test_date_range_reaches_the_tick_scan(spark, name):
    """A range on the bar date is pushed through the bar aggregation and
    unwrapped from the date cast into a Parquet filter on the raw timestamp."""
    plan = physical_plan(QUERIES[name](spark, SF001))
    pushed = [part.split("]")[0] for part in plan.split("PushedFilters: [")[1:]]
    assert any("GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p for p in pushed), pushed


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_python_only_in_the_recursive_ema(spark, name):
    """No row-at-a-time or scalar pandas UDF anywhere; the Python stages are the
    unsplit recursive EMA's mapInPandas and the correlation's matrix products."""
    plan = physical_plan(QUERIES[name](spark, SF001))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert ("MapInPandas" in plan) == (name.startswith("ema_recursive") and "year_split" not in name)
    assert ("FlatMapGroupsInArrow" in plan) == name.startswith("ticker_correlation")


@pytest.mark.parametrize("name", YEAR_SPLITS)
def test_year_split_reuses_the_bar_exchange(spark, name):
    """Both branches of a year-split series read the ticks once."""
    df = QUERIES[name](spark, SF001)
    df.collect()
    final = physical_plan(df).split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final and final.count("FileScan") == 1
