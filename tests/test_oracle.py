"""Every registered query against its DuckDB statement at sf0.01 (and the
smoke scale sf0.001): same column names, types, row count and rows."""

import pytest

import __spark_entry__ as entry_module
from conftest import SF0001, SF001
from oracle_compare import compare, duck

from barlab.plans.catalog import QUERIES
from barlab.plans.oracle import ORACLE_SQL as ORACLE


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) >= 103


def test_entry_registers_them_all():
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb_sf001(spark, duck_sf001, name):
    assert compare(spark, duck_sf001, name, QUERIES[name], ORACLE[name], SF001) == []


@pytest.fixture(scope="module")
def duck_sf0001():
    return duck(SF0001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb_smoke_scale(spark, duck_sf0001, name):
    """sf0.001 is sparse: no date is shared by all five order priorities,
    many days hold one order, so empty and degenerate results are checked."""
    assert compare(spark, duck_sf0001, name, QUERIES[name], ORACLE[name], SF0001) == []


def test_entry_runs_on_smoke_data(spark):
    df = entry_module.entry(spark)
    rows = df.collect()
    assert df.columns == ["ticker", "std_dev"]
    assert len(rows) == 3
    assert [r.std_dev for r in rows] == sorted(r.std_dev for r in rows)


@pytest.mark.parametrize(
    "name", ["weekly_averages", "return_rate_weekly", "seasonal_close", "describe_stats", "ema_recursive", "best_weekday"]
)
def test_matches_duckdb_under_other_session_settings(spark, duck_sf001, name):
    """The driver's session may differ from ours: many shuffle partitions,
    adaptive execution off.  Results must not depend on it."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert compare(spark, duck_sf001, name, QUERIES[name], ORACLE[name], SF001) == []
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
