"""Registered queries against their SQL in DuckDB. The default run takes a few of each family at
the smallest scale; SLUICE_FULL=1 takes all of them at sf0.01."""

import os

import pytest

import __spark_entry__ as entry
from check_oracle import cells, connect

FULL = os.environ.get("SLUICE_FULL") == "1"
FOLDER = "/root/testdata/sf0.01" if FULL else "/root/testdata/sf0.001"
QUICK = (
    "iso_week_label day_spine year_ranges select_years rolling_sum_full monthly_means pettitt_breaks "
    "weekly_rank_index running_month campaign_share explode_orders merge_observations conform "
    "implausible_values shift_late_readings asof_join recurrence composite_view weekly_level "
    "select_scenes monthly_median drift_residuals override_layer area_by_regime winter_trend "
    "despike_fill nearest_zone plateaus"
).split()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def base():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(entry.queries())
    assert set(QUICK) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE) if FULL else QUICK)
def test_query_equals_sql(spark, base, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    want = base.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert cells(got) == cells(want)


def test_entry(spark):
    df = entry.entry(spark)
    assert {"zone_id", "semaine", "valeur", "classe"} <= set(df.columns)
    assert df.count() > 0
