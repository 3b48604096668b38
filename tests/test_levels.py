"""Weekly levels run to the end of the year of the last order, and what is made of them reads all of these weeks."""

import pytest
from check_oracle import cells, connect
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
NAMES = "weekly_level assemble_validation auc spearman crosstab_normalised contradictions weight_sweep".split()


@pytest.fixture(scope="module")
def results(spark):
    import __spark_entry__ as entry

    base = connect(FOLDER)
    return lambda name: (entry.queries()[name](spark, FOLDER).toPandas(), base.execute(entry.oracle_sql()[name]).df())


@pytest.mark.parametrize("name", NAMES)
def test_levels_equal_their_sql(results, name):
    got, want = results(name)
    assert cells(got) == cells(want)


def test_no_week_after_the_last_order_is_left_out(spark, results):
    got = results("weekly_level")[0]
    last = spark.read.parquet(f"{FOLDER}/orders.parquet").agg(F.max("o_orderdate")).first()[0]
    assert last.year == 2001 and got["semaine"].max() == "2001-W52"
    assert len(got) == 23 * 313 and (got.loc[got["semaine"] > "2001-W35", "niveau"] > 0).any()


@pytest.mark.parametrize("label, last", [("2001-W31", "2001-W52"), ("2004-W02", "2004-W53"), ("2020-W53", "2020-W53")])
def test_last_week_of_a_year(label, last):
    import duckdb

    from registry.core import syear_end_sunday, year_end_week

    assert year_end_week(label) == last
    day = f"strptime('{label}-7', '%G-W%V-%u')"
    assert duckdb.connect().execute(f"SELECT strftime({syear_end_sunday('max(d)', f'(SELECT {day} AS d)')}, '%G-W%V')").fetchone()[0] == last
