"""Index queries read every week a table has: the same queries on tables moved to other years."""

import shutil

import pytest
from check_oracle import cells
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
NAMES = (
    "running_month", "previous_valid_month", "groundwater_index", "spi_index", "zone_mean", "zone_week_grid",
    "weekly_indices_station",
)


@pytest.fixture(scope="module")
def moved(spark, tmp_path_factory):
    """The tables with lines nine years later and one of them two years after the others."""
    folder = tmp_path_factory.mktemp("tables") / "moved"
    folder.mkdir()
    for name in "region nation customer supplier part orders".split():
        shutil.copy(f"{FOLDER}/{name}.parquet", folder)
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    last = lines.agg(F.max("l_orderkey")).first()[0]
    years = F.when(F.col("l_orderkey") == last, F.expr("interval 11 years")).otherwise(F.expr("interval 9 years"))
    lines.withColumn("l_shipdate", F.col("l_shipdate") + years).coalesce(1).write.parquet(str(folder / "lineitem.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_other_years_are_read_whole(spark, moved, name):
    import duckdb

    import __spark_entry__ as entry

    base = duckdb.connect()
    for table in "region nation customer supplier part orders".split():
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{moved}/{table}.parquet'")
    base.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{moved}/lineitem.parquet/*.parquet'")
    got = entry.queries()[name](spark, moved).toPandas()
    want = base.execute(entry.oracle_sql()[name]).df()
    assert cells(got) == cells(want)
    if name in ("running_month", "zone_week_grid"):
        assert got["sunday"].max() >= "2010"
