"""Registration, the roles the driver tables play, and the same roles in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The driver tables of one scale, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    def register(function: Callable[[Tables], DataFrame]):
        @wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Tables(spark, folder))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return function

    return register


def r6(column: Column | str, digits: int = 6) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column.cast("double"), digits)


def text_day(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.date_format(column, "yyyy-MM-dd")


def s6(expression: str, digits: int = 6) -> str:
    """SQL twin of `r6`; the sum removes the sign of a negative zero."""
    return f"(round(({expression})::DOUBLE, {digits}) + 0::DOUBLE)"


def sday(expression: str) -> str:
    return f"strftime(({expression})::DATE, '%Y-%m-%d')"


def sweek(expression: str) -> str:
    return f"strftime(({expression})::DATE, '%G-W%V')"


def ssunday(label: str) -> str:
    """Closing Sunday of a week label."""
    return (
        f"(date_trunc('week', make_date(substr({label}, 1, 4)::INT, 1, 4))::DATE"
        f" + ((substr({label}, 7, 2)::INT - 1) * 7 + 6))"
    )


def with_sql(body: str, *tables: str) -> str:
    """`WITH` and the tables, then the body. A body that starts with a comma adds tables."""
    return "WITH " + ",\n".join(t.strip() for t in tables) + "\n" + body.strip()


def probit_sql(p: str) -> str:
    """Algorithm AS 241 written as SQL, for a probability strictly inside (0, 1)."""
    from sluice.functions import stats as st

    def horner(x: str, cs) -> str:
        text = f"{cs[-1]!r}::DOUBLE"
        for c in reversed(cs[:-1]):
            text = f"({text} * {x} + {c!r}::DOUBLE)"
        return text

    q = f"({p} - 0.5::DOUBLE)"
    centre = f"(0.180625::DOUBLE - {q} * {q})"
    r = f"sqrt(-ln(least({p}, 1 - {p})))"
    m = f"({r} - 1.6::DOUBLE)"
    t = f"({r} - 5.0::DOUBLE)"
    near = f"{q} * {horner(centre, st.AS241_CENTRE[0])} / {horner(centre, st.AS241_CENTRE[1])}"
    mid = f"{horner(m, st.AS241_MIDDLE[0])} / {horner(m, st.AS241_MIDDLE[1])}"
    tail = f"{horner(t, st.AS241_TAIL[0])} / {horner(t, st.AS241_TAIL[1])}"
    return (
        f"(CASE WHEN abs({q}) <= 0.425::DOUBLE THEN {near} "
        f"ELSE sign({q}) * (CASE WHEN {r} <= 5.0 THEN {mid} ELSE {tail} END) END)"
    )


def class_sql(v: str) -> str:
    from sluice.functions.stats import CLASS_LIMITS

    terms = " + ".join(f"({v} > ({c})::DOUBLE)::INT" for c in CLASS_LIMITS)
    return f"(1 + {terms})"


def rank_p_sql(less: str, equal: str, n: str) -> str:
    return (
        f"((({less}) + 1 + ({equal}) / 2::DOUBLE - 0.44::DOUBLE)"
        f" / (({n}) + 1 + 0.12::DOUBLE))"
    )


# --- Roles ------------------------------------------------------------------------------------


def nation_id(column: str) -> Column:
    return F.concat(F.lit("N"), F.lpad(F.col(column).cast("string"), 2, "0"))


def zone_id(column: str) -> Column:
    return F.concat(F.lit("Z"), F.col(column).cast("string"))


def stations(t: Tables) -> DataFrame:
    """Nations as stations, regions as zones."""
    return t.nation.select(
        nation_id("n_nationkey").alias("station_id"),
        zone_id("n_regionkey").alias("zone_id"),
        F.col("n_name").alias("libelle"),
    )


STATIONS = """stations AS (
  SELECT 'N' || lpad(n_nationkey::VARCHAR, 2, '0') AS station_id,
         'Z' || n_regionkey::VARCHAR AS zone_id, n_name AS libelle FROM nation)"""


def shipments(t: Tables) -> DataFrame:
    """Line items with the station of their supplier, by day."""
    return t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        nation_id("s_nationkey").alias("station_id"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").alias("quantity"),
        "l_returnflag",
    )


def nation_day(t: Tables) -> DataFrame:
    """Daily station series: station_id, date, value (whole numbers), n."""
    return (
        shipments(t)
        .groupBy("station_id", "date")
        .agg(F.sum("quantity").alias("value"), F.count("*").alias("n"))
    )


NATION_DAY = """nation_day AS (
  SELECT 'N' || lpad(s_nationkey::VARCHAR, 2, '0') AS station_id, l_shipdate::DATE AS date,
         sum(l_quantity) AS value, count(*) AS n
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"""


def region_day(t: Tables) -> DataFrame:
    """Daily zone series."""
    return (
        nation_day(t)
        .join(stations(t), "station_id")
        .groupBy("zone_id", "date")
        .agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
    )


REGION_DAY = """region_day AS (
  SELECT zone_id, date, sum(value) AS value, sum(n)::BIGINT AS n
  FROM nation_day JOIN stations USING (station_id) GROUP BY 1, 2)"""


def region_rain(t: Tables) -> DataFrame:
    """Zone series on every day, zero where nothing was shipped (a rain-like series)."""
    from sluice.functions.calendar import day_spine

    return day_spine(
        region_day(t).select("zone_id", "date", "value"), ["zone_id"], "date", {"value": 0.0}
    )


REGION_RAIN = """region_rain AS (
  SELECT s.zone_id, s.date, coalesce(d.value, 0) AS value
  FROM (SELECT zone_id, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date
        FROM region_day GROUP BY zone_id) s
  LEFT JOIN region_day d USING (zone_id, date))"""

# --- The weeks a table spans -------------------------------------------------------------------


def week_range(df: DataFrame, date: str) -> tuple[str, str]:
    """Labels of the ISO weeks of the first and the last day of a table (one row to the driver). The weeks
    of an empty table are those of 1970-01-01."""
    from datetime import date as day

    row = df.agg(F.min(F.to_date(date)).alias("a"), F.max(F.to_date(date)).alias("b")).first()
    return tuple("{}-W{:02d}".format(*(d or day(1970, 1, 1)).isocalendar()[:2]) for d in (row.a, row.b))


def ship_weeks(t: Tables) -> tuple[str, str]:
    return week_range(t.lineitem, "l_shipdate")


def ssunday_of(date: str, table: str) -> str:
    """SQL twin: closing Sunday of the week of `date`, an aggregate over `table`."""
    return f"(SELECT date_trunc('week', {date}::DATE)::DATE + 6 FROM {table})"


def year_end_week(label: str) -> str:
    """Label of the last week of the ISO year of a label: the week of 28 December."""
    from datetime import date as day

    return "{}-W{:02d}".format(*day(int(label[:4]), 12, 28).isocalendar()[:2])


def syear_end_sunday(date: str, table: str) -> str:
    """SQL twin: closing Sunday of the last week of the ISO year of `date`, an aggregate over `table`."""
    return f"(SELECT date_trunc('week', make_date(isoyear({date}::DATE)::INT, 12, 28))::DATE + 6 FROM {table})"


FIRST_SUNDAY = ssunday_of("min(l_shipdate)", "lineitem")
LAST_SUNDAY = ssunday_of("max(l_shipdate)", "lineitem")

# Reference years of the driver tables
REF = {"start": 1995, "end": 1999, "minimum": 3, "freeze": 2000}


def select_years_sql(
    valid: str, alias: str = "", start=1995, end=1999, minimum=3, freeze: int | None = 2000
) -> tuple[str, str, str]:
    """(years list, period text, flag) of the rule for a sorted list of valid years, no break."""
    inside = f"list_filter({valid}, lambda a: a BETWEEN {start} AND {end})"
    before = valid if freeze is None else f"list_filter({valid}, lambda a: a <= {freeze})"
    years = (
        f"(CASE WHEN len({inside}) >= {minimum} THEN {inside} "
        f"WHEN len({before}) >= {minimum} THEN {before} "
        f"WHEN len({valid}) >= {minimum} THEN {valid}[1:{minimum}] ELSE [] END)"
    )
    off = f"(len({inside}) < {minimum})"
    period = (
        f"(CASE WHEN NOT {off} THEN '{start}-{end}' WHEN len({years}) > 0 THEN "
        f"{years}[1]::VARCHAR || '-' || {years}[-1]::VARCHAR ELSE '' END)"
    )
    return years, period, off


# --- Readings of a reservoir-like series ------------------------------------------------------


def readings(t: Tables) -> DataFrame:
    """One reading per nation of the customer and ISO week: code, date (last order day of the
    week), volume (orders of the week), capacity (a share of the largest week)."""
    from pyspark.sql import Window

    weekly = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            nation_id("c_nationkey").alias("station_id"), F.to_date("o_orderdate").alias("day")
        )
        .groupBy("station_id", F.trunc("day", "week").alias("monday"))
        .agg(F.max("day").alias("date"), F.count("*").alias("volume_m3"))
    )
    top = F.max("volume_m3").over(Window.partitionBy("station_id"))
    return weekly.select(
        "station_id",
        "date",
        "volume_m3",
        F.greatest(F.lit(1), F.floor(top * 9 / 10)).cast("long").alias("capacite_m3"),
    )


READINGS = """weekly_orders AS (
  SELECT 'N' || lpad(c_nationkey::VARCHAR, 2, '0') AS station_id,
         date_trunc('week', o_orderdate::DATE)::DATE AS monday,
         max(o_orderdate::DATE) AS date, count(*) AS volume_m3
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
readings AS (
  SELECT station_id, date, volume_m3,
         greatest(1, floor(max(volume_m3) OVER (PARTITION BY station_id) * 9 / 10))::BIGINT
           AS capacite_m3
  FROM weekly_orders)"""


def scratch(t: Tables, name: str) -> str:
    """A new folder all executors share, inside the checkpoint folder of the session."""
    import uuid

    from sluice.session import shared_folder

    return f"{shared_folder(t.spark)}/landed-{name}-{uuid.uuid4().hex}"
