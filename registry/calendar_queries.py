"""C: calendar operators on shipping and order days."""

from pyspark.sql import functions as F

from registry.core import (
    LAST_SUNDAY, NATION_DAY, REGION_DAY, STATIONS, Tables, nation_day, query, region_day, sday,
    ship_weeks, ssunday, stations, sweek, text_day, with_sql,
)
from sluice.functions import calendar as cal


def ship_day():
    return F.to_date("l_shipdate")


@query(
    "iso_week_label",
    f"""SELECT {sweek('l_shipdate')} AS week, count(*) AS n, sum(l_quantity) AS qty
        FROM lineitem GROUP BY 1""",
)
def _(t: Tables):
    return (
        t.lineitem.groupBy(cal.iso_week_label(ship_day()).alias("week"))
        .agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))
    )


@query(
    "week_bounds",
    f"""SELECT week, {sday(ssunday('week') + ' - 6')} AS monday, {sday(ssunday('week'))} AS sunday, n
        FROM (SELECT {sweek('l_shipdate')} AS week, count(*) AS n FROM lineitem GROUP BY 1)""",
)
def _(t: Tables):
    weeks = t.lineitem.groupBy(cal.iso_week_label(ship_day()).alias("week")).agg(F.count("*").alias("n"))
    week = F.col("week")
    return weeks.select(
        "week",
        text_day(cal.week_monday(week)).alias("monday"),
        text_day(cal.week_sunday(week)).alias("sunday"),
        "n",
    )


@query(
    "last_complete_week",
    """SELECT strftime(day - isodow(day)::INT, '%G-W%V') AS week, count(*) AS n
       FROM (SELECT o_orderdate::DATE AS day FROM orders) GROUP BY 1""",
)
def _(t: Tables):
    return t.orders.groupBy(
        cal.last_complete_week(F.to_date("o_orderdate")).alias("week")
    ).agg(F.count("*").alias("n"))


@query(
    "sunday_spine",
    with_sql(
        f"""SELECT station_id, {sday('sunday')} AS sunday FROM (
            SELECT station_id, unnest(generate_series({ssunday('a')}, {ssunday('b')},
                   INTERVAL 7 DAY)) AS sunday
            FROM (SELECT station_id, min({sweek('date')}) AS a, max({sweek('date')}) AS b
                  FROM nation_day GROUP BY 1))""",
        NATION_DAY,
    ),
)
def _(t: Tables):
    week = cal.iso_week_label(F.col("date"))
    spans = nation_day(t).groupBy("station_id").agg(F.min(week).alias("a"), F.max(week).alias("b"))
    return cal.sunday_spine(spans, "a", "b").select("station_id", text_day("sunday").alias("sunday"))


@query(
    "reference_week",
    """SELECT least(weekofyear(l_shipdate::DATE), 52)::INT AS week, count(*) AS n
       FROM lineitem GROUP BY 1""",
)
def _(t: Tables):
    return t.lineitem.groupBy(cal.reference_week(ship_day()).alias("week")).agg(F.count("*").alias("n"))


@query(
    "day_spine",
    with_sql(
        f"""SELECT s.station_id, {sday('s.date')} AS date, d.value
            FROM (SELECT station_id,
                    unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date
                  FROM nation_day GROUP BY 1) s
            LEFT JOIN nation_day d USING (station_id, date)""",
        NATION_DAY,
    ),
)
def _(t: Tables):
    series = nation_day(t).select("station_id", "date", "value")
    full = cal.day_spine(series, ["station_id"], "date")
    return full.select("station_id", text_day("date").alias("date"), "value")


@query(
    "seasonal_windows",
    f"""WITH y AS (SELECT DISTINCT isoyear(l_shipdate::DATE)::INT AS year FROM lineitem),
        w AS (SELECT year, unnest(range(1, 53))::INT AS week FROM y),
        s AS (SELECT year, week, (date_trunc('week', make_date(year, 1, 4))::DATE
                                  + ((week - 1) * 7 + 6)) AS sunday FROM w)
        SELECT year, week, {sday('d')} AS date
        FROM (SELECT year, week, unnest(generate_series(sunday - 15, sunday + 15,
              INTERVAL 1 DAY)) AS d FROM s)""",
)
def _(t: Tables):
    years = t.lineitem.select(cal.iso_year(ship_day()).alias("year")).distinct()
    return cal.seasonal_windows(years, "year", 15).select("year", "week", text_day("date").alias("date"))


@query(
    "containing_windows",
    with_sql(
        """, s AS (SELECT DISTINCT isoyear(m)::INT AS year, weekofyear(m)::INT AS week, m AS sunday
             FROM (SELECT unnest(generate_series(date_trunc('week', min(date) - 30)::DATE + 6,
                          max(date) + 30, INTERVAL 7 DAY))::DATE AS m FROM region_day))
        SELECT zone_id, year, week, count(*) AS n, sum(value) AS qty
        FROM region_day JOIN s ON date BETWEEN sunday - 15 AND sunday + 15
        WHERE week <= 52 GROUP BY ALL""",
        NATION_DAY, STATIONS, REGION_DAY,
    ),
)
def _(t: Tables):
    return (
        region_day(t)
        .select("zone_id", "value", F.explode(cal.containing_windows(F.col("date"), 15)).alias("w"))
        .groupBy("zone_id", F.col("w.year").alias("year"), F.col("w.week").alias("week"))
        .agg(F.count("*").alias("n"), F.sum("value").alias("qty"))
    )


@query(
    "winter_label",
    """SELECT CASE WHEN month(d) = 12 THEN year(d) WHEN month(d) <= 3 THEN year(d) - 1 END::INT AS winter,
              count(*) AS n
       FROM (SELECT l_shipdate::DATE AS d FROM lineitem)
       WHERE month(d) IN (12, 1, 2, 3) GROUP BY 1""",
)
def _(t: Tables):
    winter = cal.winter_label(ship_day())
    return (
        t.lineitem.select(winter.alias("winter")).where("winter IS NOT NULL")
        .groupBy("winter").agg(F.count("*").alias("n"))
    )


@query(
    "season_reference_year",
    """SELECT variant, coalesce(CASE WHEN variant <> 'fixed' THEN ref END, -1)::INT AS reference_year,
              bool_and(ref < 2001 OR (ref = 2001 AND 11 > 9)) AS complete, count(*) AS n
       FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 'fixed' ELSE 'yearly' END AS variant,
                    CASE WHEN month(l_shipdate) >= 10 THEN year(l_shipdate)
                         ELSE year(l_shipdate) - 1 END AS ref FROM lineitem)
       GROUP BY 1, 2""",
)
def _(t: Tables):
    variant = F.when(F.col("l_returnflag") == "R", "fixed").otherwise("yearly")
    year = cal.season_reference_year(ship_day())
    done = cal.season_complete(year, F.lit("2001-11-15").cast("date"), 9)
    return (
        t.lineitem.select(
            variant.alias("variant"),
            F.coalesce(cal.season_reference_year(ship_day(), variant), F.lit(-1)).alias("reference_year"),
            done.alias("done"),
        )
        .groupBy("variant", "reference_year")
        .agg(F.bool_and("done").alias("complete"), F.count("*").alias("n"))
    )


@query(
    "zone_week_grid",
    with_sql(
        f"""SELECT g.zone_id, {sday('g.sunday')} AS sunday, coalesce(v.qty, 0)::DOUBLE AS qty
            FROM (SELECT zone_id, unnest(generate_series(
                    (SELECT date_trunc('week', make_date(isoyear(min(l_shipdate))::INT, 1, 4))::DATE + 6 FROM lineitem), {LAST_SUNDAY}, INTERVAL 7 DAY))::DATE AS sunday
                  FROM (SELECT DISTINCT zone_id FROM stations)) g
            LEFT JOIN (SELECT zone_id, date AS sunday, sum(value) AS qty FROM region_day
                       WHERE isodow(date) = 7 GROUP BY 1, 2) v USING (zone_id, sunday)""",
        NATION_DAY, STATIONS, REGION_DAY,
    ),
)
def _(t: Tables):
    zones = stations(t).select("zone_id").distinct()
    values = (
        region_day(t).where(cal.is_sunday(F.col("date")))
        .groupBy("zone_id", F.col("date").alias("sunday")).agg(F.sum("value").alias("qty"))
    )
    first, last = ship_weeks(t)
    grid = cal.zone_week_grid(zones, values, "zone_id", "sunday", int(first[:4]), last, {"qty": 0.0})
    return grid.select("zone_id", text_day("sunday").alias("sunday"), "qty")


@query(
    "year_ranges",
    """WITH y AS (SELECT DISTINCT o_custkey AS custkey, year(o_orderdate) AS y FROM orders),
       g AS (SELECT custkey, y, y - row_number() OVER (PARTITION BY custkey ORDER BY y) AS k FROM y),
       r AS (SELECT custkey, min(y) AS a, max(y) AS b FROM g GROUP BY custkey, k)
       SELECT custkey, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END, ', '
                                  ORDER BY a) AS ranges FROM r GROUP BY custkey""",
)
def _(t: Tables):
    years = t.orders.select(F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("y"))
    return cal.year_ranges(years, ["custkey"], "y")
