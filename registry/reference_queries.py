"""D: frozen reference samples, envelopes and breaks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.core import (
    NATION_DAY, REF, REGION_DAY, REGION_RAIN, STATIONS, Tables, nation_day, nation_id, query, r6,
    region_day, region_rain, s6, select_years_sql, sday, ssunday, stations, sweek, text_day,
    with_sql, zone_id,
)
from sluice.functions import calendar as cal
from sluice.operators import reference as ref

PERIOD = ref.ReferencePeriod(REF["start"], REF["end"], REF["minimum"], REF["freeze"])
WINDOWS = {"spi_1": 30, "spi_3": 91, "spi_6": 182}


def exploded(normals: DataFrame, *keys: str) -> DataFrame:
    """One row per sample value, to compare samples row by row."""
    return normals.select(
        *keys, "n_annees", "periode_ref", "hors_reference", F.posexplode("valeurs_ref").alias("i", "v")
    ).withColumn("v", r6("v")).withColumn("i", F.col("i").cast("long"))


# --- D1, D2 -------------------------------------------------------------------------------------

_YEARS = """cust AS (
  SELECT o_custkey AS custkey, list_sort(list(DISTINCT year(o_orderdate)::INT)) AS valid
  FROM orders GROUP BY 1)"""
_Y, _P, _O = select_years_sql("valid", end=1997, minimum=3, freeze=1998)


def customer_years(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.sort_array(F.collect_set(F.year("o_orderdate"))).alias("valid")
    )


@query(
    "select_years",
    with_sql(
        f"""SELECT custkey, array_to_string({_Y}, ',') AS years, {_P} AS period_ref,
                   {_O} AS off_reference FROM cust""",
        _YEARS,
    ),
)
def _(t: Tables):
    choice = ref.select_years(F.col("valid"), ref.ReferencePeriod(1995, 1997, 3, 1998))
    return customer_years(t).select("custkey", choice.alias("c")).select(
        "custkey",
        F.array_join(F.transform("c.years", lambda y: y.cast("string")), ",").alias("years"),
        "c.period_ref",
        "c.off_reference",
    )


@query(
    "select_years_after_break",
    with_sql(
        """SELECT custkey, array_to_string(y, ',') AS years,
                  CASE WHEN len(y) > 0 THEN y[1]::VARCHAR || '-' || y[-1]::VARCHAR ELSE '' END
                    AS period_ref, true AS off_reference
           FROM (SELECT custkey, CASE WHEN len(list_filter(later, lambda a: a <= 2000)) >= m
                        THEN list_filter(later, lambda a: a <= 2000)
                        WHEN len(later) >= m THEN later[1:m] ELSE [] END AS y
                 FROM (SELECT custkey, CASE WHEN custkey % 2 = 0 THEN 2 ELSE 3 END AS m,
                              list_filter(valid, lambda a: a >= 1996 + custkey % 4) AS later
                       FROM cust))""",
        _YEARS,
    ),
)
def _(t: Tables):
    own = F.when(F.col("custkey") % 2 == 0, 2)  # a minimum of the station, else the general one
    choice = ref.select_years(
        F.col("valid"),
        ref.ReferencePeriod(1995, 1997, 4, 2000, after_break=3),
        (F.lit(1996) + F.col("custkey") % 4).cast("int"),
        own,
    )
    return customer_years(t).select("custkey", choice.alias("c")).select(
        "custkey",
        F.array_join(F.transform("c.years", lambda y: y.cast("string")), ",").alias("years"),
        "c.period_ref",
        "c.off_reference",
    )


_BREAKS = """supp AS (
  SELECT s_suppkey AS station_id, CASE WHEN s_suppkey % 2 = 0 THEN 'piezo' ELSE 'hydro' END AS source,
         'Z' || n_regionkey::VARCHAR AS zone_id FROM supplier JOIN nation ON s_nationkey = n_nationkey),
regimes AS (SELECT zone_id, (1996 + count(*) % 3)::INT AS year FROM supp WHERE source = 'hydro'
            GROUP BY 1 HAVING count(*) % 2 = 0),
own AS (SELECT s_suppkey AS station_id, 1999 AS year,
               CASE WHEN s_acctbal < 1000 THEN 2 END AS minimum FROM supplier WHERE s_acctbal < 2000)"""


@query(
    "break_years",
    with_sql(
        """SELECT station_id, coalesce(o.year, z.year)::INT AS break_year,
                  coalesce(o.minimum, -1)::INT AS break_minimum
           FROM (SELECT s.station_id, r.year FROM supp s JOIN regimes r USING (zone_id)
                 WHERE s.source = 'piezo') z
           FULL JOIN own o USING (station_id)""",
        _BREAKS,
    ),
)
def _(t: Tables):
    supp = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("station_id"),
        F.when(F.col("s_suppkey") % 2 == 0, "piezo").otherwise("hydro").alias("source"),
        zone_id("n_regionkey").alias("zone_id"),
    )
    regimes = (
        supp.where("source = 'hydro'").groupBy("zone_id").agg(F.count("*").alias("n"))
        .where("n % 2 = 0").select("zone_id", (F.lit(1996) + F.col("n") % 3).cast("int").alias("year"))
    )
    own = t.supplier.where("s_acctbal < 2000").select(
        F.col("s_suppkey").alias("station_id"),
        F.lit(1999).alias("year"),
        F.when(F.col("s_acctbal") < 1000, 2).alias("minimum"),
    )
    return ref.break_years(supp, regimes, own).select(
        "station_id", "break_year", F.coalesce("break_minimum", F.lit(-1)).alias("break_minimum")
    )


# --- D3 to D7: rain -----------------------------------------------------------------------------

WEIGHTS = """cell_overlaps AS (
  SELECT zone_id, 'N' || lpad(s_nationkey::VARCHAR, 2, '0') AS station_id, count(*) AS surface
  FROM supplier JOIN stations ON 'N' || lpad(s_nationkey::VARCHAR, 2, '0') = station_id
  GROUP BY 1, 2),
weights AS (SELECT zone_id, station_id, surface / sum(surface) OVER (PARTITION BY zone_id) AS weight
            FROM cell_overlaps)"""


def weights(t: Tables) -> DataFrame:
    overlaps = (
        t.supplier.select(nation_id("s_nationkey").alias("station_id"))
        .join(stations(t), "station_id")
        .groupBy("zone_id", "station_id")
        .agg(F.count("*").alias("surface"))
    )
    return ref.cell_zone_weights(overlaps, "zone_id", "station_id", "surface")


@query(
    "cell_zone_weights",
    with_sql(f"SELECT zone_id, station_id, {s6('weight')} AS weight FROM weights", STATIONS, WEIGHTS),
)
def _(t: Tables):
    return weights(t).withColumn("weight", r6("weight"))


@query(
    "zone_rain",
    with_sql(
        f"""SELECT zone_id, {sday('date')} AS date, {s6('sum(value * weight)')} AS value
            FROM nation_day JOIN weights USING (station_id) GROUP BY zone_id, date""",
        NATION_DAY, STATIONS, WEIGHTS,
    ),
)
def _(t: Tables):
    rain = ref.zone_rain(nation_day(t), weights(t), "zone_id", "station_id", "date", "value")
    return rain.select("zone_id", text_day("date").alias("date"), r6("value").alias("value"))


@query(
    "zone_rain_wide",
    with_sql(
        f"""SELECT {sday('date')} AS date, """
        + ", ".join(
            f"{s6(f'''sum(value * weight) FILTER (WHERE zone_id = 'Z{i}')''')} AS Z{i}"
            for i in range(5)
        )
        + " FROM nation_day JOIN weights USING (station_id) GROUP BY date",
        NATION_DAY, STATIONS, WEIGHTS,
    ),
)
def _(t: Tables):
    rain = ref.zone_rain(nation_day(t), weights(t), "zone_id", "station_id", "date", "value")
    zones = [f"Z{i}" for i in range(5)]
    wide = rain.groupBy("date").pivot("zone_id", zones).sum("value")
    return wide.select(text_day("date").alias("date"), *[r6(z).alias(z) for z in zones])


def totals_sql(source: str, windows: dict[str, int]) -> str:
    """CTE `totals` from a daily series: sums and counts over the day range."""
    parts = []
    for name, days in windows.items():
        over = (
            f"OVER (PARTITION BY zone_id ORDER BY date RANGE BETWEEN INTERVAL {days - 1} DAY "
            "PRECEDING AND CURRENT ROW)"
        )
        parts.append(
            f"SELECT zone_id, date, '{name}' AS indice, total FROM (SELECT zone_id, date, "
            f"sum(value) {over} AS total, count(value) {over} AS n FROM {source}) "
            f"WHERE n = {days} AND isodow(date) = 7"
        )
    return "totals AS (" + " UNION ALL ".join(parts) + ")"


@query(
    "rolling_sum_full",
    with_sql(
        f"SELECT zone_id, {sday('date')} AS date, indice, total FROM totals",
        NATION_DAY, STATIONS, REGION_DAY, totals_sql("region_day", WINDOWS),
    ),
)
def _(t: Tables):
    totals = ref.rolling_sum_full(region_day(t), ["zone_id"], "date", "value", WINDOWS)
    return totals.withColumn("date", text_day("date"))


def gamma_steps_sql(source: str, steps: int = 10) -> str:
    """CTEs `g0`.. from a table with `mean` and `s` = ln mean - mean of ln: the shape by Newton."""

    def digamma(k: str) -> str:
        x = f"({k} + 8)"
        y = f"(1 / ({x} * {x}))"
        head = (
            f"ln({x}) - 0.5::DOUBLE / {x} - {y} * (1::DOUBLE / 12 - {y} * (1::DOUBLE / 120 - "
            f"{y} * (1::DOUBLE / 252 - {y} * (1::DOUBLE / 240))))"
        )
        return "(" + head + "".join(f" - 1 / ({k} + {i})" for i in range(8)) + ")"

    def trigamma(k: str) -> str:
        x = f"({k} + 8)"
        y = f"(1 / ({x} * {x}))"
        head = (
            f"1 / {x} + {y} / 2 + {y} / {x} * (1::DOUBLE / 6 - {y} * (1::DOUBLE / 30 - {y} * "
            f"(1::DOUBLE / 42 - {y} * (1::DOUBLE / 30))))"
        )
        return "(" + head + "".join(f" + 1 / (({k} + {i}) * ({k} + {i}))" for i in range(8)) + ")"

    ctes = [
        f"g0 AS (SELECT *, CASE WHEN s > 1e-12 THEN (3 - s + sqrt((s - 3) * (s - 3) + 24 * s))"
        f" / (12 * s) END AS k FROM {source})"
    ]
    for i in range(steps):
        gap = f"(ln(k) - {digamma('k')} - s)"
        ctes.append(
            f"g{i + 1} AS (SELECT * REPLACE (1 / (1 / k + {gap} / (k * k * (1 / k - "
            f"{trigamma('k')}))) AS k) FROM g{i})"
        )
    return ",\n".join(ctes)


@query(
    "fit_gamma",
    with_sql(
        f"""SELECT zone_id, mois, {s6('k', 5)} AS forme, {s6('mean / k', 4)} AS echelle,
                   {s6('q0')} AS q0 FROM g10""",
        NATION_DAY, STATIONS, REGION_DAY, REGION_RAIN,
        """base AS (SELECT zone_id, month(date)::INT AS mois,
             avg(value) FILTER (WHERE value > 0) AS mean,
             ln(avg(value) FILTER (WHERE value > 0)) - avg(ln(value)) FILTER (WHERE value > 0) AS s,
             1 - count(*) FILTER (WHERE value > 0) / count(*)::DOUBLE AS q0
           FROM region_rain GROUP BY 1, 2)""",
        gamma_steps_sql("base"),
    ).replace("avg(ln(value)) FILTER", "avg(CASE WHEN value > 0 THEN ln(value) END) FILTER"),
)
def _(t: Tables):
    fitted = ref.fit_gamma(
        region_rain(t).withColumn("mois", F.month("date")), ["zone_id", "mois"], "value"
    )
    return fitted.select(
        "zone_id", "mois", r6("forme", 5).alias("forme"), r6("echelle", 4).alias("echelle"),
        r6("q0").alias("q0"),
    )


_Y, _P, _O = select_years_sql("valid")
SPI_NORMALS = (
    f"""years AS (SELECT zone_id, indice, least(weekofyear(date), 52)::INT AS semaine,
         list_sort(list(DISTINCT isoyear(date)::INT)) AS valid FROM totals GROUP BY 1, 2, 3),
    chosen AS (SELECT zone_id, indice, semaine, {_Y} AS years, {_P} AS periode_ref,
                      {_O} AS hors_reference FROM years),
    fitbase AS (SELECT c.zone_id, c.indice, c.semaine, any_value(len(years)) AS n_annees,
         any_value(periode_ref) AS periode_ref, any_value(hors_reference) AS hors_reference,
         avg(total) FILTER (WHERE total > 0) AS mean,
         ln(avg(total) FILTER (WHERE total > 0))
           - avg(CASE WHEN total > 0 THEN ln(total) END) AS s,
         1 - count(*) FILTER (WHERE total > 0) / count(*)::DOUBLE AS q0
       FROM totals t JOIN chosen c ON t.zone_id = c.zone_id AND t.indice = c.indice
            AND least(weekofyear(t.date), 52) = c.semaine
            AND list_contains(c.years, isoyear(t.date)::INT)
       GROUP BY 1, 2, 3),
    """
    + gamma_steps_sql("fitbase")
    + """,
    spi_normals AS (SELECT zone_id, indice, semaine, k AS forme, mean / k AS echelle, q0, n_annees,
                           periode_ref, hors_reference FROM g10)"""
)


def rain_totals(t: Tables) -> DataFrame:
    return ref.rolling_sum_full(region_rain(t), ["zone_id"], "date", "value", WINDOWS)


@query(
    "spi_normals",
    with_sql(
        f"""SELECT zone_id, indice, semaine, {s6('forme', 3)} AS forme, {s6('echelle', 4)} AS echelle,
                   {s6('q0')} AS q0, n_annees, periode_ref, hors_reference FROM spi_normals""",
        NATION_DAY, STATIONS, REGION_DAY, REGION_RAIN, totals_sql("region_rain", WINDOWS),
        SPI_NORMALS,
    ),
)
def _(t: Tables):
    normals = ref.spi_normals(rain_totals(t), "zone_id", "date", PERIOD)
    return normals.select(
        "zone_id", "indice", "semaine", r6("forme", 3).alias("forme"),
        r6("echelle", 4).alias("echelle"), r6("q0").alias("q0"),
        F.col("n_annees").cast("long").alias("n_annees"), "periode_ref", "hors_reference",
    )


# --- D8, D9: groundwater ------------------------------------------------------------------------

MONTHLY = """monthly AS (
  SELECT station_id, year(date)::INT AS annee, month(date)::INT AS mois, avg(value) AS moyenne,
         count(*) AS n_jours, max(date) AS derniere
  FROM nation_day GROUP BY 1, 2, 3 HAVING count(*) >= 10)"""
GW_NORMALS = f"""gw_years AS (SELECT station_id, mois, list_sort(list(DISTINCT annee)) AS valid
    FROM monthly GROUP BY 1, 2),
  gw_chosen AS (SELECT station_id, mois, {_Y} AS years, {_P} AS periode_ref, {_O} AS hors_reference
    FROM gw_years),
  gw_normals AS (SELECT c.station_id, c.mois, len(c.years) AS n_annees, c.periode_ref,
      c.hors_reference, list_sort(list(moyenne)) AS valeurs_ref
    FROM monthly m JOIN gw_chosen c ON m.station_id = c.station_id AND m.mois = c.mois
         AND list_contains(c.years, m.annee) GROUP BY ALL)"""


def gw_monthly(t: Tables) -> DataFrame:
    return ref.monthly_means(nation_day(t), "station_id", "date", "value")


@query(
    "monthly_means",
    with_sql(
        f"""SELECT station_id, annee, mois, {s6('moyenne')} AS moyenne, n_jours,
                   {sday('derniere')} AS derniere FROM monthly""",
        NATION_DAY, MONTHLY,
    ),
)
def _(t: Tables):
    return gw_monthly(t).withColumn("moyenne", r6("moyenne")).withColumn(
        "derniere", text_day("derniere")
    )


_EXPLODED = f"""n_annees, periode_ref, hors_reference,
    unnest(range(0, len(valeurs_ref))) AS i, unnest(valeurs_ref) AS raw"""


@query(
    "groundwater_normals",
    with_sql(
        f"""SELECT * EXCLUDE (raw), {s6('raw')} AS v
            FROM (SELECT station_id, mois, {_EXPLODED} FROM gw_normals)""",
        NATION_DAY, MONTHLY, GW_NORMALS,
    ),
)
def _(t: Tables):
    normals = ref.groundwater_normals(gw_monthly(t), "station_id", PERIOD)
    return exploded(normals, "station_id", "mois").withColumn(
        "n_annees", F.col("n_annees").cast("long")
    )


# --- D10 to D12: flow ---------------------------------------------------------------------------

@query(
    "splice_series",
    with_sql(
        f"""SELECT site AS station_id, {sday('date')} AS date, arg_min(value, priority) AS value
            FROM nation_day JOIN (
              SELECT station_id, first_value(station_id) OVER w AS site, row_number() OVER w AS priority
              FROM stations WINDOW w AS (PARTITION BY zone_id ORDER BY station_id)) USING (station_id)
            GROUP BY site, nation_day.date""",
        NATION_DAY, STATIONS,
    ),
)
def _(t: Tables):
    from pyspark.sql import Window

    w = Window.partitionBy("zone_id").orderBy("station_id")
    splices = stations(t).select(
        F.col("station_id").alias("station"),
        F.first("station_id").over(w).alias("site"),
        F.row_number().over(w).alias("priority"),
    )
    series = ref.splice_series(nation_day(t), "station_id", "date", "value", splices)
    return series.withColumn("date", text_day("date"))


DAY_SPINE = """spine AS (
  SELECT station_id, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date
  FROM nation_day GROUP BY 1),
rolling AS (
  SELECT station_id, date, s / n AS q7, n, date_mesure FROM (
    SELECT s.station_id, s.date, sum(d.value) OVER w AS s, count(d.value) OVER w AS n,
           max(CASE WHEN d.value IS NOT NULL THEN s.date END) OVER w AS date_mesure
    FROM spine s LEFT JOIN nation_day d USING (station_id, date)
    WINDOW w AS (PARTITION BY s.station_id ORDER BY s.date
                 RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)) WHERE n >= 3)"""
FLOW_NORMALS = f"""sundays AS (
    SELECT DISTINCT (date_trunc('week', make_date(y, 1, 4))::DATE + ((w - 1) * 7 + 6)) AS sunday,
           y AS year, w AS semaine
    FROM (SELECT unnest(range((SELECT min(year(date)) - 1 FROM rolling), (SELECT max(year(date)) + 2 FROM rolling)))::INT AS y), (SELECT unnest(range(1, 53))::INT AS w)),
  windowed AS MATERIALIZED (SELECT station_id, semaine, year, list(q7) AS v FROM rolling
    JOIN sundays ON date BETWEEN sunday - 15 AND sunday + 15 GROUP BY 1, 2, 3
    HAVING count(*) >= 16),
  fl_years AS (SELECT station_id, semaine, list_sort(list(year)) AS valid FROM windowed GROUP BY 1, 2),
  fl_chosen AS (SELECT station_id, semaine, {_Y} AS years, {_P} AS periode_ref,
      {_O} AS hors_reference FROM fl_years),
  fl_normals AS (SELECT c.station_id, c.semaine, len(c.years) AS n_annees, c.periode_ref,
      c.hors_reference, list_sort(flatten(list(w.v))) AS valeurs_ref
    FROM windowed w JOIN fl_chosen c ON w.station_id = c.station_id AND w.semaine = c.semaine
         AND list_contains(c.years, w.year) GROUP BY ALL)"""


def q7(t: Tables) -> DataFrame:
    return ref.rolling_mean_min(nation_day(t), ["station_id"], "date", "value", 7, 3)


@query(
    "rolling_mean_min",
    with_sql(
        f"""SELECT station_id, {sday('date')} AS date, {s6('q7')} AS q7,
                   {sday('date_mesure')} AS date_mesure FROM rolling""",
        NATION_DAY, DAY_SPINE,
    ),
)
def _(t: Tables):
    return q7(t).select(
        "station_id", text_day("date").alias("date"), r6("q7").alias("q7"),
        text_day("date_mesure").alias("date_mesure"),
    )


@query(
    "flow_normals",
    with_sql(
        f"""SELECT * EXCLUDE (raw), {s6('raw')} AS v
            FROM (SELECT station_id, semaine, {_EXPLODED} FROM fl_normals)""",
        NATION_DAY, DAY_SPINE, FLOW_NORMALS,
    ),
)
def _(t: Tables):
    normals = ref.flow_normals(q7(t), "station_id", "date", "q7", PERIOD)
    return exploded(normals, "station_id", "semaine").withColumn(
        "n_annees", F.col("n_annees").cast("long")
    )


# --- D13, D14 -----------------------------------------------------------------------------------

ZONE_WEEKS = f"""zone_weeks AS (
  SELECT zone_id, 'volume' AS indice, {sweek('date')} AS semaine, sum(value) AS valeur,
         sum(n) % 3 = 0 AS partiel FROM region_day GROUP BY 1, 2, 3)"""


def zone_weeks(t: Tables) -> DataFrame:
    return (
        region_day(t)
        .groupBy(
            "zone_id", F.lit("volume").alias("indice"),
            cal.iso_week_label(F.col("date")).alias("semaine"),
        )
        .agg(F.sum("value").alias("valeur"), (F.sum("n") % 3 == 0).alias("partiel"))
    )


def rank_reference_sql(source: str, keys: str, prefix: str, weeks_min: int = 26) -> str:
    """CTE `<prefix>_ref` with the sample of each key."""
    return f"""{prefix}_y AS (SELECT {keys}, substr(semaine, 1, 4)::INT AS year, list(valeur) AS v
      FROM {source} WHERE valeur IS NOT NULL GROUP BY ALL HAVING count(*) >= {weeks_min}),
    {prefix}_c AS (SELECT {keys}, {_Y} AS years, {_P} AS periode_ref, {_O} AS hors_reference
      FROM (SELECT {keys}, list_sort(list(year)) AS valid FROM {prefix}_y GROUP BY ALL)),
    {prefix}_ref AS (SELECT {keys}, periode_ref, hors_reference,
        list_sort(flatten(list(v))) AS valeurs_ref
      FROM {prefix}_y JOIN {prefix}_c USING ({keys}) WHERE list_contains(years, year) GROUP BY ALL)"""


@query(
    "zone_rank_reference",
    with_sql(
        """SELECT zone_id, indice, periode_ref, hors_reference, len(valeurs_ref) AS n_semaines,
                  unnest(range(0, len(valeurs_ref))) AS i, unnest(valeurs_ref) AS v FROM rr_ref""",
        NATION_DAY, STATIONS, REGION_DAY, ZONE_WEEKS,
        rank_reference_sql("zone_weeks", "zone_id, indice", "rr"),
    ),
)
def _(t: Tables):
    refs = ref.rank_reference(zone_weeks(t), ["zone_id", "indice"], PERIOD)
    return refs.select(
        "zone_id", "indice", "periode_ref", "hors_reference",
        F.col("n_semaines").cast("long").alias("n_semaines"),
        F.posexplode("valeurs_ref").alias("i", "v"),
    ).withColumn("i", F.col("i").cast("long"))


@query(
    "composite_reference",
    with_sql(
        """SELECT zone_id, periode_ref, hors_reference, len(valeurs_ref) AS n_semaines,
                  list_sum(valeurs_ref) AS total, valeurs_ref[1] AS lowest
           FROM (FROM a_ref UNION ALL FROM b_ref)""",
        NATION_DAY, STATIONS, REGION_DAY, ZONE_WEEKS,
        """usable AS (SELECT * FROM zone_weeks WHERE zone_id NOT IN ('Z0', 'Z1', 'Z2') OR NOT partiel)""",
        rank_reference_sql("usable", "zone_id", "a", 40),
        """others AS (SELECT * FROM zone_weeks WHERE zone_id NOT IN (SELECT zone_id FROM a_ref))""",
        rank_reference_sql("others", "zone_id", "b", 40),
    ),
)
def _(t: Tables):
    regimes = t.region.where("r_regionkey < 3").select(zone_id("r_regionkey").alias("zone_id"))
    refs = ref.composite_reference(zone_weeks(t).drop("indice"), regimes, PERIOD, 40)
    total = F.aggregate("valeurs_ref", F.lit(0.0), lambda a, v: a + v)
    return refs.select(
        "zone_id", "periode_ref", "hors_reference",
        F.col("n_semaines").cast("long").alias("n_semaines"), total.alias("total"),
        F.get("valeurs_ref", F.lit(0)).alias("lowest"),
    )


# --- D15, D16 -----------------------------------------------------------------------------------

ENVELOPE = """envelope AS (
  SELECT station_id, 'ips' AS indice, 'mois' AS pas, mois AS periode, list_min(valeurs_ref) AS minimum,
         list_median(valeurs_ref) AS mediane, list_max(valeurs_ref) AS maximum, n_annees, periode_ref,
         hors_reference FROM gw_normals
  UNION ALL
  SELECT station_id, 'debit', 'semaine', semaine, list_min(valeurs_ref), list_median(valeurs_ref),
         list_max(valeurs_ref), n_annees, periode_ref, hors_reference FROM fl_normals)"""


def envelopes(t: Tables) -> DataFrame:
    gw = ref.groundwater_normals(gw_monthly(t), "station_id", PERIOD)
    flow = ref.flow_normals(q7(t), "station_id", "date", "q7", PERIOD)
    return ref.envelope(gw, "station_id", "ips", "mois", "mois").unionByName(
        ref.envelope(flow, "station_id", "debit", "semaine", "semaine")
    )


@query(
    "envelope",
    with_sql(
        f"""SELECT station_id, indice, pas, periode, {s6('minimum')} AS minimum,
                   {s6('mediane')} AS mediane, {s6('maximum')} AS maximum, n_annees, periode_ref,
                   hors_reference FROM envelope""",
        NATION_DAY, MONTHLY, GW_NORMALS, DAY_SPINE, FLOW_NORMALS, ENVELOPE,
    ),
)
def _(t: Tables):
    table = envelopes(t)
    for c in ("minimum", "mediane", "maximum"):
        table = table.withColumn(c, r6(c))
    return table.withColumn("n_annees", F.col("n_annees").cast("long"))


def pettitt_sql(source: str, prefix: str, gap: str = "after_mean - before_mean") -> str:
    """CTE `<prefix>_breaks` from (station_id, year, value), by the definition over pairs."""
    return f"""{prefix}_n AS (SELECT *, count(*) OVER (PARTITION BY station_id) AS n,
        row_number() OVER (PARTITION BY station_id ORDER BY year) AS t FROM {source}),
    {prefix}_u AS (SELECT a.station_id, c.t, any_value(a.n) AS n, abs(sum(sign(b.value - a.value))) AS u
      FROM {prefix}_n a JOIN {prefix}_n b USING (station_id) JOIN {prefix}_n c USING (station_id)
      WHERE a.t <= c.t AND b.t > c.t AND a.n >= 5 GROUP BY 1, 2),
    {prefix}_best AS (SELECT * FROM {prefix}_u
      QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY u DESC, t) = 1),
    {prefix}_breaks AS (SELECT p.station_id, min(p.year) AS premiere_annee,
        max(p.year) AS derniere_annee, any_value(x.n) AS n_annees,
        min(p.year) FILTER (WHERE p.t > x.t) AS annee_rupture, any_value(x.u) AS k,
        least(1, 2 * exp(-6 * any_value(x.u) * any_value(x.u)
          / (pow(any_value(x.n), 3) + pow(any_value(x.n), 2)))) AS p_valeur,
        avg(p.value) FILTER (WHERE p.t <= x.t) AS before_mean,
        avg(p.value) FILTER (WHERE p.t > x.t) AS after_mean
      FROM {prefix}_n p JOIN {prefix}_best x USING (station_id) GROUP BY 1),
    {prefix}_out AS (SELECT station_id, premiere_annee, derniere_annee, n_annees, annee_rupture,
        {s6('k')} AS k, {s6('p_valeur')} AS p_valeur, {s6(gap)} AS ecart,
        p_valeur < 0.3::DOUBLE AS significative FROM {prefix}_breaks)"""


def _test_columns(df: DataFrame) -> DataFrame:
    return df.withColumn("k", r6("k")).withColumn("p_valeur", r6("p_valeur")).withColumn(
        "ecart", r6("ecart")
    )


@query(
    "pettitt_breaks",
    with_sql(
        "SELECT * FROM pt_out",
        NATION_DAY, MONTHLY,
        """yearly AS (SELECT station_id, annee AS year, avg(moyenne) AS value FROM monthly
             GROUP BY 1, 2 HAVING count(*) >= 10)""",
        pettitt_sql("yearly", "pt"),
    ),
)
def _(t: Tables):
    yearly = ref.yearly_levels(gw_monthly(t), "station_id")
    return _test_columns(ref.pettitt_breaks(yearly, ["station_id"], False, 5, 0.3))


@query(
    "break_report",
    with_sql(
        """SELECT 'piezo' AS source, *, station_id IN (SELECT station_id FROM stations WHERE zone_id = 'Z0')
             AS traitee FROM pt_out
           UNION ALL
           SELECT 'hydro', *, station_id IN (SELECT station_id FROM stations WHERE zone_id = 'Z0')
           FROM fl_out""",
        NATION_DAY, STATIONS, MONTHLY,
        """yearly AS (SELECT station_id, annee AS year, avg(moyenne) AS value FROM monthly
             GROUP BY 1, 2 HAVING count(*) >= 10)""",
        """flows AS (SELECT station_id, year(date)::INT AS year, ln(greatest(avg(value), 1)) AS value
             FROM nation_day GROUP BY 1, 2 HAVING count(*) >= 100)""",
        pettitt_sql("yearly", "pt"),
        pettitt_sql("flows", "fl", "exp(after_mean - before_mean)"),
    ),
)
def _(t: Tables):
    levels = ref.yearly_levels(gw_monthly(t), "station_id")
    flows = ref.yearly_log_flows(nation_day(t), "station_id", "date", "value", 100)
    tests = (
        ref.pettitt_breaks(levels, ["station_id"], False, 5, 0.3)
        .withColumn("source", F.lit("piezo"))
        .unionByName(
            ref.pettitt_breaks(flows, ["station_id"], True, 5, 0.3).withColumn(
                "source", F.lit("hydro")
            )
        )
    )
    treated = stations(t).where("zone_id = 'Z0'")
    return _test_columns(ref.break_report(tests, treated))
