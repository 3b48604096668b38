"""M: documented studies."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.api_queries import BASE, composite_table
from registry.core import (
    NATION_DAY, READINGS, REGION_DAY, REGION_RAIN, STATIONS, Tables, class_sql, nation_day, query,
    r6, readings, region_rain, s6, sday, ssunday, stations, sweek, text_day, with_sql,
)
from registry.optical_queries import rounded
from registry.radar_queries import trend_columns, trend_sql
from registry.reference_queries import (
    DAY_SPINE, FLOW_NORMALS, PERIOD, pettitt_sql, q7,
)
from registry.validation_queries import ALL, stored_table
from sluice.functions import calendar as cal
from sluice.functions.ranking import spearman
from sluice.operators import radar
from sluice.operators import reference as ref
from sluice.operators import studies as st


@query(
    "series_concordance",
    with_sql(
        f"""SELECT zone_id, count(*) AS n_jours, {s6('corr(ln(a.value), ln(b.value))', 5)} AS correlation_log,
              {s6('median(a.value / b.value)')} AS rapport_median
            FROM (SELECT zone_id, date, arg_min(value, station_id) AS value FROM nation_day JOIN stations USING (station_id) GROUP BY 1, 2) a
            JOIN (SELECT zone_id, date, arg_max(value, station_id) AS value FROM nation_day JOIN stations USING (station_id) GROUP BY 1, 2) b
              USING (zone_id, date) GROUP BY 1""",
        NATION_DAY, STATIONS,
    ),
)
def _(t: Tables):
    rows = nation_day(t).join(stations(t), "station_id").groupBy("zone_id", "date")
    a = rows.agg(F.min_by("value", "station_id").alias("value"))
    b = rows.agg(F.max_by("value", "station_id").alias("value"))
    table = st.series_concordance(a, b, ["zone_id"], "date", "value")
    return rounded(rounded(table, "correlation_log", digits=5), "rapport_median")


# all 231 combinations of three weights on the step of the study, 0.05
_SWEEP = f"""parts AS (SELECT zone_id, semaine, niveau >= 2 AS alerte, CASE WHEN annee < 1999 THEN 'a' ELSE 'b' END AS periode,
    valeur AS a, ips AS b, valeur * valeur AS c FROM vt),
  w AS (SELECT i / 20 AS wa, j / 20 AS wb, (20 - i - j) / 20 AS wc FROM (SELECT unnest(range(0, 21)) AS i), (SELECT unnest(range(0, 21)) AS j) WHERE i + j <= 20),
  swept AS (SELECT *, {class_sql('v')} <> {class_sql('now')} AS changed FROM (
    SELECT zone_id, periode, wa, wb, wc, alerte, (wa * a + (CASE WHEN b IS NOT NULL THEN wb * b ELSE 0 END) + wc * c) / nullif(wa + (CASE WHEN b IS NOT NULL THEN wb ELSE 0 END) + wc, 0) AS v,
      (0.5 * a + (CASE WHEN b IS NOT NULL THEN 0.25 * b ELSE 0 END) + 0.25 * c) / (0.5 + (CASE WHEN b IS NOT NULL THEN 0.25 ELSE 0 END) + 0.25) AS now
    FROM parts, w)),
  scored AS (SELECT zone_id, periode, wa, wb, wc, count(*) FILTER (WHERE alerte) AS n_positive, count(*) FILTER (WHERE NOT alerte) AS n_negative,
      (sum(r) FILTER (WHERE alerte) - count(*) FILTER (WHERE alerte) * (count(*) FILTER (WHERE alerte) + 1) / 2)
        / nullif(count(*) FILTER (WHERE alerte) * count(*) FILTER (WHERE NOT alerte), 0) AS auc
    FROM (SELECT *, rank() OVER (PARTITION BY zone_id, periode, wa, wb, wc ORDER BY v DESC) + (count(*) OVER (PARTITION BY zone_id, periode, wa, wb, wc, v) - 1) / 2 AS r
          FROM swept WHERE v IS NOT NULL) GROUP BY ALL)"""


@query(
    "weight_sweep",
    with_sql(
        f"""SELECT zone_id, periode, wa AS w_a, wb AS w_b, wc AS w_c, n_positive, n_negative, coalesce({s6('auc')}, -1) AS auc, {s6('ch')} AS part_changee,
              count(*) FILTER (WHERE auc >= best - 0.01::DOUBLE) OVER (PARTITION BY zone_id, periode) AS n_proches
            FROM (SELECT *, max(auc) OVER (PARTITION BY zone_id, periode) AS best FROM scored JOIN (
              SELECT zone_id, periode, wa, wb, wc, avg(changed::INT) AS ch FROM swept GROUP BY ALL) USING (zone_id, periode, wa, wb, wc))""",
        *ALL, _SWEEP,
    ),
)
def _(t: Tables):
    table = stored_table(t).select(
        "zone_id", "semaine", "niveau", "annee", F.col("valeur").alias("a"), F.col("ips").alias("b"),
        (F.col("valeur") * F.col("valeur")).alias("c"),
    )
    rows = st.weight_sweep(
        table, ["a", "b", "c"], {"a": 0.5, "b": 0.25, "c": 0.25}, F.col("niveau") >= 2,
        F.when(F.col("annee") < 1999, "a").otherwise("b"),
    )
    return rounded(rows, "part_changee").withColumn("auc", F.coalesce(r6("auc"), F.lit(-1.0)))


EXTREMES = """wide AS (SELECT station_id, year(date) + (month(date) = 12)::INT AS year, min(value) FILTER (WHERE month(date) IN (7, 8, 9)) AS low,
    max(value) FILTER (WHERE month(date) IN (12, 1, 2, 3)) AS high FROM nation_day GROUP BY 1, 2),
  extremes AS (SELECT station_id, year, unnest(['minimum_ete', 'maximum_hiver', 'amplitude']) AS mesure, unnest([low, high, high - low]) AS value FROM wide)"""


def extremes(t: Tables) -> DataFrame:
    return st.seasonal_extremes(nation_day(t), "station_id", "date", "value")


@query(
    "seasonal_extremes",
    with_sql("SELECT station_id, year::INT AS year, mesure, value FROM extremes WHERE value IS NOT NULL", NATION_DAY, EXTREMES),
)
def _(t: Tables):
    return extremes(t)


@query(
    "seasonal_extreme_trend",
    with_sql(
        trend_sql("known", "station_id, mesure", "year", "value"),
        NATION_DAY, EXTREMES, "known AS (SELECT * FROM extremes WHERE value IS NOT NULL)",
    ),
)
def _(t: Tables):
    return trend_columns(radar.trend_test(extremes(t), ["station_id", "mesure"], "year", "value"))


@query(
    "seasonal_extreme_breaks",
    with_sql(
        """SELECT split_part(station_id, '/', 1) AS station_id, split_part(station_id, '/', 2) AS mesure,
             annee_rupture::INT AS annee_rupture, k, p_valeur, ecart FROM pt_out""",
        NATION_DAY, EXTREMES,
        "yearly AS (SELECT station_id || '/' || mesure AS station_id, year, value FROM extremes WHERE value IS NOT NULL)",
        pettitt_sql("yearly", "pt"),
    ),
)
def _(t: Tables):
    rows = ref.pettitt_breaks(extremes(t), ["station_id", "mesure"], False, 5, 0.3)
    return rounded(rows, "k", "p_valeur", "ecart").select(
        "station_id", "mesure", "annee_rupture", "k", "p_valeur", "ecart"
    )


@query(
    "class_share_by_period",
    with_sql(
        f"""SELECT zone_id, (floor((y - 1) / 3) * 3 + 1)::INT AS debut, 'periode' AS genre, count(*) AS n, {s6('avg((classe = 1)::INT)')} AS part
            FROM c GROUP BY 1, 2 UNION ALL
            SELECT zone_id, y, 'saison', count(*), {s6('avg((classe <= 2)::INT)')} FROM c WHERE w BETWEEN 27 AND 39 GROUP BY 1, 2""",
        *BASE, "c AS (SELECT *, substr(semaine, 1, 4)::INT AS y, substr(semaine, 7)::INT AS w FROM idx)",
    ),
)
def _(t: Tables):
    return rounded(st.class_share_by_period(composite_table(t), 3), "part")


_RATIO = """monthly AS (SELECT station_id, year(date)::INT AS annee, month(date)::INT AS mois, avg(value) AS moyenne FROM nation_day GROUP BY 1, 2, 3),
  ratio AS (SELECT *, percent_rank() OVER (PARTITION BY station_id, mois ORDER BY rapport) AS rang FROM (
    SELECT *, moyenne / avg(moyenne) OVER (PARTITION BY station_id, mois) AS rapport FROM monthly))"""


@query(
    "ratio_to_normal",
    with_sql(
        f"""SELECT station_id, annee, mois, {s6('moyenne')} AS moyenne, {s6('rapport')} AS rapport, {s6('rang')} AS rang, rapport < 0.5 AS sous_moitie FROM ratio""",
        NATION_DAY, _RATIO,
    ),
)
def _(t: Tables):
    return rounded(st.ratio_to_normal(nation_day(t), "station_id", "date", "value"), "moyenne", "rapport", "rang")


@query(
    "ratio_rank_correlation",
    with_sql(
        f"""SELECT station_id, count(*) AS n, {s6('corr(ra, rb)', 5)} AS rho FROM (
              SELECT station_id, rank() OVER (PARTITION BY station_id ORDER BY moyenne) + (count(*) OVER (PARTITION BY station_id, moyenne) - 1) / 2 AS ra,
                rank() OVER (PARTITION BY station_id ORDER BY rang) + (count(*) OVER (PARTITION BY station_id, rang) - 1) / 2 AS rb FROM ratio) GROUP BY 1""",
        NATION_DAY, _RATIO,
    ),
)
def _(t: Tables):
    rows = st.ratio_to_normal(nation_day(t), "station_id", "date", "value")
    return rounded(spearman(rows, ["station_id"], "moyenne", "rang"), "rho", digits=5)


# --- Quality of readings ------------------------------------------------------------------------

FILL = """fill AS (SELECT station_id, date, volume_m3, capacite_m3, 100 * volume_m3 / capacite_m3::DOUBLE AS pct FROM readings),
  near AS (SELECT *, lag(pct) OVER w AS p, lead(pct) OVER w AS q FROM fill WINDOW w AS (PARTITION BY station_id ORDER BY date)),
  flagged AS (SELECT *, coalesce(abs(pct - p) > 20 AND abs(pct - q) > 20 AND abs(p - q) <= 10, false) AS isole FROM near)"""


def fill(t: Tables) -> DataFrame:
    return readings(t).withColumn("pct", 100 * F.col("volume_m3") / F.col("capacite_m3"))


@query(
    "isolated_outliers",
    with_sql(
        f"""SELECT station_id, {sday('date')} AS date, {s6('pct')} AS pct, isole, {s6('CASE WHEN isole THEN (p + q) / 2 ELSE pct END')} AS corrige FROM flagged""",
        READINGS, FILL,
    ),
)
def _(t: Tables):
    rows = st.isolated_outliers(fill(t), "station_id", "date", "pct")
    return rows.select("station_id", text_day("date").alias("date"), r6("pct").alias("pct"), "isole", r6("corrige").alias("corrige"))


@query(
    "outlier_effect",
    with_sql(
        f"""SELECT {sweek('date')} AS semaine, {s6('sum(pct)', 5)} AS brut, {s6('sum(CASE WHEN isole THEN (p + q) / 2 ELSE pct END)', 5)} AS corrige,
              count(*) FILTER (WHERE isole) AS n_isoles FROM flagged GROUP BY 1 HAVING bool_or(isole)""",
        READINGS, FILL,
    ),
)
def _(t: Tables):
    rows = st.outlier_effect(st.isolated_outliers(fill(t), "station_id", "date", "pct"), "date", "pct")
    return rounded(rows, "brut", "corrige", digits=5)


@query(
    "plateaus",
    with_sql(
        f"""SELECT station_id, {s6('sum(rep) / sum(len)')} AS part_repetee, max(len) AS plus_longue FROM (
              SELECT station_id, g, count(*) AS len, count(*) - 1 AS rep FROM (
                SELECT station_id, volume_m3, row_number() OVER (PARTITION BY station_id ORDER BY date) - row_number() OVER (PARTITION BY station_id, volume_m3 ORDER BY date) AS g
                FROM readings) GROUP BY station_id, volume_m3, g) GROUP BY 1""",
        READINGS,
    ),
)
def _(t: Tables):
    return rounded(st.plateaus(readings(t), "station_id", "date", "volume_m3"), "part_repetee")


@query(
    "change_profile",
    with_sql(
        f"""SELECT station_id, count(*) AS n, {s6('median(abs(pct - p))')} AS variation_mediane, count(*) FILTER (WHERE abs(pct - p) > 10) AS n_fortes,
              count(*) FILTER (WHERE abs(pct - p) > 10 AND abs(q - p) <= abs(pct - p) / 2) AS n_annulees,
              count(*) FILTER (WHERE abs(pct - p) > 10 AND (month(date) >= 11 OR month(date) <= 4)) AS n_hiver
            FROM near WHERE p IS NOT NULL GROUP BY 1""",
        READINGS, FILL,
    ),
)
def _(t: Tables):
    return rounded(st.change_profile(fill(t), "station_id", "date", "pct"), "variation_mediane")


@query(
    "extreme_association",
    with_sql(
        f"""SELECT count(*) FILTER (WHERE isole) AS n, {s6('avg(high::INT) FILTER (WHERE isole)')} AS part, {s6('(SELECT avg(high::INT) FROM h)')} AS part_attendue
            FROM (SELECT {sweek('date')} AS semaine, isole FROM flagged) JOIN h USING (semaine)""",
        READINGS, FILL, NATION_DAY,
        f"weekly AS (SELECT {sweek('date')} AS semaine, sum(value) AS v FROM nation_day GROUP BY 1)",
        "h AS (SELECT semaine, v > (SELECT quantile_cont(v, 0.9) FROM weekly) AS high FROM weekly)",
    ),
)
def _(t: Tables):
    week = cal.iso_week_label(F.col("date")).alias("semaine")
    flagged = st.isolated_outliers(fill(t), "station_id", "date", "pct").withColumn(
        "semaine", cal.iso_week_label(F.col("date"))
    )
    weekly = nation_day(t).groupBy(week).agg(F.sum("value").alias("v"))
    return rounded(st.extreme_association(flagged, weekly, "semaine", "isole", "v"), "part", "part_attendue")


@query(
    "tie_share",
    with_sql(
        f"""SELECT station_id, saison, count(*) AS n, {s6('avg((v = low)::INT)')} AS part_minimum, {s6('avg((v = 0)::INT)')} AS part_zero
            FROM (SELECT *, min(v) OVER (PARTITION BY station_id, saison) AS low FROM (
              SELECT station_id, CASE WHEN semaine BETWEEN 27 AND 39 THEN 'ete' ELSE 'autre' END AS saison, unnest(valeurs_ref) AS v FROM fl_normals)) GROUP BY 1, 2""",
        NATION_DAY, DAY_SPINE, FLOW_NORMALS,
    ),
)
def _(t: Tables):
    normals = ref.flow_normals(q7(t), "station_id", "date", "q7", PERIOD)
    rows = normals.select("station_id", "semaine", F.explode("valeurs_ref").alias("v"))
    season = F.when(F.col("semaine").between(27, 39), "ete").otherwise("autre")
    return rounded(st.tie_share(rows, ["station_id"], season, "v"), "part_minimum", "part_zero")


@query(
    "missing_weeks",
    f"""WITH seen AS (SELECT DISTINCT o_custkey AS code, {sweek('o_orderdate')} AS semaine FROM orders),
        spine AS (SELECT code, strftime(unnest(generate_series({ssunday('a')}, {ssunday('b')}, INTERVAL 7 DAY)), '%G-W%V') AS semaine
          FROM (SELECT code, min(semaine) AS a, max(semaine) AS b FROM seen GROUP BY 1))
        SELECT * FROM spine ANTI JOIN seen USING (code, semaine)""",
)
def _(t: Tables):
    rows = t.orders.select(F.col("o_custkey").alias("code"), F.to_date("o_orderdate").alias("date"))
    return st.missing_weeks(rows, "code", "date")


@query(
    "capacity_exceedances",
    with_sql(
        f"""SELECT station_id, count(*) AS n, count(*) FILTER (WHERE volume_m3 > capacite_m3) AS n_depassements,
              {s6('max(volume_m3 / capacite_m3::DOUBLE)')} AS ratio_max FROM readings GROUP BY 1""",
        READINGS,
    ),
)
def _(t: Tables):
    return rounded(st.capacity_exceedances(readings(t), "station_id", "volume_m3", "capacite_m3"), "ratio_max")


@query(
    "zero_day_share",
    with_sql(
        f"""SELECT zone_id, (floor(year(date) / 2) * 2)::INT AS debut, count(*) AS n, {s6('avg((value = 0)::INT)')} AS part_zero
            FROM region_rain WHERE month(date) IN (7, 8, 9) GROUP BY 1, 2""",
        NATION_DAY, STATIONS, REGION_DAY, REGION_RAIN,
    ),
)
def _(t: Tables):
    return rounded(st.zero_day_share(region_rain(t), "zone_id", "date", "value", 2), "part_zero")
