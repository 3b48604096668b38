"""E: weekly indices, zone means, composite, and the flagship query."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry.core import (
    FIRST_SUNDAY, LAST_SUNDAY, NATION_DAY, READINGS, REF, REGION_DAY, REGION_RAIN, STATIONS, Tables, class_sql, nation_day,
    nation_id, probit_sql, query, r6, rank_p_sql, readings, region_rain, s6, sday,
    select_years_sql, ship_weeks, ssunday, stations, sweek, text_day, with_sql,
)
from registry.reference_queries import (
    DAY_SPINE, FLOW_NORMALS, GW_NORMALS, MONTHLY, PERIOD, SPI_NORMALS, WINDOWS, ZONE_WEEKS,
    gw_monthly, q7, rain_totals, rank_reference_sql, totals_sql, zone_weeks,
)
from sluice.functions import calendar as cal
from sluice.functions import stats
from sluice.operators import indices as ix
from sluice.operators import reference as ref
from sluice.plans import weekly
from sluice.session import cut_lineage

_Y, _P, _O = select_years_sql("valid")
LESS = "len(list_filter(valeurs_ref, lambda x: x < {v}))"
SAME = "len(list_filter(valeurs_ref, lambda x: x = {v}))"


def sample_p(v: str) -> str:
    return rank_p_sql(LESS.format(v=v), SAME.format(v=v), "len(valeurs_ref)")


# --- Flagship -----------------------------------------------------------------------------------

@query(
    "weekly_rank_index",
    with_sql(
        f"""SELECT zone_id, {sweek('date')} AS semaine, total, {s6('z')} AS valeur,
                   {class_sql('z')} AS classe, periode_ref, hors_reference
            FROM (SELECT *, {probit_sql('p')} AS z FROM (
              SELECT *, {sample_p('total')} AS p FROM totals t JOIN refs USING (zone_id)
              WHERE least(weekofyear(t.date), 52) = refs.semaine))""",
        NATION_DAY, STATIONS, REGION_DAY, REGION_RAIN, totals_sql("region_rain", {"d30": 30}),
        f"""years AS (SELECT zone_id, least(weekofyear(date), 52)::INT AS semaine,
             list_sort(list(DISTINCT isoyear(date)::INT)) AS valid FROM totals GROUP BY 1, 2),
        chosen AS (SELECT zone_id, semaine, {_Y} AS years, {_P} AS periode_ref,
             {_O} AS hors_reference FROM years WHERE len({_Y}) > 0),
        refs AS (SELECT c.zone_id, c.semaine, periode_ref, hors_reference,
             list_sort(list(total)) AS valeurs_ref
           FROM totals t JOIN chosen c ON t.zone_id = c.zone_id
             AND least(weekofyear(t.date), 52) = c.semaine
             AND list_contains(c.years, isoyear(t.date)::INT) GROUP BY ALL)""",
    ),
)
def _(t: Tables):
    totals = ref.rolling_sum_full(region_rain(t), ["zone_id"], "date", "value", {"d30": 30})
    return ix.weekly_rank_index(totals, "zone_id", "date", "total", PERIOD).select(
        "zone_id", "semaine", "total", r6("valeur").alias("valeur"), "classe", "periode_ref",
        "hors_reference",
    )


# --- E1 to E4 -----------------------------------------------------------------------------------

@query(
    "rank_z",
    with_sql(
        f"""SELECT station_id, {sday('date')} AS date, volume_m3, {s6(probit_sql('p'))} AS z
            FROM (SELECT r.*, {sample_p('volume_m3')} AS p FROM readings r JOIN (
              SELECT station_id, list(volume_m3) AS valeurs_ref FROM readings GROUP BY 1)
              USING (station_id))""",
        READINGS,
    ),
)
def _(t: Tables):
    rows = readings(t)
    samples = rows.groupBy("station_id").agg(
        F.sort_array(F.collect_list("volume_m3")).alias("sample")
    )
    ranked = ix.rank_z(rows.join(samples, "station_id"), "volume_m3", "sample", "z")
    return ranked.select("station_id", text_day("date").alias("date"), "volume_m3", r6("z").alias("z"))


def gamma_z_sql(source: str, x: str, terms: int = 6000) -> str:
    """Clipped quantile from (forme, echelle, q0): the series of the incomplete gamma function
    below shape + 1, each term written with log-gamma, and its continued fraction above."""
    u = f"({x} / echelle)"
    series = (
        f"list_sum(list_transform(range(0, {terms}), lambda n: exp(n * ln({u}) + lgamma(forme + 1)"
        f" - lgamma(forme + n + 1))))"
    )
    depth = terms // 2
    fraction = (
        f"list_reduce(list_prepend({u} + {2 * depth + 1} - forme, "
        f"list_transform(range({depth}, 0, -1), lambda n: n::DOUBLE)), "
        f"lambda acc, n: {u} + 2 * n - 1 - forme - n * (n - forme) / acc)"
    )
    front = f"exp(forme * ln({u}) - {u} - lgamma(forme + 1))"
    cdf = (
        f"CASE WHEN {x} <= 0 THEN 0::DOUBLE WHEN {u} < forme + 1 THEN {front} * {series} "
        f"ELSE 1 - {front} * forme / {fraction} END"
    )
    return (
        f"SELECT *, CASE WHEN p <= 0 THEN -3::DOUBLE WHEN p >= 1 THEN 3::DOUBLE "
        f"ELSE greatest(least({probit_sql('p')}, 3), -3) END AS z "
        f"FROM (SELECT *, q0 + (1 - q0) * ({cdf}) AS p FROM {source})"
    )


@query(
    "gamma_z",
    with_sql(
        f"""SELECT zone_id, {sday('date')} AS date, value, {s6('z', 5)} AS z
            FROM ({gamma_z_sql('(SELECT r.*, 1.5::DOUBLE AS forme, m / 1.5::DOUBLE AS echelle, q0 FROM region_rain r JOIN means USING (zone_id))', 'value')})""",
        NATION_DAY, STATIONS, REGION_DAY, REGION_RAIN,
        """means AS (SELECT zone_id, avg(value) FILTER (WHERE value > 0) AS m,
             1 - count(*) FILTER (WHERE value > 0) / count(*)::DOUBLE AS q0
           FROM region_rain GROUP BY 1)""",
    ),
)
def _(t: Tables):
    rain = region_rain(t)
    positive = F.when(F.col("value") > 0, F.col("value"))
    means = rain.groupBy("zone_id").agg(
        F.lit(1.5).alias("forme"),
        (F.avg(positive) / 1.5).alias("echelle"),
        (1 - F.count(positive) / F.count("*")).alias("q0"),
    )
    scored = ix.gamma_z(rain.join(means, "zone_id"), "value", "forme", "echelle", "q0", "z")
    return scored.select("zone_id", text_day("date").alias("date"), "value", r6("z", 5).alias("z"))


@query(
    "classify",
    f"""SELECT {class_sql('v')} AS classe, count(*) AS n, sum(q) AS qty
        FROM (SELECT (l_quantity - 25) / 12 AS v, l_quantity AS q FROM lineitem) GROUP BY 1""",
)
def _(t: Tables):
    v = (F.col("l_quantity") - 25) / 12
    return t.lineitem.groupBy(stats.classify(v).alias("classe")).agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("qty")
    )


@query(
    "regime_filter",
    with_sql(
        """SELECT station_id, count(*) AS n, sum(value) AS qty FROM nation_day
           JOIN (SELECT station_id, CASE WHEN zone_id <> 'Z0' THEN 1995 + substr(zone_id, 2)::INT END AS b
                 FROM stations) USING (station_id)
           WHERE b IS NULL OR year(date) >= b GROUP BY 1""",
        NATION_DAY, STATIONS,
    ),
)
def _(t: Tables):
    breaks = stations(t).select(
        "station_id",
        F.when(
            F.col("zone_id") != "Z0", F.lit(1995) + F.substring("zone_id", 2, 1).cast("int")
        ).alias("rupture"),
    )
    kept = ix.regime_filter(nation_day(t).join(breaks, "station_id"), "date", "rupture")
    return kept.groupBy("station_id").agg(F.count("*").alias("n"), F.sum("value").alias("qty"))


# --- E5 to E7 -----------------------------------------------------------------------------------

TARGETS = f"""targets AS (
  SELECT station_id, unnest(generate_series({FIRST_SUNDAY}, {LAST_SUNDAY},
         INTERVAL 7 DAY))::DATE AS sunday FROM (SELECT DISTINCT station_id FROM nation_day)),
running AS (
  SELECT t.station_id, t.sunday, avg(value) AS moyenne, count(*) AS n_jours, max(date) AS date_mesure
  FROM targets t JOIN nation_day d ON d.station_id = t.station_id AND d.date <= t.sunday
       AND d.date >= date_trunc('month', t.sunday)
  GROUP BY 1, 2),
previous AS (
  SELECT t.station_id, t.sunday, m.moyenne, m.derniere AS date_mesure, m.mois
  FROM targets t JOIN monthly m ON m.station_id = t.station_id
       AND make_date(m.annee, m.mois, 1) < date_trunc('month', t.sunday)
  QUALIFY row_number() OVER (PARTITION BY t.station_id, t.sunday ORDER BY m.annee DESC, m.mois DESC) = 1)"""
GW_INDEX = f"""gw_kept AS (
  SELECT station_id, sunday, moyenne, date_mesure, month(sunday)::INT AS mois FROM running
  WHERE n_jours >= 10
  UNION ALL
  SELECT p.* FROM previous p WHERE NOT EXISTS (SELECT 1 FROM running r WHERE r.n_jours >= 10
    AND r.station_id = p.station_id AND r.sunday = p.sunday)),
gw_index AS (
  SELECT station_id, {sweek('sunday')} AS semaine, 'ips' AS indice, {probit_sql('p')} AS valeur,
         periode_ref, hors_reference, date_mesure, sunday - date_mesure < 45 AS dans_composite
  FROM (SELECT *, {sample_p('moyenne')} AS p FROM gw_kept JOIN gw_normals USING (station_id, mois)
        WHERE sunday - date_mesure <= 365))"""


def target_sundays(t: Tables) -> tuple[Column, Column]:
    """First and last Sunday of the indices: the weeks of the observations."""
    return tuple(cal.week_sunday(F.lit(week)) for week in ship_weeks(t))


@query(
    "running_month",
    with_sql(
        f"""SELECT station_id, {sday('sunday')} AS sunday, {s6('moyenne')} AS moyenne, n_jours,
                   {sday('date_mesure')} AS date_mesure FROM running""",
        NATION_DAY, MONTHLY, TARGETS,
    ),
)
def _(t: Tables):
    rows = ix.running_month(nation_day(t), "station_id", "date", "value")
    return rows.where(F.col("sunday").between(*target_sundays(t))).select(
        "station_id", text_day("sunday").alias("sunday"), r6("moyenne").alias("moyenne"), "n_jours",
        text_day("date_mesure").alias("date_mesure"),
    )


@query(
    "previous_valid_month",
    with_sql(
        f"""SELECT station_id, {sday('sunday')} AS sunday, {s6('moyenne')} AS moyenne, mois,
                   {sday('date_mesure')} AS date_mesure FROM previous
            WHERE sunday - date_mesure <= 365""",
        NATION_DAY, MONTHLY, TARGETS,
    ),
)
def _(t: Tables):
    start, end = target_sundays(t)
    rows = ix.previous_valid_month(gw_monthly(t), "station_id", 365, end)
    return rows.where(F.col("sunday") >= start).select(
        "station_id", text_day("sunday").alias("sunday"), r6("moyenne").alias("moyenne"), "mois",
        text_day("date_mesure").alias("date_mesure"),
    )


def gw_index(t: Tables) -> DataFrame:
    normals = ref.groundwater_normals(gw_monthly(t), "station_id", PERIOD)
    return ix.groundwater_index(
        nation_day(t), normals, "station_id", "date", "value", *target_sundays(t)
    )


def _station_columns(df: DataFrame) -> DataFrame:
    return df.withColumn("valeur", r6("valeur")).withColumn("date_mesure", text_day("date_mesure"))


@query(
    "groundwater_index",
    with_sql(
        f"""SELECT * REPLACE ({s6('valeur')} AS valeur, {sday('date_mesure')} AS date_mesure)
            FROM gw_index""",
        NATION_DAY, MONTHLY, GW_NORMALS, TARGETS, GW_INDEX,
    ),
)
def _(t: Tables):
    return _station_columns(gw_index(t))


# --- E8, E9 -------------------------------------------------------------------------------------

FLOW_INDEX = f"""flow_index AS (
  SELECT station_id, {sweek('date')} AS semaine, 'debit' AS indice, {probit_sql('p')} AS valeur,
         periode_ref, hors_reference, date_mesure, true AS dans_composite
  FROM (SELECT *, {sample_p('q7')} AS p
        FROM (SELECT *, least(weekofyear(date), 52)::INT AS semaine FROM rolling WHERE isodow(date) = 7) JOIN fl_normals USING (station_id, semaine)
        WHERE date BETWEEN {FIRST_SUNDAY} AND {LAST_SUNDAY}))"""
SPI_INDEX = f"""spi_index AS (
  SELECT zone_id, {sweek('date')} AS semaine, indice, z AS valeur, periode_ref, hors_reference
  FROM ({gamma_z_sql('(SELECT t.zone_id, t.date, t.indice, total, forme, echelle, q0, periode_ref, hors_reference FROM totals t JOIN spi_normals n ON t.zone_id = n.zone_id AND t.indice = n.indice AND least(weekofyear(t.date), 52) = n.semaine)', 'total')})
  WHERE date BETWEEN {FIRST_SUNDAY} AND {LAST_SUNDAY})"""
RAIN = (NATION_DAY, STATIONS, REGION_DAY, REGION_RAIN, totals_sql("region_rain", WINDOWS))


@query(
    "flow_index",
    with_sql(
        f"""SELECT * REPLACE ({s6('valeur')} AS valeur, {sday('date_mesure')} AS date_mesure)
            FROM flow_index""",
        NATION_DAY, DAY_SPINE, FLOW_NORMALS, FLOW_INDEX,
    ),
)
def _(t: Tables):
    rolling = q7(t)
    normals = ref.flow_normals(rolling, "station_id", "date", "q7", PERIOD)
    return _station_columns(ix.flow_index(rolling, normals, "station_id", "date", *target_sundays(t)))


@query(
    "spi_index",
    with_sql(
        f"""SELECT zone_id, semaine, indice, {s6('valeur', 4)} AS valeur, periode_ref, hors_reference
            FROM spi_index""",
        *RAIN, SPI_NORMALS, SPI_INDEX,
    ),
)
def _(t: Tables):
    totals = rain_totals(t)
    normals = ref.spi_normals(totals, "zone_id", "date", PERIOD)
    rows = ix.spi_index(totals, normals, "zone_id", "date", *target_sundays(t))
    return rows.select(
        "zone_id", "semaine", "indice", r6("valeur", 4).alias("valeur"), "detail.periode_ref",
        "detail.hors_reference",
    )


# --- E10 ----------------------------------------------------------------------------------------

def campaigns(t: Tables) -> DataFrame:
    """Orders as stream-state observations: one station per supplier nation and day."""
    rows = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    state = F.max(
        F.when(F.col("l_returnflag") == "R", "3").when(F.col("l_linestatus") == "F", "2")
        .otherwise("1")
    )
    return rows.groupBy(
        nation_id("s_nationkey").alias("station_id"), F.to_date("l_shipdate").alias("date_campagne")
    ).agg(
        state.alias("modalite"),
        F.max(F.when(F.col("l_linenumber") > 6, "complementaire").otherwise("usuelle")).alias(
            "type_campagne"
        ),
    )


CAMPAIGNS = """campaigns AS (
  SELECT 'N' || lpad(s_nationkey::VARCHAR, 2, '0') AS station_id, l_shipdate::DATE AS date_campagne,
    max(CASE WHEN l_returnflag = 'R' THEN '3' WHEN l_linestatus = 'F' THEN '2' ELSE '1' END) AS modalite,
    max(CASE WHEN l_linenumber > 6 THEN 'complementaire' ELSE 'usuelle' END) AS type_campagne
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
campaign_share AS (
  SELECT zone_id, strftime(date_campagne, '%G-W%V') AS semaine, date_campagne,
         count(DISTINCT station_id) AS n_stations,
         count(*) FILTER (WHERE modalite = '2') AS n_rupture,
         count(*) FILTER (WHERE modalite = '3') AS n_assec,
         string_agg(DISTINCT type_campagne, ', ' ORDER BY type_campagne) AS type_campagne
  FROM campaigns JOIN stations USING (station_id) GROUP BY 1, 2, 3
  QUALIFY row_number() OVER (PARTITION BY zone_id, strftime(date_campagne, '%G-W%V')
                             ORDER BY date_campagne DESC) = 1)"""


@query(
    "campaign_share",
    with_sql(
        f"""SELECT zone_id, semaine, {s6('(n_rupture + n_assec) / n_stations')} AS valeur, n_stations,
                   {sday('date_campagne')} AS date_campagne, n_rupture, n_assec, type_campagne
            FROM campaign_share""",
        STATIONS, CAMPAIGNS,
    ),
)
def _(t: Tables):
    share = ix.campaign_share(campaigns(t), stations(t))
    return share.select(
        "zone_id", "semaine", r6("valeur").alias("valeur"), "n_stations",
        text_day("detail.date_campagne").alias("date_campagne"), "detail.n_rupture",
        "detail.n_assec", "detail.type_campagne",
    )


# --- E11 to E16: the chain ----------------------------------------------------------------------

def weights_table(t: Tables) -> DataFrame:
    """Component weights per zone; the last zone ignores flow and misses a component."""
    zones = stations(t).select("zone_id").distinct()
    parts = F.create_map(
        F.lit("spi_3"), F.lit(0.25), F.lit("ips"), F.lit(0.5),
        F.lit("debit"), F.when(F.col("zone_id") == "Z4", 0.0).otherwise(0.25),
        F.lit("niveau"), F.when(F.col("zone_id") == "Z3", 0.5).otherwise(0.0),
    )
    return zones.select("zone_id", F.explode(parts).alias("indice", "poids"))


def chain_inputs(t: Tables) -> weekly.Inputs:
    daily = cut_lineage(nation_day(t))  # the stored observations of the chain
    return weekly.Inputs(
        groundwater=daily, flow=daily, rain=region_rain(t), stations=stations(t),
        weights=weights_table(t), campaigns=campaigns(t),
        regime_zones=stations(t).where("zone_id = 'Z1'"),
    )


CHAIN = weekly.Settings(period=PERIOD, q7_days_min=3, version="D14")


def chain(t: Tables) -> dict[str, DataFrame]:
    first, last = ship_weeks(t)
    return weekly.weekly_tables(chain_inputs(t), CHAIN, first, last, history=first)


STATION_INDEX = """station_index AS (
  SELECT * FROM gw_index UNION ALL SELECT * FROM flow_index),
zone_mean AS (
  SELECT zone_id, semaine, indice, sum(valeur::DECIMAL(28, 12))::DOUBLE / count(*) AS valeur,
         count(*) AS n_stations, string_agg(station_id, ',' ORDER BY station_id) AS stations
  FROM station_index JOIN stations USING (station_id) WHERE dans_composite GROUP BY 1, 2, 3)"""
STATION_CTES = (
    *RAIN, MONTHLY, GW_NORMALS, TARGETS, GW_INDEX, DAY_SPINE, FLOW_NORMALS, FLOW_INDEX,
    STATION_INDEX,
)


def restandardise_sql(source: str, refs: str, keys: str) -> str:
    """Adds raw, has_ref and the ranked value."""
    return f"""SELECT * EXCLUDE (p, valeurs_ref, raw), raw, p IS NOT NULL AS has_ref,
        CASE WHEN p IS NULL THEN raw ELSE {probit_sql('p')} END AS valeur
      FROM (SELECT z.* EXCLUDE (valeur), z.valeur AS raw, r.valeurs_ref,
              r.periode_ref AS reference, coalesce(r.hors_reference, true) AS hors_reference,
              CASE WHEN r.valeurs_ref IS NOT NULL THEN {sample_p('z.valeur')} END AS p
            FROM {source} z LEFT JOIN {refs} r USING ({keys}))"""


def composite_sql(source: str) -> str:
    def part(name: str, weight: str) -> str:
        return f"coalesce({weight} * max(valeur) FILTER (WHERE indice = '{name}'), 0)"

    w = {
        "debit": "(CASE WHEN zone_id = 'Z4' THEN 0 ELSE 0.25::DOUBLE END)",
        "ips": "0.5::DOUBLE",
        "spi_3": "0.25::DOUBLE",
    }
    use = "indice IN ('debit', 'ips', 'spi_3') AND NOT (zone_id = 'Z4' AND indice = 'debit')"
    total = "(" + " + ".join(
        f"(CASE WHEN count(*) FILTER (WHERE indice = '{n}') > 0 THEN {c} ELSE 0 END)"
        for n, c in w.items()
    ) + ")"
    wanted = "(CASE zone_id WHEN 'Z4' THEN 2 WHEN 'Z3' THEN 4 ELSE 3 END)"
    return f"""SELECT zone_id, semaine,
        ({part('debit', w['debit'])} + {part('ips', w['ips'])} + {part('spi_3', w['spi_3'])}) / {total}
          AS valeur, count(*) AS n_composantes, count(*) < {wanted} AS partiel,
        list_sort(list_filter(CASE zone_id WHEN 'Z4' THEN ['ips', 'spi_3']
          WHEN 'Z3' THEN ['debit', 'ips', 'niveau', 'spi_3'] ELSE ['debit', 'ips', 'spi_3'] END,
          lambda x: NOT list_contains(list(indice), x))) AS manquantes
      FROM {source} WHERE {use} GROUP BY 1, 2"""


CHAIN_CTES = (
    *STATION_CTES, SPI_NORMALS, SPI_INDEX,
    "early_means AS (SELECT * FROM zone_mean WHERE semaine <= '2000-W53')",
    rank_reference_sql("early_means", "zone_id, indice", "zm"),
    f"ranked AS ({restandardise_sql('zone_mean', 'zm_ref', 'zone_id, indice')})",
    """zone_values AS (SELECT zone_id, semaine, indice, valeur FROM ranked
         UNION ALL SELECT zone_id, semaine, indice, valeur FROM spi_index)""",
    f"raw_composite AS ({composite_sql('zone_values')})",
    """usable AS (SELECT * FROM raw_composite WHERE semaine <= '2000-W53'
         AND (zone_id <> 'Z1' OR NOT partiel))""",
    rank_reference_sql("usable", "zone_id", "ca"),
    """others AS (SELECT * FROM raw_composite WHERE semaine <= '2000-W53'
         AND zone_id NOT IN (SELECT zone_id FROM ca_ref))""",
    rank_reference_sql("others", "zone_id", "cb"),
    "comp_ref AS (SELECT * FROM ca_ref UNION ALL SELECT * FROM cb_ref)",
    f"composites AS ({restandardise_sql('raw_composite', 'comp_ref', 'zone_id')})",
)


@query(
    "zone_mean",
    with_sql(
        f"SELECT * REPLACE ({s6('valeur')} AS valeur) FROM zone_mean", *STATION_CTES
    ),
)
def _(t: Tables):
    inputs = chain_inputs(t)
    normals = weekly.station_normals(inputs, CHAIN)
    by_station = weekly.station_indices(inputs, normals, CHAIN, *target_sundays(t))
    return ix.zone_mean(by_station, inputs.stations).select(
        "zone_id", "semaine", "indice", r6("valeur").alias("valeur"), "n_stations",
        F.array_join("detail.stations", ",").alias("stations"),
    )


@query(
    "composite",
    with_sql(
        f"""SELECT zone_id, semaine, {s6('valeur')} AS valeur, n_composantes, partiel,
                   array_to_string(manquantes, ',') AS manquantes FROM comp""",
        NATION_DAY, STATIONS, REGION_DAY,
        f"""parts AS (SELECT zone_id, {sweek('date')} AS semaine,
             CASE isodow(date) WHEN 1 THEN 'debit' WHEN 2 THEN 'ips' ELSE 'spi_3' END AS indice,
             sum(value) / 100 - 5 AS valeur FROM region_day WHERE isodow(date) IN (1, 2, 3) GROUP BY 1, 2, 3)""",
        f"comp AS ({composite_sql('parts')})",
    ),
)
def _(t: Tables):
    from registry.core import region_day

    day = F.weekday("date")
    parts = (
        region_day(t).where(day < 3)
        .groupBy(
            "zone_id", cal.iso_week_label(F.col("date")).alias("semaine"),
            F.when(day == 0, "debit").when(day == 1, "ips").otherwise("spi_3").alias("indice"),
        )
        .agg((F.sum("value") / 100 - 5).alias("valeur"))
    )
    return ix.composite(parts, weights_table(t)).select(
        "zone_id", "semaine", r6("valeur").alias("valeur"),
        F.col("detail.n_composantes").cast("long").alias("n_composantes"), "detail.partiel",
        F.array_join("detail.manquantes", ",").alias("manquantes"),
    )


@query(
    "restandardise",
    with_sql(
        f"""SELECT zone_id, semaine, {s6('valeur')} AS valeur, raw, reference, hors_reference
            FROM ({restandardise_sql('(SELECT * EXCLUDE (partiel) FROM zone_weeks)', 'rr_ref', 'zone_id, indice')})""",
        NATION_DAY, STATIONS, REGION_DAY, ZONE_WEEKS,
        "known AS (SELECT * FROM zone_weeks WHERE zone_id <> 'Z2')",
        rank_reference_sql("known", "zone_id, indice", "rr"),
    ),
)
def _(t: Tables):
    values = zone_weeks(t).drop("partiel")
    refs = ref.rank_reference(values.where("zone_id <> 'Z2'"), ["zone_id", "indice"], PERIOD)
    table = values.withColumn("detail", F.struct(F.lit(1).alias("n")))
    done = ix.restandardise(table, refs, ["zone_id", "indice"])
    return done.select(
        "zone_id", "semaine", r6("valeur").alias("valeur"),
        F.col("detail.valeur_brute").alias("raw"), "detail.reference", "detail.hors_reference",
    )


@query(
    "weekly_indices_station",
    with_sql(
        f"""SELECT * REPLACE ({s6('valeur')} AS valeur, {sday('date_mesure')} AS date_mesure),
                   {class_sql('valeur')} AS classe, 'D14' AS version_methodo FROM station_index""",
        *STATION_CTES,
    ),
)
def _(t: Tables):
    inputs = chain_inputs(t)
    normals = weekly.station_normals(inputs, CHAIN)
    return _station_columns(weekly.station_indices(inputs, normals, CHAIN, *target_sundays(t)))


@query(
    "weekly_indices_zone",
    with_sql(
        f"""SELECT zone_id, semaine, indice, {s6('valeur', 4)} AS valeur,
                   {class_sql('valeur')} AS classe, n_stations, hors_reference::VARCHAR AS hors_reference,
                   'D14' AS version_methodo FROM (SELECT zone_id, semaine, indice, valeur, n_stations, hors_reference FROM ranked
                  UNION ALL SELECT zone_id, semaine, indice, valeur, -1, hors_reference FROM spi_index)
            UNION ALL
            SELECT zone_id, semaine, 'onde', {s6('(n_rupture + n_assec) / n_stations', 4)}, 0,
                   n_stations, '', 'D14' FROM campaign_share
            WHERE {ssunday('semaine')} BETWEEN {FIRST_SUNDAY} AND {LAST_SUNDAY}""",
        *CHAIN_CTES, CAMPAIGNS,
    ),
)
def _(t: Tables):
    zones = chain(t)["indice_zone"]
    flag = F.coalesce(F.get_json_object("detail", "$.hors_reference"), F.lit(""))
    return zones.select(
        "zone_id", "semaine", "indice", r6("valeur", 4).alias("valeur"),
        F.coalesce("classe", F.lit(0)).alias("classe"),
        F.coalesce("n_stations", F.lit(-1)).alias("n_stations"), flag.alias("hors_reference"),
        "version_methodo",
    )


@query(
    "weekly_indices_composite",
    with_sql(
        f"""SELECT zone_id, semaine, {s6('valeur', 5)} AS valeur, {class_sql('valeur')} AS classe,
                   n_composantes, partiel, array_to_string(manquantes, ',') AS manquantes,
                   {s6('raw', 4)} AS valeur_brute, reference, hors_reference FROM composites""",
        *CHAIN_CTES,
    ),
)
def _(t: Tables):
    return chain(t)["composite_zone"].select(
        "zone_id", "semaine", r6("valeur", 5).alias("valeur"), "classe",
        F.col("detail.n_composantes").cast("long").alias("n_composantes"), "detail.partiel",
        F.array_join("detail.manquantes", ",").alias("manquantes"), "detail.valeur_brute",
        "detail.reference", "detail.hors_reference",
    )


@query(
    "detail_json",
    with_sql(
        """SELECT zone_id, semaine, '{"composantes":["debit","spi_3"],"n":' || n || ',"reference":'
             || CASE WHEN n % 2 = 0 THEN '"' || semaine || '"' ELSE 'null' END || '}' AS detail
           FROM (SELECT zone_id, strftime(date, '%G-W%V') AS semaine, sum(n)::BIGINT AS n
                 FROM region_day GROUP BY 1, 2)""",
        NATION_DAY, STATIONS, REGION_DAY,
    ),
)
def _(t: Tables):
    from registry.core import region_day

    weeks = region_day(t).groupBy(
        "zone_id", cal.iso_week_label(F.col("date")).alias("semaine")
    ).agg(F.sum("n").alias("n"))
    detail = F.struct(
        "n",
        F.when(F.col("n") % 2 == 0, F.col("semaine")).alias("reference"),
        F.array(F.lit("debit"), F.lit("spi_3")).alias("composantes"),
    )
    return ix.with_detail_text(weeks.withColumn("detail", detail)).drop("n")


# The scale is checked over the reference years, as they are the ones it must be centred on.
SCALE_WEEKS = f"{REF['start']}-W01", f"{REF['end']}-W53"


@query(
    "scale_check",
    with_sql(
        f"""SELECT indice, level, count(*) AS n, {s6('avg(valeur)', 5)} AS moyenne,
               {s6('stddev_samp(valeur)', 5)} AS ecart_type,
               {s6('avg((classe = 1)::INT)')} AS part_classe_1, {s6('avg((classe = 7)::INT)')} AS part_classe_7
            FROM (SELECT indice, 'station' AS level, valeur, {class_sql('valeur')} AS classe, semaine
                  FROM station_index
                  UNION ALL SELECT indice, 'zone', valeur, {class_sql('valeur')}, semaine FROM ranked)
            WHERE semaine BETWEEN '{SCALE_WEEKS[0]}' AND '{SCALE_WEEKS[1]}' GROUP BY 1, 2""",
        *CHAIN_CTES,
    ),
)
def _(t: Tables):
    tables = chain(t)
    columns = ("indice", "semaine", "valeur", "classe")
    both = (
        tables["indice_station"].select(*columns, F.lit("station").alias("level"))
        .unionByName(
            tables["indice_zone"].where(F.col("indice").isin("ips", "debit"))
            .select(*columns, F.lit("zone").alias("level"))
        )
    )
    table = ix.scale_check(both, ["indice", "level"], *SCALE_WEEKS)
    for c in ("moyenne", "ecart_type"):
        table = table.withColumn(c, r6(c, 5))
    return table.withColumn("part_classe_1", r6("part_classe_1")).withColumn(
        "part_classe_7", r6("part_classe_7")
    )
