"""F: as-of join, read queries and map views."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.core import (
    NATION_DAY, READINGS, STATIONS, Tables, class_sql, nation_day, nation_id, query, r6, readings,
    s6, sday, ssunday, stations, sweek, text_day, with_sql,
)
from registry.index_queries import CAMPAIGNS, campaigns
from registry.reference_queries import (
    DAY_SPINE, ENVELOPE, FLOW_NORMALS, GW_NORMALS, MONTHLY, envelopes,
)
from sluice.functions import calendar as cal
from sluice.functions.stats import classify
from sluice.operators import indices as ix
from sluice.operators.asof import asof_forward, asof_join
from sluice.plans import api, views

WEEK = "2000-W20"

# --- F3 -----------------------------------------------------------------------------------------

_ASKS = """asks AS (SELECT o_orderkey, 'N' || lpad(c_nationkey::VARCHAR, 2, '0') AS station_id,
    o_orderdate::DATE AS asked FROM orders JOIN customer ON o_custkey = c_custkey),
  facts AS (SELECT station_id, date, CASE WHEN n % 3 <> 0 THEN value END AS value FROM nation_day WHERE n <> 2)"""


def _asof_tables(t: Tables) -> tuple[DataFrame, DataFrame]:
    asks = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", nation_id("c_nationkey").alias("station_id"),
        F.to_date("o_orderdate").alias("asked"),
    )
    facts = nation_day(t).where("n <> 2").select(
        "station_id", "date", F.when(F.col("n") % 3 != 0, F.col("value")).alias("value")
    )
    return asks, facts


def _asof_sql(comparison: str, order: str) -> str:
    return with_sql(
        f"""SELECT o_orderkey, station_id, {sday('asked')} AS asked, coalesce({sday('date')}, '') AS date,
                   coalesce(value, -1) AS value
            FROM (SELECT a.*, f.date, f.value FROM asks a LEFT JOIN facts f
                    ON f.station_id = a.station_id AND f.date {comparison} a.asked
                  QUALIFY row_number() OVER (PARTITION BY a.o_orderkey ORDER BY f.date {order}) = 1)""",
        NATION_DAY, _ASKS,
    )


def _asof_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "o_orderkey", "station_id", text_day("asked").alias("asked"),
        F.coalesce(text_day("date"), F.lit("")).alias("date"),
        F.coalesce("value", F.lit(-1.0)).alias("value"),
    )


@query("asof_join", _asof_sql("<=", "DESC"))
def _(t: Tables):
    asks, facts = _asof_tables(t)
    return _asof_columns(asof_join(asks, facts, ["station_id"], "asked", "date", ["date", "value"]))


@query("asof_join_strict", _asof_sql("<", "DESC"))
def _(t: Tables):
    asks, facts = _asof_tables(t)
    return _asof_columns(
        asof_join(asks, facts, ["station_id"], "asked", "date", ["date", "value"], strict=True)
    )


@query("asof_forward", _asof_sql(">", "ASC"))
def _(t: Tables):
    asks, facts = _asof_tables(t)
    return _asof_columns(
        asof_forward(asks, facts, ["station_id"], "asked", "date", ["date", "value"])
    )


@query(
    "asof_events",
    """SELECT e.event_id, coalesce(p.event_id, -1) AS previous_purchase, coalesce(p.value, -1) AS value
       FROM events e LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
         ON p.user_id = e.user_id AND p.ts <= e.ts
       WHERE e.event_type <> 'purchase'
       QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY p.ts DESC, p.event_id DESC) = 1""",
)
def _(t: Tables):
    purchases = t.events.where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("_ts"), F.col("event_id").alias("previous_purchase"), "value"
    )
    others = t.events.where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    joined = asof_join(
        others, purchases, ["user_id"], "ts", "_ts", ["previous_purchase", "value"], period="day",
        tie_order=["previous_purchase"],
    )
    return joined.select("event_id", "previous_purchase", "value").fillna(
        {"previous_purchase": -1, "value": -1.0}
    )


# --- Stored tables used below -------------------------------------------------------------------

IDX = f"""week_nation AS (SELECT station_id, {sweek('date')} AS semaine, sum(value) AS v, sum(n)::BIGINT AS n,
    max(date) AS date_mesure FROM nation_day GROUP BY 1, 2),
  idx AS (SELECT station_id, station_id AS zone_id, semaine, (v - 100) / 75 AS valeur,
    {class_sql('((v - 100) / 75)')} AS classe, n, CASE WHEN n % 2 = 0 THEN 'ips' ELSE 'debit' END AS indice,
    n % 3 = 0 AS partiel, 3 - (n % 3 = 0)::INT AS n_composantes,
    CASE WHEN n % 6 = 0 THEN 'ips, spi_3' WHEN n % 3 = 0 THEN 'ips' ELSE '' END AS manquantes,
    CASE WHEN n % 3 <> 0 THEN '1995-1999' END AS reference, n > 4 AS dans_composite, date_mesure
    FROM week_nation),
  zones AS (SELECT station_id AS zone_id, libelle FROM stations)"""
BASE = (NATION_DAY, STATIONS, IDX)


def idx(t: Tables) -> DataFrame:
    weekly = nation_day(t).groupBy(
        "station_id", cal.iso_week_label(F.col("date")).alias("semaine")
    ).agg(F.sum("value").alias("v"), F.sum("n").alias("n"), F.max("date").alias("date_mesure"))
    n, value = F.col("n"), (F.col("v") - 100) / 75
    none = F.array().cast("array<string>")
    missing = (
        F.when(n % 6 == 0, F.array(F.lit("spi_3"), F.lit("ips")))
        .when(n % 3 == 0, F.array(F.lit("ips"))).otherwise(none)
    )
    detail = F.struct(
        (n % 3 == 0).alias("partiel"),
        (3 - (n % 3 == 0).cast("int")).alias("n_composantes"),
        missing.alias("manquantes"),
        F.when(n % 3 != 0, "1995-1999").alias("reference"),
    )
    return weekly.select(
        "station_id", F.col("station_id").alias("zone_id"), "semaine", value.alias("valeur"),
        classify(value).alias("classe"), F.when(n % 2 == 0, "ips").otherwise("debit").alias("indice"),
        detail.alias("detail"), (n > 4).alias("dans_composite"), "date_mesure", "n",
    )


def composite_table(t: Tables) -> DataFrame:
    return idx(t).select("zone_id", "semaine", "valeur", "classe", "detail")


def zones(t: Tables) -> DataFrame:
    return stations(t).select(F.col("station_id").alias("zone_id"), "libelle")


# --- F1, F2, F4 to F6 ---------------------------------------------------------------------------

@query(
    "zones_at_week",
    with_sql(
        f"""SELECT z.zone_id, libelle, '{WEEK}' AS semaine, coalesce({s6('valeur')}, -99) AS valeur,
              coalesce(classe, 0) AS classe, coalesce(manquantes, '') AS manquantes
            FROM zones z LEFT JOIN idx ON idx.zone_id = z.zone_id AND semaine = '{WEEK}'""",
        *BASE,
    ),
)
def _(t: Tables):
    rows = api.unpack_detail(api.zones_at_week(zones(t), composite_table(t), WEEK), ["manquantes"])
    return rows.select(
        "zone_id", "libelle", "semaine", F.coalesce(r6("valeur"), F.lit(-99.0)).alias("valeur"),
        F.coalesce("classe", F.lit(0)).alias("classe"),
        F.coalesce(F.array_join(F.array_sort("manquantes"), ", "), F.lit("")).alias("manquantes"),
    )


@query(
    "stations_at_week",
    with_sql(
        f"""SELECT s.station_id, source, coalesce({s6('i.valeur')}, -99) AS valeur, coalesce(i.classe, 0) AS classe,
              coalesce({sday('r.date')}, '') AS date_releve, coalesce(r.volume_m3, -1) AS volume_m3,
              coalesce({s6('round(100 * r.volume_m3 / nullif(r.capacite_m3, 0), 1)')}, -1) AS remplissage_pct,
              coalesce({sday('o.date_campagne')}, '') AS date_campagne, coalesce(o.modalite, '') AS modalite
            FROM (SELECT *, CASE substr(station_id, 3)::INT % 4 WHEN 0 THEN 'piezo' WHEN 1 THEN 'hydro'
                    WHEN 2 THEN 'retenue' ELSE 'onde' END AS source FROM stations) s
            LEFT JOIN idx i ON i.station_id = s.station_id AND i.semaine = '{WEEK}'
            LEFT JOIN (SELECT * FROM readings WHERE date <= {ssunday(f"'{WEEK}'")}
              QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY date DESC) = 1) r
              ON r.station_id = s.station_id AND source = 'retenue'
            LEFT JOIN (SELECT * FROM campaigns WHERE date_campagne <= {ssunday(f"'{WEEK}'")}
              QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY date_campagne DESC) = 1) o
              ON o.station_id = s.station_id AND source = 'onde'""",
        *BASE, READINGS, CAMPAIGNS,
    ),
)
def _(t: Tables):
    k = F.substring("station_id", 3, 1).cast("int") % 4
    kinds = stations(t).withColumn(
        "source",
        F.when(k == 0, "piezo").when(k == 1, "hydro").when(k == 2, "retenue").otherwise("onde"),
    )
    index = idx(t).select("station_id", "semaine", "valeur", "classe")
    rows = api.stations_at_week(kinds, index, readings(t), campaigns(t), WEEK)
    return rows.select(
        "station_id", "source", r6("valeur").alias("valeur"), "classe",
        text_day("date_releve").alias("date_releve"), "volume_m3", "remplissage_pct",
        text_day("date_campagne").alias("date_campagne"), "modalite",
    ).fillna(
        {"valeur": -99.0, "classe": 0, "date_releve": "", "volume_m3": -1, "remplissage_pct": -1.0,
         "date_campagne": "", "modalite": ""}
    )


@query(
    "zone_series",
    with_sql(
        f"""SELECT semaine, {s6('valeur')} AS valeur, classe, n_composantes, partiel, manquantes,
                   coalesce(reference, '') AS reference
            FROM idx WHERE zone_id = 'N09' AND semaine BETWEEN '1998-W10' AND '2000-W40'""",
        *BASE,
    ),
)
def _(t: Tables):
    rows = api.zone_series(composite_table(t), "N09", "1998-W10", "2000-W40")
    rows = api.unpack_detail(rows, ["n_composantes", "partiel", "manquantes", "reference"])
    return rows.select(
        "semaine", r6("valeur").alias("valeur"), "classe", "n_composantes", "partiel",
        F.array_join(F.array_sort("manquantes"), ", ").alias("manquantes"),
        F.coalesce("reference", F.lit("")).alias("reference"),
    )


@query(
    "station_series",
    with_sql(
        f"""SELECT 'chronique' AS part, {sday('date')} AS at, value AS valeur FROM nation_day
            WHERE station_id = 'N09' AND date BETWEEN DATE '1998-01-01' AND DATE '1999-06-30'
            UNION ALL SELECT 'indice', semaine, {s6('valeur')} FROM idx
            WHERE station_id = 'N09' AND semaine BETWEEN '1998-W01' AND '1999-W26'
            UNION ALL SELECT 'enveloppe', pas || lpad(periode::VARCHAR, 2, '0'), {s6('mediane')} FROM envelope
            WHERE station_id = 'N09'""",
        *BASE, MONTHLY, GW_NORMALS, DAY_SPINE, FLOW_NORMALS, ENVELOPE,
    ),
)
def _(t: Tables):
    chronicles = {"piezo": (nation_day(t), "date", F.col("value"))}
    raw, weekly, envelope = api.station_series(
        chronicles, idx(t), envelopes(t), "N09", "piezo", "1998-01-01", "1999-06-30"
    )
    step = F.concat("pas", F.lpad(F.col("periode").cast("string"), 2, "0"))
    return (
        raw.select(F.lit("chronique").alias("part"), text_day("date").alias("at"), "valeur")
        .unionByName(weekly.select(F.lit("indice").alias("part"), F.col("semaine").alias("at"), r6("valeur").alias("valeur")))
        .unionByName(envelope.select(F.lit("enveloppe").alias("part"), step.alias("at"), r6("mediane").alias("valeur")))
    )


@query("available_weeks", with_sql("SELECT DISTINCT semaine FROM idx", *BASE))
def _(t: Tables):
    return api.available_weeks(composite_table(t))


# --- F7 to F14 ----------------------------------------------------------------------------------

@query(
    "reservoir_envelope",
    with_sql(
        f"""SELECT station_id, weekofyear(date)::INT AS periode, {s6('min(f)')} AS minimum,
              {s6('median(f)')} AS mediane, {s6('max(f)')} AS maximum, count(DISTINCT y) AS n_annees,
              min(y) || '-' || max(y) AS periode_ref
            FROM (SELECT *, isoyear(date) AS y, 100 * volume_m3 / nullif(capacite_m3, 0)::DOUBLE AS f FROM readings)
            WHERE y < 2000 GROUP BY 1, 2""",
        READINGS,
    ),
)
def _(t: Tables):
    table = api.reservoir_envelope(readings(t), 2000)
    for c in ("minimum", "mediane", "maximum"):
        table = table.withColumn(c, r6(c))
    return table


@query(
    "week_synthesis_zones",
    with_sql(
        f"""SELECT zone_id, libelle, {s6('valeur')} AS valeur, classe, manquantes
            FROM idx JOIN zones USING (zone_id) WHERE semaine = '{WEEK}'""",
        *BASE,
    ),
)
def _(t: Tables):
    listed, _ = api.week_synthesis_composite(composite_table(t), zones(t), WEEK)
    return listed.select(
        "zone_id", "libelle", r6("valeur").alias("valeur"), "classe",
        F.array_join(F.array_sort("detail.manquantes"), ", ").alias("manquantes"),
    )


@query(
    "week_synthesis_composite",
    with_sql(
        f"""SELECT classe, count(*) AS n,
              (SELECT count(*) FROM idx WHERE semaine = '{WEEK}' AND classe <= 2) AS zones_seches
            FROM idx WHERE semaine = '{WEEK}' GROUP BY 1""",
        *BASE,
    ),
)
def _(t: Tables):
    return api.week_synthesis_composite(composite_table(t), zones(t), WEEK)[1]


@query(
    "week_synthesis_stations",
    with_sql(
        f"""SELECT indice, sum(n)::BIGINT AS n, sum(c)::BIGINT AS au_composite,
              '{{' || string_agg('"' || classe || '":' || n, ',' ORDER BY classe) || '}}' AS repartition
            FROM (SELECT indice, classe, count(*) AS n, count(*) FILTER (WHERE dans_composite) AS c
                  FROM idx WHERE semaine = '{WEEK}' GROUP BY 1, 2) GROUP BY 1""",
        *BASE,
    ),
)
def _(t: Tables):
    return api.week_synthesis_stations(idx(t), WEEK).withColumn("repartition", F.to_json("repartition"))


@query(
    "latest_per_zone_in_year",
    with_sql(
        f"""SELECT zone_id, semaine, {s6('(n_rupture + n_assec) / n_stations')} AS valeur, n_stations
            FROM campaign_share WHERE semaine <= '{WEEK}' AND semaine LIKE '2000%'
            QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY semaine DESC) = 1""",
        STATIONS, CAMPAIGNS,
    ),
)
def _(t: Tables):
    share = ix.campaign_share(campaigns(t), stations(t))
    rows = api.latest_per_zone_in_year(share, WEEK, ["valeur", "n_stations"])
    return rows.withColumn("valeur", r6("valeur"))


@query(
    "reservoir_total",
    with_sql(
        f"""SELECT volume_m3, capacite_m3, n_retenues, {sday('c.date')} AS date, {s6('round(c.f, 1)')} AS remplissage_pct,
              (SELECT round(min(f), 1) FROM w WHERE y < 2000) AS minimum, (SELECT round(median(f), 1) FROM w WHERE y < 2000) AS mediane,
              (SELECT round(max(f), 1) FROM w WHERE y < 2000) AS maximum, (SELECT min(y) || '-' || max(y) FROM w WHERE y < 2000) AS periode_ref
            FROM w c WHERE y = 2000""",
        READINGS,
        """w AS (SELECT isoyear(date) AS y, sum(volume_m3)::BIGINT AS volume_m3, sum(capacite_m3)::BIGINT AS capacite_m3,
             count(*) AS n_retenues, max(date) AS date, 100 * sum(volume_m3) / sum(capacite_m3)::DOUBLE AS f
           FROM readings WHERE weekofyear(date) = 20 GROUP BY 1)""",
    ),
)
def _(t: Tables):
    return api.reservoir_total(readings(t), WEEK).withColumn("date", text_day("date"))


_RECURRENCE = """rec AS (SELECT zone_id, libelle, substr(semaine, 1, 4)::INT AS annee, count(*) AS n_semaines,
    count(*) FILTER (WHERE classe = 1) AS n_classe_1, count(*) FILTER (WHERE classe <= 2) AS n_classes_1_2,
    count(*) FILTER (WHERE partiel) AS n_partielles, max(reference) AS reference
  FROM idx JOIN zones USING (zone_id) GROUP BY 1, 2, 3)"""


@query(
    "recurrence",
    with_sql(
        """SELECT rec.*, 0.1003::DOUBLE AS part_attendue_1, 0.2005::DOUBLE AS part_attendue_1_2,
                  (SELECT CASE WHEN substr(m, 7)::INT < weekofyear(make_date(substr(m, 1, 4)::INT, 12, 28))
                     THEN substr(m, 1, 4)::INT END FROM (SELECT max(semaine) AS m FROM idx)) AS annee_incomplete
           FROM rec""",
        *BASE, _RECURRENCE,
    ),
)
def _(t: Tables):
    return api.recurrence(composite_table(t), zones(t))


@query(
    "recurrence_share",
    with_sql(
        f"""SELECT scope, annee, {s6('part')} AS part, coalesce(CASE WHEN i >= 3 AND annee <> 2001 THEN
              {s6('''avg(CASE WHEN annee <> 2001 THEN part END) OVER (PARTITION BY scope ORDER BY annee
              ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)''')} END, -1) AS moyenne
            FROM (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY annee) AS i FROM (
              SELECT zone_id AS scope, annee, 100 * n_classe_1 / n_semaines AS part FROM rec
              UNION ALL SELECT 'all', annee, avg(100 * n_classe_1 / n_semaines) FROM rec GROUP BY annee))""",
        *BASE, _RECURRENCE,
    ),
)
def _(t: Tables):
    share = api.recurrence_share(api.recurrence(composite_table(t), zones(t)), 3)
    return share.select(
        "scope", "annee", r6("part").alias("part"),
        F.coalesce(r6("moyenne"), F.lit(-1.0)).alias("moyenne"),
    )


@query(
    "envelope_on_dates",
    with_sql(
        f"""SELECT d.station_id, {sday('d.date')} AS date, e.pas, e.indice, {s6('minimum')} AS minimum,
              {s6('mediane')} AS mediane, {s6('maximum')} AS maximum
            FROM nation_day d JOIN envelope e ON e.station_id = d.station_id AND e.periode =
              CASE e.pas WHEN 'mois' THEN month(d.date) ELSE least(weekofyear(d.date), 52) END""",
        NATION_DAY, MONTHLY, GW_NORMALS, DAY_SPINE, FLOW_NORMALS, ENVELOPE,
    ),
)
def _(t: Tables):
    rows = api.envelope_on_dates(nation_day(t), envelopes(t))
    for c in ("minimum", "mediane", "maximum"):
        rows = rows.withColumn(c, r6(c))
    return rows.withColumn("date", text_day("date")).drop("periode")


# --- F15 to F19 ---------------------------------------------------------------------------------

def _dates(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, text_day(c))
    return df


_BOUNDS = f"{sday(ssunday('semaine') + ' - 6')} AS debut, {sday(ssunday('semaine'))} AS fin"


@query(
    "composite_view",
    with_sql(
        f"""SELECT zone_id || '|' || semaine AS cle, zone_id, libelle, semaine, {_BOUNDS},
              {s6('valeur')} AS valeur, classe, n_composantes, partiel, manquantes,
              semaine = (SELECT max(semaine) FROM idx) AS derniere
            FROM idx JOIN zones USING (zone_id)""",
        *BASE,
    ),
)
def _(t: Tables):
    rows = views.composite_view(composite_table(t), zones(t))
    return _dates(rows, "debut", "fin").withColumn("valeur", r6("valeur")).fillna({"manquantes": ""})


@query(
    "zone_index_view",
    with_sql(
        f"""SELECT zone_id || '|' || semaine || '|' || indice AS cle, zone_id, libelle, indice, semaine, {_BOUNDS},
              {s6('valeur')} AS valeur, classe, n AS n_stations, semaine = (SELECT max(semaine) FROM idx) AS derniere
            FROM idx JOIN zones USING (zone_id)""",
        *BASE,
    ),
)
def _(t: Tables):
    rows = views.zone_index_view(idx(t).withColumn("n_stations", F.col("n")), zones(t))
    return _dates(rows, "debut", "fin").withColumn("valeur", r6("valeur"))


@query(
    "campaign_view",
    with_sql(
        f"""SELECT zone_id || '|' || semaine AS cle, zone_id, zone_id AS libelle, semaine, {_BOUNDS},
              {sday('date_campagne')} AS date_campagne, type_campagne,
              {s6('(n_rupture + n_assec) / n_stations')} AS part_sans_ecoulement,
              {s6('round(100 * ((n_rupture + n_assec) / n_stations), 1)')} AS pct_sans_ecoulement, n_stations,
              n_assec, n_rupture, semaine = max(semaine) OVER (PARTITION BY zone_id) AS derniere
            FROM campaign_share""",
        STATIONS, CAMPAIGNS,
    ),
)
def _(t: Tables):
    names = stations(t).select("zone_id", F.col("zone_id").alias("libelle")).distinct()
    rows = views.campaign_view(ix.campaign_share(campaigns(t), stations(t)), names)
    return _dates(rows, "debut", "fin", "date_campagne").withColumn(
        "part_sans_ecoulement", r6("part_sans_ecoulement")
    )


@query(
    "station_index_view",
    with_sql(
        f"""SELECT station_id || '|' || semaine || '|' || indice AS cle, station_id, libelle, indice, semaine, {_BOUNDS},
              {s6('valeur')} AS valeur, classe, ({ssunday('semaine')} - date_mesure)::INT AS anciennete_jours,
              dans_composite, semaine = (SELECT max(semaine) FROM idx) AS derniere
            FROM idx JOIN (SELECT station_id, libelle FROM stations) USING (station_id)""",
        *BASE,
    ),
)
def _(t: Tables):
    rows = views.station_index_view(idx(t), stations(t).select("station_id", "libelle"))
    return _dates(rows, "debut", "fin").select(
        "cle", "station_id", "libelle", "indice", "semaine", "debut", "fin",
        r6("valeur").alias("valeur"), "classe", "anciennete_jours", "dans_composite", "derniere",
    )


@query(
    "reservoir_view",
    with_sql(
        f"""SELECT station_id || '|' || {sday('date')} AS cle, station_id, libelle, zone_id, {sday('date')} AS date,
              {sweek('date')} AS semaine, {sday("date_trunc('week', date)")} AS debut,
              {sday("date_trunc('week', date)::DATE + 6")} AS fin, volume_m3, capacite_m3,
              {s6('round(100 * volume_m3 / nullif(capacite_m3, 0)::DOUBLE, 1)')} AS remplissage_pct,
              date = max(date) OVER (PARTITION BY station_id) AS derniere
            FROM readings JOIN stations USING (station_id)""",
        READINGS, STATIONS,
    ),
)
def _(t: Tables):
    return _dates(views.reservoir_view(readings(t), stations(t)), "date", "debut", "fin")
