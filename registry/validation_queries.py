"""H: restriction orders against the weekly composite."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.api_queries import BASE, composite_table, idx, zones
from registry.core import Tables, query, r6, s6, sday, ssunday, sweek, syear_end_sunday, week_range, with_sql, year_end_week
from sluice.functions.ranking import spearman
from sluice.operators import validation as va
from sluice.session import cut_lineage

DECREES = """decrees AS (
  SELECT o_orderkey AS arrete_id, o_orderdate::DATE AS date_debut,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate::DATE - (o_orderkey % 5)::INT END AS date_signature,
    CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate::DATE + (o_custkey % 40)::INT END AS date_fin,
    CASE WHEN o_orderstatus = 'F' THEN 'SUP' ELSE 'SOU' END AS type_zone_alerte,
    CASE WHEN o_orderdate >= DATE '1996-02-01' THEN ' Natión-' || c_nationkey::VARCHAR || '. ' END AS nom_zone_alerte,
    CASE left(o_orderpriority, 1) WHEN '1' THEN 'crise' WHEN '2' THEN 'alerte_renforcee'
      WHEN '3' THEN 'alerte' WHEN '4' THEN 'vigilance' END AS niveau_gravite,
    CASE WHEN c_nationkey < 23 AND o_orderdate >= DATE '1996-02-01' THEN 'N' || lpad(c_nationkey::VARCHAR, 2, '0') END AS zone_id
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
LEVELS = f"""sundays AS (SELECT unnest(generate_series(
      (SELECT date_trunc('week', make_date(year(min(date_debut))::INT, 1, 4))::DATE + 6 FROM decrees WHERE nom_zone_alerte IS NOT NULL),
      {syear_end_sunday('max(o_orderdate)', 'orders')},
      INTERVAL 7 DAY))::DATE AS sunday),
  in_force AS (SELECT zone_id, type_zone_alerte, nom_zone_alerte, sunday, CASE niveau_gravite WHEN 'crise' THEN 4
      WHEN 'alerte_renforcee' THEN 3 WHEN 'alerte' THEN 2 ELSE 1 END AS niveau
    FROM decrees JOIN sundays ON date_debut <= sunday AND sunday <= coalesce(date_fin, DATE '9999-12-31')
    WHERE zone_id IS NOT NULL AND niveau_gravite IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY zone_id, type_zone_alerte, sunday
      ORDER BY date_debut DESC, date_signature DESC NULLS LAST, arrete_id DESC) = 1),
  levels AS (SELECT z.zone_id, {sweek('s.sunday')} AS semaine, coalesce(l.niveau, 0) AS niveau,
      coalesce(l.zones_alerte, '') AS zones_alerte
    FROM (SELECT zone_id FROM zones WHERE zone_id < 'N23') z CROSS JOIN sundays s LEFT JOIN (
      SELECT zone_id, sunday, any_value(niveau) AS niveau,
             string_agg(type_zone_alerte || ' ' || nom_zone_alerte, ', ' ORDER BY type_zone_alerte) AS zones_alerte
      FROM (SELECT *, max(niveau) OVER (PARTITION BY zone_id, sunday) AS m FROM in_force)
      WHERE niveau = m GROUP BY 1, 2) l ON l.zone_id = z.zone_id AND l.sunday = s.sunday)"""
TABLE = f"""vt AS (SELECT l.zone_id, l.semaine, niveau, valeur, classe, substr(l.semaine, 1, 4)::INT AS annee,
      month({ssunday('l.semaine')})::INT AS mois, CASE WHEN indice = 'ips' THEN valeur END AS ips,
      CASE WHEN indice = 'debit' THEN valeur END AS debit
    FROM levels l JOIN idx USING (zone_id, semaine) WHERE substr(l.semaine, 7)::INT BETWEEN 18 AND 44)"""
ALL = (*BASE, DECREES, LEVELS, TABLE)


def decrees(t: Tables) -> DataFrame:
    """All orders; those before February 1996 don't name their zones."""
    day, key = F.to_date("o_orderdate"), F.col("o_orderkey")
    p = F.substring("o_orderpriority", 1, 1)
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        key.alias("arrete_id"), day.alias("date_debut"),
        F.when(key % 7 != 0, F.date_sub(day, (key % 5).cast("int"))).alias("date_signature"),
        F.when(key % 50 != 0, F.date_add(day, (F.col("o_custkey") % 40).cast("int"))).alias("date_fin"),
        F.when(F.col("o_orderstatus") == "F", "SUP").otherwise("SOU").alias("type_zone_alerte"),
        F.when(
            day >= F.lit("1996-02-01").cast("date"), F.concat(F.lit(" Natión-"), "c_nationkey", F.lit(". "))
        ).alias("nom_zone_alerte"),
        F.when(p == "1", "crise").when(p == "2", "alerte_renforcee").when(p == "3", "alerte")
        .when(p == "4", "vigilance").alias("niveau_gravite"),
    )


def zone_names(t: Tables) -> DataFrame:
    names = zones(t).where("zone_id < 'N23'")
    return names.select("zone_id", F.col("libelle").alias("name"), F.explode(F.array(F.lit("SUP"), F.lit("SOU"))).alias("type"))


def matched(t: Tables) -> DataFrame:
    return va.match_by_name(decrees(t), zone_names(t))


def levels(t: Tables) -> DataFrame:
    """Weeks run to the end of the year of the last order: orders stay in force after the last one begins."""
    wanted = zone_names(t).select("zone_id").distinct()
    return va.weekly_level(matched(t), wanted, year_end_week(week_range(t.orders, "o_orderdate")[1]))


def table(t: Tables) -> DataFrame:
    return va.assemble_validation(levels(t), composite_table(t), idx(t), ["ips", "debit"])


def stored_table(t: Tables) -> DataFrame:
    """The same table written once, for the measures that read it several times."""
    return cut_lineage(table(t))


@query(
    "match_by_name",
    with_sql(
        "SELECT arrete_id, coalesce(zone_id, '') AS zone_id, type_zone_alerte FROM decrees", DECREES
    ),
)
def _(t: Tables):
    return matched(t).select("arrete_id", F.coalesce("zone_id", F.lit("")).alias("zone_id"), "type_zone_alerte")


@query(
    "unmatched_names",
    with_sql(
        "SELECT DISTINCT type_zone_alerte, nom_zone_alerte FROM decrees WHERE zone_id IS NULL AND nom_zone_alerte IS NOT NULL", DECREES
    ),
)
def _(t: Tables):
    return va.unmatched_names(matched(t))


@query("first_detailed_year", with_sql("SELECT min(year(date_debut))::INT AS annee FROM decrees WHERE nom_zone_alerte IS NOT NULL", DECREES))
def _(t: Tables):
    return va.first_detailed_year(decrees(t))


@query("weekly_level", with_sql("SELECT * FROM levels", *BASE, DECREES, LEVELS))
def _(t: Tables):
    return levels(t).fillna({"zones_alerte": ""})


@query(
    "assemble_validation",
    with_sql(
        f"""SELECT zone_id, semaine, niveau, {s6('valeur')} AS valeur, classe, annee, mois,
              coalesce({s6('ips')}, -99) AS ips, coalesce({s6('debit')}, -99) AS debit FROM vt""",
        *ALL,
    ),
)
def _(t: Tables):
    rows = table(t).drop("zones_alerte")
    for c in ("valeur", "ips", "debit"):
        rows = rows.withColumn(c, r6(c))
    return rows.fillna({"ips": -99.0, "debit": -99.0})


@query(
    "auc",
    with_sql(
        f"""SELECT zone_id, metric, count(*) FILTER (WHERE a) AS n_positive, count(*) FILTER (WHERE NOT a) AS n_negative,
              coalesce({s6('''(sum(r) FILTER (WHERE a) - count(*) FILTER (WHERE a) * (count(*) FILTER (WHERE a) + 1) / 2)
                / nullif(count(*) FILTER (WHERE a) * count(*) FILTER (WHERE NOT a), 0)''')}, -1) AS auc
            FROM (SELECT *, rank() OVER (PARTITION BY zone_id, metric ORDER BY value DESC)
                    + (count(*) OVER (PARTITION BY zone_id, metric, value) - 1) / 2 AS r
                  FROM (SELECT z AS zone_id, metric, value, niveau >= 2 AS a FROM (
                          SELECT unnest([zone_id, 'all']) AS z, * FROM vt),
                        LATERAL (SELECT unnest(['composite', 'ips', 'debit']) AS metric,
                                        unnest([valeur, ips, debit]) AS value)
                        WHERE value IS NOT NULL)) GROUP BY 1, 2""",
        *ALL,
    ),
)
def _(t: Tables):
    rows = va.auc_table(stored_table(t), {"composite": "valeur", "ips": "ips", "debit": "debit"})
    return rows.withColumn("auc", F.coalesce(r6("auc"), F.lit(-1.0)))


@query(
    "yearly_agreement",
    with_sql(
        f"""SELECT annee, {s6('avg((niveau >= 2)::INT)')} AS alerte, {s6('avg((niveau = 4)::INT)')} AS crise,
              {s6('avg(valeur)')} AS composite, {s6('avg((classe <= 2)::INT)')} AS seches,
              {s6('avg((classe >= 4)::INT)')} AS normales FROM vt GROUP BY 1""",
        *ALL,
    ),
)
def _(t: Tables):
    rows = va.yearly_agreement(table(t))
    for c in ("alerte", "crise", "composite", "seches", "normales"):
        rows = rows.withColumn(c, r6(c))
    return rows


@query(
    "spearman",
    with_sql(
        f"""SELECT zone_id, count(*) AS n, {s6('corr(ra, rb)')} AS rho FROM (
              SELECT zone_id, rank() OVER (PARTITION BY zone_id ORDER BY niveau)
                  + (count(*) OVER (PARTITION BY zone_id, niveau) - 1) / 2 AS ra,
                rank() OVER (PARTITION BY zone_id ORDER BY valeur)
                  + (count(*) OVER (PARTITION BY zone_id, valeur) - 1) / 2 AS rb FROM vt) GROUP BY 1""",
        *ALL,
    ),
)
def _(t: Tables):
    return spearman(stored_table(t), ["zone_id"], "niveau", "valeur").withColumn("rho", r6("rho"))


@query(
    "crosstab_normalised",
    with_sql(
        f"""SELECT classe, niveau, count(*) AS n, sum(count(*)) OVER (PARTITION BY niveau)::BIGINT AS effectif,
              {s6('count(*) / sum(count(*)) OVER (PARTITION BY niveau)')} AS part FROM vt GROUP BY 1, 2""",
        *ALL,
    ),
)
def _(t: Tables):
    return va.crosstab_normalised(table(t)).withColumn("part", r6("part"))


@query(
    "contradictions",
    with_sql(
        """SELECT CASE grouping_id(zone_id, mois) WHEN 3 THEN 'total' WHEN 1 THEN 'zone' ELSE 'mois' END AS niveau_detail,
              coalesce(zone_id, '') AS zone_id, coalesce(mois, 0)::INT AS mois,
              count(*) FILTER (WHERE classe >= 4) AS n, count(*) AS n_crise
            FROM vt WHERE niveau = 4 GROUP BY GROUPING SETS ((), (zone_id), (mois))""",
        *ALL,
    ),
)
def _(t: Tables):
    return va.contradictions(table(t)).fillna({"zone_id": "", "mois": 0})
