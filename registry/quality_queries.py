"""B: audits; G: cleaning of readings."""

from pyspark.sql import functions as F

from registry.core import (
    NATION_DAY, READINGS, REGION_DAY, STATIONS, Tables, nation_day, nation_id, query, r6, readings,
    region_day, s6, sday, stations, sweek, text_day, with_sql,
)
from registry.index_queries import CHAIN, STATION_CTES, chain_inputs, target_sundays, weights_table
from sluice.functions import calendar as cal
from sluice.operators import cleaning, quality
from sluice.plans import weekly


@query(
    "duplicated_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(t: Tables):
    return quality.duplicated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "key_audit",
    """WITH d AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1)
       SELECT 'ingere_le' AS missing, count(*) AS n_duplicated, sum(n)::BIGINT AS n_rows,
              (SELECT string_agg(l_orderkey::VARCHAR, ',' ORDER BY l_orderkey) FROM
                (SELECT l_orderkey FROM d ORDER BY 1 LIMIT 5)) AS examples FROM d""",
)
def _(t: Tables):
    audit = quality.key_audit(t.lineitem, ["l_orderkey", "ingere_le"], "l_orderkey")
    return audit.withColumn(
        "examples", F.array_join(F.transform("examples", lambda x: x.cast("string")), ",")
    )


@query(
    "implausible_values",
    """WITH f AS (
         SELECT 'negative' AS rule, l_orderkey, l_linenumber FROM lineitem WHERE l_quantity - 5 < 0
         UNION ALL SELECT 'range', l_orderkey, l_linenumber FROM lineitem
           WHERE l_extendedprice < 1000 OR l_extendedprice > 90000
         UNION ALL SELECT 'ratio', l_orderkey, l_linenumber FROM lineitem WHERE l_discount + l_tax > 0.17::DOUBLE)
       SELECT rule, count(*) AS n, min((l_orderkey, l_linenumber))[1] AS first_l_orderkey,
              min((l_orderkey, l_linenumber))[2] AS first_l_linenumber FROM f GROUP BY 1""",
)
def _(t: Tables):
    rules = {
        "negative": F.col("l_quantity") - 5 < 0,
        "range": (F.col("l_extendedprice") < 1000) | (F.col("l_extendedprice") > 90000),
        "ratio": F.col("l_discount") + F.col("l_tax") > 0.17,
        "never": F.col("l_quantity") < 0,
    }
    return quality.implausible_values(t.lineitem, rules, ["l_orderkey", "l_linenumber"])


@query(
    "week_coverage",
    with_sql(
        f"""SELECT '2000-W20' AS semaine, {sday("(SELECT max(date) FROM region_day WHERE date >= DATE '2000-05-14')")} AS last_rain,
              (SELECT max(date) FROM region_day) >= DATE '2000-05-21' AS rain_complete,
              count(*) FILTER (WHERE indice = 'ips') AS n_ips,
              count(*) FILTER (WHERE indice = 'ips' AND dans_composite) AS n_ips_composite,
              count(*) FILTER (WHERE indice = 'debit') AS n_debit
            FROM station_index WHERE semaine = '2000-W20'""",
        *STATION_CTES,
    ),
)
def _(t: Tables):
    inputs = chain_inputs(t)
    normals = weekly.station_normals(inputs, CHAIN)
    by_station = weekly.station_indices(inputs, normals, CHAIN, *target_sundays(t))
    row = quality.week_coverage(region_day(t), by_station, "2000-W20")
    return row.withColumn("last_rain", text_day("last_rain"))


@query(
    "history_inventory",
    with_sql(
        f"""SELECT a.*, b.annees_exploitables, b.annees_ref FROM (
              SELECT station_id, {sday('min(date)')} AS premiere, {sday('max(date)')} AS derniere,
                count(*) AS n_mesures, median(gap)::DOUBLE AS pas_median_j, {s6('avg((n > 1)::INT)')} AS part_statut,
                (DATE '2001-12-31' - max(date))::INT AS retard_j
              FROM (SELECT *, date - lag(date) OVER (PARTITION BY station_id ORDER BY date) AS gap FROM nation_day)
              GROUP BY 1) a JOIN (
              SELECT station_id, count(*) FILTER (WHERE m >= 10 AND d >= 100) AS annees_exploitables,
                count(*) FILTER (WHERE m >= 10 AND d >= 100 AND y BETWEEN 1995 AND 1999) AS annees_ref
              FROM (SELECT station_id, year(date) AS y, count(DISTINCT month(date)) AS m, count(DISTINCT date) AS d
                    FROM nation_day GROUP BY 1, 2) GROUP BY 1) b USING (station_id)""",
        NATION_DAY,
    ),
)
def _(t: Tables):
    rows = quality.history_inventory(
        nation_day(t), "station_id", "date", F.lit("2001-12-31").cast("date"), F.col("n") > 1,
        (1995, 1999), months_min=10, days_min=100,
    )
    return (
        rows.withColumn("premiere", text_day("premiere")).withColumn("derniere", text_day("derniere"))
        .withColumn("part_statut", r6("part_statut"))
    )


@query(
    "feed_comparison",
    with_sql(
        f"""SELECT variable, count(g) AS n, {s6('avg((g < 1e-9)::INT)')} AS part_identique,
                   {s6('max(g)')} AS ecart_max
            FROM (SELECT unnest(['value', 'n']) AS variable,
                    unnest([abs(a.value - b.value), abs(a.n - b.n)::DOUBLE]) AS g
                  FROM (SELECT * FROM nation_day WHERE n <> 2) a JOIN
                       (SELECT station_id, date, value + (n % 4 = 0)::INT * 0.5::DOUBLE AS value,
                               n + (value > 100)::INT AS n FROM nation_day WHERE n <> 3) b
                       USING (station_id, date)) GROUP BY 1""",
        NATION_DAY,
    ),
)
def _(t: Tables):
    a = nation_day(t).where("n <> 2")
    b = nation_day(t).where("n <> 3").select(
        "station_id", "date",
        (F.col("value") + F.when(F.col("n") % 4 == 0, 0.5).otherwise(0.0)).alias("value"),
        (F.col("n") + F.when(F.col("value") > 100, 1).otherwise(0)).alias("n"),
    )
    rows = quality.feed_comparison(a, b, ["station_id", "date"], ["value", "n"])
    return rows.withColumn("part_identique", r6("part_identique")).withColumn(
        "ecart_max", r6("ecart_max")
    )


@query(
    "weights_audit",
    """WITH w AS (SELECT 'N' || lpad(c_nationkey::VARCHAR, 2, '0') AS zone_id, c_mktsegment AS indice,
           count(*) AS n FROM customer GROUP BY 1, 2),
         p AS (SELECT zone_id, indice, floor(100 * n / sum(n) OVER (PARTITION BY zone_id)) / 100 AS poids FROM w)
       SELECT zone_id, 'sum' AS rule, round(sum(poids)::DOUBLE, 6) AS value FROM p GROUP BY 1
       HAVING abs(sum(poids) - 1) > 1e-6""",
)
def _(t: Tables):
    from pyspark.sql import Window

    counts = t.customer.groupBy(
        nation_id("c_nationkey").alias("zone_id"), F.col("c_mktsegment").alias("indice")
    ).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("zone_id"))
    weights = counts.select(
        "zone_id", "indice", (F.floor(100 * F.col("n") / total) / 100).alias("poids")
    )
    return quality.weights_audit(weights).withColumn("value", r6("value"))


@query(
    "single_membership",
    """SELECT l_suppkey, count(DISTINCT l_partkey % 20) AS n_groups FROM lineitem GROUP BY 1
       HAVING count(DISTINCT l_partkey % 20) > 1""",
)
def _(t: Tables):
    members = t.lineitem.select("l_suppkey", (F.col("l_partkey") % 20).alias("g"))
    return quality.single_membership(members, "l_suppkey", "g")


@query(
    "stale_attributes",
    """WITH a AS (SELECT o_custkey AS k, max(o_orderdate) AS d, count(*) AS n FROM orders
                  WHERE o_orderstatus = 'F' GROUP BY 1),
            b AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1)
       SELECT k, CASE WHEN b.n IS NULL THEN 'stored_only' WHEN a.n IS NULL THEN 'current_only'
                      WHEN a.n <> b.n THEN 'stale' END AS state,
              coalesce('{"debit":1.0,"ips":' || b.n || '.0}', '') AS current
       FROM a FULL JOIN b USING (k) WHERE a.n IS NULL OR b.n IS NULL OR a.n <> b.n""",
)
def _(t: Tables):
    stored = t.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("k")).agg(
        F.format_string('{"ips": %d, "debit": 1}', F.count("*")).alias("poids")
    )
    current = t.orders.where("o_orderstatus <> 'O'").groupBy(F.col("o_custkey").alias("k")).agg(
        F.format_string('{"debit":1.0,"ips":%d.0}', F.count("*")).alias("poids")
    )
    return quality.stale_attributes(stored, current, "k", "poids").fillna({"current": ""})


@query(
    "multi_reading_weeks",
    f"""SELECT o_custkey, {sweek('o_orderdate')} AS semaine, count(*) AS n FROM orders
        GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(t: Tables):
    rows = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("date"))
    return quality.multi_reading_weeks(rows, "o_custkey", "date")


@query(
    "run_status",
    """SELECT count(*) FILTER (WHERE event_type = 'error') AS n_errors,
              count(*) FILTER (WHERE value < 0) AS n_failures,
              CASE WHEN count(*) FILTER (WHERE value < 0) > 0 THEN 'failed'
                   WHEN count(*) FILTER (WHERE event_type = 'error') > 0 THEN 'partial' ELSE 'ok' END AS status
       FROM events""",
)
def _(t: Tables):
    return quality.run_status(t.events.where("event_type = 'error'"), t.events.where("value < 0"))


@query(
    "run_summary",
    with_sql(
        f"""SELECT zone_id, libelle, coalesce({s6('valeur', 4)}, -99) AS valeur, coalesce(classe, 0) AS classe,
                   coalesce('class ' || classe, '') AS libelle_classe,
                   CASE WHEN classe IS NULL THEN 'all' ELSE manquantes END AS manquantes
            FROM (SELECT station_id AS zone_id, libelle FROM stations) LEFT JOIN (
              SELECT station_id AS zone_id, valeur, 1 + (valeur > 50)::INT + (valeur > 120)::INT AS classe,
                     CASE WHEN n < 3 THEN 'ips, spi_3' ELSE '' END AS manquantes
              FROM (SELECT station_id, sum(value) AS valeur, count(*) AS n FROM nation_day
                    WHERE {sweek('date')} = '2000-W20' GROUP BY 1)) USING (zone_id)""",
        NATION_DAY, STATIONS,
    ),
)
def _(t: Tables):
    week = nation_day(t).groupBy(
        F.col("station_id").alias("zone_id"), cal.iso_week_label(F.col("date")).alias("semaine")
    ).agg(F.sum("value").alias("valeur"), F.count("*").alias("n"))
    level = 1 + (F.col("valeur") > 50).cast("int") + (F.col("valeur") > 120).cast("int")
    missing = F.when(F.col("n") < 3, F.array(F.lit("ips"), F.lit("spi_3"))).otherwise(
        F.array().cast("array<string>")
    )
    table = week.withColumn("classe", level).withColumn(
        "detail", F.struct(missing.alias("manquantes"))
    )
    labels = table.select("classe").distinct().withColumn(
        "libelle_classe", F.concat(F.lit("class "), "classe")
    )
    zones = stations(t).select(F.col("station_id").alias("zone_id"), "libelle")
    rows = quality.run_summary(zones, table, "2000-W20", labels)
    return rows.withColumn("valeur", r6("valeur", 4)).fillna(
        {"valeur": -99.0, "classe": 0, "libelle_classe": ""}
    )


# --- G ------------------------------------------------------------------------------------------

@query(
    "shift_late_readings",
    f"""WITH r AS (SELECT o_custkey AS code, o_orderkey AS id, o_orderdate::DATE AS date,
             date_trunc('week', o_orderdate)::DATE AS monday FROM orders),
         c AS (SELECT code, monday, count(*) AS n FROM r GROUP BY 1, 2),
         first AS (SELECT code, id FROM r WHERE isodow(date) <> 7
           QUALIFY row_number() OVER (PARTITION BY code, monday ORDER BY date, id) = 1),
         m AS (SELECT r.code, r.id FROM r JOIN first USING (code, id) JOIN c USING (code, monday)
           WHERE n > 1 AND NOT EXISTS (SELECT 1 FROM c p WHERE p.code = r.code AND p.monday = r.monday - 7))
       SELECT r.code, r.id, {sday('CASE WHEN m.id IS NULL THEN r.date ELSE r.monday - 1 END')} AS date,
              m.id IS NOT NULL AS moved FROM r LEFT JOIN m USING (code, id)""",
)
def _(t: Tables):
    rows = t.orders.select(
        F.col("o_custkey").alias("code"), F.col("o_orderkey").alias("id"),
        F.to_date("o_orderdate").alias("date"),
    )
    moved = cleaning.shift_late_readings(rows, "code", "date", ["date", "id"])
    return moved.withColumn("date", text_day("date"))


@query(
    "station_from_latest",
    f"""SELECT o_custkey AS code, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS libelle,
               arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS capacite,
               {sday('max(o_orderdate)')} AS date FROM orders GROUP BY 1""",
)
def _(t: Tables):
    rows = t.orders.select(
        F.col("o_custkey").alias("code"), F.col("o_orderkey").alias("id"),
        F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("libelle"),
        F.col("o_totalprice").alias("capacite"),
    )
    latest = cleaning.station_from_latest(rows, "code", "date", ["libelle", "capacite", "date"], ["id"])
    return latest.withColumn("date", text_day("date"))
