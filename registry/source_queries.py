"""A: scans, shaping, merges and exports."""

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registry.core import (
    NATION_DAY, READINGS, REGION_DAY, STATIONS, Tables, nation_day, nation_id, query, r6, readings,
    region_day, s6, scratch, sday, stations, sweek, text_day, with_sql,
)
from sluice.functions import calendar as cal
from sluice.sources import scans, sinks
from sluice.sources.snapshots import SnapshotStore


@query(
    "scan_yearly",
    with_sql(
        f"""SELECT station_id, {sday('date')} AS date, value, year(date)::INT AS year FROM nation_day
            WHERE date >= DATE '1999-03-15'""",
        NATION_DAY,
    ),
)
def _(t: Tables):
    path = scratch(t, "yearly")
    series = nation_day(t).select("station_id", "date", "value", F.year("date").alias("year"))
    series.hint("rebalance", "year").write.partitionBy("year").parquet(path)
    rows = scans.scan_yearly(t.spark, path, since=date(1999, 3, 15))
    return rows.withColumn("date", text_day("date"))


@query(
    "scan_grid_csv",
    f"""SELECT 'M' || (l_partkey % 90)::VARCHAR || '_' || (l_suppkey % 40)::VARCHAR AS maille_id,
               {sday('l_shipdate')} AS date, {s6('l_quantity + l_linenumber / 2::DOUBLE')} AS precip_mm,
               l_discount AS etp_mm, l_tax AS swi, l_orderkey
        FROM lineitem WHERE (l_partkey % 90) < 60""".replace(", l_orderkey", ""),
)
def _(t: Tables):
    path = scratch(t, "grid")
    rows = t.lineitem.select(
        (F.col("l_partkey") % 90).cast("int").alias("LAMBX"),
        (F.col("l_suppkey") % 40).cast("int").alias("LAMBY"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("DATE"),
        (F.col("l_linenumber") / 2).alias("PRENEI"),
        F.col("l_quantity").alias("PRELIQ"),
        F.col("l_discount").alias("ETP"),
        F.col("l_tax").alias("SWI"),
    )
    rows.write.option("sep", ";").option("header", True).option("compression", "gzip").csv(path)
    cells = (
        rows.select("LAMBX", "LAMBY").distinct().where("LAMBX < 60")
        .withColumn("maille_id", F.concat(F.lit("M"), "LAMBX", F.lit("_"), "LAMBY"))
    )
    grid = scans.scan_grid_csv(t.spark, path, cells)
    return grid.withColumn("date", text_day("date")).withColumn("precip_mm", r6("precip_mm"))


def _pages(t: Tables) -> DataFrame:
    """Landed pages: one request per customer, pages of one year; the announced count of some
    requests is wrong."""
    path = scratch(t, "pages")
    total = t.orders.groupBy("o_custkey").agg(F.count("*").alias("_n"))
    page = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("page")).agg(
        F.collect_list(
            F.struct(
                F.col("o_orderkey").alias("code"),
                F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                F.col("o_totalprice").alias("result"),
            )
        ).alias("data")
    )
    count = F.when(F.col("o_custkey") % 7 == 0, F.col("_n") + 1).otherwise(F.col("_n"))
    pages = page.join(total, "o_custkey").select(
        F.col("o_custkey").alias("request"), count.alias("count"), "data"
    )
    pages.write.json(path)
    return t.spark.read.json(
        path, schema="request long, count long, data array<struct<code:long,date:string,result:double>>"
    )


@query(
    "flatten_pages",
    f"""SELECT o_custkey AS request, o_orderkey AS code, {sday('o_orderdate')} AS date,
               o_totalprice AS result FROM orders""",
)
def _(t: Tables):
    return scans.flatten_pages(_pages(t), "request")


@query(
    "reconcile_pages",
    """SELECT o_custkey AS request, count(*) + (o_custkey % 7 = 0)::INT AS announced,
              count(*) AS received, o_custkey % 7 <> 0 AS complete FROM orders GROUP BY o_custkey""",
)
def _(t: Tables):
    return scans.reconcile_pages(_pages(t), "request")


@query(
    "shape_groundwater",
    f"""SELECT 'piezo:' || l_suppkey::VARCHAR AS station_id, {sday('l_shipdate')} AS date,
               l_quantity AS niveau_ngf,
               coalesce(CASE WHEN s_nationkey % 5 > 1 THEN {s6('round(s_acctbal, 2) - l_quantity', 4)} END, -1)
                 AS profondeur, l_returnflag AS qualification
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey WHERE l_linenumber <> 3""",
)
def _(t: Tables):
    raw = t.lineitem.select(
        F.col("l_suppkey").alias("code"), F.col("l_shipdate").alias("date"),
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("niveau"),
        F.col("l_returnflag").alias("statut"),
    )
    altitude = (
        F.when(F.col("s_nationkey") % 5 > 1, F.round("s_acctbal", 2).cast("string"))
        .when(F.col("s_nationkey") % 5 == 1, "-999")
    )
    marks = t.supplier.select(
        F.concat(F.lit("piezo:"), "s_suppkey").alias("station_id"),
        F.to_json(F.struct(altitude.alias("altitude"))).alias("metadonnees"),
    )
    rows = scans.shape_groundwater(raw, marks)
    return rows.withColumn("date", text_day("date")).withColumn(
        "profondeur", F.coalesce(r6("profondeur", 4), F.lit(-1.0))
    )


@query(
    "shape_flow",
    f"""SELECT 'hydro:' || l_suppkey::VARCHAR AS station_id, {sday('l_shipdate')} AS date,
               l_quantity AS qmj_ls, l_linestatus AS qualification
        FROM lineitem WHERE l_linenumber <> 2""",
)
def _(t: Tables):
    raw = t.lineitem.select(
        F.col("l_suppkey").alias("code"), F.col("l_shipdate").alias("date"),
        F.when(F.col("l_linenumber") != 2, F.col("l_quantity")).alias("resultat"),
        F.col("l_linestatus").alias("statut"),
    )
    return scans.shape_flow(raw).withColumn("date", text_day("date"))


_CAMP = """obs AS (SELECT 'onde:' || user_id::VARCHAR AS station_id, ts::DATE AS date_campagne,
      event_type AS modalite, json_extract(props, '$.k')::INT AS k, event_id
    FROM events WHERE event_type <> 'error'),
  types AS (SELECT DISTINCT json_extract(props, '$.k')::INT AS k,
      CASE WHEN json_extract(props, '$.k')::INT % 4 = 0 THEN 'complementaire' ELSE 'usuelle' END AS type_campagne
    FROM events WHERE json_extract(props, '$.k')::INT % 9 <> 0),
  known AS (SELECT DISTINCT 'onde:' || user_id::VARCHAR AS station_id FROM events WHERE value > 45 AND user_id % 2 = 0)"""


def _campaign(t: Tables) -> tuple[DataFrame, DataFrame]:
    k = F.get_json_object("props", "$.k")
    obs = t.events.select(
        F.col("user_id").alias("code_station"), F.col("ts").alias("date"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("modalite"),
        k.alias("code_campagne"), "event_id",
    )
    kinds = t.events.select(k.cast("int").alias("code_campagne")).distinct().where(
        "code_campagne % 9 <> 0"
    ).withColumn(
        "type_campagne",
        F.when(F.col("code_campagne") % 4 == 0, "complementaire").otherwise("usuelle"),
    )
    known = t.events.where("value > 45 AND user_id % 2 = 0").select(
        F.concat(F.lit("onde:"), "user_id").alias("station_id")
    ).distinct()
    return scans.shape_campaign(obs, kinds, known)


@query(
    "shape_campaign",
    with_sql(
        f"""SELECT station_id, {sday('date_campagne')} AS date_campagne, modalite,
                   coalesce(type_campagne, '') AS type_campagne
            FROM obs LEFT JOIN types USING (k) WHERE station_id IN (SELECT station_id FROM known)""",
        _CAMP,
    ),
)
def _(t: Tables):
    return _campaign(t)[0].withColumn("date_campagne", text_day("date_campagne")).fillna(
        {"type_campagne": ""}
    )


@query(
    "unknown_stations",
    with_sql(
        """SELECT station_id, count(*) AS n FROM obs
           WHERE station_id NOT IN (SELECT station_id FROM known) GROUP BY 1""",
        _CAMP,
    ),
)
def _(t: Tables):
    return _campaign(t)[1]


def _territory_feed(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    label = F.when(F.col("o_custkey") % 11 == 0, "Semaine inconnue").otherwise(
        F.concat(F.lit("Semaine "), F.weekofyear("o_orderdate"), F.lit(" (au "), day, F.lit(")"))
    )
    return t.orders.select(
        F.concat(F.lit("  Étang n°"), F.col("o_custkey") % 97, F.lit("-Retenue")).alias("nom"),
        label.alias("libelle_date"),
        F.col("o_orderkey").alias("volume_m3"),
        F.col("o_custkey").alias("capacite_m3"),
    )


@query(
    "shape_reservoir",
    f"""SELECT coalesce('ALIAS_' || CASE WHEN o_custkey % 97 < 20 THEN (o_custkey % 97)::VARCHAR END,
                'ETANG_N_' || (o_custkey % 97)::VARCHAR) AS code,
               '  Étang n°' || (o_custkey % 97)::VARCHAR || '-Retenue' AS libelle,
               {sday('o_orderdate')} AS date, o_orderkey::DOUBLE AS volume_m3,
               o_custkey::DOUBLE AS capacite_m3
        FROM orders WHERE o_custkey % 11 <> 0""",
)
def _(t: Tables):
    k = F.col("c_custkey") % 97
    aliases = t.customer.select(
        F.concat(F.lit("ETANG_N_"), k).alias("code"), F.concat(F.lit("ALIAS_"), k).alias("alias")
    ).where(k < 20).distinct()
    rows = scans.shape_reservoir(_territory_feed(t), aliases)
    return rows.withColumn("date", text_day("date"))


@query(
    "shape_reservoir_national",
    f"""SELECT 'LAC_' || (o_custkey % 97)::VARCHAR AS code, 'lac ' || (o_custkey % 97)::VARCHAR AS libelle,
               {sday('o_orderdate')} AS date, round(o_orderkey)::DOUBLE * 1000 AS volume_m3,
               coalesce(CASE WHEN o_custkey % 3 > 0 THEN o_custkey::DOUBLE * 100000 END, -1) AS capacite_m3
        FROM orders WHERE o_orderkey % 5 <> 0""",
)
def _(t: Tables):
    raw = t.orders.select(
        F.concat(F.lit("lac "), F.col("o_custkey") % 97).alias("nom"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("libelle_date"),
        F.when(F.col("o_orderkey") % 5 == 0, "")
        .otherwise(F.format_string("%.3f", F.col("o_orderkey") / 1000)).alias("stock_millions"),
        F.when(F.col("o_custkey") % 3 == 0, "")
        .otherwise(F.format_string("%.1f", F.col("o_custkey") / 10)).alias("capacite_millions"),
    )
    rows = scans.shape_reservoir_national(raw)
    return rows.withColumn("date", text_day("date")).fillna({"capacite_m3": -1.0})


@query(
    "source_with_fallback",
    with_sql(
        f"""SELECT station_id, {sday('date')} AS date, volume_m3, source_donnee FROM (
              SELECT *, 'territoire' AS source_donnee FROM readings WHERE capacite_m3 < 4
              UNION ALL SELECT *, 'national' FROM readings
              WHERE capacite_m3 >= 4 AND NOT EXISTS (SELECT 1 FROM readings WHERE capacite_m3 < 4))""",
        READINGS,
    ),
)
def _(t: Tables):
    rows = readings(t)
    both = scans.source_with_fallback(rows.where("capacite_m3 < 4"), rows.where("capacite_m3 >= 4"))
    return both.select("station_id", text_day("date").alias("date"), "volume_m3", "source_donnee")


@query(
    "fallback_per_key",
    with_sql(
        f"""SELECT station_id, {sday('date')} AS date, volume_m3, source_donnee FROM (
              SELECT *, 'territoire' AS source_donnee FROM readings WHERE volume_m3 > 3
              UNION ALL SELECT r.*, 'national' FROM readings r ANTI JOIN
                (SELECT DISTINCT date FROM readings WHERE volume_m3 > 3) USING (date))""",
        READINGS,
    ),
)
def _(t: Tables):
    rows = readings(t)
    both = scans.fallback_per_key(rows.where("volume_m3 > 3"), rows, ["date"])
    return both.select("station_id", text_day("date").alias("date"), "volume_m3", "source_donnee")


def _order_cells(t: Tables) -> DataFrame:
    """Orders of one department with parallel JSON lists; some are `null`, unreadable or uneven."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity")
    grouped = t.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("_l"))

    def cell(value):
        return F.to_json(F.transform("_l", value))

    names = cell(lambda x: F.concat(F.lit(" zone "), x["l_suppkey"], F.lit(" ")))
    levels = F.when(
        F.col("l_orderkey") % 13 == 0, F.to_json(F.array(F.lit("crise")))
    ).otherwise(cell(lambda x: x["l_returnflag"]))
    kinds = cell(lambda x: F.when(x["l_quantity"] > 25, "SUP").otherwise("SOU"))

    def emptied(c):
        k = F.col("l_orderkey") % 17
        return F.when(k == 1, "null").when(k == 2, "{oops").when(k == 3, "").otherwise(c)

    return grouped.select(
        F.col("l_orderkey").alias("arrete_id"),
        emptied(names).alias("noms"), emptied(levels).alias("niveaux"), emptied(kinds).alias("types"),
    )


LISTS = {"type_zone": "types", "nom_zone": "noms", "niveau": "niveaux"}
_LINES = """lines AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)"""


@query(
    "explode_orders",
    with_sql(
        """SELECT l_orderkey AS arrete_id, CASE WHEN l_quantity > 25 THEN 'SUP' ELSE 'SOU' END AS type_zone,
                  'zone ' || l_suppkey AS nom_zone, l_returnflag AS niveau
           FROM lineitem JOIN lines USING (l_orderkey)
           WHERE l_orderkey % 17 NOT IN (1, 2, 3) AND (l_orderkey % 13 <> 0)
           UNION ALL
           SELECT l_orderkey, CASE WHEN l_quantity > 25 THEN 'SUP' ELSE 'SOU' END, 'zone ' || l_suppkey, 'crise'
           FROM lineitem JOIN lines USING (l_orderkey)
           WHERE l_orderkey % 17 NOT IN (1, 2, 3) AND l_orderkey % 13 = 0 AND n = 1
           UNION ALL
           SELECT l_orderkey, '', '', '' FROM lines WHERE l_orderkey % 17 IN (1, 2, 3)""",
        _LINES,
    ),
)
def _(t: Tables):
    rows, _ = scans.explode_orders(_order_cells(t), LISTS, ["arrete_id"], "nom_zone")
    return rows.fillna("", ["type_zone", "nom_zone", "niveau"])


@query(
    "uneven_orders",
    with_sql(
        """SELECT l_orderkey AS arrete_id, n AS n_type_zone, n AS n_nom_zone, 1::BIGINT AS n_niveau
           FROM lines WHERE l_orderkey % 17 NOT IN (1, 2, 3) AND l_orderkey % 13 = 0 AND n <> 1""",
        _LINES,
    ),
)
def _(t: Tables):
    _, bad = scans.explode_orders(_order_cells(t), LISTS, ["arrete_id"], "nom_zone")
    return bad.select("arrete_id", *[F.col(f"n_{c}").cast("long").alias(f"n_{c}") for c in LISTS])


# --- Merges -------------------------------------------------------------------------------------

@query(
    "conform",
    """SELECT o_custkey::VARCHAR AS station_id, strftime(o_orderdate, '%Y-%m-01') AS month,
              arg_max(round(o_totalprice)::BIGINT, o_orderkey) AS value,
              arg_max(o_orderpriority, o_orderkey) AS qualification
       FROM orders GROUP BY 1, 2""",
)
def _(t: Tables):
    raw = t.orders.select(
        F.col("o_custkey").alias("station_id"), F.trunc("o_orderdate", "month").alias("month"),
        F.round("o_totalprice").alias("value"), F.col("o_orderpriority").alias("qualification"),
        "o_orderkey", "o_orderstatus",
    )
    schema = {"station_id": "string", "month": "date", "value": "long", "qualification": "string"}
    table = sinks.conform(raw, schema, ["station_id", "month"], ["o_orderkey"])
    return table.withColumn("month", text_day("month"))


def _stored_and_batch(t: Tables) -> tuple[DataFrame, DataFrame]:
    series = nation_day(t)
    stored = series.where(F.col("n") % 5 != 0).select(
        "station_id", "date", F.when(F.col("n") % 3 != 0, F.col("value")).alias("value"),
        F.lit("2001-12-01").alias("ingere_le"),
    )
    batch = series.where(F.year("date") >= 1998).select(
        "station_id", "date",
        F.when(F.col("n") % 6 != 0, F.col("value") + (F.col("n") % 2)).alias("value"),
        F.lit("2001-12-08").alias("ingere_le"),
    )
    return stored, batch


_MERGE = """stored AS (SELECT station_id, date, CASE WHEN n % 3 <> 0 THEN value END AS value,
     '2001-12-01' AS ingere_le FROM nation_day WHERE n % 5 <> 0),
   batch AS (SELECT station_id, date, CASE WHEN n % 6 <> 0 THEN value + n % 2 END AS value,
     '2001-12-08' AS ingere_le FROM nation_day WHERE year(date) >= 1998),
   merged AS (SELECT station_id, date,
       CASE WHEN keep_old THEN ov ELSE nv END AS value, CASE WHEN keep_old THEN oi ELSE ni END AS ingere_le
     FROM (SELECT station_id, date, o.value AS ov, b.value AS nv, o.ingere_le AS oi, b.ingere_le AS ni,
             b.ingere_le IS NULL OR (o.ingere_le IS NOT NULL AND o.value IS NOT DISTINCT FROM b.value)
               AS keep_old
           FROM stored o FULL JOIN batch b USING (station_id, date)))"""
_MERGED = with_sql(
    f"""SELECT station_id, {sday('date')} AS date, coalesce(value, -1) AS value, ingere_le FROM merged""",
    NATION_DAY, _MERGE,
)


@query("merge_observations", _MERGED)
def _(t: Tables):
    stored, batch = _stored_and_batch(t)
    merged = sinks.merge_observations(stored, batch, ["station_id", "date"], ["value"])
    return merged.withColumn("date", text_day("date")).fillna({"value": -1.0})


@query("merge_into_table", _MERGED)
def _(t: Tables):
    store = SnapshotStore(t.spark, scratch(t, "merge"))
    stored, batch = _stored_and_batch(t)
    for part in (stored, batch, batch):  # the second run of a batch changes nothing
        store.merge("observations", part, ["station_id", "date"], ["value"])
    table = store.read("observations").select("station_id", "date", "value", "ingere_le")
    return table.withColumn("date", text_day("date")).fillna({"value": -1.0})


@query("merge_stream", _MERGED)
def _(t: Tables):
    from sluice.streaming.merge_stream import merge_new_files

    landing, path, state = (scratch(t, n) for n in ("landing", "stream", "state"))
    store = SnapshotStore(t.spark, path)
    schema = {"station_id": "string", "date": "date", "value": "double", "ingere_le": "string"}
    for part in _stored_and_batch(t):
        part.write.mode("append").parquet(landing)
        merge_new_files(
            t.spark, landing, schema, store, "observations", ["station_id", "date"], ["value"], ["ingere_le"], state
        ).awaitTermination()
    table = store.read("observations").select("station_id", "date", "value", "ingere_le")
    return table.withColumn("date", text_day("date")).fillna({"value": -1.0})


@query(
    "replace_weeks",
    with_sql(
        f"""SELECT zone_id, semaine, value FROM w WHERE semaine NOT LIKE '%-W1%'
            UNION ALL SELECT zone_id, semaine, value + 1000 FROM w
            WHERE semaine LIKE '%-W1%' AND zone_id <> 'Z0'""",
        NATION_DAY, STATIONS, REGION_DAY,
        f"w AS (SELECT zone_id, {sweek('date')} AS semaine, sum(value) AS value FROM region_day GROUP BY 1, 2)",
    ),
)
def _(t: Tables):
    stored = region_day(t).groupBy(
        "zone_id", cal.iso_week_label(F.col("date")).alias("semaine")
    ).agg(F.sum("value").alias("value"))
    again = stored.where(F.col("semaine").contains("-W1"))
    fresh = again.where("zone_id <> 'Z0'").withColumn("value", F.col("value") + 1000)
    return sinks.replace_weeks(stored, fresh, again)


# --- Several tables in one snapshot -------------------------------------------------------------

def _week_tables(t: Tables) -> tuple[DataFrame, DataFrame]:
    week = cal.iso_week_label(F.col("date")).alias("semaine")
    zones = region_day(t).groupBy("zone_id", week).agg(F.sum("value").alias("value"))
    return zones, nation_day(t).groupBy("station_id", week).agg(F.sum("value").alias("value"))


class _Died(Exception):
    pass


def _published(t: Tables) -> SnapshotStore:
    """Three commits of both tables: all weeks, a run that dies after one table, weeks of the spring anew
    (without one zone and one station)."""
    store = SnapshotStore(t.spark, scratch(t, "published"))
    zones, stations_ = _week_tables(t)
    with store.transaction() as c:
        c.replace_weeks("zones", zones, zones.select("semaine"))
        c.replace_weeks("stations", stations_, stations_.select("semaine"))
    again = [x.where(F.col("semaine").contains("-W1")) for x in (zones, stations_)]
    try:
        with store.transaction() as c:
            c.replace_weeks("zones", again[0].withColumn("value", F.lit(-1.0)), again[0])
            raise _Died
    except _Died:
        pass
    fresh = (again[0].where("zone_id <> 'Z0'"), again[1].where("station_id <> 'N00'"))
    with store.transaction() as c:
        for name, new, weeks in zip(("zones", "stations"), fresh, again):
            c.replace_weeks(name, new.withColumn("value", F.col("value") + 1000), weeks)
    return store


_PUBLISHED = f"""z AS (SELECT zone_id AS id, {sweek('date')} AS semaine, sum(value) AS value FROM region_day GROUP BY 1, 2),
s AS (SELECT station_id AS id, {sweek('date')} AS semaine, sum(value) AS value FROM nation_day GROUP BY 1, 2),
first AS (SELECT 'zones' AS table_name, * FROM z UNION ALL SELECT 'stations', * FROM s),
second AS (SELECT table_name, id, semaine, CASE WHEN semaine LIKE '%-W1%' THEN value + 1000 ELSE value END AS value FROM first
  WHERE semaine NOT LIKE '%-W1%' OR id NOT IN ('Z0', 'N00'))"""


@query(
    "publish_tables",
    with_sql(
        "SELECT 1 AS version, * FROM first UNION ALL SELECT 2, * FROM second", NATION_DAY, STATIONS, REGION_DAY, _PUBLISHED
    ),
)
def _(t: Tables):
    store, parts = _published(t), []
    for version in store.versions():
        for name, key in (("zones", "zone_id"), ("stations", "station_id")):
            rows = store.read(name, version)
            parts.append(rows.select(F.lit(version).alias("version"), F.lit(name).alias("table_name"), F.col(key).alias("id"), "semaine", "value"))
    return reduce(DataFrame.unionByName, parts)


@query(
    "snapshot_history",
    with_sql(
        """SELECT version, table_name, count(DISTINCT substr(semaine, 1, 4)) AS n_parts, count(*) AS n_rows
           FROM (SELECT 1::BIGINT AS version, * FROM first UNION ALL SELECT 2, * FROM second) GROUP BY 1, 2""",
        NATION_DAY, STATIONS, REGION_DAY, _PUBLISHED,
    ),
)
def _(t: Tables):
    return _published(t).history()


@query(
    "publish_audit",
    with_sql(
        """SELECT (table_name <> 'zones')::INT AS position, table_name, count(*) AS n_read, count(*) AS n_loaded, true AS ok
           FROM first GROUP BY 2""",
        NATION_DAY, STATIONS, REGION_DAY, _PUBLISHED,
    ),
)
def _(t: Tables):
    store = SnapshotStore(t.spark, scratch(t, "audited"))
    zones, stations_ = _week_tables(t)
    commit = store.transaction()
    commit.replace_weeks("zones", zones, zones.select("semaine"))
    commit.replace("stations", stations_)
    return commit.audit()  # counted before the swap


@query(
    "incremental_since",
    with_sql(
        f"""SELECT station_id, {sday('date')} AS date, value FROM nation_day JOIN
              (SELECT station_id, max(date) AS last FROM nation_day
               WHERE date <= DATE '2000-06-01' - (substr(station_id, 2)::INT * 20) GROUP BY 1)
              USING (station_id)
            WHERE date >= least(DATE '2000-06-01' - 90, last)""",
        NATION_DAY,
    ),
)
def _(t: Tables):
    feed = nation_day(t).select("station_id", "date", "value")
    limit = F.date_sub(
        F.lit("2000-06-01").cast("date"), F.substring("station_id", 2, 2).cast("int") * 20
    )
    stored = feed.where(F.col("date") <= limit)
    rows = sinks.incremental_since(
        stored, feed, "station_id", "date", F.lit("2000-06-01").cast("date")
    )
    return rows.withColumn("date", text_day("date"))


# --- Audits of a load, exports ------------------------------------------------------------------

@query(
    "load_audit",
    """SELECT position, table_name, n_read, n_loaded, n_read = n_loaded AS ok FROM (
         SELECT 0 AS position, 'nation' AS table_name, (SELECT count(*) FROM nation) AS n_read,
                (SELECT count(*) FROM nation) AS n_loaded
         UNION ALL SELECT 1, 'supplier', (SELECT count(*) FROM supplier),
                (SELECT count(*) FROM supplier JOIN nation ON s_nationkey = n_nationkey)
         UNION ALL SELECT 2, 'orders', (SELECT count(*) FROM orders),
                (SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)))""",
)
def _(t: Tables):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return sinks.load_audit(
        {
            "nation": (t.nation, t.nation),
            "supplier": (
                t.supplier, t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
            ),
            "orders": (t.orders, t.orders.join(lines, "o_orderkey", "left_semi")),
        }
    )


_LINE_TEXT = " || ".join(
    f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    for c in (
        "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag "
        "l_linestatus l_shipdate"
    ).split()
)


@query(
    "table_fingerprint",
    f"""SELECT count(*) AS n, sum(('0x' || substr(md5({_LINE_TEXT}), 1, 15))::UBIGINT::HUGEINT)::VARCHAR AS fingerprint
        FROM lineitem""",
)
def _(t: Tables):
    table = sinks.table_fingerprint(t.lineitem)
    return table.withColumn("fingerprint", F.col("fingerprint").cast("string"))


@query(
    "feature_collection",
    """SELECT '{"type":"Feature","geometry":{"coordinates":[' || s_suppkey || ',' || s_nationkey
              || '],"type":"Point"},"properties":{"station_id":"' || s_name || '","zone_id":'
              || CASE WHEN s_nationkey % 4 = 0 THEN 'null' ELSE '"Z' || s_nationkey || '"' END || '}}'
              AS feature FROM supplier""",
)
def _(t: Tables):
    geometry = F.format_string(
        '{"type":"Point","coordinates":[%d,%d]}', F.col("s_suppkey"), F.col("s_nationkey")
    )
    rows = t.supplier.select(
        geometry.alias("geometrie"), F.col("s_name").alias("station_id"),
        F.when(F.col("s_nationkey") % 4 != 0, F.concat(F.lit("Z"), "s_nationkey")).alias("zone_id"),
    )
    return sinks.feature_collection(rows, "geometrie", ["station_id", "zone_id"])


@query(
    "export_by_year",
    with_sql(
        """SELECT substr(semaine, 1, 4)::INT AS year, '{"semaine":"' || semaine || '","zones":' || coalesce(zones, '{}')
              || ',"stations":' || coalesce(stations, '{}') || ',"synthese":' || coalesce(synthese, 'null') || '}' AS value
           FROM wz FULL JOIN ws USING (semaine) FULL JOIN wy USING (semaine)""",
        NATION_DAY, STATIONS, REGION_DAY,
        f"""wz AS (SELECT semaine, '{{' || string_agg('"' || zone_id || '":{{"valeur":' || v || '}}', ',' ORDER BY zone_id) || '}}' AS zones
              FROM (SELECT zone_id, {sweek('date')} AS semaine, sum(value) AS v FROM region_day GROUP BY 1, 2) GROUP BY 1),
        ws AS (SELECT semaine, '{{' || string_agg('"' || station_id || '":{{"valeur":' || v || coalesce(',"classe":' || c, '') || '}}', ','
                ORDER BY station_id) || '}}' AS stations
              FROM (SELECT station_id, {sweek('date')} AS semaine, sum(value) AS v, max(CASE WHEN n > 3 THEN n END) AS c
                    FROM nation_day GROUP BY 1, 2) GROUP BY 1),
        wy AS (SELECT {sweek('date')} AS semaine, '{{"total":' || sum(value) || '}}' AS synthese FROM nation_day GROUP BY 1)""",
    ),
)
def _(t: Tables):
    week = cal.iso_week_label(F.col("date")).alias("semaine")
    z = region_day(t).groupBy("zone_id", week).agg(F.sum("value").alias("valeur"))
    s = nation_day(t).groupBy("station_id", week).agg(
        F.sum("value").alias("valeur"), F.max(F.when(F.col("n") > 3, F.col("n"))).alias("classe")
    )
    y = nation_day(t).groupBy(week).agg(F.sum("value").alias("total"))
    path = scratch(t, "export")
    sinks.write_export(
        sinks.export_by_year(z, s, y, ["valeur"], ["valeur", "classe"]), path
    )
    return t.spark.read.text(path)
