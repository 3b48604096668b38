"""K: radar pixels. A part is a pixel of a site, a quarter a pass, a quantity its backscatter."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registry.core import Tables, query, r6, s6, scratch, sday, text_day, with_sql
from registry.landcover_queries import CODES, codes
from registry.optical_queries import cells, rounded
from sluice.operators import radar as ra
from sluice.operators import series as se
from sluice.operators.components import network_reach
from sluice.plans.resume import resume, resume_passages
from sluice.session import cut_lineage
from sluice.sources.snapshots import SnapshotStore

PIXELS = """dom AS (SELECT 'M' || (p_partkey // 64 // 16)::VARCHAR AS marais, (p_partkey % 64)::INT AS ix, (p_partkey // 64)::INT AS iy,
    p_size % 10 <> 0 AS domaine, CASE p_size % 3 WHEN 0 THEN 'ouvert' WHEN 1 THEN 'ferme' END AS regime FROM part),
seen AS MATERIALIZED (SELECT (l_partkey % 64)::INT AS ix, (l_partkey // 64)::INT AS iy,
    make_date(year(l_shipdate), (quarter(l_shipdate) - 1) * 3 + 2, 1) AS date, median(-l_quantity / 2) AS db FROM lineitem GROUP BY 1, 2, 3),
pixels AS MATERIALIZED (SELECT d.marais, d.ix, d.iy, p.date, s.db FROM dom d JOIN (SELECT DISTINCT marais, date FROM seen JOIN dom USING (ix, iy)) p USING (marais)
    LEFT JOIN seen s ON s.ix = d.ix AND s.iy = d.iy AND s.date = p.date)"""
REFS = """yearly AS (SELECT marais, ix, iy, year(date)::INT AS annee, round_even(median(db) * 100, 0) / 100 AS ref FROM pixels
    WHERE month(date) IN (7, 8, 9) AND db IS NOT NULL GROUP BY 1, 2, 3, 4),
refs AS (SELECT marais, ix, iy, annee AS annee_ref, 'hydro' AS variante, ref FROM yearly
    UNION ALL SELECT marais, ix, iy, 0, 'fixe', round_even(median(ref) * 100, 0) / 100 FROM yearly GROUP BY 1, 2, 3)"""


def domain(t: Tables) -> DataFrame:
    k = F.col("p_size") % 3
    return t.part.select(
        F.concat(F.lit("M"), F.floor(F.floor(F.col("p_partkey") / 64) / 16)).alias("marais"),
        *cells("p_partkey"), (F.col("p_size") % 10 != 0).alias("domaine"),
        F.when(k == 0, "ouvert").when(k == 1, "ferme").alias("regime"),
    )


def seen(t: Tables) -> DataFrame:
    """Median of each cell and quarter, the mean of the middle values of a sort: groups are small and nearly as many
    as rows, so the maps of an aggregate of values cost more than they combine."""
    day = F.make_date(F.year("l_shipdate"), (F.quarter("l_shipdate") - 1) * 3 + 2, F.lit(1))
    group = Window.partitionBy("ix", "iy", "date")
    n, at = F.count("db").over(group), F.row_number().over(group.orderBy(F.col("db").asc_nulls_last()))
    placed = t.lineitem.select(*cells("l_partkey"), day.alias("date"), (-F.col("l_quantity") / 2).alias("db"))
    middle = placed.select("*", n.alias("_n"), at.alias("_at")).where("_at = 1 AND _n = 0 OR 2 * _at BETWEEN _n AND _n + 2 AND _at <= _n")
    return middle.groupBy("ix", "iy", "date").agg(F.avg("db").alias("db"))


def pixels(t: Tables) -> DataFrame:
    values = cut_lineage(seen(t))  # read by the passes and by the join
    grid = domain(t).select("marais", "ix", "iy")
    passes = values.join(grid, ["ix", "iy"]).select("marais", "date").distinct()
    return grid.join(passes, "marais").join(values, ["ix", "iy", "date"], "left")


# --- K1 to K3 -----------------------------------------------------------------------------------

@query(
    "to_decibel",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, coalesce({s6('CASE WHEN l_quantity > 10 THEN 10 * log10(l_quantity - 10) END')}, -99) AS db
        FROM lineitem""",
)
def _(t: Tables):
    db = ra.to_decibel(F.col("l_quantity") - 10)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.coalesce(r6(db), F.lit(-99.0)).alias("db"))


@query(
    "select_passes",
    f"""SELECT {sday('o_orderdate')} AS date, count(*) AS n_scenes, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS plateformes
        FROM orders WHERE o_custkey % 3 = 1 AND o_orderdate BETWEEN '1996-01-01' AND '1999-12-31' GROUP BY 1""",
)
def _(t: Tables):
    scenes = t.orders.select(
        (F.col("o_custkey") % 3).alias("orbite"), F.to_date("o_orderdate").alias("date"),
        F.col("o_orderstatus").alias("plateforme"),
    )
    rows = ra.select_passes(scenes, 1, "1996-01-01", "1999-12-31")
    return rows.withColumn("date", text_day("date")).withColumn("plateformes", F.array_join("plateformes", ","))


@query(
    "dry_reference",
    with_sql(f"SELECT marais, ix, iy, annee_ref, variante, {s6('ref')} AS ref FROM refs", PIXELS, REFS),
)
def _(t: Tables):
    rows = ra.dry_reference(pixels(t), ["marais"]).withColumn("annee_ref", F.coalesce("annee", F.lit(0)))
    return rounded(rows.drop("annee"), "ref")


@query(
    "dry_reference_period",
    with_sql(
        f"""SELECT marais, ix, iy, annee AS annee_ref, 'hydro' AS variante, {s6('ref')} AS ref FROM yearly WHERE annee < 2000
            UNION ALL SELECT marais, ix, iy, 0, 'fixe', {s6('round_even(median(ref) * 100, 0) / 100')} FROM yearly
            WHERE annee BETWEEN 1996 AND 1998 GROUP BY 1, 2, 3""",
        PIXELS, REFS,
    ),
)
def _(t: Tables):
    today = F.lit("2000-09-15").cast("date")  # the season of that year is not over
    rows = ra.dry_reference(pixels(t), ["marais"], period=(1996, 1998), today=today)
    return rounded(rows.withColumn("annee_ref", F.coalesce("annee", F.lit(0))).drop("annee"), "ref")


# --- K4 to K8 -----------------------------------------------------------------------------------

def smooth_sql(source: str, keys: str, value: str, name: str) -> str:
    """CTE body: `source` with the 3 x 3 median `name`."""
    same = " AND ".join(f"a.{k.strip()} = b.{k.strip()}" for k in keys.split(","))
    return f"""SELECT s.*, m.{name} FROM {source} s JOIN (
      SELECT {', '.join('a.' + k.strip() for k in keys.split(','))}, a.ix, a.iy, median(b.v) AS {name}
      FROM (SELECT {keys}, ix, iy, least(greatest(ix + dx, x0), x1) AS nx, least(greatest(iy + dy, y0), y1) AS ny
            FROM (SELECT *, min(ix) OVER w AS x0, max(ix) OVER w AS x1, min(iy) OVER w AS y0, max(iy) OVER w AS y1
                  FROM {source} WINDOW w AS (PARTITION BY {keys})),
              (SELECT unnest([-1, 0, 1]) AS dx), (SELECT unnest([-1, 0, 1]) AS dy)) a
      JOIN (SELECT {keys}, ix, iy, coalesce({value}, median({value}) OVER (PARTITION BY {keys})) AS v FROM {source}) b
        ON {same} AND b.ix = a.nx AND b.iy = a.ny
      GROUP BY ALL) m USING ({keys}, ix, iy)"""


@query(
    "median_filter_3x3",
    with_sql(
        f"SELECT marais, {sday('date')} AS date, ix, iy, {s6('lisse')} AS lisse FROM sm",
        PIXELS, f"sm AS ({smooth_sql('pixels', 'marais, date', 'db', 'lisse')})",
    ),
)
def _(t: Tables):
    rows = ra.median_filter_3x3(pixels(t), ["marais", "date"], "db", tile=32)
    return rows.select("marais", text_day("date").alias("date"), "ix", "iy", r6("lisse").alias("lisse"))


@query(
    "detect_change",
    with_sql(
        f"""SELECT p.marais, {sday('p.date')} AS date, count(*) AS n, sum((db - ref < -3 AND db < -16 AND ref >= -16)::INT)::BIGINT AS n_crue
            FROM pixels p JOIN refs r ON p.marais = r.marais AND p.ix = r.ix AND p.iy = r.iy AND variante = 'fixe'
            WHERE db IS NOT NULL GROUP BY 1, 2""",
        PIXELS, REFS,
    ),
)
def _(t: Tables):
    px = pixels(t)
    fixed = ra.dry_reference(px, ["marais"]).where("variante = 'fixe'").select("marais", "ix", "iy", "ref")
    rows = px.where("db IS NOT NULL").join(fixed, ["marais", "ix", "iy"])
    hit = ra.detect_change(F.col("db"), F.col("ref"), F.lit(True))
    table = rows.groupBy("marais", "date").agg(F.count("*").alias("n"), F.count_if(hit).alias("n_crue"))
    return table.withColumn("date", text_day("date"))


def patches_sql(source: str, keys: str, prefix: str) -> str:
    """CTEs: `<prefix>_size`, each flagged pixel with the size of its 4-connected patch. Must follow
    WITH RECURSIVE."""
    same = " AND ".join(f"n.{k.strip()} = r.{k.strip()}" for k in keys.split(","))
    return f"""{prefix}_reach AS (SELECT {keys}, ix AS rx, iy AS ry, ix, iy FROM {source}
      UNION SELECT {', '.join('r.' + k.strip() for k in keys.split(','))}, r.rx, r.ry, n.ix, n.iy FROM {prefix}_reach r JOIN {source} n
        ON {same} AND abs(n.ix - r.ix) + abs(n.iy - r.iy) = 1),
    {prefix}_size AS (SELECT {keys}, rx AS ix, ry AS iy, count(*) AS taille FROM {prefix}_reach GROUP BY ALL)"""


@query(
    "min_patch_size",
    with_sql(
        "SELECT annee, ix, iy FROM p_size WHERE taille >= 3",
        """flagged AS (SELECT DISTINCT year(l_shipdate)::INT AS annee, (l_partkey % 64)::INT AS ix, (l_partkey // 64)::INT AS iy
             FROM lineitem WHERE l_quantity >= 49)""",
        patches_sql("flagged", "annee", "p"),
    ).replace("WITH", "WITH RECURSIVE", 1),
)
def _(t: Tables):
    flagged = t.lineitem.where("l_quantity >= 49").select(F.year("l_shipdate").alias("annee"), *cells("l_partkey"))
    return ra.min_patch_size(flagged, ["annee"], 3)


@query(
    "area_by_regime",
    with_sql(
        f"""SELECT marais, {sday('date')} AS date, {s6('count(*) FILTER (WHERE c AND domaine) * 0.01')} AS surface_ha,
              {s6('100 * count(*) FILTER (WHERE ok AND domaine) / count(*) FILTER (WHERE domaine)')} AS pct_valides,
              {s6("count(*) FILTER (WHERE c AND domaine AND regime = 'ouvert') * 0.01")} AS ha_ouvert,
              {s6("count(*) FILTER (WHERE c AND domaine AND regime = 'ferme') * 0.01")} AS ha_ferme,
              {s6('count(*) FILTER (WHERE c AND domaine AND regime IS NULL) * 0.01')} AS ha_autres
            FROM (SELECT *, db IS NOT NULL AS ok, coalesce(db < -16, false) AS c FROM pixels JOIN dom USING (marais, ix, iy)) GROUP BY 1, 2""",
        PIXELS,
    ),
)
def _(t: Tables):
    rows = pixels(t).join(domain(t), ["marais", "ix", "iy"]).withColumn("ok", F.col("db").isNotNull())
    rows = rows.withColumn("crue", F.coalesce(F.col("db") < -16, F.lit(False)))
    table = ra.area_by_regime(rows, ["marais", "date"], ["ouvert", "ferme"], 0.01)
    return rounded(table, "surface_ha", "pct_valides", "ha_ouvert", "ha_ferme", "ha_autres").withColumn("date", text_day("date"))


_KEYS = "marais, date, variante, annee_ref"
PASSAGES = with_sql(
    f"""SELECT a.marais, {sday('a.date')} AS date, a.variante, a.annee_ref, coalesce({s6('surface_ha')}, -1) AS surface_ha,
          coalesce({s6('pct_valides')}, -1) AS pct_valides, coalesce({s6('ha_ouvert')}, -1) AS ha_ouvert, coalesce({s6('ha_autres')}, -1) AS ha_autres
        FROM asked a LEFT JOIN (
          SELECT {_KEYS}, count(*) FILTER (WHERE crue AND domaine) * 0.01 AS surface_ha,
            100 * count(*) FILTER (WHERE ok AND domaine) / count(*) FILTER (WHERE domaine) AS pct_valides,
            count(*) FILTER (WHERE crue AND domaine AND regime = 'ouvert') * 0.01 AS ha_ouvert,
            count(*) FILTER (WHERE crue AND domaine AND regime IS NULL) * 0.01 AS ha_autres
          FROM (SELECT s.*, coalesce(p.taille >= 2, false) AS crue, domaine, regime FROM sm s LEFT JOIN p_size p USING ({_KEYS}, ix, iy)
                JOIN dom USING (marais, ix, iy)) GROUP BY ALL) b USING ({_KEYS})""",
    PIXELS, REFS,
    """known AS (SELECT DISTINCT marais, variante, annee_ref FROM refs)""",
    """fullref AS (SELECT d.marais, d.ix, d.iy, k.variante, k.annee_ref, r.ref FROM dom d JOIN known k USING (marais)
         LEFT JOIN refs r ON r.marais = d.marais AND r.ix = d.ix AND r.iy = d.iy AND r.variante = k.variante AND r.annee_ref = k.annee_ref)""",
    f"refsm AS ({smooth_sql('fullref', 'marais, variante, annee_ref', 'ref', 'ref_lisse')})",
    """asked AS (SELECT DISTINCT marais, date, v AS variante, CASE WHEN v = 'fixe' THEN 0 WHEN month(date) >= 10 THEN year(date)
         ELSE year(date) - 1 END::INT AS annee_ref FROM pixels, (SELECT unnest(['hydro', 'fixe']) AS v))""",
    """joined AS (SELECT a.marais, a.date, a.variante, a.annee_ref, p.ix, p.iy, ref_lisse, db IS NOT NULL AND ref IS NOT NULL AS ok,
         CASE WHEN ref IS NOT NULL THEN db END AS seendb
         FROM asked a JOIN pixels p USING (marais, date) JOIN refsm r ON r.marais = a.marais AND r.variante = a.variante
           AND r.annee_ref = a.annee_ref AND r.ix = p.ix AND r.iy = p.iy)""",
    f"sm AS ({smooth_sql('joined', _KEYS, 'seendb', 'lisse')})",
    f"""flagged AS (SELECT {_KEYS}, ix, iy FROM sm WHERE ok AND lisse - ref_lisse < -3 AND lisse < -13 AND ref_lisse >= -13)""",
    patches_sql("flagged", _KEYS, "p"),
).replace("WITH", "WITH RECURSIVE", 1)


@query("passages", PASSAGES)
def _(t: Tables):
    rows = ra.passages(pixels(t), domain(t), ["ouvert", "ferme"], 0.01, minimum=2, tile=32, limit=-13.0)
    rows = rounded(rows, "surface_ha", "pct_valides", "ha_ouvert", "ha_autres").drop("ha_ferme")
    return rows.withColumn("date", text_day("date")).fillna(-1.0)


_CUT = "(SELECT (min(year(l_shipdate)) + max(year(l_shipdate))) // 2 FROM lineitem)"
RESUMED = PASSAGES.replace(
    "FROM yearly GROUP BY 1, 2, 3)", f"FROM yearly WHERE annee <= {_CUT} GROUP BY 1, 2, 3)", 1
)


def run_years(t: Tables) -> tuple[int, int, int]:
    """First, middle and last year of the passes."""
    years = t.lineitem.agg(F.min(F.year("l_shipdate")).alias("a"), F.max(F.year("l_shipdate")).alias("b")).first()
    return years.a, (years.a + years.b) // 2, years.b


@query("passages_resumed", RESUMED)
def _(t: Tables):
    # two runs: one in the autumn of the middle year, on the passes there were, and one after the last;
    # the fixed reference is that of the years up to the middle one
    first, cut, last = run_years(t)
    store = SnapshotStore(t.spark, scratch(t, "passages"))
    every = cut_lineage(pixels(t))
    for today in (f"{cut}-11-01", f"{last}-12-31"):
        archive = every.where(F.col("date") <= today)
        resume_passages(
            store, archive.select("marais", "date"), archive, domain(t), ["ouvert", "ferme"], 0.01,
            F.lit(today).cast("date"), "drop 3, limit -13, 2 px", period=(first, cut), years_per_commit=10,
            minimum=2, tile=32, limit=-13.0,
        )
    rows = store.read("passages").drop("annee", "ha_ferme")
    rows = rounded(rows, "surface_ha", "pct_valides", "ha_ouvert", "ha_autres")
    return rows.withColumn("date", text_day("date")).fillna(-1.0)


@query(
    "passages_units",
    with_sql(
        f"""SELECT *, CASE WHEN annee < {_CUT} THEN 1 ELSE 2 END AS run,
              annee < (SELECT max(year(l_shipdate)) FROM lineitem) AS closed
            FROM (SELECT marais, year(date)::INT AS annee, count(*) AS n, count(db) AS n_seen FROM pixels GROUP BY 1, 2)""",
        PIXELS,
    ),
)
def _(t: Tables):
    # the ledger of two runs, with the pixels each finished unit read
    _, cut, last = run_years(t)
    store, keys, made = SnapshotStore(t.spark, scratch(t, "units")), ["marais", "annee"], []
    every = cut_lineage(pixels(t).withColumn("annee", F.year("date")))
    for today in (f"{cut}-11-01", f"{last}-12-31"):
        archive = every.where(F.col("date") <= today)
        made += resume(
            store, "pixels", archive, keys, "v1", F.col("annee") >= int(today[:4]),
            lambda units, a=archive: a.join(units, keys, "left_semi").groupBy(*keys).agg(F.count("*").alias("n"), F.count("db").alias("n_seen")),
            years_per_commit=10,
        )
    run = F.when(F.col("snapshot") <= made[0], 1).otherwise(2)
    units = store.read("pixels_units").select(*keys, run.alias("run"), "closed")
    return units.join(store.read("pixels"), keys)


# --- K9, K10 ------------------------------------------------------------------------------------

PASSES = """passes AS (SELECT 'Z' || n_regionkey::VARCHAR AS marais, l_returnflag AS variante, l_shipdate::DATE AS date,
    CASE WHEN count(*) > 1 THEN sum(l_quantity) END AS surface_ha, max(l_quantity) AS ha_max, avg(l_linenumber * 14) AS pct_valides
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3),
winters AS (SELECT marais, variante, year(date) - (month(date) <= 3)::INT AS hiver, median(surface_ha) AS surface_ha FROM passes
  WHERE surface_ha IS NOT NULL AND pct_valides >= 30 AND month(date) IN (12, 1, 2, 3)
  GROUP BY 1, 2, 3 HAVING count(*) >= 3 AND count(DISTINCT month(date)) = 4)"""


def passes(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        t.nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    return rows.groupBy(
        F.concat(F.lit("Z"), "n_regionkey").alias("marais"), F.col("l_returnflag").alias("variante"),
        F.to_date("l_shipdate").alias("date"),
    ).agg(
        F.when(F.count("*") > 1, F.sum("l_quantity")).alias("surface_ha"),
        F.max("l_quantity").alias("ha_max"), F.avg(F.col("l_linenumber") * 14).alias("pct_valides"),
    )


@query(
    "monthly_area",
    with_sql(
        f"""SELECT marais, variante, strftime(date, '%Y-%m') AS mois, {s6('median(surface_ha)')} AS surface_ha, {s6('median(ha_max)')} AS ha_max,
              count(*) AS n_passages, {s6('median(pct_valides)')} AS pct_valides FROM passes
            WHERE surface_ha IS NOT NULL AND pct_valides >= 30 GROUP BY 1, 2, 3""",
        PASSES,
    ),
)
def _(t: Tables):
    return rounded(ra.monthly_area(passes(t), 30), "surface_ha", "ha_max", "pct_valides")


def trend_sql(source: str, keys: str, year: str, value: str) -> str:
    """Definition over pairs. The p value is exact without ties; with ties it is that of the normal
    law, the complement of P(1/2, z^2 / 2) by its power series. Series under 5 years have counts only."""
    table = ", ".join(f"({n}, {c}, {p!r})" for n, c, p in ra.kendall_exact_rows(9))
    half = "(con - dis) * (con - dis) / (sigma * sigma) / 2"
    low = "sl[greatest(round_even((total - 1.959963984540054 * sigma) / 2, 0) - 1, 0)::INT + 1]"
    high = "sl[least(round_even((total + 1.959963984540054 * sigma) / 2, 0), total - 1)::INT + 1]"
    p = f"""CASE WHEN tied = 0 THEN x.p WHEN con = dis THEN 1.0 ELSE
          1 - list_sum(list_transform(range(0, 120), lambda k: exp((0.5 + k) * ln({half}) - {half} - lgamma(1.5 + k)))) END"""
    return f"""SELECT {keys}, n, first, last, {s6('med')} AS median, {s6('slope')} AS slope, {s6('slope_low')} AS slope_low,
        {s6('slope_high')} AS slope_high, {s6('tau')} AS tau, {s6('p')} AS p FROM (
      SELECT {keys}, n, first, last, med, CASE WHEN n >= 5 THEN slope END AS slope, CASE WHEN n >= 5 THEN {low} END AS slope_low,
        CASE WHEN n >= 5 THEN {high} END AS slope_high,
        CASE WHEN n >= 5 AND total > tied THEN (con - dis) / sqrt(total * (total - tied)) END AS tau,
        CASE WHEN n >= 5 AND sigma > 0 THEN {p} END AS p
      FROM (SELECT *, sqrt((n * (n - 1) * (2 * n + 5) - t1) / 18::DOUBLE) AS sigma, least(con, dis) AS c FROM (
          SELECT {keys}, count(*) AS n, min({year})::INT AS first, max({year})::INT AS last, median({value}) AS med,
            sum((k - 1) / 2) AS tied, sum((k - 1) * (2 * k + 5)) AS t1
          FROM (SELECT *, count(*) OVER (PARTITION BY {keys}, {value}) AS k FROM {source}) GROUP BY ALL)
        LEFT JOIN (SELECT {keys}, count(*)::BIGINT AS total, median(s) AS slope, list_sort(list(s)) AS sl,
            count(*) FILTER (WHERE s > 0) AS con, count(*) FILTER (WHERE s < 0) AS dis
          FROM (SELECT {', '.join('a.' + k.strip() for k in keys.split(','))}, (b.{value} - a.{value}) / (b.{year} - a.{year}) AS s
                FROM {source} a JOIN {source} b USING ({keys}) WHERE b.{year} > a.{year}) GROUP BY ALL) USING ({keys})) w
      LEFT JOIN (VALUES {table}) x(xn, xc, p) ON xn = n AND xc = c)"""


def trend_columns(df: DataFrame) -> DataFrame:
    df = df.withColumn("n", F.col("n").cast("long"))
    return rounded(df, "median", "slope", "slope_low", "slope_high", "tau", "p")


@query("winter_trend", with_sql(trend_sql("winters", "marais, variante", "hiver", "surface_ha"), PASSES))
def _(t: Tables):
    return trend_columns(ra.winter_trend(passes(t), 30))


# --- K11 to K15 ---------------------------------------------------------------------------------

_MASK = """part_dark AS (SELECT marais, ix, iy, year(date)::INT AS annee, count(*) AS n, count(*) FILTER (WHERE db < -12) AS d FROM pixels
    WHERE db IS NOT NULL GROUP BY 1, 2, 3, 4),
  fixed AS (SELECT marais, ix, iy, sum(d) / sum(n) AS part FROM part_dark GROUP BY 1, 2, 3)"""


@query(
    "permanent_mask_areas",
    with_sql(
        f"""SELECT marais, seuil, {s6('count(*) FILTER (WHERE part > seuil) * 0.01')} AS ha FROM fixed, (SELECT unnest([0.3, 0.4, 0.5, 0.6, 0.7])::DOUBLE AS seuil)
            GROUP BY 1, 2""",
        PIXELS, _MASK,
    ),
)
def _(t: Tables):
    areas, _ = ra.permanent_mask(pixels(t), F.col("db") < -12, [0.3, 0.4, 0.5, 0.6, 0.7], 0.01)
    return rounded(areas, "ha")


@query(
    "permanent_mask_agreement",
    with_sql(
        f"""SELECT marais, annee, {s6('count(*) FILTER (WHERE y) * 0.01')} AS ha_annee, {s6('count(*) FILTER (WHERE f) * 0.01')} AS ha_fixe,
              {s6('count(*) FILTER (WHERE f AND y) / greatest(count(*) FILTER (WHERE f OR y), 1)')} AS jaccard,
              {s6('count(*) FILTER (WHERE y AND NOT f) * 0.01')} AS ha_annee_hors_fixe, {s6('count(*) FILTER (WHERE f AND NOT y) * 0.01')} AS ha_fixe_hors_annee
            FROM (SELECT f.marais, g.annee, f.part > 0.5 AS f, coalesce(p.d / p.n > 0.5, false) AS y
                  FROM fixed f JOIN (SELECT DISTINCT marais, annee FROM part_dark) g USING (marais)
                  LEFT JOIN part_dark p ON p.marais = f.marais AND p.ix = f.ix AND p.iy = f.iy AND p.annee = g.annee) GROUP BY 1, 2""",
        PIXELS, _MASK,
    ),
)
def _(t: Tables):
    _, agreement = ra.permanent_mask(pixels(t), F.col("db") < -12, [0.5], 0.01)
    return rounded(agreement, "ha_annee", "ha_fixe", "jaccard", "ha_annee_hors_fixe", "ha_fixe_hors_annee")


_TIDE = """tide AS (SELECT l_shipdate::DATE AS date, sum(l_linenumber)::DOUBLE AS h FROM lineitem GROUP BY 1 HAVING count(*) > 20),
  r AS (SELECT (l_partkey % 64)::INT AS ix, (l_partkey // 64)::INT AS iy, count(*) AS n, CASE WHEN count(*) >= 20 THEN corr(l_quantity, h) END AS r
    FROM lineitem JOIN tide ON l_shipdate::DATE = date GROUP BY 1, 2)"""


def correlations(t: Tables) -> DataFrame:
    tide = t.lineitem.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.sum("l_linenumber").cast("double").alias("h"), F.count("*").alias("_n")
    ).where("_n > 20")
    px = t.lineitem.select(*cells("l_partkey"), F.to_date("l_shipdate").alias("date"), F.col("l_quantity").alias("q"))
    return ra.pixel_correlation(px, tide, ["ix", "iy"], "date", "q", "h")


@query("pixel_correlation", with_sql(f"SELECT ix, iy, n, coalesce({s6('r')}, -9) AS r FROM r", _TIDE))
def _(t: Tables):
    return correlations(t).withColumn("r", F.coalesce(r6("r"), F.lit(-9.0)))


@query(
    "correlated_share",
    with_sql(f"SELECT count(r) AS n_px, {s6('avg((r < -0.2::DOUBLE)::INT)')} AS part FROM r WHERE r IS NOT NULL", _TIDE),
)
def _(t: Tables):
    return rounded(ra.correlated_share(correlations(t), -0.2), "part")


LIMITS = [0, 5, 10, 20, 40, 80]


def _distances(t: Tables) -> DataFrame:
    return codes(t).select(
        ((F.col("p_partkey") * 7919) % 100).cast("double").alias("d"), (F.col("p_size") < 15).alias("s")
    )


@query(
    "distance_bands",
    f"""SELECT len(list_filter({LIMITS}, lambda x: d > x)) ::INT AS bande, {s6('count(*) * 0.09')} AS ha, {s6('count(*) FILTER (WHERE s) * 0.09')} AS ha_signale,
          {s6('avg(s::INT)')} AS part FROM (SELECT p_partkey * 7919 % 100 AS d, p_size < 15 AS s FROM part) GROUP BY 1""",
)
def _(t: Tables):
    return rounded(ra.distance_bands(_distances(t), "d", "s", LIMITS, 0.09), "ha", "ha_signale", "part")


@query(
    "margin_areas",
    f"""SELECT marge, {s6('count(*) FILTER (WHERE d <= marge) * 0.09')} AS ha_retire, {s6('count(*) FILTER (WHERE d > marge AND s) * 0.09')} AS ha_signale_reste,
          {s6('count(*) FILTER (WHERE d > marge AND s) / count(*) FILTER (WHERE d > marge)')} AS part_reste
        FROM (SELECT p_partkey * 7919 % 100 AS d, p_size < 15 AS s FROM part), (SELECT unnest({LIMITS})::DOUBLE AS marge) GROUP BY 1""",
)
def _(t: Tables):
    return rounded(ra.margin_areas(_distances(t), "d", "s", LIMITS, 0.09), "ha_retire", "ha_signale_reste", "part_reste")


@query(
    "detection_scores",
    with_sql(
        " UNION ALL ".join(
            f"""SELECT marais, '{name}' AS variante, count(*) FILTER (WHERE c AND eau) AS tp, count(*) FILTER (WHERE c AND NOT eau) AS fp,
                  count(*) FILTER (WHERE NOT c AND eau) AS fn, {s6('count(*) FILTER (WHERE c AND eau) / greatest(count(*) FILTER (WHERE c), 1)')} AS precision,
                  {s6('count(*) FILTER (WHERE c AND eau) / greatest(count(*) FILTER (WHERE eau), 1)')} AS rappel
                FROM (SELECT marais, date, {cond} AS c, ix % 3 = 0 AS eau FROM pixels WHERE db IS NOT NULL) GROUP BY marais"""
            for name, cond in (("absolu", "db < -16"), ("souple", "db < -8"), ("nul", "db < -99"))
        ),
        PIXELS,
    ),
)
def _(t: Tables):
    rows = pixels(t).where("db IS NOT NULL").withColumn("eau", F.col("ix") % 3 == 0)
    variants = {"absolu": F.col("db") < -16, "souple": F.col("db") < -8, "nul": F.col("db") < -99}
    return rounded(ra.detection_scores(rows, variants, "eau", ["marais"]), "precision", "rappel")


@query(
    "common_coverage",
    with_sql(
        f"""SELECT orbite, {sday('date')} AS date, absolu, {s6('count(*) * 0.01')} AS couvert_ha, {s6('count(*) FILTER (WHERE commun) * 0.01')} AS commun_ha,
              {s6('count(*) FILTER (WHERE h AND db < absolu) * 0.01')} AS crue_ha, {s6('count(*) FILTER (WHERE h AND db < absolu AND commun) * 0.01')} AS crue_commun_ha
            FROM (SELECT o.*, r.ref, n = 3 AS commun, o.db - r.ref < -3 AND r.ref >= -16 AS h FROM orbits o JOIN oref r USING (orbite, ix, iy)
                  JOIN (SELECT ix, iy, count(*) AS n FROM oref GROUP BY 1, 2) USING (ix, iy)),
              (SELECT unnest([-14, -16, -18])::DOUBLE AS absolu) GROUP BY 1, 2, 3""",
        """orbits AS (SELECT (l_linenumber % 3)::INT AS orbite, make_date(year(l_shipdate), quarter(l_shipdate) * 3, 1) AS date, (l_partkey % 64)::INT AS ix,
             (l_partkey // 64)::INT AS iy, min(-l_quantity / 2) AS db FROM lineitem GROUP BY 1, 2, 3, 4)""",
        "oref AS (SELECT orbite, ix, iy, median(db) AS ref FROM orbits WHERE month(date) = 9 GROUP BY 1, 2, 3)",
    ),
)
def _(t: Tables):
    day = F.make_date(F.year("l_shipdate"), F.quarter("l_shipdate") * 3, F.lit(1))
    orbits = t.lineitem.groupBy(
        (F.col("l_linenumber") % 3).alias("orbite"), day.alias("date"), *cells("l_partkey")
    ).agg(F.min(-F.col("l_quantity") / 2).alias("db"))
    refs = orbits.where("month(date) = 9").groupBy("orbite", "ix", "iy").agg(F.median("db").alias("ref"))
    rows = ra.common_coverage(orbits, refs, 3, [-14, -16, -18], 0.01)
    return rounded(rows, "couvert_ha", "commun_ha", "crue_ha", "crue_commun_ha").withColumn("date", text_day("date"))


# --- K16, K17, K20 ------------------------------------------------------------------------------

_NETWORK = """seg AS (SELECT o_orderkey, 'c' || o_custkey::VARCHAR AS a, 'd' || strftime(o_orderdate, '%Y%m%d') AS b, o_custkey % 50 = 0 AS start,
    o_orderkey % 1000 AS len, v AS variant FROM orders, (SELECT unnest(['A', 'B']) AS v)
    WHERE (v = 'A' AND o_totalprice > 400000) OR (v = 'B' AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')),
  hit AS (SELECT variant, a AS node FROM seg WHERE start UNION
    SELECT s.variant, unnest([s.a, s.b]) FROM hit h JOIN seg s ON s.variant = h.variant AND (s.a = h.node OR s.b = h.node))"""


@query(
    "network_reach",
    with_sql(
        """SELECT variant, count(*) AS n_segments, sum(len)::BIGINT AS total_length FROM seg s
           WHERE EXISTS (SELECT 1 FROM hit h WHERE h.variant = s.variant AND h.node = s.a) GROUP BY 1""",
        _NETWORK,
    ).replace("WITH", "WITH RECURSIVE", 1),
)
def _(t: Tables):
    segments = t.orders.select(
        "o_orderkey", F.concat(F.lit("c"), "o_custkey").alias("a"),
        F.concat(F.lit("d"), F.date_format("o_orderdate", "yyyyMMdd")).alias("b"),
        (F.col("o_custkey") % 50 == 0).alias("start"), (F.col("o_orderkey") % 1000).alias("len"),
        (F.col("o_totalprice") > 400000).alias("dear"),
        ((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")).alias("urgent"),
    )
    return network_reach(segments, "o_orderkey", "a", "b", "start", {"A": "dear", "B": "urgent"}, "len")


@query(
    "baseline_pair_gap",
    with_sql(
        f"""SELECT a.marais, {s6('median(b.v - a.v)')} AS v, {s6('median(b.w - a.w)')} AS w FROM o a JOIN n b USING (marais, ix, iy) GROUP BY 1""",
        PIXELS,
        """o AS (SELECT marais, ix, iy, median(db) AS v, max(db) AS w FROM pixels WHERE date < DATE '1998-01-01' GROUP BY 1, 2, 3)""",
        """n AS (SELECT marais, ix, iy, median(db) AS v, max(db) AS w FROM pixels WHERE date >= DATE '1998-01-01' GROUP BY 1, 2, 3)""",
    ),
)
def _(t: Tables):
    old, new = (
        pixels(t).where(c).groupBy("marais", "ix", "iy").agg(F.median("db").alias("v"), F.max("db").alias("w"))
        for c in ("date < '1998-01-01'", "date >= '1998-01-01'")
    )
    return rounded(ra.baseline_pair_gap(old, new, ["marais"], ["v", "w"]), "v", "w")


@query(
    "separation_profile",
    with_sql(
        f"""SELECT annee, label, count(db) AS n, {s6('quantile_cont(db, 0.05)')} AS p05, {s6('quantile_cont(db, 0.5)')} AS p50, {s6('quantile_cont(db, 0.95)')} AS p95,
              {s6('avg((db < -14)::INT)')} AS part_lt_14, {s6('avg((db < -20)::INT)')} AS part_lt_20
            FROM (SELECT year(date)::INT AS annee, ix % 4 = 0 AS label, db FROM pixels) WHERE db IS NOT NULL GROUP BY 1, 2""",
        PIXELS,
    ),
)
def _(t: Tables):
    rows = pixels(t).select(F.year("date").alias("annee"), (F.col("ix") % 4 == 0).alias("label"), "db")
    table = ra.separation_profile(rows, ["annee"], "label", "db", {"p05": 0.05, "p50": 0.5, "p95": 0.95}, [-14, -20])
    return rounded(table, "p05", "p50", "p95", "part_lt_14", "part_lt_20")


# --- K18, K19 -----------------------------------------------------------------------------------

@query(
    "despike_fill",
    f"""WITH e AS (SELECT event_type AS k, ts, value AS v, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS i,
            median(value) OVER w AS m, count(value) OVER w AS n FROM events
            WINDOW w AS (PARTITION BY event_type ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
        c AS (SELECT k, ts, i, CASE WHEN n >= 3 AND abs(v - m) < 8 THEN v END AS v FROM e),
        f AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN (i, v) END IGNORE NULLS) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS p,
            first_value(CASE WHEN v IS NOT NULL THEN (i, v) END IGNORE NULLS) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS q FROM c)
        SELECT k, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, {s6('x')} AS value FROM (
          SELECT k, ts, coalesce(v, CASE WHEN p IS NOT NULL THEN coalesce(p[2] + (q[2] - p[2]) * (i - p[1]) / (q[1] - p[1]), p[2]) END) AS x FROM f) WHERE x IS NOT NULL""",
)
def _(t: Tables):
    rows = t.events.select(F.col("event_type").alias("k"), "ts", "value")
    done = se.despike_fill(rows, ["k"], "ts", "value", tolerance=8, block=500)
    return done.select("k", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), r6("value").alias("value"))


@query(
    "interpolate_at",
    f"""WITH s AS (SELECT user_id % 10 AS k, ts, value FROM events WHERE event_type IN ('purchase', 'click')),
        a AS (SELECT event_id, user_id % 10 AS k, ts FROM events WHERE event_type NOT IN ('purchase', 'click')),
        b AS (SELECT a.event_id, max(s.ts) AS t0, arg_max(s.value, s.ts) AS v0 FROM a JOIN s ON s.k = a.k AND s.ts < a.ts GROUP BY 1),
        c AS (SELECT a.event_id, min(s.ts) AS t1, arg_min(s.value, s.ts) AS v1 FROM a JOIN s ON s.k = a.k AND s.ts >= a.ts GROUP BY 1)
        SELECT event_id, coalesce({s6('CASE WHEN epoch_us(t1) - epoch_us(t0) <= 7200000000 THEN v0 + (v1 - v0) * ((epoch_us(ts) - epoch_us(t0)) / (epoch_us(t1) - epoch_us(t0))::DOUBLE) END')}, -1) AS value
        FROM a LEFT JOIN b USING (event_id) LEFT JOIN c USING (event_id)""",
)
def _(t: Tables):
    rows = t.events.withColumn("k", F.col("user_id") % 10)
    in_series = F.col("event_type").isin("purchase", "click")
    series = rows.where(in_series).select("k", F.col("ts").alias("t"), "value")
    done = se.interpolate_at(rows.where(~in_series).select("event_id", "k", "ts"), series, ["k"], "ts", "t", "value", 7200)
    return done.select("event_id", F.coalesce(r6("value"), F.lit(-1.0)).alias("value"))
