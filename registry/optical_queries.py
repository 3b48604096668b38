"""I: optical pixels. A part is a pixel, a line item an observation of it, an order a scene."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.core import Tables, query, r6, s6, sday, text_day, with_sql
from sluice.operators import optical as op
from sluice.operators import quality

VALID = [2, 3, 4, 5, 6]

SCENES = """scenes AS (
  SELECT 'S' || lpad(o_orderkey::VARCHAR, 12, '0') AS id, 'T' || (o_custkey % 5)::VARCHAR AS tuile,
    o_orderdate::DATE AS jour, 'S2' || o_orderstatus AS plateforme, CASE left(o_orderpriority, 1) WHEN '1' THEN '02.14'
      WHEN '2' THEN '04.00' WHEN '3' THEN '05.09' WHEN '5' THEN 'abc' END AS baseline,
    (o_orderkey % 1000) / 10 AS nuages_pct, strftime(o_orderdate, '%Y-%m') AS mois FROM orders),
ranked AS (SELECT *, CASE WHEN num >= 4 THEN -1000 ELSE 0 END::DOUBLE AS "offset",
    baseline IS NOT NULL AND row_number() OVER (PARTITION BY tuile, jour, baseline IS NULL
      ORDER BY num DESC, id DESC) = 1 AS kept
  FROM (SELECT *, coalesce(TRY_CAST(baseline AS DOUBLE), -1) AS num FROM scenes))"""


def scenes(t: Tables) -> DataFrame:
    p = F.substring("o_orderpriority", 1, 1)
    return t.orders.select(
        F.concat(F.lit("S"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("id"),
        F.concat(F.lit("T"), F.col("o_custkey") % 5).alias("tuile"),
        F.to_date("o_orderdate").alias("jour"),
        F.concat(F.lit("S2"), "o_orderstatus").alias("plateforme"),
        F.when(p == "1", "02.14").when(p == "2", "04.00").when(p == "3", "05.09")
        .when(p == "4", "").otherwise("abc").alias("baseline"),
        (F.col("o_orderkey") % 1000 / 10).alias("nuages_pct"),
        F.date_format("o_orderdate", "yyyy-MM").alias("mois"),
    )


PIX = """pix AS (
  SELECT *, CASE WHEN ok THEN (r08 - r04) / (r08 + r04) END AS ndvi, CASE WHEN ok THEN (r08 - r11) / (r08 + r11) END AS ndmi
  FROM (SELECT *, scl BETWEEN 2 AND 6 AND b04 > 0 AND b08 > 0 AND b11 > 0 AND r08 + r04 > 0 AND r08 + r11 > 0 AS ok
    FROM (SELECT *, greatest(0, (b04 + "offset") / 10000::DOUBLE) AS r04, greatest(0, (b08 + "offset") / 10000::DOUBLE) AS r08,
            greatest(0, (b11 + "offset") / 10000::DOUBLE) AS r11
          FROM (SELECT (l_partkey % 64)::INT AS ix, (l_partkey // 64)::INT AS iy, l_shipdate::DATE AS jour,
                  year(l_shipdate)::INT AS annee, month(l_shipdate)::INT AS mois, (l_quantity * 40)::INT AS b04,
                  (floor(l_extendedprice)::BIGINT % 5000)::INT AS b08, (l_orderkey * 37 % 4000)::INT AS b11,
                  l_linenumber AS scl, CASE WHEN l_returnflag = 'R' THEN -1000 ELSE 0 END::DOUBLE AS "offset"
                FROM lineitem)))),
cls AS (SELECT (p_partkey % 64)::INT AS ix, (p_partkey // 64)::INT AS iy, 'C' || (p_size % 3)::VARCHAR AS classe FROM part)"""


def cells(key: str) -> list:
    return [
        (F.col(key) % 64).cast("int").alias("ix"), F.floor(F.col(key) / 64).cast("int").alias("iy")
    ]


def observations(t: Tables) -> DataFrame:
    return t.lineitem.select(
        *cells("l_partkey"), F.to_date("l_shipdate").alias("jour"),
        F.year("l_shipdate").alias("annee"), F.month("l_shipdate").alias("mois"),
        (F.col("l_quantity") * 40).cast("int").alias("b04"),
        (F.floor("l_extendedprice") % 5000).cast("int").alias("b08"),
        (F.col("l_orderkey") * 37 % 4000).cast("int").alias("b11"),
        F.col("l_linenumber").alias("scl"),
        F.when(F.col("l_returnflag") == "R", -1000.0).otherwise(0.0).alias("offset"),
    )


def pixels(t: Tables) -> DataFrame:
    return op.pixel_indices(observations(t), VALID)


def classes(t: Tables) -> DataFrame:
    return t.part.select(*cells("p_partkey"), F.concat(F.lit("C"), F.col("p_size") % 3).alias("classe"))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, r6(c, digits))
    return df


# --- I1, I2, cover ------------------------------------------------------------------------------

@query(
    "select_scenes",
    with_sql(
        f"""SELECT id, tuile, {sday('jour')} AS jour, plateforme, baseline, "offset", n - 1 AS doublons
            FROM ranked JOIN (SELECT tuile, jour, count(*) AS n FROM scenes WHERE baseline IS NOT NULL
              GROUP BY 1, 2) USING (tuile, jour) WHERE kept""",
        SCENES,
    ),
)
def _(t: Tables):
    return op.select_scenes(scenes(t)).select(
        "id", "tuile", text_day("jour").alias("jour"), "plateforme", "baseline", "offset", "doublons"
    )


@query(
    "planes",
    with_sql(
        f"""SELECT {sday('jour')} || '|' || "offset"::BIGINT AS cle, "offset", count(*) AS n_scenes,
              string_agg(DISTINCT plateforme, ',' ORDER BY plateforme) AS plateformes,
              string_agg(DISTINCT baseline, ',' ORDER BY baseline) AS baselines,
              string_agg(DISTINCT tuile, ',' ORDER BY tuile) AS tuiles, {s6('avg(nuages_pct)', 4)} AS nuages_pct
            FROM ranked WHERE kept GROUP BY jour, "offset" """,
        SCENES,
    ),
)
def _(t: Tables):
    return rounded(op.planes(op.select_scenes(scenes(t))), "nuages_pct", digits=4).drop("jour")


@query(
    "cover_report",
    with_sql(
        f"""SELECT r.*, pct_jamais_valide, observations_moyennes FROM (
              SELECT mois, count(*) AS scenes_trouvees, count(*) FILTER (WHERE baseline IS NULL) AS scenes_baseline_inconnue,
                count(*) FILTER (WHERE baseline IS NOT NULL AND NOT kept) AS scenes_doublons_ecartes,
                count(*) FILTER (WHERE kept) AS scenes_retenues, count(DISTINCT CASE WHEN kept THEN (jour, "offset") END) AS plans
              FROM ranked GROUP BY 1) r LEFT JOIN (
              SELECT mois, {s6('100 * avg((n = 0)::INT)', 3)} AS pct_jamais_valide,
                {s6('sum(n) / count(*) FILTER (WHERE n > 0)', 2)} AS observations_moyennes
              FROM (SELECT ix, iy, strftime(jour, '%Y-%m') AS mois, count(ndvi) AS n FROM pix GROUP BY 1, 2, 3) GROUP BY 1)
            USING (mois)""",
        SCENES, PIX,
    ),
)
def _(t: Tables):
    per_pixel = pixels(t).groupBy("ix", "iy", F.date_format("jour", "yyyy-MM").alias("mois")).agg(
        F.count("ndvi").alias("n_obs")
    )
    rows = quality.cover_report(op.rank_scenes(scenes(t)), per_pixel)
    return rounded(rows, "pct_jamais_valide", digits=3)


@query(
    "scene_availability",
    with_sql(
        """SELECT coalesce(tuile, 'all') AS tuile, coalesce(annee::VARCHAR, 'all') AS annee,
              coalesce(plateforme, 'all') AS plateforme, count(*) AS n, count(baseline) AS n_baseline_connue
            FROM (SELECT *, year(jour) AS annee FROM scenes) GROUP BY CUBE (tuile, annee, plateforme)""",
        SCENES,
    ),
)
def _(t: Tables):
    rows = scenes(t).withColumn("annee", F.year("jour").cast("string"))
    return op.scene_availability(rows, ["tuile", "annee", "plateforme"]).fillna("all")


# --- I3 to I7 -----------------------------------------------------------------------------------

@query(
    "pixel_indices",
    with_sql(
        f"""SELECT ix, iy, {sday('jour')} AS jour, b04, b08, b11, scl, coalesce({s6('ndvi')}, -9) AS ndvi,
                   coalesce({s6('ndmi')}, -9) AS ndmi FROM pix""",
        PIX,
    ),
)
def _(t: Tables):
    rows = rounded(pixels(t), "ndvi", "ndmi").fillna({"ndvi": -9.0, "ndmi": -9.0})
    return rows.select("ix", "iy", text_day("jour").alias("jour"), "b04", "b08", "b11", "scl", "ndvi", "ndmi")


@query(
    "monthly_median",
    with_sql(
        f"""SELECT ix, iy, annee, coalesce({s6('median(ndvi)')}, -9) AS ndvi, coalesce({s6('median(ndmi)')}, -9) AS ndmi,
                   count(ndvi) AS n_obs FROM pix GROUP BY 1, 2, 3""",
        PIX,
    ),
)
def _(t: Tables):
    rows = op.monthly_median(pixels(t), ["ix", "iy", "annee"])
    return rounded(rows, "ndvi", "ndmi").fillna({"ndvi": -9.0, "ndmi": -9.0})


@query(
    "quantise",
    with_sql(
        """SELECT coalesce(round_even(ndvi * 10000, 0)::INT, -32768) AS q, count(*) AS n FROM pix GROUP BY 1""", PIX
    ),
)
def _(t: Tables):
    return pixels(t).groupBy(op.quantise(F.col("ndvi")).cast("int").alias("q")).agg(F.count("*").alias("n"))


_BROKEN = """broken AS (SELECT * REPLACE (CASE WHEN b04 % 3 = 0 THEN 0 ELSE b04 END AS b04, CASE WHEN b11 % 40 > 2 THEN 0 ELSE b08 END AS b08,
    CASE WHEN b11 % 40 > 2 THEN 0 ELSE b11 END AS b11, CASE WHEN scl = 7 THEN 0 ELSE scl END AS scl) FROM pix)"""


@query(
    "integrity_check",
    with_sql(
        f"""SELECT annee, mois, bloc, d AS desaccord, u AS "union", {s6('100 * d / u')} AS pct, 100 * d / u > 2 AS corrompu
            FROM (SELECT annee, mois, (ix // 32)::INT AS bloc, count(*) FILTER (WHERE (scl > 0) <> (b04 > 0 OR b08 > 0 OR b11 > 0)) AS d,
                    count(*) FILTER (WHERE scl > 0 OR b04 > 0 OR b08 > 0 OR b11 > 0) AS u FROM broken GROUP BY 1, 2, 3) WHERE u > 0""",
        PIX, _BROKEN,
    ),
)
def _(t: Tables):
    cut = F.col("b11") % 40 > 2
    broken = observations(t).select(
        "annee", "mois", F.floor(F.col("ix") / 32).cast("int").alias("bloc"),
        F.when(F.col("b04") % 3 == 0, 0).otherwise(F.col("b04")).alias("b04"),
        F.when(cut, 0).otherwise(F.col("b08")).alias("b08"),
        F.when(cut, 0).otherwise(F.col("b11")).alias("b11"),
        F.when(F.col("scl") == 7, 0).otherwise(F.col("scl")).alias("scl"),
    )
    return rounded(op.integrity_check(broken, ["annee", "mois", "bloc"]), "pct")


@query(
    "stable_class_medians",
    with_sql(
        f"""SELECT annee, "offset", classe, count(*) AS n_px, {s6('median(ndvi)')} AS ndvi, {s6('median(ndmi)')} AS ndmi
            FROM pix JOIN cls USING (ix, iy) WHERE ndvi IS NOT NULL AND ndmi IS NOT NULL GROUP BY 1, 2, 3""",
        PIX,
    ),
)
def _(t: Tables):
    rows = op.stable_class_medians(pixels(t), classes(t), ["annee", "offset"])
    return rounded(rows, "ndvi", "ndmi")


# --- I8 to I10 ----------------------------------------------------------------------------------

DRIFT = """drift AS (SELECT strftime(jour, '%Y-%m-%d') || '|' || "offset"::BIGINT AS cle, jour AS date, strftime(jour, '%Y-%m') AS mois,
    CASE day(jour) % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'A,B' END AS plateformes, "offset", classe, count(*) AS n_px,
    median(ndvi) AS ndvi, median(ndmi) AS ndmi
  FROM pix JOIN cls USING (ix, iy) WHERE ndvi IS NOT NULL GROUP BY jour, "offset", classe),
seen AS (SELECT * FROM drift QUALIFY n_px / max(n_px) OVER (PARTITION BY classe, mois) >= 0.5),
residuals AS (SELECT a.classe, a.cle, any_value(a.date) AS date, any_value(year(a.date))::INT AS annee, any_value(a.plateformes) AS plateformes,
    any_value(a."offset") AS "offset", any_value(a.ndvi) - median(b.ndvi) AS residu_ndvi, any_value(a.ndmi) - median(b.ndmi) AS residu_ndmi
  FROM seen a JOIN seen b ON a.classe = b.classe AND abs(a.date - b.date) <= 7 AND a.cle <> b.cle
  GROUP BY a.classe, a.cle HAVING count(*) >= 2),
groups AS (SELECT classe, periode, critere, groupe, count(*) AS n_plans, median(residu_ndvi) AS residu_ndvi, median(residu_ndmi) AS residu_ndmi
  FROM (SELECT classe, annee::VARCHAR AS periode, 'plateforme' AS critere, plateformes AS groupe, residu_ndvi, residu_ndmi
          FROM residuals WHERE NOT contains(plateformes, ',')
        UNION ALL SELECT classe, (SELECT min(annee) || '-' || max(annee) FROM residuals), 'offset', 'offset ' || "offset"::BIGINT, residu_ndvi, residu_ndmi
          FROM residuals) GROUP BY 1, 2, 3, 4 HAVING count(*) >= 5)"""


def drift_table(t: Tables) -> DataFrame:
    day = F.dayofmonth("jour") % 3
    rows = pixels(t).where("ndvi IS NOT NULL").join(classes(t), ["ix", "iy"])
    return rows.groupBy("jour", "offset", "classe").agg(
        F.count("*").alias("n_px"), F.median("ndvi").alias("ndvi"), F.median("ndmi").alias("ndmi")
    ).select(
        op.plane_key(F.col("jour"), F.col("offset")).alias("cle"), F.col("jour").alias("date"),
        F.date_format("jour", "yyyy-MM").alias("mois"),
        F.when(day == 0, "A").when(day == 1, "B").otherwise("A,B").alias("plateformes"),
        "offset", "classe", "n_px", "ndvi", "ndmi",
    )


@query(
    "drift_residuals",
    with_sql(
        f"""SELECT classe, cle, {sday('date')} AS date, annee, plateformes, "offset", {s6('residu_ndvi')} AS residu_ndvi,
                   {s6('residu_ndmi')} AS residu_ndmi FROM residuals""",
        PIX, DRIFT,
    ),
)
def _(t: Tables):
    rows = rounded(op.drift_residuals(drift_table(t)), "residu_ndvi", "residu_ndmi")
    return rows.withColumn("date", text_day("date"))


@query(
    "drift_groups",
    with_sql(
        f"""SELECT * REPLACE ({s6('residu_ndvi')} AS residu_ndvi, {s6('residu_ndmi')} AS residu_ndmi) FROM groups""",
        PIX, DRIFT,
    ),
)
def _(t: Tables):
    return rounded(op.drift_groups(op.drift_residuals(drift_table(t))), "residu_ndvi", "residu_ndmi")


@query(
    "drift_gaps",
    with_sql(
        f"""SELECT classe, periode, critere, groupes, n_plans, {s6('g')} AS ecart_ndvi, {s6('h')} AS ecart_ndmi,
                   greatest(g, h) > 0.03::DOUBLE AS anormal
            FROM (SELECT classe, periode, critere, string_agg(groupe, ',' ORDER BY groupe) AS groupes, sum(n_plans)::BIGINT AS n_plans,
                    max(residu_ndvi) - min(residu_ndvi) AS g, max(residu_ndmi) - min(residu_ndmi) AS h
                  FROM groups GROUP BY 1, 2, 3 HAVING count(*) >= 2)""",
        PIX, DRIFT,
    ),
)
def _(t: Tables):
    groups = op.drift_groups(op.drift_residuals(drift_table(t)))
    return rounded(op.drift_gaps(groups), "ecart_ndvi", "ecart_ndmi")


# --- I11 to I16 ---------------------------------------------------------------------------------

@query(
    "observation_share",
    with_sql(
        f"""SELECT classe, mois, {s6('avg(s1)')} AS sous_1, {s6('avg(s2)')} AS sous_2, {s6('avg(s3)')} AS sous_3, {s6('avg(m)')} AS mediane
            FROM (SELECT classe, annee, mois, 100 * avg((n < 1)::INT) AS s1, 100 * avg((n < 2)::INT) AS s2, 100 * avg((n < 3)::INT) AS s3, median(n) AS m
                  FROM (SELECT ix, iy, annee, mois, count(ndvi) AS n FROM pix GROUP BY ALL) JOIN cls USING (ix, iy) GROUP BY 1, 2, 3)
            GROUP BY 1, 2""",
        PIX,
    ),
)
def _(t: Tables):
    counts = pixels(t).groupBy("ix", "iy", "annee", "mois").agg(F.count("ndvi").alias("n_obs"))
    rows = op.observation_share(counts.join(classes(t), ["ix", "iy"]), "classe")
    return rounded(rows, "sous_1", "sous_2", "sous_3", "mediane")


TAUS = [-0.5, -0.25, -0.125, 0.0, 0.125, 0.25, 0.5]


@query(
    "threshold_sweep",
    with_sql(
        f"""SELECT tau, {s6('p')} AS persistant_pris_caduc, {s6('c')} AS caduc_pris_persistant, {s6('m')} AS mixte_vu_caduc,
                   {s6('(p + c) / 2')} AS erreur_moyenne, row_number() OVER (ORDER BY (p + c) / 2, tau) = 1 AS meilleur
            FROM (SELECT tau, 100 * avg((ndvi >= tau)::INT) FILTER (WHERE classe = 'C0') AS p,
                    100 * avg((ndvi < tau)::INT) FILTER (WHERE classe = 'C1') AS c, 100 * avg((ndvi >= tau)::INT) FILTER (WHERE classe = 'C2') AS m
                  FROM pix JOIN cls USING (ix, iy), (SELECT unnest({TAUS})::DOUBLE AS tau) WHERE ndvi IS NOT NULL GROUP BY 1)""",
        PIX,
    ),
)
def _(t: Tables):
    role = F.when(F.col("classe") == "C0", "persistant").when(F.col("classe") == "C1", "caduc").otherwise("mixte")
    rows = pixels(t).join(classes(t), ["ix", "iy"]).withColumn("role", role)
    table = op.threshold_sweep(rows, "ndvi", "role", TAUS)
    return rounded(table, "persistant_pris_caduc", "caduc_pris_persistant", "mixte_vu_caduc", "erreur_moyenne")


SEASON_SQL = "CASE WHEN mois BETWEEN 5 AND 9 THEN 'ete' ELSE 'hiver' END"


def seasons(t: Tables) -> DataFrame:
    season = F.when(F.col("mois").between(5, 9), "ete").otherwise("hiver")
    return pixels(t).join(classes(t), ["ix", "iy"]).withColumn("saison", season)


@query(
    "seasonal_contrast",
    with_sql(
        f"""SELECT classe, count(ecart) AS n, {s6('quantile_cont(ecart, 0.05)')} AS p05, {s6('quantile_cont(ecart, 0.5)')} AS p50,
                   {s6('quantile_cont(ecart, 0.95)')} AS p95
            FROM (SELECT ix, iy, classe, median(g) AS ecart FROM (
                    SELECT ix, iy, classe, annee, avg(ndvi) FILTER (WHERE {SEASON_SQL} = 'ete') - avg(ndvi) FILTER (WHERE {SEASON_SQL} = 'hiver') AS g
                    FROM pix JOIN cls USING (ix, iy) GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3) GROUP BY 1""",
        PIX,
    ),
)
def _(t: Tables):
    rows = op.seasonal_contrast(seasons(t), {"p05": 0.05, "p50": 0.5, "p95": 0.95})
    return rounded(rows, "p05", "p50", "p95")


@query(
    "robust_sigma",
    with_sql(
        f"""SELECT classe, count(*) AS n, {s6('any_value(m)')} AS mediane, {s6('1.4826 * median(abs(ndvi - m))')} AS sigma
            FROM pix JOIN cls USING (ix, iy) JOIN (SELECT classe, median(ndvi) AS m FROM pix JOIN cls USING (ix, iy) GROUP BY 1) USING (classe)
            WHERE ndvi IS NOT NULL GROUP BY 1""",
        PIX,
    ),
)
def _(t: Tables):
    rows = pixels(t).join(classes(t), ["ix", "iy"]).where("ndvi IS NOT NULL")
    return rounded(op.robust_sigma(rows, "classe", "ndvi"), "mediane", "sigma")


@query(
    "mean_median_gap",
    with_sql(
        f"""SELECT count(*) AS n_px, {s6('avg((g > 0.02::DOUBLE)::INT)')} AS part_0_02, {s6('avg((g > 0.05::DOUBLE)::INT)')} AS part_0_05,
                   {s6('avg((g > 0.1::DOUBLE)::INT)')} AS part_0_1
            FROM (SELECT ix, iy, abs(avg(ndvi) - median(ndvi)) AS g FROM pix WHERE ndvi IS NOT NULL GROUP BY 1, 2)""",
        PIX,
    ),
)
def _(t: Tables):
    return rounded(op.mean_median_gap(pixels(t), ["ix", "iy"], "ndvi"), "part_0_02", "part_0_05", "part_0_1")


PROFILE = f"""profile AS (SELECT c.classe, 'L' || (ix // 32)::INT AS lieu, median(ndvi) FILTER (WHERE {SEASON_SQL} = 'ete') AS ete,
    median(ndvi) FILTER (WHERE {SEASON_SQL} = 'hiver') AS hiver, any_value(p.p_size > 25) AS rpg
  FROM pix JOIN cls c USING (ix, iy) JOIN part p ON p.p_partkey = ix + 64 * iy GROUP BY 1, 2, ix, iy
  HAVING median(ndvi) FILTER (WHERE {SEASON_SQL} = 'ete') IS NOT NULL AND median(ndvi) FILTER (WHERE {SEASON_SQL} = 'hiver') IS NOT NULL)"""


def profile(t: Tables) -> DataFrame:
    med = {s: F.median(F.when(F.col("saison") == s, F.col("ndvi"))) for s in ("ete", "hiver")}
    flags = t.part.select(*cells("p_partkey"), (F.col("p_size") > 25).alias("rpg"))
    return (
        seasons(t).groupBy("classe", F.concat(F.lit("L"), F.floor(F.col("ix") / 32)).alias("lieu"), "ix", "iy")
        .agg(med["ete"].alias("ete"), med["hiver"].alias("hiver"))
        .where("ete IS NOT NULL AND hiver IS NOT NULL").join(flags, ["ix", "iy"])
    )


@query(
    "class_profile",
    with_sql(
        f"""SELECT classe, coalesce(lieu, 'all') AS lieu, {s6('count(*) * 0.01')} AS ha, {s6('median(ete)')} AS ete, {s6('median(hiver)')} AS hiver,
                   {s6('median(ete - hiver)')} AS ecart, {s6('100 * avg((ete < 0.4::DOUBLE)::INT)')} AS part_sous_0_4, {s6('100 * avg(rpg::INT)')} AS part_rpg
            FROM profile GROUP BY GROUPING SETS ((classe, lieu), (classe))""",
        PIX, PROFILE,
    ),
)
def _(t: Tables):
    rows = op.class_profile(profile(t), 0.01, ["rpg"])
    return rounded(rows, "ha", "ete", "hiver", "ecart", "part_sous_0_4", "part_rpg")
