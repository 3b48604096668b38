"""J: land-cover cells. A part is a cell, its brand the code of the source map."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.core import Tables, query, r6, s6, with_sql
from registry.optical_queries import PIX, cells, pixels, rounded
from sluice.operators import grid
from sluice.operators import landcover as lc

CODES = """codes AS (SELECT (p_partkey % 64)::INT AS ix, (p_partkey // 64)::INT AS iy, p_brand AS code, p_size, p_partkey,
    p_retailprice, p_type FROM part),
nomenclature AS (SELECT DISTINCT p_brand AS code, CASE WHEN substr(p_brand, 7)::INT % 4 <> 0 THEN substr(p_brand, 7)::INT % 7 + 1 END AS classe
  FROM part WHERE substr(p_brand, 7)::INT % 5 <> 0),
base AS (SELECT ix, iy, coalesce(classe, 0) AS classe, p_size FROM codes LEFT JOIN nomenclature USING (code)),
mask AS (SELECT DISTINCT (l_partkey % 64)::INT AS ix, (l_partkey // 64)::INT AS iy FROM lineitem WHERE l_quantity = 50)"""


def codes(t: Tables) -> DataFrame:
    return t.part.select(
        *cells("p_partkey"), F.col("p_brand").alias("code"), "p_size", "p_partkey", "p_type"
    )


def nomenclature(t: Tables) -> DataFrame:
    n = F.substring("p_brand", 7, 3).cast("int")
    return t.part.where(n % 5 != 0).select(
        F.col("p_brand").alias("code"), F.when(n % 4 != 0, n % 7 + 1).alias("classe")
    ).distinct()


def base(t: Tables) -> DataFrame:
    return codes(t).join(nomenclature(t), "code", "left").select(
        "ix", "iy", F.coalesce("classe", F.lit(0)).alias("classe"), "p_size"
    )


def mask(t: Tables) -> DataFrame:
    return t.lineitem.where("l_quantity = 50").select(*cells("l_partkey")).distinct()


@query(
    "map_codes",
    with_sql(
        "SELECT ix, iy, code, coalesce(classe, -1)::INT AS classe FROM codes JOIN nomenclature USING (code)", CODES
    ),
)
def _(t: Tables):
    classed, _ = lc.map_codes(codes(t), nomenclature(t))
    return classed.select("ix", "iy", "code", F.coalesce("classe", F.lit(-1)).alias("classe"))


@query(
    "unknown_codes",
    with_sql(
        "SELECT code, count(*) AS n FROM codes ANTI JOIN nomenclature USING (code) GROUP BY 1", CODES
    ),
)
def _(t: Tables):
    return lc.map_codes(codes(t), nomenclature(t))[1]


@query(
    "complete_mask",
    with_sql(
        """SELECT ix, iy, bool_and(s) AS ajoute FROM (SELECT ix, iy, false AS s FROM mask UNION ALL
             SELECT ix, iy, true FROM codes WHERE code IN ('Brand#3', 'Brand#8')) GROUP BY 1, 2""",
        CODES,
    ),
)
def _(t: Tables):
    return lc.complete_mask(mask(t), codes(t), ["Brand#3", "Brand#8"])


@query(
    "drop_unconfirmed",
    with_sql(
        """SELECT b.ix, b.iy, CASE WHEN gone THEN 0 ELSE classe END AS classe, gone AS retire FROM (
             SELECT b.*, b.classe IN (1, 2, 3) AND m.ix IS NULL AS gone FROM base b LEFT JOIN mask m USING (ix, iy)) b""",
        CODES,
    ),
)
def _(t: Tables):
    return lc.drop_unconfirmed(base(t), mask(t), [1, 2, 3]).drop("p_size")


_PARCELS = """eroded AS (SELECT (l_partkey % 64)::INT AS ix, (l_partkey // 64)::INT AS iy, arg_max(20 + l_linenumber, (l_orderkey, l_linenumber)) AS classe
  FROM lineitem WHERE l_quantity = 50 AND l_returnflag = 'A' GROUP BY 1, 2),
overridden AS (SELECT b.ix, b.iy, coalesce(e.classe, CASE WHEN m.ix IS NOT NULL THEN 0 ELSE b.classe END)::INT AS classe,
    m.ix IS NOT NULL AND b.classe <> 0 AS efface FROM base b LEFT JOIN mask m USING (ix, iy) LEFT JOIN eroded e USING (ix, iy))"""


def overridden(t: Tables) -> DataFrame:
    eroded = t.lineitem.where("l_quantity = 50 AND l_returnflag = 'A'").select(
        *cells("l_partkey"), (F.col("l_linenumber") + 20).alias("classe"),
        F.struct("l_orderkey", "l_linenumber").alias("rang"),
    )
    return lc.override_layer(base(t), mask(t), eroded)


@query("override_layer", with_sql("SELECT * FROM overridden", CODES, _PARCELS))
def _(t: Tables):
    return overridden(t)


@query(
    "class_tally",
    with_sql(
        f"""SELECT CASE WHEN iy % 9 <> 0 THEN classe ELSE 255 END AS classe, count(*) AS n_px, {s6('count(*) * 0.01')} AS ha
            FROM overridden GROUP BY 1""",
        CODES, _PARCELS,
    ),
)
def _(t: Tables):
    territory = codes(t).where(F.col("iy") % 9 != 0)
    return rounded(lc.class_tally(overridden(t), territory, 0.01), "ha")


@query(
    "erode_cells",
    with_sql(
        """SELECT a.id, a.ix, a.iy FROM s a JOIN s b ON a.id = b.id AND abs(a.ix - b.ix) <= 1 AND abs(a.iy - b.iy) <= 1
           GROUP BY 1, 2, 3 HAVING count(*) = 9""",
        CODES, "s AS (SELECT (ix // 11)::INT AS id, ix, iy FROM codes WHERE p_size > 2)",
    ),
)
def _(t: Tables):
    shapes = codes(t).where("p_size > 2").select(F.floor(F.col("ix") / 11).cast("int").alias("id"), "ix", "iy")
    return grid.erode_cells(shapes, "id", tile=16)


@query(
    "dilate_cells",
    with_sql(
        """SELECT DISTINCT (ix + dx)::INT AS ix, (iy + dy)::INT AS iy FROM codes, (SELECT unnest(range(-2, 3)) AS dx), (SELECT unnest(range(-2, 3)) AS dy)
           WHERE p_size = 1 AND abs(dx) + abs(dy) <= 2""",
        CODES,
    ),
)
def _(t: Tables):
    return grid.dilate_cells(codes(t).where("p_size = 1"), [], 2, tile=16)


@query(
    "distance_steps",
    with_sql(
        """SELECT (ix + dx)::INT AS ix, (iy + dy)::INT AS iy, min(abs(dx) + abs(dy))::INT AS distance
           FROM codes, (SELECT unnest(range(-7, 8)) AS dx), (SELECT unnest(range(-7, 8)) AS dy)
           WHERE p_size = 1 AND abs(dx) + abs(dy) <= 7 GROUP BY 1, 2""",
        CODES,
    ),
)
def _(t: Tables):
    return grid.distance_transform(codes(t).where("p_size = 1"), [], 7)


@query(
    "layered_exclusion",
    with_sql(
        f"""SELECT any_value(k)::INT AS rank, ['mask', 'small', 'brand', 'remainder'][any_value(k) + 1] AS couche, {s6('count(*) FILTER (WHERE k = first) * 0.01')} AS ha_retire,
              {s6('count(*) * 0.01')} AS ha_seule
            FROM (SELECT unnest(CASE WHEN len(l) = 0 THEN [3] ELSE l END) AS k, CASE WHEN len(l) = 0 THEN 3 ELSE list_min(l) END AS first
                  FROM (SELECT list_filter([CASE WHEN m.ix IS NOT NULL THEN 0 END, CASE WHEN p_size < 10 THEN 1 END, CASE WHEN code = 'Brand#7' THEN 2 END],
                          lambda x: x IS NOT NULL) AS l
                        FROM codes c LEFT JOIN mask m USING (ix, iy) WHERE iy % 5 <> 0)) GROUP BY k""",
        CODES,
    ),
)
def _(t: Tables):
    layers = {"mask": mask(t), "small": codes(t).where("p_size < 10"), "brand": codes(t).where("code = 'Brand#7'")}
    table = lc.layered_exclusion(codes(t).where(F.col("iy") % 5 != 0), layers, 0.01)
    return rounded(table, "ha_retire", "ha_seule")


@query(
    "map_agreement",
    with_sql(
        f"""SELECT source, {s6('count(*) * 0.01')} AS ha, {s6('100 * count(*) FILTER (WHERE coeur) / (SELECT count(*) FROM c WHERE coeur)')} AS rappel,
              {s6('count(*) FILTER (WHERE o) * 0.01')} AS ha_hors, {s6('median(ete) FILTER (WHERE o)')} AS hors_mediane,
              {s6('100 * avg(vert::INT) FILTER (WHERE o)')} AS hors_vert
            FROM (SELECT *, NOT reference AND ete IS NOT NULL AS o FROM maps JOIN c USING (ix, iy)) GROUP BY 1""",
        PIX, CODES,
        """c AS (SELECT ix, iy, p_size < 20 AS reference, p_size < 12 AS coeur, ete, coalesce(ete > 0.1::DOUBLE, false) AS vert
             FROM codes LEFT JOIN (SELECT ix, iy, median(ndvi) AS ete FROM pix GROUP BY 1, 2) USING (ix, iy))""",
        """maps AS (SELECT 'type ' || substr(p_type, 1, 3) AS source, ix, iy FROM codes UNION ALL SELECT 'mask', ix, iy FROM mask)""",
    ),
)
def _(t: Tables):
    summer = pixels(t).groupBy("ix", "iy").agg(F.median("ndvi").alias("ete"))
    table = codes(t).join(summer, ["ix", "iy"], "left").select(
        "ix", "iy", (F.col("p_size") < 20).alias("reference"), (F.col("p_size") < 12).alias("coeur"),
        "ete", F.coalesce(F.col("ete") > 0.1, F.lit(False)).alias("vert"),
    )
    maps = codes(t).select(
        F.concat(F.lit("type "), F.substring("p_type", 1, 3)).alias("source"), "ix", "iy"
    ).unionByName(mask(t).select(F.lit("mask").alias("source"), "ix", "iy"))
    rows = lc.map_agreement(table, maps, "ete", ["vert"], 0.01)
    return rounded(rows, "ha", "rappel", "ha_hors", "hors_mediane", "hors_vert")
