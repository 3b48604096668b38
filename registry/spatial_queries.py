"""L: points and areas. Each nation is a diamond around a grid point, each customer a point."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.core import Tables, nation_id, query, r6, s6, with_sql
from registry.landcover_queries import CODES, codes
from registry.optical_queries import rounded
from sluice.operators import grid
from sluice.operators import outlines as ol
from sluice.operators import spatial as sp

# Diamond of half-width 900 + 20 x key around (2000 x (key % 5), 2000 x (key / 5))
EDGES = """corners AS (SELECT 'N' || lpad(n_nationkey::VARCHAR, 2, '0') AS zone_id, 2000 * (n_nationkey % 5)::DOUBLE AS cx,
    2000 * (n_nationkey // 5)::DOUBLE AS cy, 900 + 20 * n_nationkey::DOUBLE AS r FROM nation),
edges AS (SELECT zone_id, unnest([cx + r, cx, cx - r, cx]) AS x1, unnest([cy, cy + r, cy, cy - r]) AS y1,
    unnest([cx, cx - r, cx, cx + r]) AS x2, unnest([cy + r, cy, cy - r, cy]) AS y2 FROM corners),
points AS (SELECT c_custkey AS id, (c_custkey * 7919 % 11000 - 1000)::DOUBLE + 0.5 AS x, (c_custkey * 104729 % 11000 - 1000)::DOUBLE + 0.25 AS y FROM customer),
inside AS (SELECT id, zone_id FROM points JOIN edges ON ((y1 > y) <> (y2 > y)) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    GROUP BY 1, 2 HAVING count(*) % 2 = 1)"""


def edges(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    c = t.nation.select(
        nation_id("n_nationkey").alias("zone_id"), (2000.0 * (k % 5)).alias("cx"),
        (2000.0 * F.floor(k / 5)).alias("cy"), (900.0 + 20.0 * k).alias("r"),
    )
    x = [F.col("cx") + F.col("r"), F.col("cx"), F.col("cx") - F.col("r"), F.col("cx")]
    y = [F.col("cy"), F.col("cy") + F.col("r"), F.col("cy"), F.col("cy") - F.col("r")]
    sides = [
        F.struct(x[i].alias("x1"), y[i].alias("y1"), x[(i + 1) % 4].alias("x2"), y[(i + 1) % 4].alias("y2"))
        for i in range(4)
    ]
    return c.select("zone_id", F.explode(F.array(*sides)).alias("e")).select("zone_id", "e.*")


def points(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.select(
        k.alias("id"), ((k * 7919 % 11000 - 1000).cast("double") + 0.5).alias("x"),
        ((k * 104729 % 11000 - 1000).cast("double") + 0.25).alias("y"),
    )


@query("point_in_polygon", with_sql("SELECT * FROM inside", EDGES))
def _(t: Tables):
    return sp.point_in_polygon(points(t), edges(t), "id", 700.0)


_DIST = """sqrt(pow(x - (x1 + s * (x2 - x1)), 2) + pow(y - (y1 + s * (y2 - y1)), 2))"""


@query(
    "nearest_zone",
    with_sql(
        f"""SELECT p.id, coalesce(i.zone_id, n.zone_id, '') AS zone_id, coalesce(CASE WHEN i.zone_id IS NOT NULL THEN 0 ELSE {s6('n.d', 4)} END, -1) AS distance
            FROM points p LEFT JOIN (SELECT id, min(zone_id) AS zone_id FROM inside GROUP BY 1) i USING (id) LEFT JOIN (
              SELECT id, zone_id, d FROM (SELECT id, zone_id, {_DIST} AS d FROM (
                  SELECT *, greatest(0, least(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2)))) AS s
                  FROM points, edges)) WHERE d <= 300
              QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, zone_id) = 1) n USING (id)""",
        EDGES,
    ),
)
def _(t: Tables):
    rows = sp.nearest_zone(points(t), edges(t), "id", 300.0, 500.0)
    return rows.select(
        "id", F.coalesce("zone_id", F.lit("")).alias("zone_id"),
        F.coalesce(r6("distance", 4), F.lit(-1.0)).alias("distance"),
    )


@query(
    "cells_intersecting",
    with_sql(
        """SELECT DISTINCT id, zone_id FROM (SELECT id, zone_id FROM inside UNION ALL SELECT id, zone_id FROM points, edges WHERE
             greatest(least((x - 200 - x1) / (x2 - x1), (x + 200 - x1) / (x2 - x1)), least((y - 200 - y1) / (y2 - y1), (y + 200 - y1) / (y2 - y1)), 0)
             <= least(greatest((x - 200 - x1) / (x2 - x1), (x + 200 - x1) / (x2 - x1)), greatest((y - 200 - y1) / (y2 - y1), (y + 200 - y1) / (y2 - y1)), 1))""",
        EDGES,
    ),
)
def _(t: Tables):
    return sp.cells_intersecting(points(t), edges(t), "id", 200.0, 500.0)


_WIDE = "greatest(0, least(x1, cx + r - abs({y} - cy)) - greatest(x0, cx - r + abs({y} - cy)))"
COVERAGE = f"""squares AS (SELECT zone_id, cx, cy, r, ix, iy, 700 * ix::DOUBLE AS x0, 700 * (ix + 1)::DOUBLE AS x1, 700 * iy::DOUBLE AS y0, 700 * (iy + 1)::DOUBLE AS y1
    FROM (SELECT *, unnest(range(floor((cx - r) / 700)::BIGINT, floor((cx + r) / 700)::BIGINT + 1)) AS ix FROM corners),
      (SELECT unnest(range(-5, 20)) AS iy)),
knots AS (SELECT *, list_sort(list_transform([y0, y1, cy, cy - r, cy + r, cy - r + abs(x0 - cx), cy + r - abs(x0 - cx), cy - r + abs(x1 - cx), cy + r - abs(x1 - cx)],
    lambda y: greatest(y0, least(y1, y)))) AS k FROM squares),
strips AS (SELECT * EXCLUDE (k), unnest(k[:-2]) AS a, unnest(k[2:]) AS b FROM knots),
coverage AS (SELECT zone_id, ix, iy, sum((b - a) * ({_WIDE.format(y='a')} + {_WIDE.format(y='b')}) / 2) AS surface FROM strips
    GROUP BY 1, 2, 3 HAVING sum((b - a) * ({_WIDE.format(y='a')} + {_WIDE.format(y='b')}) / 2) > 0.000001)"""


@query(
    "cell_coverage",
    with_sql(
        f"""SELECT zone_id, ix, iy, {s6('surface', 4)} AS surface, {s6('surface / sum(surface) OVER (PARTITION BY zone_id)', 8)} AS poids
            FROM coverage""",
        EDGES, COVERAGE,
    ),
)
def _(t: Tables):
    rows = sp.coverage_weights(sp.cell_coverage(edges(t), 700.0))
    return rows.where("surface > 0.000001").select("zone_id", "ix", "iy", r6("surface", 4).alias("surface"), r6("poids", 8).alias("poids"))


@query(
    "overlay_surface",
    with_sql(
        f"SELECT ix // 9 AS id_a, code AS id_b, {s6('count(*) * 0.25')} AS surface FROM codes WHERE p_size > 5 GROUP BY 1, 2", CODES
    ),
)
def _(t: Tables):
    a = codes(t).select(F.floor(F.col("ix") / 9).alias("id"), "ix", "iy")
    b = codes(t).where("p_size > 5").select(F.col("code").alias("id"), "ix", "iy")
    return rounded(sp.overlay_surface(a, b, 0.25), "surface")


@query(
    "dissolve",
    "SELECT l_returnflag AS code, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1",
)
def _(t: Tables):
    from registry.optical_queries import cells

    footprint = t.lineitem.select(F.col("l_returnflag").alias("code"), *cells("l_partkey"))
    return sp.dissolve(footprint, "code").groupBy("code").agg(F.count("*").alias("n"))


# Cells of the parts shipped with each flag and status in each month of the year: some of all, with holes, at any size
SHIPPED = """shipped AS (SELECT DISTINCT l_returnflag || '-' || l_linestatus || '-' || month(l_shipdate)::VARCHAR AS code, l_partkey % 64 AS ix, l_partkey // 64 AS iy FROM lineitem),
sides AS (SELECT code, unnest([ix, ix, ix + 1, ix]) AS x, unnest([iy, iy, iy, iy + 1]) AS y, unnest(['h', 'v', 'v', 'h']) AS turn FROM shipped),
border AS (SELECT code, count(*) AS n_edges FROM (SELECT code FROM sides GROUP BY code, x, y, turn HAVING count(*) = 1) GROUP BY 1),
euler AS (SELECT s.code, count(*) AS n, count(*) - count(r.ix) - count(u.ix) + count(CASE WHEN r.ix IS NOT NULL AND u.ix IS NOT NULL THEN d.ix END) AS euler
    FROM shipped s LEFT JOIN shipped r ON r.code = s.code AND r.ix = s.ix + 1 AND r.iy = s.iy
    LEFT JOIN shipped u ON u.code = s.code AND u.ix = s.ix AND u.iy = s.iy + 1
    LEFT JOIN shipped d ON d.code = s.code AND d.ix = s.ix + 1 AND d.iy = s.iy + 1 GROUP BY 1)"""


@query(
    "dissolve_outlines",
    with_sql(
        "SELECT code, n_edges, n_edges::DOUBLE AS perimetre, n::DOUBLE AS surface, euler FROM border JOIN euler USING (code)", SHIPPED
    ),
)
def _(t: Tables):
    """Outlines less holes is the Euler number of the merged cells, which SQL counts from cells and neighbours."""
    from registry.optical_queries import cells

    code = F.concat_ws("-", "l_returnflag", "l_linestatus", F.month("l_shipdate").cast("string"))
    shipped = t.lineitem.select(code.alias("code"), *cells("l_partkey"))
    rings = ol.ring_areas(ol.outlines(ol.cell_edges(shipped, "code"), "code"), "code")
    return rings.groupBy("code").agg(
        F.sum("n_edges").alias("n_edges"), F.sum("perimetre").alias("perimetre"), F.sum("surface").alias("surface"),
        (F.count_if(~F.col("hole")) - F.count_if("hole")).alias("euler"),
    )


@query(
    "align_grid",
    with_sql(
        """SELECT floor(min(x) / 30) * 30 AS xmin, ceil(max(y) / 30) * 30 AS ymax, (ceil(max(x) / 30) - floor(min(x) / 30))::BIGINT AS width,
             (ceil(max(y) / 30) - floor(min(y) / 30))::BIGINT AS height FROM points""",
        EDGES,
    ),
)
def _(t: Tables):
    return grid.align_grid(points(t), "x", "y", 30.0)


def claims(t: Tables) -> DataFrame:
    """Zones made of blocks of columns; each also claims one column of its neighbour, and some
    cells belong to no unit."""
    cells = codes(t)
    units = cells.where("p_size % 11 <> 0").select(F.col("ix").alias("unit"), "ix", "iy")
    block = F.floor(F.col("unit") / 8)
    zones = units.select("unit").distinct().select(
        "unit",
        F.explode(F.array(block, F.floor((F.col("unit") - 1) / 8))).alias("b"),
    ).where("b >= 0").select(
        F.concat(F.lit("Z"), "b").alias("zone_id"), F.col("b").alias("rang"), "unit"
    ).distinct()
    return sp.zone_claims(units, zones, cells)


@query(
    "zone_overlaps",
    with_sql(
        f"""SELECT 'Z' || (ix // 8)::VARCHAR AS zone_id, {s6('count(*) * 0.01')} AS chevauchement FROM codes
            WHERE p_size % 11 <> 0 AND ix % 8 = 0 AND ix > 0 GROUP BY 1""",
        CODES,
    ),
)
def _(t: Tables):
    return rounded(sp.zone_overlaps(claims(t), 0.01), "chevauchement")


# Parts are found by reach (pairs of cells), the nearest piece by looking at all
PARTITION = """owned AS (SELECT ix, iy, CASE WHEN p_size % 11 = 0 THEN '' WHEN ix = 0 THEN 'Z0' ELSE 'Z' || ((ix - 1) // 8)::VARCHAR END AS label FROM codes),
reach AS (SELECT ix, iy, ix AS px, iy AS py, label FROM owned UNION
    SELECT r.ix, r.iy, o.ix, o.iy, r.label FROM reach r, (SELECT unnest([1, -1, 0, 0]) AS dx, unnest([0, 0, 1, -1]) AS dy) d, owned o
    WHERE o.ix = r.px + d.dx AND o.iy = r.py + d.dy AND o.label = r.label),
pieces AS (SELECT ix, iy, any_value(label) AS label, min((px, py)) AS part, any_value(label) <> '' AND count(*) >= 20 AS big FROM reach GROUP BY 1, 2),
border AS (SELECT part, label FROM (SELECT s.part, l.label, count(*) AS n FROM pieces s JOIN pieces l ON abs(s.ix - l.ix) + abs(s.iy - l.iy) = 1
      WHERE NOT s.big AND l.big GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY part ORDER BY n DESC, label) = 1),
near AS (SELECT s.part, l.label FROM pieces s, pieces l WHERE NOT s.big AND l.big AND s.part NOT IN (SELECT part FROM border)
    QUALIFY row_number() OVER (PARTITION BY s.part ORDER BY (s.ix - l.ix) ** 2 + (s.iy - l.iy) ** 2, l.label) = 1),
partition_rows AS (SELECT CASE WHEN big THEN p.label ELSE coalesce(b.label, n.label) END AS zone_id, big FROM pieces p
    LEFT JOIN border b ON b.part = p.part LEFT JOIN near n ON n.part = p.part)"""


@query(
    "partition_zones",
    "WITH RECURSIVE " + CODES + ", " + PARTITION + " SELECT zone_id, count(*) AS n, count(*) FILTER (WHERE NOT big) AS n_rattache FROM partition_rows GROUP BY 1",
)
def _(t: Tables):
    parts = sp.partition_zones(claims(t), codes(t), 20)
    return parts.groupBy("zone_id").agg(F.count("*").alias("n"), F.count_if("rattache").alias("n_rattache"))


@query("partition_coverage", with_sql("SELECT avg((ix IS NOT NULL)::INT)::DOUBLE AS couverture FROM codes", CODES))
def _(t: Tables):
    """Every cell of the territory has a zone."""
    parts = sp.partition_zones(claims(t), codes(t), 20)
    return sp.partition_coverage(parts).select("couverture")
