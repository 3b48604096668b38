"""Points, edges and cells. A polygon is a set of edges (`zone_id`, x1, y1, x2, y2), closed rings in
any order; candidates always come from an equi-join on tiles, never from all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.radar import pixel_patches
from sluice.session import cut_lineage


def _slot(x: Column, size: float) -> Column:
    return F.floor(x / F.lit(float(size))).cast("long")


def _slots(low: Column, high: Column, size: float) -> Column:
    return F.sequence(_slot(low, size), _slot(high, size))


def edge_tiles(edges: DataFrame, size: float, reach: float = 0.0) -> DataFrame:
    """Each edge once for every tile (`_tx`, `_ty`) it comes within `reach` of: row by row, the tiles over
    the part of the edge inside that row, never the whole box around it."""
    rows = edges.withColumn(
        "_ty", F.explode(_slots(F.least("y1", "y2") - reach, F.greatest("y1", "y2") + reach, size))
    )
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")

    def at(y: Column) -> Column:
        t = (y - F.col("y1")) / F.nullif(dy, F.lit(0.0))
        return F.col("x1") + F.greatest(F.lit(0.0), F.least(F.lit(1.0), t)) * dx

    low, high = at(F.col("_ty") * size - reach), at((F.col("_ty") + 1) * size + reach)
    flat = dy == 0
    xa = F.when(flat, F.least("x1", "x2")).otherwise(F.least(low, high))
    xb = F.when(flat, F.greatest("x1", "x2")).otherwise(F.greatest(low, high))
    pad = reach + size * 1e-9  # more tiles than needed do no harm
    return rows.withColumn("_tx", F.explode(_slots(xa - pad, xb + pad, size)))


def tile_index(edges: DataFrame, tile: float) -> DataFrame:
    """(zone_id, _tx, _ty, _odd, _edges): for each tile that a zone touches or covers, the parity of the
    zone's crossings left of the tile's lower left corner, and its edges in the tile.

    The parity is a running sum, along each row of tiles, of the crossings of the row's lower line. Tiles
    inside a zone have no edges and an odd parity."""
    size = float(tile)
    lines = edges.withColumn(
        "_ty", F.explode(_slots(F.least("y1", "y2"), F.greatest("y1", "y2"), size))
    ).withColumn("_y", F.col("_ty") * size)
    crossings = lines.where((F.col("y1") > F.col("_y")) != (F.col("y2") > F.col("_y"))).select(
        "zone_id", "_ty", F.ceil(_x_at(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), F.col("_y")) / size).alias("_from")
    )
    row = Window.partitionBy("zone_id", "_ty").orderBy("_from")
    odd = (
        crossings.groupBy("zone_id", "_ty", "_from").agg(F.count("*").alias("_n"))
        .withColumn("_sum", F.sum("_n").over(row.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("_to", F.lead("_from").over(row))
        .where((F.col("_sum") % 2 == 1) & (F.col("_to") > F.col("_from")))
        .select("zone_id", "_ty", F.explode(F.sequence("_from", F.col("_to") - 1)).alias("_tx"))
        .withColumn("_odd", F.lit(1))
    )
    inside = edge_tiles(edges, size).groupBy("zone_id", "_tx", "_ty").agg(
        F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("_edges")
    )
    keys = ["zone_id", "_tx", "_ty"]
    return inside.join(odd, keys, "full").select(
        *keys, F.coalesce("_odd", F.lit(0)).alias("_odd"), F.coalesce("_edges", F.array()).alias("_edges")
    )


def _x_at(x1: Column, y1: Column, x2: Column, y2: Column, y: Column) -> Column:
    return (x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1


def _crossings(x: Column, y: Column, x0: Column, y0: Column) -> Column:
    """Edges of the tile crossed on the way from its corner (x0, y0) up to the point's height, then
    right to the point. A line through a corner of the ring meets one of its two edges: a point counts
    as a little further right, and by much less further up."""

    def crossed(e: Column) -> Column:
        x1, y1, x2, y2 = e["x1"], e["y1"], e["x2"], e["y2"]
        at = _x_at(x1, y1, x2, y2, y)
        right = ((y1 > y) != (y2 > y)) & (at > x0) & (at <= x)
        rise = _x_at(y1, x1, y2, x2, x0)  # the same with the axes exchanged
        climbs = ((y2 - y1) > 0) == ((x2 - x1) > 0)

        def above(v: Column) -> Column:
            return (rise > v) | ((rise == v) & climbs & (y2 != y1))

        up = ((x1 > x0) != (x2 > x0)) & above(y0) & ~above(y)
        return right.cast("int") + up.cast("int")

    return F.aggregate("_edges", F.lit(0), lambda n, e: n + F.coalesce(crossed(e), F.lit(0)))


def point_in_polygon(
    points: DataFrame, edges: DataFrame, point: str, tile: float
) -> DataFrame:
    """(point, zone_id) for each polygon that contains a point, by the parity of crossings.

    A point meets the zones of its own tile and their edges there, whatever the width of the zone: see
    `tile_index`. The join is by tile; AQE splits a tile that holds many points."""
    size = float(tile)
    located = points.select(point, "x", "y", _slot(F.col("x"), size).alias("_tx"), _slot(F.col("y"), size).alias("_ty"))
    n = F.col("_odd") + _crossings(F.col("x"), F.col("y"), F.col("_tx") * size, F.col("_ty") * size)
    return located.join(tile_index(edges, size), ["_tx", "_ty"]).where(n % 2 == 1).select(point, "zone_id")


def _segment_distance() -> Column:
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    length = dx * dx + dy * dy
    along = ((F.col("x") - F.col("x1")) * dx + (F.col("y") - F.col("y1")) * dy) / F.nullif(
        length, F.lit(0.0)
    )
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
    ex = F.col("x") - (F.col("x1") + t * dx)
    ey = F.col("y") - (F.col("y1") + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def nearest_zone(
    points: DataFrame, edges: DataFrame, point: str, distance: float, tile: float
) -> DataFrame:
    """One row per point: the zone that contains it, else the nearest one within `distance`, else
    null. Ties go to the first zone in order."""
    inside = point_in_polygon(points, edges, point, tile).groupBy(point).agg(
        F.min("zone_id").alias("_inside")
    )
    size = float(max(tile, distance))
    near_edges = edge_tiles(edges, size, distance)
    outside = points.select(point, "x", "y").join(inside, point, "left_anti").select(
        point, "x", "y", _slot(F.col("x"), size).alias("_tx"), _slot(F.col("y"), size).alias("_ty")
    )
    near = (
        outside.join(near_edges, ["_tx", "_ty"])
        .withColumn("_d", _segment_distance())
        .where(F.col("_d") <= distance)
        .groupBy(point)
        .agg(F.min(F.struct("_d", "zone_id")).alias("_near"))
    )
    return (
        points.join(inside, point, "left")
        .join(near, point, "left")
        .withColumn("zone_id", F.coalesce("_inside", F.col("_near.zone_id")))
        .withColumn("distance", F.when(F.col("_inside").isNotNull(), 0.0).otherwise(F.col("_near._d")))
        .drop("_inside", "_near")
    )


def cells_intersecting(
    centres: DataFrame, edges: DataFrame, cell: str, half: float, tile: float
) -> DataFrame:
    """Square cells (side 2 x half around a centre) that touch an area: an edge enters the square,
    or the centre is inside the area."""
    size = float(max(tile, half))
    near = edge_tiles(edges, size, half)
    located = centres.select(
        cell, "x", "y", _slot(F.col("x"), size).alias("_tx"), _slot(F.col("y"), size).alias("_ty")
    )
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")

    # part of the edge, as an interval of [0, 1], inside each slab of the square
    def slab(start: Column, step: Column, middle: Column) -> tuple[Column, Column]:
        a, b = (middle - half - start) / F.nullif(step, F.lit(0.0)), (
            middle + half - start
        ) / F.nullif(step, F.lit(0.0))
        within = F.abs(start - middle) <= half
        return (
            F.coalesce(F.least(a, b), F.when(within, 0.0).otherwise(2.0)),
            F.coalesce(F.greatest(a, b), F.when(within, 1.0).otherwise(-1.0)),
        )

    ax, bx = slab(F.col("x1"), dx, F.col("x"))
    ay, by = slab(F.col("y1"), dy, F.col("y"))
    touches = F.greatest(ax, ay, F.lit(0.0)) <= F.least(bx, by, F.lit(1.0))
    crossed = located.join(near, ["_tx", "_ty"]).where(touches).select(cell, "zone_id")
    return crossed.unionByName(point_in_polygon(centres, edges, cell, tile)).distinct()


def cell_coverage(edges: DataFrame, size: float) -> DataFrame:
    """(zone_id, ix, iy, surface): exact area of each zone in each square cell of side `size`, for cells
    with a positive one. Rings are directed, holes the other way round from outlines.

    An edge is cut at the borders of rows and columns. Right of each piece, inside its row, the zone gains
    (or loses) the height of the piece: in the piece's own cell a trapezoid, in every further cell the
    whole width. So the areas are sums over pieces, and a running sum of heights along each row."""
    s = float(size)
    rows = edges.withColumn("iy", F.explode(_slots(F.least("y1", "y2"), F.greatest("y1", "y2"), s))).where("y1 != y2")
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")

    def clip(v: Column, low: Column, high: Column) -> Column:
        return F.greatest(low, F.least(high, v))

    bottom, top = F.col("iy") * s, (F.col("iy") + 1) * s
    ya, yb = clip(F.col("y1"), bottom, top), clip(F.col("y2"), bottom, top)
    pieces = (
        rows.withColumn("_ya", ya).withColumn("_yb", yb).where("_ya != _yb")
        .withColumn("_xa", F.col("x1") + (F.col("_ya") - F.col("y1")) / dy * dx)
        .withColumn("_xb", F.col("x1") + (F.col("_yb") - F.col("y1")) / dy * dx)
        .withColumn("ix", F.explode(_slots(F.least("_xa", "_xb"), F.greatest("_xa", "_xb"), s)))
    )
    left, right = F.col("ix") * s, (F.col("ix") + 1) * s
    width = F.nullif(F.col("_xb") - F.col("_xa"), F.lit(0.0))

    def height(x: Column, end: Column) -> Column:
        """Height of the piece at `x`; `end` for an upright one."""
        return F.coalesce(F.col("_ya") + (x - F.col("_xa")) / width * (F.col("_yb") - F.col("_ya")), end)

    xa, xb = clip(F.col("_xa"), left, right), clip(F.col("_xb"), left, right)
    fall = height(xa, F.col("_ya")) - height(xb, F.col("_yb"))
    row = Window.partitionBy("zone_id", "iy").orderBy("ix")
    cells = (
        pieces.select("zone_id", "ix", "iy", fall.alias("_h"), (fall * (right - (xa + xb) / 2)).alias("_a"))
        .groupBy("zone_id", "ix", "iy").agg(F.sum("_h").alias("_h"), F.sum("_a").alias("_a"))
        .withColumn("_before", F.coalesce(F.sum("_h").over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("_next", F.coalesce(F.lead("ix").over(row), F.col("ix") + 1))
    )
    # the cell of the pieces, then the cells up to the next one, which no edge enters
    run = F.when(F.abs(F.col("_before") + F.col("_h")) > s * 1e-9, F.sequence("ix", F.col("_next") - 1)).otherwise(F.array("ix"))
    spread = cells.withColumn("_x", F.explode(run)).select(
        "zone_id", F.col("_x").alias("ix"), "iy",
        F.when(F.col("_x") == F.col("ix"), F.col("_before") * s + F.col("_a")).otherwise((F.col("_before") + F.col("_h")) * s).alias("surface"),
    )
    turn = spread.groupBy("zone_id").agg(F.signum(F.sum("surface")).alias("_turn"))
    return (
        spread.join(turn, "zone_id").withColumn("surface", F.col("surface") * F.col("_turn"))
        .where(F.col("surface") > s * s * 1e-12).drop("_turn")
    )


def coverage_weights(coverage: DataFrame) -> DataFrame:
    """`coverage` with `poids`, the cell's share of its zone; the weights of a zone add up to 1. The shares
    come from an aggregate joined back: a zone may have any number of cells."""
    total = coverage.groupBy("zone_id").agg(F.sum("surface").alias("_total"))
    return coverage.join(total, "zone_id").withColumn("poids", F.col("surface") / F.col("_total")).drop("_total")


def overlay_surface(a: DataFrame, b: DataFrame, cell_area: float) -> DataFrame:
    """Area shared by the parts of two partitions laid on one fine grid. `a` and `b` have id, ix,
    iy."""
    left = a.select(F.col("id").alias("id_a"), "ix", "iy")
    right = b.select(F.col("id").alias("id_b"), "ix", "iy")
    return (
        left.join(right, ["ix", "iy"])
        .groupBy("id_a", "id_b")
        .agg((F.count("*") * cell_area).alias("surface"))
    )


def dissolve(cells: DataFrame, code: str) -> DataFrame:
    """One footprint per code: shared cells count once."""
    return cells.select(code, "ix", "iy").distinct()


def zone_claims(units: DataFrame, zones: DataFrame, territory: DataFrame) -> DataFrame:
    """Cells of the territory with the zones that claim them, in the order of the zones. `units`
    has unit, ix, iy; `zones` zone_id, rang, unit."""
    return (
        units.join(zones, "unit")
        .join(territory.select("ix", "iy"), ["ix", "iy"], "left_semi")
        .groupBy("ix", "iy", "zone_id")
        .agg(F.min("rang").alias("rang"))
    )


def zone_overlaps(claims: DataFrame, cell_area: float) -> DataFrame:
    """Area each zone shares with earlier ones; large values are errors of the definition."""
    first = claims.groupBy("ix", "iy").agg(F.min("rang").alias("_first"))
    return (
        claims.join(first, ["ix", "iy"])
        .where(F.col("rang") > F.col("_first"))
        .groupBy("zone_id")
        .agg((F.count("*") * cell_area).alias("chevauchement"))
    )


def _nearest_zone_by_rings(lonely: DataFrame, large: DataFrame, reach: int) -> DataFrame:
    """(component, _zone): the zone of the large cell nearest to any cell of a component. Rings of
    doubling radius are searched, each time only for the components that are still without a zone."""
    found = lonely.sparkSession.createDataFrame([], f"component {lonely.schema['component'].dataType.simpleString()}, _zone string")
    if large.isEmpty():
        return found
    inner, outer = 0, reach
    left = cut_lineage(lonely)
    while not left.isEmpty():
        steps = F.sequence(F.lit(-outer), F.lit(outer))
        ring = (
            left.withColumn("_dx", F.explode(steps)).withColumn("_dy", F.explode(steps))
            .withColumn("_d", F.col("_dx") * F.col("_dx") + F.col("_dy") * F.col("_dy"))
            .where((F.col("_d") > inner * inner) & (F.col("_d") <= outer * outer))
            .select("component", (F.col("ix") + F.col("_dx")).alias("ix"), (F.col("iy") + F.col("_dy")).alias("iy"), "_d")
        )
        hits = cut_lineage(
            ring.join(large, ["ix", "iy"]).groupBy("component").agg(F.min(F.struct("_d", "_zone")).alias("_b"))
            .select("component", F.col("_b._zone").alias("_zone"))
        )
        found = found.unionByName(hits)
        left = cut_lineage(left.join(hits, "component", "left_anti"))
        inner, outer = outer, 2 * outer
    return found


def partition_zones(
    claims: DataFrame, territory: DataFrame, fragment_cells: int, reach: int = 8
) -> DataFrame:
    """A partition of the territory: each cell to the first zone that claims it; fragments smaller
    than `fragment_cells` and gaps of any size join the large piece they share the longest border
    with, else the nearest one. Zones are null only where there is no large piece at all. `reach`
    is the first distance in cells that is searched; it doubles until all are attached. Returns ix,
    iy, zone_id, `rattache`."""
    owned = claims.groupBy("ix", "iy").agg(F.min_by("zone_id", "rang").alias("zone_id"))
    cells = territory.select("ix", "iy").distinct().join(owned, ["ix", "iy"], "left")
    cells = cut_lineage(cells.withColumn("_label", F.coalesce("zone_id", F.lit(""))))
    pieces = pixel_patches(cells.select("_label", "ix", "iy"), ["_label"])
    pieces = cut_lineage(
        pieces.select(
            "ix", "iy", F.col("patch").alias("component"), "_label",
            ((F.col("_label") != "") & (F.col("taille") >= fragment_cells)).alias("_large"),
        )
    )
    large = pieces.where("_large").select("ix", "iy", F.col("_label").alias("_zone"))
    small = pieces.where(~F.col("_large"))
    # border: pairs of neighbouring cells on both sides
    around = F.explode(
        F.array(*[F.struct(F.lit(x).alias("dx"), F.lit(y).alias("dy"))
                  for x, y in ((1, 0), (-1, 0), (0, 1), (0, -1))])
    )
    border = (
        small.select("component", "ix", "iy", around.alias("_s"))
        .select("component", (F.col("ix") + F.col("_s.dx")).alias("ix"), (F.col("iy") + F.col("_s.dy")).alias("iy"))
        .join(large, ["ix", "iy"])
        .groupBy("component", "_zone")
        .agg(F.count("*").alias("_len"))
        .groupBy("component")
        .agg(F.min(F.struct((-F.col("_len")).alias("n"), "_zone")).alias("_b"))
        .select("component", F.col("_b._zone").alias("_zone"))
    )
    lonely = small.join(border, "component", "left_anti").select("component", "ix", "iy")
    near = _nearest_zone_by_rings(lonely, large, reach)
    given = border.unionByName(near)
    attached = small.join(given, "component", "left").select(
        "ix", "iy", F.col("_zone").alias("zone_id"), F.lit(True).alias("rattache")
    )
    return large.select("ix", "iy", F.col("_zone").alias("zone_id"), F.lit(False).alias("rattache")).unionByName(attached)


def partition_coverage(partition: DataFrame) -> DataFrame:
    """Share of the territory with a zone; at least 0.9999 is expected."""
    return partition.agg(
        F.avg(F.col("zone_id").isNotNull().cast("int")).alias("couverture"),
        F.count_if("rattache").alias("n_rattache"),
    )
