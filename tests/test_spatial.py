"""Points, edges and tiles against the plain rules."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import spatial as sp

EDGE = "zone_id string, x1 double, y1 double, x2 double, y2 double"


def ring(zone, corners):
    return [(zone, *map(float, a), *map(float, b)) for a, b in zip(corners, [*corners[1:], corners[0]])]


def plain_inside(edges, x, y):
    odd = set()
    for z, x1, y1, x2, y2 in edges:
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd ^= {z}
    return odd


# exact in floating point: slopes of 0, 1, -1, 2 and upright edges, corners on tile corners and tile sides
SHAPES = [
    *ring("square", [(0, 0), (8, 0), (8, 8), (0, 8)]), *ring("square", [(2, 2), (2, 6), (6, 6), (6, 2)]),  # a hole
    *ring("diamond", [(10, -3), (17, 4), (10, 11), (3, 4)]), *ring("far", [(-20, -20), (44, -20), (44, 44), (-20, 44)]),
    *ring("comb", [(-16, 0), (-4, 0), (-4, 12), (-6, 12), (-6, 2), (-8, 2), (-8, 12), (-10, 12), (-10, 2), (-12, 2), (-12, 12), (-16, 12)]),
    *ring("spike", [(4, 12), (8, 20), (12, 12), (10, 12), (8, 16), (6, 12)]), *ring("spike", [(20, 20), (24, 20), (22, 24)]),
]


@pytest.mark.parametrize("tile", [4.0, 5.0, 64.0])
def test_points_on_corners_sides_and_edges(spark, tile):
    points = [(i, x / 2, y / 2) for i, (x, y) in enumerate((x, y) for x in range(-44, 92, 2) for y in range(-44, 92, 3))]
    got = sp.point_in_polygon(spark.createDataFrame(points, "id int, x double, y double"), spark.createDataFrame(SHAPES, EDGE), "id", tile)
    found = {}
    for i, z in got.collect():
        found.setdefault(i, set()).add(z)
    assert {i: plain_inside(SHAPES, x, y) for i, x, y in points if plain_inside(SHAPES, x, y)} == found


def test_random_rings(spark):
    rng = random.Random(5)
    edges = []
    for z in range(6):
        corners = [(rng.uniform(-50, 50), rng.uniform(-50, 50)) for _ in range(rng.randint(3, 40))]  # they cross themselves
        edges += ring(f"z{z}", corners)
    points = [(i, rng.uniform(-60, 60), rng.uniform(-60, 60)) for i in range(1500)]
    frame, shapes = spark.createDataFrame(points, "id int, x double, y double"), spark.createDataFrame(edges, EDGE)
    got = sp.point_in_polygon(frame, shapes, "id", 7.0).collect()
    assert {(i, z) for i, z in got} == {(i, z) for i, x, y in points for z in plain_inside(edges, x, y)} and len(got) == len(set(got))


def test_inner_tiles_have_no_edges_and_edges_meet_few_tiles(spark):
    shapes = spark.createDataFrame(ring("big", [(0, 0), (1000, 3), (1003, 1000), (1, 1001)]), EDGE)
    index = sp.tile_index(shapes, 10.0).cache()
    assert index.where("_odd = 1 AND size(_edges) = 0").count() > 9_000
    assert index.agg(F.max(F.size("_edges"))).first()[0] <= 2
    slant = spark.createDataFrame([("a", 0.0, 0.0, 1000.0, 1000.0)], EDGE)
    assert sp.edge_tiles(slant, 10.0).count() < 400  # the box has 10,000


@pytest.mark.parametrize("distance", [3.0, 25.0])
def test_nearest_zone_equals_all_edges(spark, distance):
    rng = random.Random(9)
    edges = []
    for z in range(5):
        x, y = rng.uniform(-80, 80), rng.uniform(-80, 80)
        edges += ring(f"z{z}", [(x, y), (x + rng.uniform(5, 60), y + rng.uniform(-5, 5)), (x + 10, y + rng.uniform(5, 60))])
    points = [(i, rng.uniform(-100, 100), rng.uniform(-100, 100)) for i in range(400)]

    def away(x, y, e):
        _, x1, y1, x2, y2 = e
        dx, dy = x2 - x1, y2 - y1
        s = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)))
        return ((x - x1 - s * dx) ** 2 + (y - y1 - s * dy) ** 2) ** 0.5

    want = {}
    for i, x, y in points:
        inside = plain_inside(edges, x, y)
        best = min((away(x, y, e), e[0]) for e in edges)
        want[i] = min(inside) if inside else best[1] if best[0] <= distance else None
    got = sp.nearest_zone(spark.createDataFrame(points, "id int, x double, y double"), spark.createDataFrame(edges, EDGE), "id", distance, 6.0)
    assert {r.id: r.zone_id for r in got.collect()} == want


def clipped_area(corners, x0, y0, s):
    """Shoelace area of a ring cut by the four sides of a square (Sutherland and Hodgman)."""
    for axis, bound, keep in ((0, x0, 1), (0, x0 + s, -1), (1, y0, 1), (1, y0 + s, -1)):
        out = []
        for a, b in zip(corners, [*corners[1:], *corners[:1]]):
            ina, inb = keep * (a[axis] - bound) >= 0, keep * (b[axis] - bound) >= 0
            if ina != inb:
                t = (bound - a[axis]) / (b[axis] - a[axis])
                out += [a] * ina + [(a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1]))]
            elif ina:
                out.append(a)
        corners = out
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(corners, [*corners[1:], *corners[:1]]))) / 2


@pytest.mark.parametrize("size", [3.0, 10.0, 500.0])
def test_coverage_equals_clipped_rings(spark, size):
    rng = random.Random(3)
    rings = {
        "square": [(0, 0), (30, 0), (30, 30), (0, 30)], "turned": [(0, 0), (0, 30), (30, 30), (30, 0)],
        "slim": [(-41.5, 7.25), (66.1, 8.5), (12.3, 9.75)], "steep": [(5, -60), (6.5, 70), (4, 71)],
    }
    for z in range(3):  # star-shaped, so that they don't cross themselves
        r = [rng.uniform(3, 40) for _ in range(17)]
        rings[f"star{z}"] = [(k * math.cos(i * 2 * math.pi / 17) - 7, k * math.sin(i * 2 * math.pi / 17) + 3) for i, k in enumerate(r)]
    edges = [e for z, c in rings.items() for e in ring(z, c)]
    hole = [(5, 5), (5, 25), (25, 25), (25, 5)]
    edges += ring("square", hole)
    got = {(r.zone_id, r.ix, r.iy): r.surface for r in sp.cell_coverage(spark.createDataFrame(edges, EDGE), size).collect()}
    span = range(int(-80 // size) - 1, int(80 // size) + 2)
    for z, corners in rings.items():
        for ix in span:
            for iy in span:
                want = clipped_area(corners, ix * size, iy * size, size)
                if z == "square":
                    want -= clipped_area(hole, ix * size, iy * size, size)
                assert got.get((z, ix, iy), 0.0) == pytest.approx(want, abs=1e-9 * size * size + 1e-9)
    weights = sp.coverage_weights(sp.cell_coverage(spark.createDataFrame(edges, EDGE), size)).groupBy("zone_id").agg(F.sum("poids").alias("w"))
    assert all(abs(r.w - 1) < 1e-9 for r in weights.collect())
