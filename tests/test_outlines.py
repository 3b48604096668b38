"""Outlines of merged areas against a plain walk."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.operators import outlines as ol

EDGE = "code string, x1 double, y1 double, x2 double, y2 double"


def ring(code, corners):
    return [(code, *map(float, a), *map(float, b)) for a, b in zip(corners, [*corners[1:], corners[0]])]


def square(code, x, y, s=1):
    return ring(code, [(x, y), (x + s, y), (x + s, y + s), (x, y + s)])


def rings(spark, edges):
    return ol.outlines(spark.createDataFrame(edges, EDGE), "code")


def walks(rows):
    """{(code, ring): edges in order}, checked to be closed and numbered without a gap."""
    found = defaultdict(list)
    for r in rows.collect():
        found[r.code, tuple(r.ring)].append((r.position, r.x1, r.y1, r.x2, r.y2, r.n_edges))
    for (_, first), edges in found.items():
        edges.sort()
        assert [e[0] for e in edges] == list(range(len(edges))) and {e[5] for e in edges} == {len(edges)}
        assert edges[0][1:5] == first == min(e[1:5] for e in edges)
        assert all(a[3:5] == b[1:3] for a, b in zip(edges, [*edges[1:], edges[0]]))
    return found


def area(edges):
    return sum(x1 * y2 - x2 * y1 for _, x1, y1, x2, y2, _ in edges) / 2


def test_shared_borders_go_and_holes_stay(spark):
    frame = [e for x in range(3) for y in range(3) if (x, y) != (1, 1) for e in square("a", x, y)]
    far = ring("a", [(10, 0), (12, 0), (11, 2)]) + ring("a", [(12, 0), (13, 2), (11, 2)])  # share a slanted edge
    found = walks(rings(spark, frame + far + square("b", 1, 1)))
    assert sorted((k[0], len(v), area(v)) for k, v in found.items()) == [("a", 4, -1.0), ("a", 4, 4.0), ("a", 12, 9.0), ("b", 4, 1.0)]


def test_areas_that_touch_in_a_vertex(spark):
    found = walks(rings(spark, square("a", 0, 0) + square("a", 1, 1) + square("a", -1, 1)))
    assert sorted(area(v) for v in found.values()) == [1.0, 1.0, 1.0]
    # the two holes touch each other in a vertex
    cells = [e for x in range(4) for y in range(4) if (x, y) not in {(1, 1), (2, 2)} for e in square("a", x, y)]
    assert sorted(area(v) for v in walks(rings(spark, cells)).values()) == [-2.0, 16.0]


def test_a_long_spiral_is_one_ring(spark):
    x = y = 0
    cells, step = {(0, 0)}, 2
    for turn in range(24):
        dx, dy = [(1, 0), (0, 1), (-1, 0), (0, -1)][turn % 4]
        for _ in range(step):
            x, y = x + dx, y + dy
            cells.add((x, y))
        step += 2 * (turn % 2)
    frame = spark.createDataFrame([("s", *c) for c in cells], "code string, ix int, iy int")
    found = walks(ol.outlines(ol.cell_edges(frame, "code"), "code"))
    assert len(found) == 1 and [area(v) for v in found.values()] == [float(len(cells))]


def test_random_cells(spark):
    rng = random.Random(3)
    rows = [(c, x, y) for c, share in (("p", 0.3), ("q", 0.6), (None, 0.8)) for x in range(-9, 12) for y in range(-9, 9) if rng.random() < share]
    frame = spark.createDataFrame(rows + rows[:50], "code string, ix int, iy int")
    found = walks(ol.outlines(ol.cell_edges(frame, "code", 2.0), "code"))
    for code in ("p", "q", None):
        mine = {(x, y) for c, x, y in rows if c == code}
        pairs = sum((x + 1, y) in mine for x, y in mine) + sum((x, y + 1) in mine for x, y in mine)
        blocks = sum({(x + 1, y), (x, y + 1), (x + 1, y + 1)} <= mine for x, y in mine)
        areas = [area(v) for k, v in found.items() if k[0] == code]
        assert sum(areas) == 4.0 * len(mine)
        assert sum(len(v) for k, v in found.items() if k[0] == code) == 4 * len(mine) - 2 * pairs
        assert sum(1 if a > 0 else -1 for a in areas) == len(mine) - pairs + blocks  # outlines less holes
        parts = Counter()  # one outline per 4-connected part
        seen = set()
        for c in mine:
            if c not in seen:
                stack = [c]
                seen.add(c)
                n = 0
                while stack:
                    x, y = stack.pop()
                    n += 1
                    for d in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                        if d in mine and d not in seen:
                            seen.add(d)
                            stack.append(d)
                parts[n] += 1
        assert sum(a > 0 for a in areas) == sum(parts.values())


def test_ring_areas(spark):
    edges = ring("a", [(1e6, 1e6), (1e6 + 3, 1e6), (1e6 + 3, 1e6 + 4)]) + ring("a", [(0, 0), (0, 2), (2, 2), (2, 0)])
    got = ol.ring_areas(rings(spark, edges), "code").orderBy("surface").select("n_edges", "perimetre", "surface", "hole").collect()
    assert [tuple(r) for r in got] == [(4, 8.0, -4.0, True), (3, 12.0, 6.0, False)]


@pytest.mark.parametrize(
    "edges",
    [
        square("a", 0, 0) + square("a", 0, 0),  # the same area twice
        square("a", 0, 0)[:3],  # not closed
        square("a", 0, 0)[:3] + [("a", 0.0, 1.0, None, 0.0)],
    ],
)
def test_refusals(spark, edges):
    with pytest.raises(PySparkException):
        rings(spark, edges).collect()


def test_empty(spark):
    empty = spark.createDataFrame([], EDGE)
    assert ol.outlines(empty, "code").isEmpty()
    assert ol.outlines(spark.createDataFrame([("a", 1.0, 1.0, 1.0, 1.0)], EDGE), "code").isEmpty()
    assert ol.ring_areas(ol.outlines(empty, "code"), "code").where(F.col("hole")).isEmpty()


def test_rings_of_one_tile_are_closed_before_the_loop(spark, monkeypatch):
    made, cut = [], ol.cut_lineage
    monkeypatch.setattr(ol, "cut_lineage", lambda df: made.append(cut(df)) or made[-1])
    found = walks(rings(spark, [e for i in range(30) for e in square("a", 3 * i, 0) + square(None, 0, 3 * i)]))
    assert len(found) == 60 and {len(v) for v in found.values()} == {4}
    assert len(made) == 1  # nothing is left for the rounds


@pytest.mark.parametrize("tile", [1.0, 5.0, 256.0])
def test_chains_of_small_chunks(spark, monkeypatch, tile):
    r = random.Random(3)
    cells = {(x, y) for x in range(24) for y in range(24) if r.random() < 0.6}
    edges = [e for c in (None, "a", "b") for x, y in cells for e in square(c, x, y)]
    want = {k: [e[1:] for e in v] for k, v in walks(rings(spark, edges)).items()}
    monkeypatch.setattr(ol, "CHUNK", 7)
    made, cut = [], ol.cut_lineage
    monkeypatch.setattr(ol, "cut_lineage", lambda df: made.append(cut(df)) or made[-1])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = {k: [e[1:] for e in v] for k, v in walks(rings(spark, edges)).items()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want
    assert len(made) > 1 and made[1].count() < made[0].count()


def test_edges_are_shuffled_by_tile_only(spark, monkeypatch):
    made, cut = [], ol.cut_lineage
    monkeypatch.setattr(ol, "cut_lineage", lambda df: made.append((df, cut(df))) or made[-1][1])
    cells = spark.range(9000).selectExpr("'a' AS code", "2 * (id % 100) AS ix", "id DIV 100 AS iy")
    rings = ol.outlines(ol.cell_edges(cells, "code"), "code", 1024.0)
    plan = made[0][0]._jdf.queryExecution().executedPlan().toString()
    shuffles = {line.split("hashpartitioning(")[1].split("),")[0] for line in plan.splitlines() if "Exchange" in line}
    assert shuffles and all("_tx" in s and "_ty" in s for s in shuffles)
    assert ol._packed_edges(ol.cell_edges(cells, "code"), "code", 1024.0).count() < 100  # of 18,200 edges
    assert made[0][1].count() == 400 and rings.count() == 18_200  # 100 columns of 90 cells, in pieces of up to 50 edges


@pytest.mark.parametrize("chunk, mix", [(100_000, ol.MIX), (40, ol.MIX), (40, 0)])
def test_cells_that_come_again_and_cross_tiles(spark, monkeypatch, chunk, mix):
    monkeypatch.setattr(ol, "CHUNK", chunk)  # 40: no task holds a tile
    monkeypatch.setattr(ol, "MIX", mix)
    r = random.Random(8)
    cells = [(c, x, y) for c in ("a", None) for x in range(-270, -240) for y in range(240, 270) if r.random() < 0.5]
    odd = [("a", None, 1), ("a", 1, None), ("a", None, None), (None, None, 7)]  # their edges cancel or have no length
    rows = cells * 3 + odd * 2
    r.shuffle(rows)
    frame = spark.createDataFrame(rows, "code string, ix long, iy int").repartition(7)
    edges = ol.cell_edges(frame, "code", 0.5)
    assert edges.count() == 4 * len(set(cells + odd)) and edges.distinct().count() == edges.count() - 3
    found = walks(ol.outlines(edges, "code", 16.0))
    for code in ("a", None):
        mine = {c for c in cells if c[0] == code}
        pairs = sum((code, x + dx, y + dy) in mine for _, x, y in mine for dx, dy in ((1, 0), (0, 1)))
        areas = [area(v) for k, v in found.items() if k[0] == code]
        assert sum(areas) == len(mine) / 4
        assert sum(len(v) for k, v in found.items() if k[0] == code) == 4 * len(mine) - 2 * pairs


def test_long_edges_and_signed_zeros(spark):
    wide = ring("a", [(-1000, -0.0), (0.0, -700.5), (1e5, 0), (0, 3e4)]) + ring("a", [(0.0, 3e4), (1e5, -0.0), (2e5, 5e4)])
    whole = ring("a", [(-1000, 0), (0, -700.5), (1e5, 0), (2e5, 5e4), (0, 3e4)])
    for tile in (10.0, 256.0, 1e9):
        found = walks(ol.outlines(spark.createDataFrame(wide, EDGE), "code", tile))
        assert [[e[1:5] for e in v] for v in found.values()] == [[e[1:] for e in whole]]
