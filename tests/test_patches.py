"""Patches in two levels against a flood fill."""

from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.operators import components, radar

PIXEL = "im string, ix int, iy int"


def spiral(turns):
    """One patch that crosses every border many times."""
    x = y = 0
    cells, step = {(0, 0)}, 2
    for turn in range(turns):
        dx, dy = [(1, 0), (0, 1), (-1, 0), (0, -1)][turn % 4]
        for _ in range(step):
            x, y = x + dx, y + dy
            cells.add((x, y))
        step += 2 * (turn % 2)
    return cells


def comb(teeth, length):
    return {(x, 0) for x in range(2 * teeth)} | {(2 * t, -y) for t in range(teeth) for y in range(length)}


def fill(cells):
    """{cell: (a name of its patch, size)}"""
    found = {}
    for start in cells:
        if start in found:
            continue
        found[start], patch, todo = None, [], deque([start])
        while todo:
            x, y = todo.popleft()
            patch.append((x, y))
            for q in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if q in cells and q not in found:
                    found[q] = None
                    todo.append(q)
        for q in patch:
            found[q] = (start, len(patch))
    return found


def noise(seed, share):
    return set(zip(*(np.argwhere(np.random.default_rng(seed).random((37, 45)) < share) - 20).T.tolist()))


IMAGES = {"spiral": spiral(16), "comb": comb(9, 14), "sparse": noise(1, 0.4), "dense": noise(2, 0.62), None: noise(3, 0.55)}


@pytest.mark.parametrize("tile", [4, 7, 256])
def test_patches_equal_a_flood_fill(spark, tile):
    rows = [(im, x, y) for im, cells in IMAGES.items() for x, y in cells]
    frame = spark.createDataFrame(rows + rows[:99] + [("sparse", None, 1)], PIXEL)
    got = radar.pixel_patches(frame, ["im"], tile).collect()
    assert len(got) == len(rows)
    want = {(im, *c): (im, *v) for im, cells in IMAGES.items() for c, v in fill(cells).items()}
    pairs = {(r.patch, want[r.im, r.ix, r.iy][:2]) for r in got}
    assert all(r.taille == want[r.im, r.ix, r.iy][2] for r in got)
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})  # names match one to one


def test_only_parts_at_borders_reach_the_loop(spark, monkeypatch):
    """A block with a hole in every tile and an island in the hole: islands stay out of the loop."""
    seen = []

    def counted(nodes, edges):
        seen.append(nodes.count())
        return components.connected_components(nodes, edges)

    monkeypatch.setattr(radar, "connected_components", counted)
    rows = [("a", x, y) for x in range(32) for y in range(32) if not (2 <= x % 8 <= 5 and 2 <= y % 8 <= 5) or (x % 8, y % 8) == (3, 3)]
    got = radar.pixel_patches(spark.createDataFrame(rows, PIXEL), ["im"], 8)
    assert sorted(r["count"] for r in got.groupBy("patch").count().collect()) == [1] * 16 + [16 * 48]
    assert seen == [16]


def test_no_pixels_and_two_image_columns(spark):
    assert radar.pixel_patches(spark.createDataFrame([], PIXEL), ["im"]).isEmpty()
    rows = [("a|b", "c", 0, 0), ("a", "b|c", 1, 0), ("a", "b|c", 2, 0)]
    got = radar.pixel_patches(spark.createDataFrame(rows, "u string, v string, ix long, iy long"), ["u", "v"], 2)
    assert sorted(r.taille for r in got.select("taille").collect()) == [1, 2, 2]
    assert got.select(F.countDistinct("patch")).first()[0] == 2
