"""Distances to a mask against a search over all its cells."""

import random

import pytest

from sluice.operators import grid


@pytest.mark.parametrize("limit", [0, 1, 3, 12, 100])
def test_distances_equal_all_cells(spark, limit):
    r = random.Random(limit)
    rows = [("a", r.randrange(-30, 30), r.randrange(-30, 30)) for _ in range(25)]
    rows += [("b", 5, 5), ("b", 5, 9), ("b", 5, 5), (None, 0, 0)]  # a repeated cell, an image without name
    want = {}
    for image, x, y in rows:
        for dx in range(-limit, limit + 1):
            for dy in range(abs(dx) - limit, limit - abs(dx) + 1):
                cell = image, x + dx, y + dy
                want[cell] = min(want.get(cell, limit), abs(dx) + abs(dy))
    df = spark.createDataFrame(rows, "im string, ix int, iy int")
    got = grid.distance_transform(df, ["im"], limit).collect()
    assert {(g.im, g.ix, g.iy): g.distance for g in got} == want
    assert len(got) == len(want)


def test_a_full_square_grows_by_its_rim_only(spark):
    square = spark.range(2500).selectExpr("cast(id % 50 AS int) AS ix", "cast(id div 50 AS int) AS iy")
    got = grid.distance_transform(square, [], 40)
    assert got.count() == 2500 + 4 * 50 * 40 + 4 * (39 * 40 // 2)
    # the first pass gives the square and its columns, not a diamond for each cell
    first = grid._nearest_along(square.selectExpr("*", "0 AS distance"), ["ix"], "iy", 40)
    assert first.count() == 50 * (50 + 80)
    assert grid.distance_transform(square.limit(0), [], 40).count() == 0
