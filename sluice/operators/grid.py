"""Neighbourhoods on long pixel tables.

Pixels are grouped by image and square tile. A pixel near an edge is also sent to the tile next
door, so one shuffle of about the table's own size gives every tile its halo; spreading to the
neighbours and the aggregate that follows stay inside the tile's task. Distances to a mask need no
tiles: they go along columns, then along rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE = 256


def _tile(x: Column, tile: int) -> Column:
    return F.floor(x / tile).cast("int")


def with_halo(df: DataFrame, image: Sequence[str], halo: int = 1, tile: int = TILE) -> DataFrame:
    """Rows repeated for each tile whose halo holds them, hash-partitioned by image and tile."""

    def tiles(axis: str) -> Column:
        return F.sequence(_tile(F.col(axis) - halo, tile), _tile(F.col(axis) + halo, tile))

    return (
        df.withColumn("_tx", F.explode(tiles("ix")))
        .withColumn("_ty", F.explode(tiles("iy")))
        .repartition(*image, "_tx", "_ty")
    )


def spread(
    df: DataFrame, image: Sequence[str], xs: Column, ys: Column, halo: int = 1, tile: int = TILE
) -> DataFrame:
    """Each row sent to the cells (`qx`, `qy`) of `xs` x `ys`, kept where the cell lies in the tile.
    Group by `cell_keys(image)` next: no further shuffle is needed."""
    return (
        with_halo(df, image, halo, tile)
        .withColumn("qx", F.explode(xs))
        .where(_tile(F.col("qx"), tile) == F.col("_tx"))
        .withColumn("qy", F.explode(ys))
        .where(_tile(F.col("qy"), tile) == F.col("_ty"))
    )


def cell_keys(image: Sequence[str]) -> list[str]:
    return [*image, "_tx", "_ty", "qx", "qy"]


def around(axis: str) -> Column:
    return F.array(F.col(axis) - 1, F.col(axis), F.col(axis) + 1)


def erode_cells(cells: DataFrame, label: str, tile: int = TILE) -> DataFrame:
    """Cells whose eight neighbours have the same label: the footprint shrunk by one cell."""
    sent = spread(cells.select(label, "ix", "iy").distinct(), [label], around("ix"), around("iy"),
                  1, tile)
    return (
        sent.groupBy(*cell_keys([label]))
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") == 9)
        .select(label, F.col("qx").alias("ix"), F.col("qy").alias("iy"))
    )


def _nearest_along(cells: DataFrame, line: Sequence[str], place: str, limit: int) -> DataFrame:
    """Least `distance` plus steps along `place` to any cell of the line, for every place where that
    is at most `limit`. A place is emitted once, by the cell before it, from running minima of both
    directions; repeated cells are one. The windows hold one line of an image."""
    forth = Window.partitionBy(*line).orderBy(place)
    back = Window.partitionBy(*line).orderBy(F.col(place).desc())
    known = (
        cells.withColumn("_back", F.min(F.col("distance") + F.col(place)).over(back))
        .withColumn("_forth", F.min(F.col("distance") - F.col(place)).over(forth))
        .withColumn("_next", F.lead(place).over(forth))
        .withColumn("_next_back", F.lead("_back").over(forth))
        .withColumn("_first", F.lag(place).over(forth).isNull())
    )

    def places(low: Column, high: Column) -> Column:
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<long>"))

    here, after = F.col(place).cast("long"), F.col("_next").cast("long") - 1
    reach = limit - F.col("_forth").cast("long")  # as far as the cells up to this one go
    ahead = F.col("_next_back").cast("long") - limit  # from here on the next ones do
    at = F.concat(
        F.when(F.col("_first"), places(F.col("_back").cast("long") - limit, here - 1)).otherwise(F.array().cast("array<long>")),
        places(here, F.least(reach, after)),
        F.coalesce(places(F.greatest(reach + 1, ahead), after), F.array().cast("array<long>")),
    )
    steps = F.when(F.col("_at") < here, F.col("_back") - F.col("_at")).otherwise(
        F.least(F.col("_forth") + F.col("_at"), F.col("_next_back") - F.col("_at"))
    )
    other = [c for c in cells.columns if c not in (place, "distance")]
    return known.withColumn("_at", F.explode(at)).select(
        *other, F.col("_at").cast(cells.schema[place].dataType).alias(place), steps.cast("int").alias("distance")
    )


def distance_transform(cells: DataFrame, image: Sequence[str], limit: int) -> DataFrame:
    """Cells at most `limit` steps to the four neighbours away from a mask, with the number of steps
    (`distance`, 0 in the mask): along columns first, then along rows. Each pass is one shuffle and
    gives no more rows than the result has, whatever the limit. A mask without cells gives none."""
    image = list(image)
    mask = cells.select(*image, "ix", "iy", F.lit(0).alias("distance"))
    columns = _nearest_along(mask, [*image, "ix"], "iy", limit)
    return _nearest_along(columns, [*image, "iy"], "ix", limit).select(*image, "ix", "iy", "distance")


def dilate_cells(cells: DataFrame, image: Sequence[str], steps: int, tile: int = TILE) -> DataFrame:
    """Mask grown by `steps` steps to the four neighbours: all cells at most that many steps away.
    Lines need no tiles; `tile` is taken as by `erode_cells` and changes nothing."""
    return distance_transform(cells, image, steps).drop("distance")


def align_grid(points: DataFrame, x: str, y: str, resolution: float) -> DataFrame:
    """Smallest grid on multiples of the resolution that covers all points: xmin, ymax, width,
    height."""
    r = F.lit(float(resolution))
    box = points.agg(
        F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")
    )
    left, right = F.floor(F.col("x0") / r) * r, F.ceil(F.col("x1") / r) * r
    low, high = F.floor(F.col("y0") / r) * r, F.ceil(F.col("y1") / r) * r
    return box.select(
        left.alias("xmin"),
        high.alias("ymax"),
        ((right - left) / r).cast("long").alias("width"),
        ((high - low) / r).cast("long").alias("height"),
    )
