"""Readings dated one week late, and stations derived from readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import calendar as cal


def shift_late_readings(
    readings: DataFrame, key: str, date: str, order: Sequence[str]
) -> DataFrame:
    """A reading not dated on a Sunday moves to the previous Sunday when its ISO week holds another
    reading of the key and the previous week holds none.

    At most one reading per week can move: the first in `order` that is not on a Sunday. A move
    empties no week and fills only an empty one, so moves do not depend on each other and the rule
    is a join of weekly counts with themselves. Adds `moved`."""
    monday = F.trunc(F.col(date), "week")
    late = F.when(~cal.is_sunday(F.col(date)), F.struct(*[F.col(c) for c in order]))
    weeks = readings.groupBy(key, monday.alias("_monday")).agg(
        F.count("*").alias("_n"), F.min(late).alias("_first")
    )
    before = weeks.select(key, F.date_add("_monday", 7).alias("_monday"), F.lit(True).alias("_full"))
    movable = (
        weeks.where((F.col("_n") > 1) & F.col("_first").isNotNull())
        .join(before, [key, "_monday"], "left_anti")
        .select(key, "_monday", "_first")
    )
    joined = readings.withColumn("_monday", monday).join(movable, [key, "_monday"], "left")
    hit = F.coalesce(F.struct(*[F.col(c) for c in order]) == F.col("_first"), F.lit(False))
    return joined.select(
        *[c for c in readings.columns if c != date],
        F.when(hit, F.date_sub("_monday", 1)).otherwise(F.col(date)).alias(date),
        hit.alias("moved"),
    )


def station_from_latest(
    readings: DataFrame, key: str, date: str, columns: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """One row per key with the columns of its most recent reading."""
    rank = F.struct(F.col(date), *[F.col(c) for c in order])
    return (
        readings.groupBy(key)
        .agg(F.max_by(F.struct(*columns), rank).alias("_row"))
        .select(key, "_row.*")
    )
