"""As-of join: the latest right row at or before each left row.

A plain window over a key puts all rows of that key in one task. Here time is cut into periods:
each (key, period) is its own window, and one row per (key, period) carries the last right row of
the earlier periods forward. Only that short summary is windowed by key alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    payload: Sequence[str],
    period: str = "month",
    tie_order: Sequence[str] = (),
    strict: bool = False,
    how: str = "left",
) -> DataFrame:
    """Columns of `left` plus `payload` of the latest row of `right` with the same key and a time
    at or before (`strict`: before) `left_time`. Right rows at the same time are told apart by
    `tie_order`, highest last. A null in the payload still counts as a match.

    `period` is the unit of `date_trunc` that bounds the rows one task windows over."""
    keys = list(keys)
    packed = F.struct(*[F.col(c) for c in payload])
    latest = F.max(F.struct(F.col("_t"), F.col("_tie"), F.col("_row")))
    # one right row per key and time: duplicates are combined before the shuffle
    tie = F.struct(*[F.col(c) for c in tie_order]) if tie_order else F.lit(0)
    facts = (
        right.select(*keys, F.col(right_time).alias("_t"), tie.alias("_tie"), packed.alias("_row"))
        .groupBy(*keys, "_t")
        .agg(F.max_by("_row", "_tie").alias("_row"))
        .withColumn("_period", F.date_trunc(period, "_t"))
    )
    asks = left.withColumn("_left", F.struct(*[F.col(c) for c in left.columns])).select(
        *keys, F.col(left_time).alias("_t"), "_left"
    ).withColumn("_period", F.date_trunc(period, "_t"))

    # right rows sort before left rows at the same time, unless the match is strict
    side_right, side_left = (1, 0) if strict else (0, 1)
    both = facts.select(
        *keys, "_period", "_t", F.lit(side_right).alias("_side"), "_row", F.lit(None).alias("_left")
    ).unionByName(
        asks.select(
            *keys,
            "_period",
            "_t",
            F.lit(side_left).alias("_side"),
            F.lit(None).alias("_row"),
            "_left",
        )
    )
    inside = Window.partitionBy(*keys, "_period").orderBy("_t", "_side")
    matched = both.withColumn(
        "_here", F.last("_row", ignorenulls=True).over(inside.rowsBetween(
            Window.unboundedPreceding, 0))
    ).where(F.col("_left").isNotNull())

    ends = facts.groupBy(*keys, "_period").agg(F.max_by("_row", "_t").alias("_end"))
    periods = (
        ends.unionByName(asks.select(*keys, "_period").distinct().withColumn("_end", F.lit(None)))
        .groupBy(*keys, "_period")
        .agg(F.first("_end", ignorenulls=True).alias("_end"))
    )
    before = Window.partitionBy(*keys).orderBy("_period").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = periods.select(
        *keys, "_period", F.last("_end", ignorenulls=True).over(before).alias("_before")
    )
    joined = matched.join(carried, [*keys, "_period"], "left").select(
        "_left", F.coalesce("_here", "_before").alias("_row")
    )
    if how == "inner":
        joined = joined.where(F.col("_row").isNotNull())
    return joined.select("_left.*", *[F.col("_row")[c].alias(c) for c in payload])


def asof_forward(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    payload: Sequence[str],
    period: str = "month",
    strict: bool = True,
) -> DataFrame:
    """The mirror of `asof_join`: the earliest right row after each left row (`strict=False`: at or
    after it). Time is reflected so that one operator serves both directions."""
    def reflect(c: str) -> Column:
        return F.timestamp_micros(-F.unix_micros(F.col(c).cast("timestamp")))

    result = asof_join(
        left.withColumn("_lt", reflect(left_time)),
        right.withColumn("_rt", reflect(right_time)),
        keys,
        "_lt",
        "_rt",
        payload,
        period=period,
        strict=strict,
    )
    return result.drop("_lt")
