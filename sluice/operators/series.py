"""Sub-daily series: removal of spikes, short gaps, value at an instant.

A long series is cut into blocks of rows, so that one key is many tasks. Row positions come from
the counts of each (key, day) and their running sum; a block also receives the few rows next to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.ranking import sorted_median
from sluice.operators.asof import asof_forward, asof_join


def with_positions(df: DataFrame, keys: Sequence[str], time: str, period: str = "day") -> DataFrame:
    """Position of each row in its key (`_i`, from 0), without sorting a whole key in one task."""
    keys = list(keys)
    rows = df.withColumn("_period", F.date_trunc(period, time))
    counts = rows.groupBy(*keys, "_period").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_period").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *keys, "_period", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = F.row_number().over(Window.partitionBy(*keys, "_period").orderBy(time)) - 1
    return (
        rows.withColumn("_k", inside)
        .join(starts, [*keys, "_period"])
        .withColumn("_i", F.col("_start") + F.col("_k"))
        .drop("_period", "_k", "_start")
    )


def _in_blocks(df: DataFrame, block: int, halo: int) -> DataFrame:
    def of(i: Column) -> Column:
        return F.floor(i / block)

    i = F.col("_i")
    return df.withColumn("_own", of(i)).withColumn(
        "_block", F.explode(F.sequence(of(i - halo), of(i + halo)))
    )


def despike_fill(
    df: DataFrame, keys: Sequence[str], time: str, value: str,
    tolerance: float = 0.4, half: int = 3, minimum: int = 3, limit: int = 3, block: int = 100_000,
) -> DataFrame:
    """Values at `tolerance` or more from the centred median of 2 x half + 1 points (`minimum` of
    them present) are dropped, then at most `limit` missing points in a row are filled on the line
    between their neighbours, or with the last value at the end of the series. Points still
    missing are left out."""
    keys = list(keys)
    placed = with_positions(df.select(*keys, time, value), keys, time)
    by_block = Window.partitionBy(*keys, "_block").orderBy("_i")
    back = Window.partitionBy(*keys, "_block").orderBy(F.desc("_i"))
    near = F.filter(
        F.collect_list(F.struct(F.col(value).alias("v"))).over(by_block.rowsBetween(-half, half)),
        lambda p: p["v"].isNotNull(),
    )
    window = _in_blocks(placed, block, half).withColumn("_near", F.transform(near, lambda p: p["v"]))
    middle = F.when(F.size("_near") >= minimum, sorted_median(F.col("_near")))
    clean = window.where(F.col("_block") == F.col("_own")).select(
        *keys, time, "_i", F.when(F.abs(F.col(value) - middle) < tolerance, F.col(value)).alias("_v")
    )
    # the previous valid point is at most `limit` rows back; the next one may be in a later block
    point = F.when(F.col("_v").isNotNull(), F.struct(F.col("_i").alias("i"), F.col("_v").alias("v")))
    blocks = _in_blocks(clean, block, limit).withColumn("_p", point)
    firsts = blocks.where(F.col("_block") == F.col("_own")).groupBy(*keys, "_block").agg(
        F.min("_p").alias("_first")
    )
    later = Window.partitionBy(*keys).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    carried = firsts.select(
        *keys, "_block", F.last("_first", ignorenulls=True).over(later).alias("_later")
    )
    around = (
        blocks.withColumn(
            "_prev", F.last("_p", ignorenulls=True).over(by_block.rowsBetween(-limit, -1))
        )
        .withColumn(
            "_next",
            F.last("_p", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1)),
        )
        .where(F.col("_block") == F.col("_own"))
        .join(carried, [*keys, "_block"], "left")
        .withColumn("_next", F.coalesce("_next", "_later"))
    )
    prev, nxt = F.col("_prev"), F.col("_next")
    line = prev["v"] + (nxt["v"] - prev["v"]) * (F.col("_i") - prev["i"]) / (nxt["i"] - prev["i"])
    filled = F.coalesce("_v", F.when(prev.isNotNull(), F.coalesce(line, prev["v"])))
    return around.select(*keys, time, filled.alias(value)).where(F.col(value).isNotNull())


def interpolate_at(
    instants: DataFrame, series: DataFrame, keys: Sequence[str], at: str, time: str, value: str,
    max_gap_seconds: int = 1800, period: str = "day",
) -> DataFrame:
    """Value of a series at instants, on the line between the reading before and the reading at or
    after; null outside the series or when the two are too far apart."""
    before = series.select(*keys, F.col(time).alias("_bt"), F.col(time).alias("_b"), F.col(value).alias("_bv"))
    after = series.select(*keys, F.col(time).alias("_at"), F.col(time).alias("_a"), F.col(value).alias("_av"))
    rows = asof_join(instants, before, keys, at, "_bt", ["_b", "_bv"], period=period, strict=True)
    rows = asof_forward(rows, after, keys, at, "_at", ["_a", "_av"], period=period, strict=False)

    def micros(later: str, earlier: str) -> Column:
        return F.unix_micros(F.col(later).cast("timestamp")) - F.unix_micros(
            F.col(earlier).cast("timestamp")
        )

    gap = micros("_a", "_b")
    line = F.col("_bv") + (F.col("_av") - F.col("_bv")) * (micros(at, "_b") / gap)
    return rows.withColumn(value, F.when(gap <= max_gap_seconds * 1_000_000, line)).drop("_b", "_bv", "_a", "_av")
