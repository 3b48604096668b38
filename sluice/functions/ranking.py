"""Exact ranks and quantiles of groups of any size.

`median` and rank windows hold one group in one task, which fails when a group is a third of the
table. Here the distinct values of a group are cut into ranges at approximate quantiles. The cut
points only decide which task counts which values, so the results stay exact. A value finds its
range in two steps, among the coarse cut points and then among those of its step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def cumulative_counts(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    counts: Mapping[str, Column | int],
    root: int = 8,
) -> DataFrame:
    """One row per key and distinct value with, for each entry of `counts`, its sum at the value
    (same name), over all lower values of the key (`<name>_below`) and over the key
    (`<name>_total`). Null values are left out."""
    keys = list(keys)
    per_value = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(*[F.sum(c if isinstance(c, Column) else F.lit(c)).alias(n) for n, c in counts.items()])
    )
    ranges = root * root
    cuts = (
        per_value.groupBy(*keys)
        .agg(
            F.percentile_approx(
                value, [i / ranges for i in range(1, ranges)], F.lit(20 * ranges)
            ).alias("_cuts")
        )
        .withColumn("_coarse", F.array(*[F.get("_cuts", F.lit(root * i - 1)) for i in range(1, root)]))
    )

    def below(points: str | Column) -> Column:
        return F.size(F.filter(points, lambda c: c < F.col(value)))

    join_keys = keys or ["_all"]
    if not keys:
        per_value = per_value.withColumn("_all", F.lit(0))
        cuts = cuts.withColumn("_all", F.lit(0))
    # one shuffle by key and range serves both the totals of the ranges and the counts inside them
    placed = (
        per_value.join(cuts, join_keys)
        .withColumn("_step", below("_coarse") * root)
        .withColumn(
            "_range", F.col("_step") + below(F.slice("_cuts", F.col("_step") + 1, F.lit(root - 1)))
        )
        .drop("_cuts", "_coarse", "_step")
        .repartition(*join_keys, "_range")
    )
    by_key = Window.partitionBy(*join_keys)
    earlier = by_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*join_keys, "_range")
        .agg(*[F.sum(n).alias(n) for n in counts])
        .select(
            *join_keys,
            "_range",
            *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_start_{n}") for n in counts],
            *[F.sum(n).over(by_key).alias(f"{n}_total") for n in counts],
        )
    )
    inside = Window.partitionBy(*join_keys, "_range").orderBy(value).rowsBetween(
        Window.unboundedPreceding, -1
    )
    local = placed.select(
        "*", *[F.coalesce(F.sum(n).over(inside), F.lit(0)).alias(f"_in_{n}") for n in counts]
    )
    return local.join(starts, [*join_keys, "_range"]).select(
        *keys,
        value,
        *counts,
        *[(F.col(f"_start_{n}") + F.col(f"_in_{n}")).alias(f"{n}_below") for n in counts],
        *[f"{n}_total" for n in counts],
    )


def average_ranks(df: DataFrame, keys: Sequence[str], value: str, name: str = "rank") -> DataFrame:
    """One row per key and distinct value with its rank from 1, ties at their mean rank."""
    ranked = cumulative_counts(df, keys, value, {"n": 1})
    return ranked.select(
        *keys, value, "n", (F.col("n_below") + (F.col("n") + 1) / 2).alias(name)
    )


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Mapping[str, float]
) -> DataFrame:
    """One row per key with its size `n` and the interpolated quantiles named in
    `probabilities`."""
    keys = list(keys)
    ranked = cumulative_counts(df, keys, value, {"n": 1})

    def at(index: Column) -> Column:
        hit = (F.col("n_below") <= index) & (index < F.col("n_below") + F.col("n"))
        return F.max(F.when(hit, F.col(value)))

    columns = []
    for name, p in probabilities.items():
        position = F.lit(float(p)) * (F.col("n_total") - 1)
        columns.append(at(F.floor(position)).alias(f"_lo_{name}"))
        columns.append(at(F.ceil(position)).alias(f"_hi_{name}"))
    grouped = ranked.groupBy(*keys, "n_total").agg(*columns)
    result = []
    for name, p in probabilities.items():
        position = F.lit(float(p)) * (F.col("n_total") - 1)
        weight = position - F.floor(position)
        result.append(
            (F.col(f"_lo_{name}") * (1 - weight) + F.col(f"_hi_{name}") * weight).alias(name)
        )
    return grouped.select(*keys, F.col("n_total").alias("n"), *result)


def exact_medians(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], count: str | None = None
) -> DataFrame:
    """Median of several columns per key, each column cut into its own ranges. The columns are
    stacked first so that one pass serves all of them. `count` names the number of known values of
    the first column."""
    long = df.select(
        *keys,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(v).alias("_measure"), F.col(v).cast("double").alias("_value"))
                    for v in values
                ]
            )
        ).alias("_cell"),
    ).select(*keys, "_cell.*")
    medians = exact_quantiles(long, [*keys, "_measure"], "_value", {"_median": 0.5})
    wide = [F.max(F.when(F.col("_measure") == v, F.col("_median"))).alias(v) for v in values]
    if count:
        wide.append(F.max(F.when(F.col("_measure") == values[0], F.col("n"))).alias(count))
    return medians.groupBy(*keys).agg(*wide)


def sorted_median(values: Column) -> Column:
    """Median of a short array; null when it is empty."""
    ordered = F.sort_array(F.filter(values, lambda v: v.isNotNull()))
    n = F.size(ordered)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (low + high) / 2)


def group_auc(df: DataFrame, keys: Sequence[str], value: str, positive: Column) -> DataFrame:
    """Per key: probability that a positive row has a lower value than a negative one, ties for
    one half; null without both kinds. Null values are left out."""
    keys = list(keys)
    ranked = cumulative_counts(
        df.withColumn("_positive", positive.cast("long")),
        keys,
        value,
        {"n1": F.col("_positive"), "n0": 1 - F.col("_positive")},
    )
    # pairs won: negatives strictly above each positive, half of those at the same value
    won = F.sum(F.col("n0") * F.col("n1_below") + F.col("n0") * F.col("n1") / 2)
    total = F.sum("n1") * F.sum("n0")
    return ranked.groupBy(*keys).agg(
        F.sum("n1").alias("n_positive"),
        F.sum("n0").alias("n_negative"),
        F.when(total > 0, won / total).alias("auc"),
    )


def spearman(df: DataFrame, keys: Sequence[str], x: str, y: str, minimum: int = 3) -> DataFrame:
    """Rank correlation of two columns per key; null below `minimum` complete rows."""
    keys = list(keys)
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = pairs
    for column, name in ((x, "_rx"), (y, "_ry")):
        ranks = average_ranks(pairs, keys, column, name).drop("n")
        ranked = ranked.join(ranks, [*keys, column])
    # sums of integers (twice the rank) keep the result independent of the order of rows
    a, b = (F.col("_rx") * 2).cast("decimal(20,0)"), (F.col("_ry") * 2).cast("decimal(20,0)")
    sums = ranked.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.sum(a).cast("double").alias("_a"),
        F.sum(b).cast("double").alias("_b"),
        F.sum(a * b).cast("double").alias("_ab"),
        F.sum(a * a).cast("double").alias("_aa"),
        F.sum(b * b).cast("double").alias("_bb"),
    )
    n = F.col("n")
    cov = n * F.col("_ab") - F.col("_a") * F.col("_b")
    va = n * F.col("_aa") - F.col("_a") * F.col("_a")
    vb = n * F.col("_bb") - F.col("_b") * F.col("_b")
    return sums.select(
        *keys,
        "n",
        F.when((n >= minimum) & (va > 0) & (vb > 0), cov / F.sqrt(va * vb)).alias("rho"),
    )
