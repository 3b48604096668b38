"""Documented studies: concordance of gauges, weights, extremes, ratios and quality of readings."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import calendar as cal
from sluice.functions.stats import CLASS_LIMITS


def series_concordance(
    a: DataFrame, b: DataFrame, keys: Sequence[str], date: str, value: str
) -> DataFrame:
    """Two candidate gauges over their common days: number, correlation of the logarithms, median
    ratio. Non-positive values are left out. A pair is bounded by the calendar."""
    right = b.select(*keys, date, F.col(value).alias("_b"))
    both = a.select(*keys, date, F.col(value).alias("_a")).join(right, [*keys, date]).where(
        (F.col("_a") > 0) & (F.col("_b") > 0)
    )
    return both.groupBy(*keys).agg(
        F.count("*").alias("n_jours"),
        F.corr(F.ln("_a"), F.ln("_b")).alias("correlation_log"),
        F.median(F.col("_a") / F.col("_b")).alias("rapport_median"),
    )


def weight_combinations(k: int, step: float = 0.05) -> list[tuple[float, ...]]:
    """All combinations of k weights on a step that sum to 1."""
    n = round(1 / step)

    def combos(left: int, k: int) -> list[tuple[int, ...]]:
        if k == 1:
            return [(left,)]
        return [(i, *rest) for i in range(left + 1) for rest in combos(left - i, k - 1)]

    return [tuple(i / n for i in combo) for combo in combos(n, k)]


def _weighted_mean(parts: Sequence[np.ndarray], there: Sequence[np.ndarray], weights: Sequence[float]):
    """(means, where there is one) of the components that are there."""
    top = bottom = np.zeros(len(parts[0]))
    for x, known, w in zip(parts, there, weights, strict=True):
        top = top + np.where(known, w * x, 0.0)
        bottom = bottom + np.where(known, w, 0.0)
    known = bottom != 0
    return top / np.where(known, bottom, 1.0), known


def _pairs_won(values: np.ndarray, positive: np.ndarray) -> float:
    """Pairs in which the positive row has the lower value, ties for one half."""
    distinct, code = np.unique(values, return_inverse=True)
    n1 = np.bincount(code, positive, len(distinct))
    n0 = np.bincount(code, ~positive, len(distinct))
    return float(np.sum(n0 * (np.cumsum(n1) - n1) + n0 * n1 / 2))


def weight_sweep(
    table: DataFrame,
    components: Sequence[str],
    current: dict[str, float],
    positive: Column,
    period: Column,
    step: float = 0.05,
) -> DataFrame:
    """Per zone, period and combination of weights: AUC of the composite, share of weeks whose
    class changes against the current weights, and the number of combinations of the zone within
    0.01 of the best. `table` has zone_id, semaine and one column per component, one row per zone and
    week; missing components are left out and the weights renormalised. Only these rows are
    shuffled: the weeks of a zone and period, bounded by the calendar, are ranked under all
    combinations inside their task. Weeks without a level count in the share alone; combinations
    without any value have no row."""
    grid = weight_combinations(len(components), step)
    now = [current[c] for c in components]
    rows = table.select(
        "zone_id", period.alias("periode"), positive.alias("_alert"), *[F.col(c).cast("double").alias(c) for c in components]
    )
    limits = np.array(CLASS_LIMITS)

    def sweep(weeks: pa.Table) -> pa.Table:
        columns = [weeks[c].combine_chunks() for c in components]
        there = [c.is_valid().to_numpy(zero_copy_only=False) for c in columns]
        parts = [c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in columns]
        alert = weeks["_alert"].combine_chunks()
        judged = alert.is_valid().to_numpy(zero_copy_only=False)
        alert = alert.fill_null(False).to_numpy(zero_copy_only=False)
        before, had = _weighted_mean(parts, there, now)
        before = np.searchsorted(limits, before)
        out = []
        for weights in grid:
            value, known = _weighted_mean(parts, there, weights)
            if not known.any():
                continue
            mine, both = known & judged, known & had
            n1, n0 = int(np.sum(alert & mine)), int(np.sum(~alert & mine))
            auc = _pairs_won(value[mine], alert[mine]) / (n1 * n0) if n1 and n0 else None
            changed = np.searchsorted(limits, value[both]) != before[both]
            out.append((*weights, n1, n0, auc, float(changed.mean()) if both.any() else None))
        best = max((r[-2] for r in out if r[-2] is not None), default=None)
        near = sum(r[-2] is not None and r[-2] >= best - 0.01 for r in out)
        first = weeks.slice(0, 1).select(["zone_id", "periode"])
        made = pa.Table.from_pylist(
            [dict(zip(names, (*r, near))) for r in out], pa.schema([(n, pa.int64() if n.startswith("n_") else pa.float64()) for n in names])
        )
        keys = first.take(pa.array(np.zeros(len(out), np.int64)))
        return pa.table([*keys.columns, *made.columns], names=[*keys.column_names, *names])

    names = [*[f"w_{c}" for c in components], "n_positive", "n_negative", "auc", "part_changee", "n_proches"]
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("zone_id", "periode")}
    schema = ", ".join([f"{c} {k}" for c, k in kinds.items()] + [f"`{n}` {'long' if n.startswith('n_') else 'double'}" for n in names])
    return rows.groupBy("zone_id", "periode").applyInArrow(sweep, schema)


def seasonal_extremes(
    df: DataFrame, station: str, date: str, value: str,
    summer: Sequence[int] = (7, 8, 9), winter: Sequence[int] = (12, 1, 2, 3),
) -> DataFrame:
    """Summer minimum, winter maximum and their difference per station and year, in long form
    (mesure, value); the winter of December belongs to the next year."""
    m = F.month(date)
    year = F.year(date) + F.when(m == 12, 1).otherwise(0)
    wide = df.groupBy(station, year.alias("year")).agg(
        F.min(F.when(m.isin(list(summer)), F.col(value))).alias("_low"),
        F.max(F.when(m.isin(list(winter)), F.col(value))).alias("_high"),
    )
    cells = F.array(
        F.struct(F.lit("minimum_ete").alias("mesure"), F.col("_low").alias("value")),
        F.struct(F.lit("maximum_hiver").alias("mesure"), F.col("_high").alias("value")),
        F.struct(F.lit("amplitude").alias("mesure"), (F.col("_high") - F.col("_low")).alias("value")),
    )
    return (
        wide.select(station, "year", F.explode(cells).alias("_c"))
        .select(station, "year", "_c.*")
        .where(F.col("value").isNotNull())
    )


def class_share_by_period(
    indices: DataFrame, span: int = 10, season: tuple[int, int] = (27, 39)
) -> DataFrame:
    """Share of class 1 per zone and period of `span` years, and share of classes 1-2 in a season
    per zone and year (kind `saison`)."""
    year, week = cal.label_year(F.col("semaine")), cal.label_number(F.col("semaine"))
    first = (F.floor((year - 1) / span) * span + 1).cast("int")
    periods = indices.groupBy("zone_id", first.alias("debut")).agg(
        F.avg((F.col("classe") == 1).cast("int")).alias("part"), F.count("*").alias("n")
    )
    seasons = (
        indices.where(week.between(*season))
        .groupBy("zone_id", year.alias("debut"))
        .agg(F.avg((F.col("classe") <= 2).cast("int")).alias("part"), F.count("*").alias("n"))
    )
    return periods.withColumn("genre", F.lit("periode")).unionByName(
        seasons.withColumn("genre", F.lit("saison"))
    )


def ratio_to_normal(df: DataFrame, station: str, date: str, value: str) -> DataFrame:
    """Month mean over the mean of that month in all years, its rank among the years (0 to 1) and
    whether it is under one half. The windows hold one row per year."""
    monthly = df.groupBy(
        station, F.year(date).alias("annee"), F.month(date).alias("mois")
    ).agg(F.avg(value).alias("moyenne"))
    years = Window.partitionBy(station, "mois")
    return (
        monthly.withColumn("rapport", F.col("moyenne") / F.nullif(F.avg("moyenne").over(years), F.lit(0.0)))
        .withColumn("rang", F.percent_rank().over(years.orderBy("rapport")))
        .withColumn("sous_moitie", F.col("rapport") < 0.5)
    )


def _neighbours(df: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Previous and next value of weekly readings; a key has one row per week."""
    order = Window.partitionBy(key).orderBy(date)
    return df.withColumn("_prev", F.lag(value).over(order)).withColumn(
        "_next", F.lead(value).over(order)
    )


def isolated_outliers(
    df: DataFrame, key: str, date: str, value: str, jump: float = 20.0, agree: float = 10.0
) -> DataFrame:
    """Readings more than `jump` away from both neighbours, which agree within `agree`: flag
    `isole` and `corrige`, the value or the mean of the neighbours."""
    rows = _neighbours(df, key, date, value)
    v, p, n = F.col(value), F.col("_prev"), F.col("_next")
    alone = F.coalesce(
        (F.abs(v - p) > jump) & (F.abs(v - n) > jump) & (F.abs(p - n) <= agree), F.lit(False)
    )
    return rows.withColumn("isole", alone).withColumn(
        "corrige", F.when(alone, (p + n) / 2).otherwise(v)
    ).drop("_prev", "_next")


def outlier_effect(flagged: DataFrame, date: str, value: str) -> DataFrame:
    """Weekly totals before and after the correction, of the weeks it changes."""
    week = cal.iso_week_label(F.col(date)).alias("semaine")
    return (
        flagged.groupBy(week)
        .agg(
            F.sum(value).alias("brut"), F.sum("corrige").alias("corrige"),
            F.count_if("isole").alias("n_isoles"),
        )
        .where(F.col("n_isoles") > 0)
    )


def plateaus(df: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Share of readings that repeat the previous one and longest run of equal readings, per key."""
    order = Window.partitionBy(key).orderBy(date)
    same = (F.col(value) == F.lag(value).over(order)).cast("int")
    rows = df.withColumn("_same", F.coalesce(same, F.lit(0))).withColumn(
        "_run", F.sum(1 - F.col("_same")).over(order)
    )
    runs = rows.groupBy(key, "_run").agg(F.count("*").alias("_len"), F.sum("_same").alias("_rep"))
    return runs.groupBy(key).agg(
        (F.sum("_rep") / F.sum("_len")).alias("part_repetee"), F.max("_len").alias("plus_longue")
    )


def change_profile(df: DataFrame, key: str, date: str, value: str, jump: float = 10.0) -> DataFrame:
    """Per key: median weekly change, changes above `jump`, those cancelled the next week (back
    within half of it), and those between November and April."""
    rows = _neighbours(df, key, date, value).where(F.col("_prev").isNotNull())
    change = F.col(value) - F.col("_prev")
    big = F.abs(change) > jump
    back = big & F.coalesce(F.abs(F.col("_next") - F.col("_prev")) <= F.abs(change) / 2, F.lit(False))
    return rows.groupBy(key).agg(
        F.count("*").alias("n"),
        F.median(F.abs(change)).alias("variation_mediane"),
        F.count_if(big).alias("n_fortes"),
        F.count_if(back).alias("n_annulees"),
        F.count_if(big & ((F.month(date) >= 11) | (F.month(date) <= 4))).alias("n_hiver"),
    )


def extreme_association(
    events: DataFrame, series: DataFrame, week: str, flag: str, value: str, p: float = 0.9
) -> DataFrame:
    """Share of flagged rows that fall in weeks above a percentile of another weekly series, next
    to the share of all weeks. `series` has one row per week, so its percentile is one short
    list of values."""
    limit = series.agg(F.percentile(value, F.lit(p)).alias("l")).scalar()
    high = series.select(week, (F.col(value) > limit).alias("_high"))
    expected = high.agg(F.avg(F.col("_high").cast("int")).alias("e")).scalar()
    hit = F.col("_high").cast("int")
    return events.join(high, week).agg(
        F.count_if(flag).alias("n"),
        F.avg(F.when(F.col(flag), hit)).alias("part"),
        F.max(expected).alias("part_attendue"),
    )


def tie_share(samples: DataFrame, keys: Sequence[str], season: Column, value: str) -> DataFrame:
    """Share of a reference sample equal to its minimum, and to zero, per key and season."""
    rows = samples.withColumn("saison", season)
    by = [*keys, "saison"]
    low = rows.groupBy(*by).agg(F.min(value).alias("_low"))
    return rows.join(low, by).groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg((F.col(value) == F.col("_low")).cast("int")).alias("part_minimum"),
        F.avg((F.col(value) == 0).cast("int")).alias("part_zero"),
    )


def missing_weeks(df: DataFrame, key: str, date: str) -> DataFrame:
    """Weeks without a reading between the first and the last week of each key. The weeks of a key are one array,
    bounded by the calendar: only readings are shuffled, and no week that is missing. Rows without key share no week."""
    week = F.floor((F.unix_date(F.col(date).cast("date")) + 3) / 7).cast("int")  # Mondays; 1970-01-01 is a Thursday
    seen = df.select(key, week.alias("_week")).groupBy(key).agg(F.collect_set("_week").alias("_seen"))
    span = seen.where(F.size("_seen") > 0).withColumn("_all", F.sequence(F.array_min("_seen"), F.array_max("_seen")))
    left = F.when(F.col(key).isNull(), F.col("_all")).otherwise(F.array_except("_all", "_seen"))
    sunday = F.date_from_unix_date(F.col("_left") * 7 + 3)
    return span.select(key, F.explode(left).alias("_left")).select(key, cal.iso_week_label(sunday).alias("semaine"))


def capacity_exceedances(df: DataFrame, key: str, value: str, capacity: str) -> DataFrame:
    ratio = F.col(value) / F.nullif(F.col(capacity), F.lit(0))
    return df.groupBy(key).agg(
        F.count("*").alias("n"), F.count_if(ratio > 1).alias("n_depassements"),
        F.max(ratio).alias("ratio_max"),
    )


def zero_day_share(
    df: DataFrame, station: str, date: str, value: str, span: int,
    months: Sequence[int] = (7, 8, 9),
) -> DataFrame:
    """Share of the days of a season at zero, per station and period of `span` years."""
    first = (F.floor(F.year(date) / span) * span).cast("int")
    return (
        df.where(F.month(date).isin(list(months)))
        .groupBy(station, first.alias("debut"))
        .agg(F.count("*").alias("n"), F.avg((F.col(value) == 0).cast("int")).alias("part_zero"))
    )
