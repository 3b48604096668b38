"""Frozen reference samples ("normals") and breaks.

Series arrive as one row per key and day, so the rows of a key are bounded by the calendar; arrays
collected below hold at most a few values per year of one key.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import calendar as cal
from sluice.functions import stats
from sluice.functions.ranking import sorted_median


@dataclass(frozen=True)
class ReferencePeriod:
    """Years of the reference and the minimum of valid ones; `freeze` is the last year a fallback
    reference may use, `after_break` the minimum of years after a break."""

    start: int
    end: int
    minimum: int = 1
    freeze: int | None = None
    after_break: int | None = None


def select_years(
    valid: Column,
    period: ReferencePeriod,
    break_year: Column | None = None,
    break_minimum: Column | None = None,
) -> Column:
    """Struct (years, period_ref, off_reference) from the sorted array of valid years.

    Years of the reference period when there are enough of them. Otherwise the frozen fallback:
    the years up to `freeze` if enough, else the first `minimum` years. After a break only later
    years count, with their own minimum, and the result is always flagged. No years: empty."""
    none = F.array().cast("array<int>")

    def frozen(years: Column, minimum: Column) -> Column:
        early = years if period.freeze is None else F.filter(years, lambda y: y <= period.freeze)
        return (
            F.when(F.size(early) >= minimum, early)
            .when(F.size(years) >= minimum, F.slice(years, F.lit(1), minimum))
            .otherwise(none)
        )

    inside = F.filter(valid, lambda y: (y >= period.start) & (y <= period.end))
    enough = F.size(inside) >= period.minimum
    years = F.when(enough, inside).otherwise(frozen(valid, F.lit(period.minimum)))
    off = ~enough
    if break_year is not None:
        after_minimum = F.lit(period.after_break or period.minimum)
        if break_minimum is not None:
            after_minimum = F.coalesce(break_minimum, after_minimum)
        later = F.filter(valid, lambda y: y >= break_year)
        years = F.when(break_year.isNotNull(), frozen(later, after_minimum)).otherwise(years)
        off = F.when(break_year.isNotNull(), F.lit(True)).otherwise(off)
    text = F.when(~off, F.lit(f"{period.start}-{period.end}")).otherwise(
        F.coalesce(
            F.concat_ws(
                "-",
                F.try_element_at(years, F.lit(1)).cast("string"),
                F.try_element_at(years, F.lit(-1)).cast("string"),
            ),
            F.lit(""),
        )
    )
    return F.struct(years.alias("years"), text.alias("period_ref"), off.alias("off_reference"))


def _distinct_years(rows: str) -> Column:
    return F.sort_array(F.array_distinct(F.transform(rows, lambda r: r["year"])))


def _with_choice(
    grouped: DataFrame,
    valid: Column,
    period: ReferencePeriod,
    breaks: DataFrame | None,
    station: str,
) -> DataFrame:
    """Add `_choice`, and keep the groups that have a reference."""
    break_year = break_minimum = None
    if breaks is not None:
        grouped = grouped.join(
            breaks.select(station, "break_year", "break_minimum"), station, "left"
        )
        break_year, break_minimum = F.col("break_year"), F.col("break_minimum")
    else:
        grouped = grouped.withColumn("break_year", F.lit(None).cast("int"))
    chosen = grouped.withColumn("_valid", valid)
    chosen = chosen.withColumn(
        "_choice", select_years(F.col("_valid"), period, break_year, break_minimum)
    )
    return chosen.where(F.size("_choice.years") > 0)


def break_years(
    stations: DataFrame, zone_regimes: DataFrame, station_breaks: DataFrame, source: str = "piezo"
) -> DataFrame:
    """station_id, break_year, break_minimum: the regime of the zone for stations of one source,
    overridden by the break of the station itself.

    `stations` has station_id, source, zone_id; `zone_regimes` zone_id, year; `station_breaks`
    station_id, year, minimum."""
    by_zone = (
        stations.where(F.col("source") == source)
        .join(zone_regimes.select("zone_id", F.col("year").alias("_zone_year")), "zone_id")
        .select("station_id", "_zone_year")
    )
    own = station_breaks.select(
        "station_id", F.col("year").alias("_own_year"), F.col("minimum").alias("break_minimum")
    )
    return by_zone.join(own, "station_id", "full").select(
        "station_id", F.coalesce("_own_year", "_zone_year").alias("break_year"), "break_minimum"
    )


def cell_zone_weights(overlaps: DataFrame, zone: str, cell: str, surface: str) -> DataFrame:
    """Share of each cell in its zone; shares sum to 1 per zone. Totals are joined back rather
    than windowed, so a very large zone is never one task."""
    shares = overlaps.groupBy(zone, cell).agg(F.sum(surface).alias("_surface"))
    totals = overlaps.groupBy(zone).agg(F.sum(surface).alias("_total"))
    return shares.join(totals, zone).select(
        zone, cell, (F.col("_surface") / F.col("_total")).alias("weight")
    )


def zone_rain(
    observations: DataFrame, weights: DataFrame, zone: str, cell: str, date: str, value: str
) -> DataFrame:
    """Daily zone value: sum of cell values times weights. Missing cells are skipped and the
    weights are not renormalised. The pivoted form is `zone_rain(...).groupBy(date).pivot(zone)`.
    """
    part = F.col(value) * F.col("weight")
    return (
        observations.join(weights, cell)
        .groupBy(zone, date)
        .agg(F.coalesce(F.sum(part), F.lit(0.0)).alias(value))
    )


def rolling_sum_full(
    df: DataFrame, keys: Sequence[str], date: str, value: str, windows: Mapping[str, int]
) -> DataFrame:
    """Totals over the last N days, on Sundays, only where all N days have a value: keys, date,
    indice, total. All windows share one sort; absent days simply lower the count, so no day spine
    is built. `df` has at most one row per key and day."""
    keys = list(keys)
    day = F.unix_date(F.col(date))
    cells = []
    rows = df.withColumn("_day", day)
    for name, days in windows.items():
        frame = Window.partitionBy(*keys).orderBy("_day").rangeBetween(-(days - 1), 0)
        rows = rows.withColumn(f"_s_{name}", F.sum(value).over(frame)).withColumn(
            f"_n_{name}", F.count(value).over(frame)
        )
        cells.append(
            F.struct(
                F.lit(name).alias("indice"),
                F.when(F.col(f"_n_{name}") == days, F.col(f"_s_{name}")).alias("total"),
            )
        )
    return (
        rows.where(cal.is_sunday(F.col(date)))
        .select(*keys, date, F.explode(F.array(*cells)).alias("_cell"))
        .select(*keys, date, "_cell.*")
        .where(F.col("total").isNotNull())
    )


def fit_gamma(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, forme, echelle, q0 of a gamma law with location 0 fitted on the positive values; q0 is
    the share of the others. Only sums are shuffled. A sample without two distinct positive values
    has no fit: null parameters."""
    positive = F.when(F.col(value) > 0, F.col(value))
    sums = df.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        F.count(positive).alias("_p"),
        F.avg(positive).alias("_mean"),
        F.avg(F.ln(positive)).alias("_log"),
    )
    shaped = sums.withColumn("forme", stats.gamma_shape(F.col("_mean"), F.col("_log")))
    return shaped.select(
        *keys,
        "forme",
        (F.col("_mean") / F.col("forme")).alias("echelle"),
        (1 - F.col("_p") / F.col("_n")).alias("q0"),
    )


def spi_normals(totals: DataFrame, zone: str, date: str, period: ReferencePeriod) -> DataFrame:
    """Gamma parameters per zone, window and reference week, from the totals of
    `rolling_sum_full`. One grouping: years, sample and sums come from the same array."""
    rows = totals.select(
        zone,
        "indice",
        cal.reference_week(F.col(date)).alias("semaine"),
        F.struct(cal.iso_year(F.col(date)).alias("year"), F.col("total").alias("v")).alias("_r"),
    )
    grouped = rows.groupBy(zone, "indice", "semaine").agg(
        F.sort_array(F.collect_list("_r")).alias("_rows")
    )
    chosen = _with_choice(grouped, _distinct_years("_rows"), period, None, zone)
    kept = F.transform(
        F.filter("_rows", lambda r: F.array_contains("_choice.years", r["year"])), lambda r: r["v"]
    )
    chosen = chosen.withColumn("_sample", kept).withColumn(
        "_positive", F.filter("_sample", lambda v: v > 0)
    )
    count = F.size("_positive")

    def mean_of(transform) -> Column:
        total = F.aggregate("_positive", F.lit(0.0), lambda a, v: a + transform(v))
        return F.when(count > 0, total / count)

    shaped = chosen.withColumn("_mean", mean_of(lambda v: v)).withColumn(
        "_log", mean_of(lambda v: F.ln(v))
    )
    shaped = shaped.withColumn("forme", stats.gamma_shape(F.col("_mean"), F.col("_log")))
    return shaped.select(
        zone,
        "indice",
        "semaine",
        "forme",
        (F.col("_mean") / F.col("forme")).alias("echelle"),
        (1 - count / F.size("_sample")).alias("q0"),
        F.size("_choice.years").alias("n_annees"),
        F.col("_choice.period_ref").alias("periode_ref"),
        F.col("_choice.off_reference").alias("hors_reference"),
    )


def monthly_means(
    df: DataFrame, station: str, date: str, value: str, days_min: int = 10
) -> DataFrame:
    """station, annee, mois, moyenne, n_jours and the last day read, months below `days_min` days
    dropped."""
    day = F.col(date)
    return (
        df.groupBy(station, F.year(day).alias("annee"), F.month(day).alias("mois"))
        .agg(
            F.avg(value).alias("moyenne"),
            F.count("*").alias("n_jours"),
            F.max(day).alias("derniere"),
        )
        .where(F.col("n_jours") >= days_min)
    )


def groundwater_normals(
    monthly: DataFrame, station: str, period: ReferencePeriod, breaks: DataFrame | None = None
) -> DataFrame:
    """Sorted sample of monthly means per station and calendar month, over the selected years."""
    row = F.struct(F.col("annee").alias("year"), F.col("moyenne").alias("v"))
    grouped = monthly.groupBy(station, "mois").agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    chosen = _with_choice(grouped, _distinct_years("_rows"), period, breaks, station)
    sample = F.sort_array(
        F.transform(
            F.filter("_rows", lambda r: F.array_contains("_choice.years", r["year"])),
            lambda r: r["v"],
        )
    )
    return chosen.select(
        station,
        "mois",
        sample.alias("valeurs_ref"),
        F.size("_choice.years").alias("n_annees"),
        F.col("_choice.period_ref").alias("periode_ref"),
        F.col("_choice.off_reference").alias("hors_reference"),
        F.col("break_year").alias("rupture"),
    )


def splice_series(
    df: DataFrame, station: str, date: str, value: str, splices: DataFrame
) -> DataFrame:
    """Gauges that succeed each other on a site become one series, carried by the first of them.
    For each day the first gauge with a value wins. `splices` has station, site and priority."""
    members = splices.select(F.col("station").alias(station), "site", "priority")
    tagged = df.where(F.col(value).isNotNull()).join(members, station, "left")
    return (
        tagged.withColumn("_key", F.coalesce("site", station))
        .groupBy(F.col("_key").alias(station), date)
        .agg(F.min_by(value, F.coalesce("priority", F.lit(0))).alias(value))
    )


def rolling_mean_min(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    value: str,
    days: int = 7,
    minimum: int = 5,
    name: str = "q7",
) -> DataFrame:
    """Mean of the last `days` days, on every calendar day from the first to the last reading of
    the key (days without a reading included), where at least `minimum` days have a value. Also
    gives the day of the last reading used."""
    keys = list(keys)
    spine = cal.day_spine(df.select(*keys, date, value), keys, date)
    frame = Window.partitionBy(*keys).orderBy("_day").rangeBetween(-(days - 1), 0)
    read = F.when(F.col(value).isNotNull(), F.col(date))
    return (
        spine.withColumn("_day", F.unix_date(F.col(date)))
        .select(
            *keys,
            date,
            (F.sum(value).over(frame) / F.count(value).over(frame)).alias(name),
            F.count(value).over(frame).alias("_n"),
            F.max(read).over(frame).alias("date_mesure"),
        )
        .where(F.col("_n") >= minimum)
        .drop("_n")
    )


def flow_normals(
    rolling: DataFrame,
    station: str,
    date: str,
    value: str,
    period: ReferencePeriod,
    half: int = 15,
    share: float = 0.5,
    breaks: DataFrame | None = None,
) -> DataFrame:
    """Sorted sample per station and week 1-52: values of the days at most `half` days from the
    Sunday of the week, over the selected years. A year is valid when at least `share` of its
    window has a value."""
    minimum = math.ceil((2 * half + 1) * share)
    days = rolling.select(
        station, F.col(value).alias("v"), F.explode(cal.containing_windows(F.col(date), half)).alias("w")
    )
    per_year = days.groupBy(
        station, F.col("w.week").alias("semaine"), F.col("w.year").alias("year")
    ).agg(F.collect_list("v").alias("v"))
    # years observed only: the ends of the data reach into the windows of the years next to them
    year = F.year(date)
    span = rolling.agg(F.min(year).alias("a"), F.max(year).alias("b"))
    per_year = per_year.where(
        (F.col("year") >= span.select("a").scalar()) & (F.col("year") <= span.select("b").scalar())
    )
    valid = per_year.where(F.size("v") >= minimum)
    grouped = valid.groupBy(station, "semaine").agg(
        F.sort_array(F.collect_list(F.struct("year", "v"))).alias("_rows")
    )
    chosen = _with_choice(grouped, _distinct_years("_rows"), period, breaks, station)
    sample = F.sort_array(
        F.flatten(
            F.transform(
                F.filter("_rows", lambda r: F.array_contains("_choice.years", r["year"])),
                lambda r: r["v"],
            )
        )
    )
    return chosen.select(
        station,
        "semaine",
        sample.alias("valeurs_ref"),
        F.size("_choice.years").alias("n_annees"),
        F.col("_choice.period_ref").alias("periode_ref"),
        F.col("_choice.off_reference").alias("hors_reference"),
        F.col("break_year").alias("rupture"),
    )


def rank_reference(
    values: DataFrame, keys: Sequence[str], period: ReferencePeriod, weeks_min: int = 26
) -> DataFrame:
    """Sorted sample of weekly values per key (zone and index). `values` has semaine and valeur; a
    year is valid with at least `weeks_min` non-null weeks."""
    keys = list(keys)
    known = values.where(F.col("valeur").isNotNull())
    per_year = known.groupBy(*keys, cal.label_year(F.col("semaine")).alias("year")).agg(
        F.collect_list("valeur").alias("v")
    )
    grouped = (
        per_year.where(F.size("v") >= weeks_min)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("year", "v"))).alias("_rows"))
    )
    chosen = _with_choice(grouped, _distinct_years("_rows"), period, None, keys[0])
    sample = F.sort_array(
        F.flatten(
            F.transform(
                F.filter("_rows", lambda r: F.array_contains("_choice.years", r["year"])),
                lambda r: r["v"],
            )
        )
    )
    return chosen.select(
        *keys,
        sample.alias("valeurs_ref"),
        F.col("_choice.period_ref").alias("periode_ref"),
        F.col("_choice.off_reference").alias("hors_reference"),
    ).withColumn("n_semaines", F.size("valeurs_ref"))


def composite_reference(
    composites: DataFrame, regime_zones: DataFrame, period: ReferencePeriod, weeks_min: int = 26
) -> DataFrame:
    """`rank_reference` of the composite. Zones listed in `regime_zones` use their complete weeks
    only, or all weeks when those are too few."""
    marked = composites.join(
        regime_zones.select("zone_id").distinct().withColumn("_regime", F.lit(True)),
        "zone_id",
        "left",
    )
    usable = marked.where(F.col("_regime").isNull() | ~F.col("partiel"))
    first = rank_reference(usable, ["zone_id"], period, weeks_min)
    rest = composites.join(first.select("zone_id"), "zone_id", "left_anti")
    return first.unionByName(rank_reference(rest, ["zone_id"], period, weeks_min))


def envelope(normals: DataFrame, station: str, indice: str, step: str, column: str) -> DataFrame:
    """Minimum, median and maximum of each reference sample."""
    return normals.select(
        station,
        F.lit(indice).alias("indice"),
        F.lit(step).alias("pas"),
        F.col(column).alias("periode"),
        F.array_min("valeurs_ref").alias("minimum"),
        sorted_median(F.col("valeurs_ref")).alias("mediane"),
        F.array_max("valeurs_ref").alias("maximum"),
        "n_annees",
        "periode_ref",
        "hors_reference",
    )


def yearly_levels(monthly: DataFrame, station: str, months_min: int = 10) -> DataFrame:
    """Mean of the monthly means of the years with enough valid months."""
    return (
        monthly.groupBy(station, F.col("annee").alias("year"))
        .agg(F.avg("moyenne").alias("value"), F.count("*").alias("_n"))
        .where(F.col("_n") >= months_min)
        .drop("_n")
    )


def yearly_log_flows(
    df: DataFrame, station: str, date: str, value: str, days_min: int = 330, floor: float = 1.0
) -> DataFrame:
    """Logarithm of the yearly mean flow (at least `floor`) of the years with enough days."""
    return (
        df.groupBy(station, F.year(date).alias("year"))
        .agg(F.avg(value).alias("_mean"), F.count("*").alias("_n"))
        .where(F.col("_n") >= days_min)
        .select(station, "year", F.ln(F.greatest("_mean", F.lit(floor))).alias("value"))
    )


def pettitt_breaks(
    yearly: DataFrame,
    keys: Sequence[str],
    ratio: bool = False,
    years_min: int = 15,
    significance: float = 0.01,
) -> DataFrame:
    """Pettitt test on yearly values (`year`, `value`), one row per key with enough years.

    The statistic at year t compares all pairs before and after t. It equals the running sum of
    n + 1 - 2 x rank, so two windows over the years of a key replace the pairs."""
    keys = list(keys)
    by_key = Window.partitionBy(*keys)
    to_now = by_key.orderBy("year").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        yearly.withColumn("_n", F.count("*").over(by_key))
        .where(F.col("_n") >= years_min)
        .withColumn("_less", F.rank().over(by_key.orderBy("value")) - 1)
        .withColumn("_same", F.count("*").over(Window.partitionBy(*keys, "value")))
    )
    twice_rank = 2 * F.col("_less") + F.col("_same") + 1
    steps = (
        ranked.withColumn("_term", F.col("_n") + 1 - twice_rank)
        .withColumn("_u", F.abs(F.sum("_term").over(to_now)))
        .withColumn("_t", F.count("*").over(to_now))
        .withColumn("_sum", F.sum("value").over(to_now))
        .withColumn("_total", F.sum("value").over(by_key))
        .withColumn("_after", F.lead("year").over(by_key.orderBy("year")))
    )
    best = F.max(
        F.when(
            F.col("_t") < F.col("_n"),
            F.struct(
                F.col("_u").alias("u"), (-F.col("_t")).alias("t"), F.col("_after").alias("year"),
                F.col("_sum").alias("sum"),
            ),
        )
    )
    found = steps.groupBy(*keys).agg(
        F.first("_n").alias("n_annees"),
        F.min("year").alias("premiere_annee"),
        F.max("year").alias("derniere_annee"),
        F.max("_total").alias("_total"),
        best.alias("_b"),
    )
    n = F.col("n_annees").cast("double")
    t = -F.col("_b.t")
    gap = (F.col("_total") - F.col("_b.sum")) / (n - t) - F.col("_b.sum") / t
    p = F.least(
        F.lit(1.0), 2 * F.exp(-6 * F.col("_b.u") * F.col("_b.u") / (n * n * n + n * n))
    )
    return found.select(
        *keys,
        "premiere_annee",
        "derniere_annee",
        "n_annees",
        F.col("_b.year").alias("annee_rupture"),
        F.col("_b.u").alias("k"),
        p.alias("p_valeur"),
        (F.exp(gap) if ratio else gap).alias("ecart"),
        (p < significance).alias("significative"),
    )


def break_report(tests: DataFrame, treated: DataFrame, station: str = "station_id") -> DataFrame:
    """Breaks with the flag of those already treated."""
    known = treated.select(station).distinct().withColumn("traitee", F.lit(True))
    return tests.join(known, station, "left").fillna({"traitee": False})
