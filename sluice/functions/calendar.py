"""ISO weeks, winters and reference years as column expressions.

A week is the text `YYYY-Www` with its ISO year, so that text order is time order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST_REFERENCE_WEEK = 52  # week 53 uses the reference of week 52


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day).cast("int")


def iso_week_label(day: Column) -> Column:
    return F.concat(
        iso_year(day).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0")
    )


def week_monday(label: Column) -> Column:
    """Opening Monday: 4 January is always in week 1."""
    first = F.trunc(F.make_date(label_year(label), F.lit(1), F.lit(4)), "week")
    return F.date_add(first, (label_number(label) - 1) * 7)


def week_sunday(label: Column) -> Column:
    return F.date_add(week_monday(label), 6)


def label_year(label: Column) -> Column:
    return F.substring(label, 1, 4).cast("int")


def label_number(label: Column) -> Column:
    return F.substring(label, 7, 2).cast("int")


def sunday_of(day: Column) -> Column:
    """Sunday closing the ISO week of a date."""
    return F.date_add(F.trunc(day, "week"), 6)


def is_sunday(day: Column) -> Column:
    return F.weekday(day) == 6


def last_complete_week(today: Column) -> Column:
    """Week whose Sunday is strictly before `today`."""
    return iso_week_label(F.date_sub(today, F.weekday(today) + 1))


def reference_week(day: Column) -> Column:
    return F.least(F.weekofyear(day), F.lit(LAST_REFERENCE_WEEK))


def winter_label(day: Column) -> Column:
    """December of year N to March of N+1 is winter N; null outside."""
    month, year = F.month(day), F.year(day)
    return F.when(month == 12, year).when(month <= 3, year - 1)


def season_reference_year(day: Column, variant: Column | None = None) -> Column:
    """Year of the dry season a date is compared to: the same year from October on, otherwise the
    year before. A fixed reference has no year."""
    year = F.when(F.month(day) >= 10, F.year(day)).otherwise(F.year(day) - 1)
    return year if variant is None else F.when(variant != "fixed", year)


def season_complete(year: Column, today: Column, last_month: int) -> Column:
    """True once the last month of the season of `year` is over."""
    return (year < F.year(today)) | ((year == F.year(today)) & (F.month(today) > last_month))


def sunday_spine(df: DataFrame, start: str, end: str, name: str = "sunday") -> DataFrame:
    """Rows of `df` repeated for every Sunday from the week label `start` to the label `end`."""
    days = F.sequence(
        week_sunday(F.col(start)), week_sunday(F.col(end)), F.expr("interval 7 days")
    )
    return df.withColumn(name, F.explode(days))


def day_spine(
    df: DataFrame, keys: list[str], day: str, fill: dict[str, object] | None = None
) -> DataFrame:
    """One row per key and calendar day between the first and the last day of the key. Days
    without a row get nulls, or the constants in `fill`."""
    bounds = df.groupBy(*keys).agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    spine = bounds.select(
        *keys, F.explode(F.sequence("_first", "_last", F.expr("interval 1 day"))).alias(day)
    )
    full = spine.join(df, [*keys, day], "left")
    return full.fillna(fill) if fill else full


def containing_windows(day: Column, half: int) -> Column:
    """Array of (year, week, sunday) for every Sunday at most `half` days from `day`, weeks 1-52.

    This is the inverse of listing the window of every week: each row of data finds its own
    windows, so no join with a window table is needed."""
    first = F.next_day(F.date_sub(day, half + 1), "Sun")
    last = F.date_add(day, half)
    sundays = F.when(first <= last, F.sequence(first, last, F.expr("interval 7 days")))
    windows = F.transform(
        sundays,
        lambda s: F.struct(
            iso_year(s).alias("year"), F.weekofyear(s).alias("week"), s.alias("sunday")
        ),
    )
    return F.filter(windows, lambda w: w["week"] <= LAST_REFERENCE_WEEK)


def seasonal_windows(years: DataFrame, year: str, half: int) -> DataFrame:
    """For each ISO year of `years` and week 1-52: the days at most `half` days from its Sunday."""
    weeks = F.explode(F.sequence(F.lit(1), F.lit(LAST_REFERENCE_WEEK))).alias("week")
    sunday = week_sunday(
        F.concat(F.col(year), F.lit("-W"), F.lpad(F.col("week").cast("string"), 2, "0"))
    )
    return (
        years.select(year, weeks)
        .withColumn("sunday", sunday)
        .select(
            year,
            "week",
            F.explode(
                F.sequence(
                    F.date_sub("sunday", half), F.date_add("sunday", half), F.expr("interval 1 day")
                )
            ).alias("date"),
        )
    )


def year_ranges(df: DataFrame, keys: list[str], year: str) -> DataFrame:
    """Consecutive years of each key as text: `2005-2007, 2010`. The years of a key are distinct
    values of a calendar, so the array of a key is short."""
    years = F.sort_array(F.collect_set(year))
    islands = F.filter(
        F.transform(
            "_years", lambda y: F.when(~F.array_contains("_years", y - 1), y)
        ),
        lambda y: y.isNotNull(),
    )

    def render(first: Column) -> Column:
        stop = F.array_min(
            F.filter(
                "_years",
                lambda y: (y >= first) & ~F.array_contains("_years", y + 1),
            )
        )
        return F.when(stop == first, first.cast("string")).otherwise(
            F.concat_ws("-", first.cast("string"), stop.cast("string"))
        )

    return (
        df.groupBy(*keys)
        .agg(years.alias("_years"))
        .select(*keys, F.array_join(F.transform(islands, render), ", ").alias("ranges"))
    )


def zone_week_grid(
    zones: DataFrame,
    values: DataFrame,
    zone: str,
    sunday: str,
    first_year: int | Column,
    last_week: str | Column,
    fill: dict[str, object],
) -> DataFrame:
    """Every zone with every Sunday of the period; missing combinations take `fill`."""
    first = first_year if isinstance(first_year, Column) else F.lit(first_year)
    last = last_week if isinstance(last_week, Column) else F.lit(last_week)
    grid = zones.select(
        zone,
        F.concat(first.cast("string"), F.lit("-W01")).alias("_a"),
        last.alias("_b"),
    )
    grid = sunday_spine(grid, "_a", "_b", sunday).drop("_a", "_b")
    return grid.join(values, [zone, sunday], "left").fillna(fill)
