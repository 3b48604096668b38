"""Agreement of the indices with restriction orders valid over intervals."""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import calendar as cal
from sluice.functions.ranking import group_auc
from sluice.functions.text import name_key

# Severity of the levels, and the levels and classes the measures refer to.
LEVELS = {"vigilance": 1, "alerte": 2, "alerte_renforcee": 3, "crise": 4}
ALERT, CRISIS, NORMAL_CLASS = 2, 4, 4
SEASON = (18, 44)


def severity(text: Column) -> Column:
    result = F.lit(None).cast("int")
    for name, value in LEVELS.items():
        result = F.when(text == name, value).otherwise(result)
    return result


def match_by_name(orders: DataFrame, zone_names: DataFrame) -> DataFrame:
    """`zone_id` of each order from the type and the normalised name of its alert zone; null
    without a match. `orders` has type_zone_alerte and nom_zone_alerte; `zone_names` zone_id, type
    and name."""
    names = zone_names.select(
        F.col("type").alias("type_zone_alerte"), name_key(F.col("name")).alias("_key"), "zone_id"
    )
    keyed = orders.withColumn("_key", name_key(F.col("nom_zone_alerte")))
    return keyed.join(names, ["type_zone_alerte", "_key"], "left").drop("_key")


def unmatched_names(matched: DataFrame) -> DataFrame:
    """Alert zones named by orders and tied to no zone."""
    return (
        matched.where(F.col("zone_id").isNull() & F.col("nom_zone_alerte").isNotNull())
        .select("type_zone_alerte", "nom_zone_alerte")
        .distinct()
    )


def first_detailed_year(orders: DataFrame) -> DataFrame:
    """Year of the first order that lists its zones; before it the level is unknown, not 0."""
    return orders.where(F.col("nom_zone_alerte").isNotNull()).agg(
        F.year(F.min("date_debut")).alias("annee")
    )


def runs_in_force(
    intervals: DataFrame, keys: Sequence[str], first: str, last: str, rank: str, step: int = 1
) -> DataFrame:
    """Runs of days on which one interval of its key is in force: the open one of highest `rank`. The rows of
    `intervals` whose turn it is, `first` and `last` replaced by the ends of the run; a row has several runs
    when others interrupt it. `first` and `last` are dates on one grid of `step` days, both included. Rows of
    equal rank are taken in the order of their ends; rows without keys, dates or with first > last have no run.

    Intervals with the same key and ends are first reduced to the highest, before the shuffle, so a key has at
    most as many rows as the calendar has pairs of ends, and no row is spread over its days. The sweep of a key then
    takes starts in order, with a heap of the open rows."""
    keys = list(keys)
    others = [c for c in intervals.columns if c not in {*keys, first, last, rank}]
    best = (
        intervals.where(F.col(first) <= F.col(last)).dropna(subset=keys).groupBy(*keys, first, last)
        .agg(F.max(F.struct(rank, *others)).alias("_best"))
        .select(*keys, first, last, "_best.*")
    )
    ordered = best.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(rank, last, first)))
    ordered = ordered.withColumn(first, F.unix_date(first)).withColumn(last, F.unix_date(last))

    def sweep(table: pa.Table) -> pa.Table:
        table = table.sort_by([(first, "ascending")])
        starts, ends, places = (table[c].to_pylist() for c in (first, last, "_place"))
        n, i, day, heap, rows, opened, closed = len(starts), 0, 0, [], [], [], []
        while i < n or heap:
            if not heap:
                day = starts[i]
            while i < n and starts[i] <= day:
                heapq.heappush(heap, (-places[i], i))
                i += 1
            while heap and ends[heap[0][1]] < day:
                heapq.heappop(heap)
            if not heap:
                continue
            row = heap[0][1]
            until = min(ends[row], starts[i] - step) if i < n else ends[row]
            if rows and rows[-1] == row and closed[-1] == day - step:
                closed[-1] = until
            else:
                rows.append(row), opened.append(day), closed.append(until)
            day = until + step
        found = table.take(pa.array(rows, "int64"))
        for name, values in ((first, opened), (last, closed)):
            found = found.set_column(found.schema.get_field_index(name), name, pa.array(values, "int32"))
        return found

    runs = ordered.groupBy(*keys).applyInArrow(sweep, ordered.schema)
    return runs.withColumn(first, F.date_from_unix_date(first)).withColumn(last, F.date_from_unix_date(last)).drop("_place")


def weekly_level(
    matched: DataFrame, zones: DataFrame, last_week: str, first_year: Column | None = None
) -> DataFrame:
    """Level in force on each Sunday, per zone: the latest order of each alert zone (start,
    signature, id), then the highest level of the zone with the alert zones that hold it; 0 without
    an order, on the full grid of zones and Sundays.

    Orders become runs of the order in force by a sweep per alert zone; Sundays are laid on the runs, so
    what is shuffled doesn't grow with the length of an order."""
    if first_year is None:
        first_year = first_detailed_year(matched).scalar()
    end = cal.week_sunday(F.lit(last_week))
    start = cal.week_sunday(F.concat(first_year.cast("string"), F.lit("-W01")))
    rows = matched.where(F.col("zone_id").isNotNull() & F.col("niveau_gravite").isNotNull())
    last = F.least(F.coalesce("date_fin", end), end)
    orders = rows.select(
        "zone_id",
        F.concat_ws(":", "type_zone_alerte", name_key(F.col("nom_zone_alerte"))).alias("_key"),
        F.greatest(cal.sunday_of(F.col("date_debut")), start).alias("_first"),
        F.date_sub(F.next_day(last, "Sun"), 7).alias("_last"),  # the last Sunday up to the end
        F.struct("date_debut", "date_signature", "arrete_id").alias("_rank"),
        F.struct(
            severity(F.col("niveau_gravite")).alias("niveau"),
            F.concat_ws(" ", "type_zone_alerte", "nom_zone_alerte").alias("zone_alerte"),
        ).alias("_row"),
    )
    runs = runs_in_force(orders, ["zone_id", "_key"], "_first", "_last", "_rank", 7)
    in_force = runs.select("zone_id", F.explode(F.sequence("_first", "_last", F.expr("interval 7 days"))).alias("sunday"), "_row")
    per_zone = (
        in_force.groupBy("zone_id", "sunday")
        .agg(F.max("_row.niveau").alias("niveau"), F.collect_set("_row").alias("_rows"))
        .withColumn(
            "zones_alerte",
            F.array_join(
                F.array_sort(
                    F.array_distinct(
                        F.transform(
                            F.filter("_rows", lambda r: r["niveau"] == F.col("niveau")),
                            lambda r: r["zone_alerte"],
                        )
                    )
                ),
                ", ",
            ),
        )
        .drop("_rows")
    )
    grid = cal.zone_week_grid(
        zones, per_zone, "zone_id", "sunday", first_year, last_week, {"niveau": 0}
    )
    return grid.select(
        "zone_id", cal.iso_week_label(F.col("sunday")).alias("semaine"), "niveau", "zones_alerte"
    )


def assemble_validation(
    levels: DataFrame,
    composite: DataFrame,
    zone_indices: DataFrame,
    components: Sequence[str],
    season: tuple[int, int] = SEASON,
) -> DataFrame:
    """One row per zone and week of the season: level, composite value and class, and the value of
    each component (null when absent)."""
    wide = (
        zone_indices.where(F.col("indice").isin(*components))
        .groupBy("zone_id", "semaine")
        .pivot("indice", list(components))
        .agg(F.avg("valeur"))
    )
    week = F.col("semaine")
    number = cal.label_number(week)
    return (
        levels.join(composite.select("zone_id", "semaine", "valeur", "classe"), ["zone_id", "semaine"])
        .join(wide, ["zone_id", "semaine"], "left")
        .where(number.between(*season))
        .withColumn("annee", cal.label_year(week))
        .withColumn("mois", F.month(cal.week_sunday(week)))
    )


def auc_table(table: DataFrame, metrics: Mapping[str, str], threshold: int = ALERT) -> DataFrame:
    """AUC of each metric (name -> column) per zone and for all zones (zone_id `all`)."""
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("metric"), F.col(c).alias("value"))
                for n, c in metrics.items()
            ]
        )
    )
    long = table.select(
        F.explode(F.array("zone_id", F.lit("all"))).alias("zone_id"), "niveau", cells.alias("_c")
    ).select("zone_id", "niveau", "_c.*")
    return group_auc(long, ["zone_id", "metric"], "value", F.col("niveau") >= threshold)


def _share(condition: Column) -> Column:
    return F.avg(condition.cast("int"))


def yearly_agreement(table: DataFrame) -> DataFrame:
    level, klass = F.col("niveau"), F.col("classe")
    return table.groupBy("annee").agg(
        _share(level >= ALERT).alias("alerte"),
        _share(level == CRISIS).alias("crise"),
        F.avg("valeur").alias("composite"),
        _share(klass <= 2).alias("seches"),
        _share(klass >= NORMAL_CLASS).alias("normales"),
    )


def crosstab_normalised(table: DataFrame, row: str = "classe", column: str = "niveau") -> DataFrame:
    """Share of each row value among the rows of a column value, in long form, with the size of the
    column value."""
    cells = table.groupBy(row, column).agg(F.count("*").alias("n"))
    sizes = cells.groupBy(column).agg(F.sum("n").alias("effectif"))
    return cells.join(sizes, column).withColumn("part", F.col("n") / F.col("effectif"))


def contradictions(table: DataFrame) -> DataFrame:
    """Crisis weeks with a normal or wetter class: in all, per zone and per month (grouping sets);
    `n_crise` is the number of crisis weeks of the same group."""
    crisis = table.where(F.col("niveau") == CRISIS)
    hit = F.col("classe") >= NORMAL_CLASS
    return (
        crisis.groupingSets([[], [F.col("zone_id")], [F.col("mois")]], "zone_id", "mois")
        .agg(
            F.grouping_id().alias("_g"),
            F.count_if(hit).alias("n"),
            F.count("*").alias("n_crise"),
        )
        .select(
            F.when(F.col("_g") == 3, "total").when(F.col("_g") == 1, "zone").otherwise("mois").alias(
                "niveau_detail"
            ),
            "zone_id",
            "mois",
            "n",
            "n_crise",
        )
    )
