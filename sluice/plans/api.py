"""Read queries over the stored tables. Parameters become literals of the plan, never text.

Tables: zones (zone_id, libelle), stations (station_id, source, zone_id, ...), composite (zone_id,
semaine, valeur, classe, detail), zone_index and station_index (the same with indice), reservoir
(station_id, date, volume_m3, capacite_m3), campaigns (station_id, date_campagne, modalite).
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import calendar as cal
from sluice.functions.stats import CLASS_LIMITS


def fill_pct(volume: Column, capacity: Column) -> Column:
    return 100 * volume / F.nullif(capacity, F.lit(0))


def unpack_detail(table: DataFrame, fields: Sequence[str]) -> DataFrame:
    return table.select("*", *[F.col("detail")[f].alias(f) for f in fields]).drop("detail")


def zones_at_week(zones: DataFrame, composite: DataFrame, week: str) -> DataFrame:
    """All zones, with the composite of the week where there is one."""
    rows = composite.where(F.col("semaine") == week).drop("semaine")
    return zones.join(rows, "zone_id", "left").withColumn("semaine", F.lit(week))


def latest_per_key(table: DataFrame, key: str, time: str, columns: Sequence[str]) -> DataFrame:
    """Columns of the latest row of each key; an aggregate, so a busy key shuffles few rows."""
    return (
        table.groupBy(key)
        .agg(F.max_by(F.struct(*columns), time).alias("_r"))
        .select(key, "_r.*")
    )


def stations_at_week(
    stations: DataFrame,
    station_index: DataFrame,
    reservoir: DataFrame,
    campaigns: DataFrame,
    week: str,
    source: str | None = None,
) -> DataFrame:
    """All stations with their index of the week; reservoirs and campaign stations with their last
    row at or before its Sunday."""
    sunday = cal.week_sunday(F.lit(week))
    index = station_index.where(F.col("semaine") == week).drop("semaine")
    full = latest_per_key(
        reservoir.where(F.col("date") <= sunday),
        "station_id",
        "date",
        ["date", "volume_m3", "capacite_m3"],
    ).withColumnRenamed("date", "date_releve")
    state = latest_per_key(
        campaigns.where(F.col("date_campagne") <= sunday),
        "station_id",
        "date_campagne",
        ["date_campagne", "modalite"],
    )
    chosen = stations if source is None else stations.where(F.col("source") == source)
    full = full.withColumn("source", F.lit("retenue"))
    state = state.withColumn("source", F.lit("onde"))
    return (
        chosen.join(index, "station_id", "left")
        .join(full, ["station_id", "source"], "left")
        .join(state, ["station_id", "source"], "left")
        .withColumn(
            "remplissage_pct", F.round(fill_pct(F.col("volume_m3"), F.col("capacite_m3")), 1)
        )
    )


def zone_series(
    table: DataFrame, zone: str, start: str, end: str, indice: str | None = None
) -> DataFrame:
    """One zone between two weeks, in order; `indice` selects a zone index."""
    rows = table.where((F.col("zone_id") == zone) & F.col("semaine").between(start, end))
    if indice is not None:
        rows = rows.where(F.col("indice") == indice)
    return rows.orderBy("semaine")


def station_series(
    chronicles: dict[str, tuple[DataFrame, str, Column]],
    station_index: DataFrame,
    envelope: DataFrame,
    station: str,
    source: str,
    start: str,
    end: str,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(raw chronicle, weekly indices, envelope) of one station between two days. `chronicles`
    gives for each source its table, its day column and its value."""
    table, day, value = chronicles[source]
    raw = (
        table.where((F.col("station_id") == station) & F.col(day).between(start, end))
        .select(F.col(day).alias("date"), value.alias("valeur"))
        .orderBy("date")
    )
    first = cal.iso_week_label(F.lit(start).cast("date"))
    last = cal.iso_week_label(F.lit(end).cast("date"))
    weekly = station_index.where(
        (F.col("station_id") == station) & (F.col("semaine") >= first) & (F.col("semaine") <= last)
    ).orderBy("semaine")
    return raw, weekly, envelope.where(F.col("station_id") == station).orderBy("periode")


def available_weeks(composite: DataFrame) -> DataFrame:
    return composite.select("semaine").distinct().orderBy(F.desc("semaine"))


def reservoir_envelope(reservoir: DataFrame, year: int, station: str | None = None) -> DataFrame:
    """Per station and ISO week: minimum, median and maximum fill of the years before `year`. A
    group holds the readings of one week number, a few per year."""
    rows = reservoir if station is None else reservoir.where(F.col("station_id") == station)
    y = cal.iso_year(F.col("date"))
    fill = fill_pct(F.col("volume_m3"), F.col("capacite_m3"))
    return (
        rows.where(y < year)
        .select("station_id", F.weekofyear("date").alias("periode"), y.alias("y"), fill.alias("f"))
        .groupBy("station_id", "periode")
        .agg(
            F.min("f").alias("minimum"),
            F.median("f").alias("mediane"),
            F.max("f").alias("maximum"),
            F.count_distinct("y").alias("n_annees"),
            F.concat_ws("-", F.min("y").cast("string"), F.max("y").cast("string")).alias(
                "periode_ref"
            ),
        )
    )


def week_synthesis_composite(
    composite: DataFrame, zones: DataFrame, week: str
) -> tuple[DataFrame, DataFrame]:
    """(zones of a week from the driest, one row per class with its number of zones and the number
    in classes 1 and 2)."""
    rows = composite.where(F.col("semaine") == week)
    listed = rows.join(zones.select("zone_id", "libelle"), "zone_id").orderBy("valeur")
    dry = rows.agg(F.count_if(F.col("classe") <= 2).alias("d"))
    histogram = (
        rows.groupBy("classe").agg(F.count("*").alias("n")).withColumn("zones_seches", dry.scalar())
    )
    return listed, histogram


def week_synthesis_stations(station_index: DataFrame, week: str) -> DataFrame:
    """Per index: stations, those in the composite, and the class histogram as a map."""
    per_class = (
        station_index.where(F.col("semaine") == week)
        .groupBy("indice", "classe")
        .agg(F.count("*").alias("n"), F.count_if("dans_composite").alias("au_composite"))
    )
    return per_class.groupBy("indice").agg(
        F.sum("n").alias("n"),
        F.sum("au_composite").alias("au_composite"),
        F.map_from_entries(
            F.sort_array(F.collect_list(F.struct(F.col("classe").cast("string").alias("k"), "n")))
        ).alias("repartition"),
    )


def latest_per_zone_in_year(
    zone_index: DataFrame, week: str, columns: Sequence[str], indice: str = "onde"
) -> DataFrame:
    """Latest campaign of each zone at or before a week, in the same year."""
    rows = zone_index.where(
        (F.col("indice") == indice)
        & (F.col("semaine") <= week)
        & (F.substring("semaine", 1, 4) == week[:4])
    )
    return latest_per_key(rows, "zone_id", "semaine", ["semaine", *columns])


def reservoir_total(reservoir: DataFrame, week: str) -> DataFrame:
    """One row: totals of a week next to the extremes of the same week in earlier years."""
    year, number = int(week[:4]), int(week[6:])
    weekly = (
        reservoir.groupBy(
            cal.iso_year(F.col("date")).alias("y"), F.weekofyear("date").alias("w")
        )
        .agg(
            F.sum("volume_m3").alias("volume_m3"),
            F.sum("capacite_m3").alias("capacite_m3"),
            F.count("*").alias("n_retenues"),
            F.max("date").alias("date"),
        )
        .where(F.col("w") == number)
        .withColumn("fill", fill_pct(F.col("volume_m3"), F.col("capacite_m3")))
    )
    earlier = weekly.where(F.col("y") < year).agg(
        F.struct(
            F.round(F.min("fill"), 1).alias("minimum"),
            F.round(F.median("fill"), 1).alias("mediane"),
            F.round(F.max("fill"), 1).alias("maximum"),
            F.concat_ws("-", F.min("y").cast("string"), F.max("y").cast("string")).alias(
                "periode_ref"
            ),
        ).alias("e")
    )
    return weekly.where(F.col("y") == year).select(
        "volume_m3",
        "capacite_m3",
        "n_retenues",
        "date",
        F.round("fill", 1).alias("remplissage_pct"),
        earlier.scalar().alias("_e"),
    ).select("volume_m3", "capacite_m3", "n_retenues", "date", "remplissage_pct", "_e.*")


def incomplete_year(composite: DataFrame) -> Column:
    """Year of the last week when that week is not the last of its ISO year, else null."""
    last = composite.agg(F.max("semaine").alias("m")).select(
        F.when(
            cal.label_number(F.col("m"))
            < F.weekofyear(F.make_date(cal.label_year(F.col("m")), F.lit(12), F.lit(28))),
            cal.label_year(F.col("m")),
        ).alias("y")
    )
    return last.scalar()


def recurrence(composite: DataFrame, zones: DataFrame) -> DataFrame:
    """Per zone and ISO year: weeks, weeks in class 1 and in classes 1-2, partial weeks, reference;
    next to the shares expected on the reference scale."""
    expected = [round(NormalDist().cdf(x), 4) for x in CLASS_LIMITS[:2]]
    return (
        composite.join(zones.select("zone_id", "libelle"), "zone_id")
        .groupBy("zone_id", "libelle", cal.label_year(F.col("semaine")).alias("annee"))
        .agg(
            F.count("*").alias("n_semaines"),
            F.count_if(F.col("classe") == 1).alias("n_classe_1"),
            F.count_if(F.col("classe") <= 2).alias("n_classes_1_2"),
            F.count_if(F.col("detail.partiel")).alias("n_partielles"),
            F.max("detail.reference").alias("reference"),
        )
        .withColumn("part_attendue_1", F.lit(expected[0]))
        .withColumn("part_attendue_1_2", F.lit(expected[1]))
        .withColumn("annee_incomplete", incomplete_year(composite))
    )


def recurrence_share(table: DataFrame, years: int = 10) -> DataFrame:
    """Percentage of weeks in class 1 per zone and year, the mean of the zones per year (scope
    `all`), and the trailing mean of the last `years` points without the incomplete year; null
    before `years` points and on the incomplete year. A scope holds one row per year."""
    part = 100 * F.col("n_classe_1") / F.col("n_semaines")
    zones = table.select(F.col("zone_id").alias("scope"), "annee", part.alias("part"), "annee_incomplete")
    everything = zones.groupBy("annee", "annee_incomplete").agg(F.avg("part").alias("part")).select(
        F.lit("all").alias("scope"), "annee", "part", "annee_incomplete"
    )
    order = Window.partitionBy("scope").orderBy("annee")
    complete = ~F.col("annee").eqNullSafe(F.col("annee_incomplete"))
    trailing = F.avg(F.when(complete, F.col("part"))).over(order.rowsBetween(-(years - 1), 0))
    return (
        zones.unionByName(everything)
        .withColumn("_i", F.row_number().over(order))
        .withColumn("moyenne", F.when((F.col("_i") >= years) & complete, trailing))
        .drop("_i", "annee_incomplete")
    )


def envelope_on_dates(chronicle: DataFrame, envelope: DataFrame) -> DataFrame:
    """Envelope of each station on the days of its chronicle, by month or reference week."""
    day = F.col("date")
    steps = chronicle.select(
        "station_id",
        "date",
        F.explode(
            F.array(
                F.struct(F.lit("mois").alias("pas"), F.month(day).alias("periode")),
                F.struct(F.lit("semaine").alias("pas"), cal.reference_week(day).alias("periode")),
            )
        ).alias("_p"),
    ).select("station_id", "date", "_p.*")
    return steps.join(
        envelope.select("station_id", "pas", "periode", "indice", "minimum", "mediane", "maximum"),
        ["station_id", "pas", "periode"],
    )
