"""Weekly standardised indices of stations and zones, and the composite."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import calendar as cal
from sluice.functions import stats
from sluice.functions.text import detail_json

# Sums of decimals do not depend on the order of rows; 12 digits also keep equal ranks equal, so
# that ties between weeks survive the mean.
EXACT = "decimal(28,12)"


def exact_mean(value: Column) -> Column:
    """Mean of bounded values (indices) that is the same whatever the order of rows."""
    return F.sum(value.cast(EXACT)).cast("double") / F.count(value)


def rank_z(df: DataFrame, value: str, sample: str, name: str = "valeur") -> DataFrame:
    """Normal quantile of the rank of `value` in the sorted array `sample`."""
    return (
        df.withColumn("_p", stats.sample_probability(F.col(value), F.col(sample)))
        .withColumn(name, stats.probit(F.col("_p")))
        .drop("_p")
    )


def gamma_z(
    df: DataFrame, value: str, shape: str, scale: str, zero_share: str, name: str = "valeur"
) -> DataFrame:
    """Normal quantile of the mixed gamma law, clipped."""
    cdf = stats.gamma_cdf(F.col(value), F.col(shape), F.col(scale))
    q0 = F.col(zero_share)
    return (
        df.withColumn("_cdf", cdf)
        .withColumn("_p", q0 + (1 - q0) * F.col("_cdf"))
        .withColumn(name, stats.clip(stats.probit(F.col("_p"))))
        .drop("_cdf", "_p")
    )


def regime_filter(df: DataFrame, date: str, break_year: str) -> DataFrame:
    """Rows without a break, or measured from the year of the break on."""
    return df.where(F.col(break_year).isNull() | (F.year(date) >= F.col(break_year)))


def running_month(df: DataFrame, station: str, date: str, value: str) -> DataFrame:
    """For each station and Sunday: mean, number of days and last day of the readings of the
    Sunday's month up to it. Each reading goes to the Sundays left in its month (five at most), so
    one grouping replaces cumulative windows and an as-of join."""
    day = F.col(date)
    first = cal.sunday_of(day)
    left = F.when(
        first <= F.last_day(day), F.sequence(first, F.last_day(day), F.expr("interval 7 days"))
    )
    return (
        df.where(F.col(value).isNotNull())
        .select(station, day.alias("_d"), F.col(value).alias("_v"), F.explode(left).alias("sunday"))
        .groupBy(station, "sunday")
        .agg(
            F.avg("_v").alias("moyenne"),
            F.count("*").alias("n_jours"),
            F.max("_d").alias("date_mesure"),
        )
    )


def previous_valid_month(
    monthly: DataFrame, station: str, age_max: int, until: Column | None = None
) -> DataFrame:
    """For each station and Sunday: the last valid month that ended before the Sunday's month.

    A valid month serves the Sundays from the next month to the end of the following valid month;
    beyond `age_max` days after its last reading it serves none. `monthly` is `monthly_means`."""
    end = F.last_day(F.make_date("annee", "mois", F.lit(1)))
    order = Window.partitionBy(station).orderBy("_end")
    spans = monthly.withColumn("_end", end).withColumn("_next", F.lead("_end").over(order))
    first = cal.sunday_of(F.date_add("_end", 1))
    last = F.least(
        F.coalesce("_next", F.date_add("derniere", age_max)), F.date_add("derniere", age_max)
    )
    if until is not None:
        last = F.least(last, until)
    served = F.when(first <= last, F.sequence(first, last, F.expr("interval 7 days")))
    return spans.select(
        station,
        F.explode(served).alias("sunday"),
        "moyenne",
        F.col("derniere").alias("date_mesure"),
        "mois",
    )


def groundwater_index(
    daily: DataFrame,
    normals: DataFrame,
    station: str,
    date: str,
    value: str,
    start: Column,
    end: Column,
    days_min: int = 10,
    age_max: int = 365,
    fresh_days: int = 45,
) -> DataFrame:
    """Weekly groundwater index of the Sundays from `start` to `end`: the running month when it has
    enough days, else the last valid month, ranked in the sample of the same month."""
    from sluice.operators.reference import monthly_means

    known = daily.where(F.col(value).isNotNull()).join(
        normals.select(station).distinct(), station, "left_semi"
    )
    current = (
        running_month(known, station, date, value)
        .where(F.col("n_jours") >= days_min)
        .select(
            station, "sunday", "moyenne", "date_mesure", F.month("sunday").alias("mois"),
            F.lit(2).alias("_first"),
        )
    )
    past = previous_valid_month(
        monthly_means(known, station, date, value, days_min), station, age_max, end
    ).select(station, "sunday", "moyenne", "date_mesure", "mois", F.lit(1).alias("_first"))
    row = F.struct("moyenne", "date_mesure", "mois")
    kept = (
        current.unionByName(past)
        .where((F.col("sunday") >= start) & (F.col("sunday") <= end))
        .groupBy(station, "sunday")
        .agg(F.max_by(row, "_first").alias("_r"))
        .select(station, "sunday", "_r.*")
        .where(F.datediff("sunday", "date_mesure") <= age_max)
    )
    joined = regime_filter(kept.join(normals, [station, "mois"]), "date_mesure", "rupture")
    ranked = rank_z(joined, "moyenne", "valeurs_ref")
    return ranked.select(
        station,
        cal.iso_week_label(F.col("sunday")).alias("semaine"),
        F.lit("ips").alias("indice"),
        "valeur",
        "periode_ref",
        "hors_reference",
        "date_mesure",
        (F.datediff("sunday", "date_mesure") < fresh_days).alias("dans_composite"),
    )


def flow_index(
    rolling: DataFrame, normals: DataFrame, station: str, date: str, start: Column, end: Column
) -> DataFrame:
    """Weekly flow index: the rolling mean of each Sunday ranked in the sample of the same week.
    `rolling` is `rolling_mean_min`; the last measure at or before the Sunday is always inside its
    window, so its day comes with it."""
    sundays = rolling.where(
        cal.is_sunday(F.col(date)) & (F.col(date) >= start) & (F.col(date) <= end)
    ).withColumn("semaine", cal.reference_week(F.col(date)))
    joined = regime_filter(sundays.join(normals, [station, "semaine"]), date, "rupture")
    return rank_z(joined, "q7", "valeurs_ref").select(
        station,
        cal.iso_week_label(F.col(date)).alias("semaine"),
        F.lit("debit").alias("indice"),
        "valeur",
        "periode_ref",
        "hors_reference",
        "date_mesure",
        F.lit(True).alias("dans_composite"),
    )


def spi_index(
    totals: DataFrame, normals: DataFrame, zone: str, date: str, start: Column, end: Column
) -> DataFrame:
    """Weekly rain index: totals of the Sundays against the gamma law of the same week."""
    sundays = totals.where((F.col(date) >= start) & (F.col(date) <= end)).withColumn(
        "semaine", cal.reference_week(F.col(date))
    )
    joined = sundays.join(normals, [zone, "indice", "semaine"])
    scored = gamma_z(joined, "total", "forme", "echelle", "q0")
    return scored.select(
        zone,
        cal.iso_week_label(F.col(date)).alias("semaine"),
        "indice",
        "valeur",
        F.lit(None).cast("long").alias("n_stations"),
        F.struct("hors_reference", "periode_ref").alias("detail"),
    )


def campaign_share(
    observations: DataFrame,
    stations: DataFrame,
    no_flow: str = "2",
    dry: str = "3",
) -> DataFrame:
    """Share of stations without flow per zone and week. Several campaigns in a week: the latest.
    `observations` has station_id, date_campagne, modalite, type_campagne."""
    rows = observations.where(F.col("modalite").isNotNull()).join(
        stations.where(F.col("zone_id").isNotNull()).select("station_id", "zone_id"), "station_id"
    )
    state = F.col("modalite").cast("string")
    per_campaign = rows.groupBy(
        "zone_id", cal.iso_week_label(F.col("date_campagne")).alias("semaine"), "date_campagne"
    ).agg(
        F.count_distinct("station_id").alias("n_stations"),
        F.count_if(state == no_flow).alias("n_rupture"),
        F.count_if(state == dry).alias("n_assec"),
        F.array_join(F.sort_array(F.collect_set(F.col("type_campagne").cast("string"))), ", ").alias(
            "type_campagne"
        ),
    )
    latest = per_campaign.groupBy("zone_id", "semaine").agg(
        F.max(
            F.struct("date_campagne", "n_stations", "n_rupture", "n_assec", "type_campagne")
        ).alias("_c")
    )
    c = F.col("_c")
    return latest.select(
        "zone_id",
        "semaine",
        F.lit("onde").alias("indice"),
        ((c["n_rupture"] + c["n_assec"]) / c["n_stations"]).alias("valeur"),
        c["n_stations"].alias("n_stations"),
        F.struct(
            c["date_campagne"].alias("date_campagne"),
            c["n_assec"].alias("n_assec"),
            c["n_rupture"].alias("n_rupture"),
            c["type_campagne"].alias("type_campagne"),
        ).alias("detail"),
    )


def zone_mean(station_indices: DataFrame, stations: DataFrame) -> DataFrame:
    """Mean of the indices of a zone's stations that enter the composite, their number and their
    sorted list."""
    rows = station_indices.where(F.col("dans_composite")).join(
        stations.where(F.col("zone_id").isNotNull()).select("station_id", "zone_id"), "station_id"
    )
    return (
        rows.groupBy("zone_id", "semaine", "indice")
        .agg(
            exact_mean(F.col("valeur")).alias("valeur"),
            F.count("*").alias("n_stations"),
            F.sort_array(F.collect_list("station_id")).alias("_stations"),
        )
        .withColumn("detail", F.struct(F.col("_stations").alias("stations")))
        .drop("_stations")
    )


def composite(zone_indices: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted mean of the components a zone has in a week, weights renormalised. `weights` has
    zone_id, indice, poids; zero weights are ignored. The detail gives each component with its
    weight, the missing ones and the partial flag."""
    useful = weights.where(F.col("poids") > 0)
    wanted = useful.groupBy("zone_id").agg(F.sort_array(F.collect_set("indice")).alias("_all"))
    parts = zone_indices.where(F.col("valeur").isNotNull()).join(useful, ["zone_id", "indice"])
    entry = F.struct("indice", "valeur", "poids")
    grouped = parts.groupBy("zone_id", "semaine").agg(
        F.sort_array(F.collect_list(entry)).alias("_parts")
    )
    joined = grouped.join(wanted, "zone_id").withColumn(
        "_total", F.aggregate("_parts", F.lit(0.0), lambda a, p: a + p["poids"])
    )
    value = F.aggregate("_parts", F.lit(0.0), lambda a, p: a + p["poids"] * p["valeur"])
    missing = F.array_except("_all", F.transform("_parts", lambda p: p["indice"]))
    components = F.map_from_entries(
        F.transform(
            "_parts",
            lambda p: F.struct(
                p["indice"].alias("key"),
                F.struct(
                    p["poids"].alias("poids"),
                    F.round(p["poids"] / F.col("_total"), 4).alias("poids_applique"),
                    F.round(p["valeur"], 4).alias("valeur"),
                ).alias("value"),
            ),
        )
    )
    return joined.select(
        "zone_id",
        "semaine",
        (value / F.col("_total")).alias("valeur"),
        F.struct(
            components.alias("composantes"),
            missing.alias("manquantes"),
            F.size("_parts").alias("n_composantes"),
            (F.size(missing) > 0).alias("partiel"),
        ).alias("detail"),
    )


def restandardise(table: DataFrame, references: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace `valeur` by its rank in the sample of its zone. The raw value, the reference period
    and the flag are added to `detail`. Without a sample the raw value stays, flagged."""
    keys = list(keys)
    refs = references.select(
        *keys, "valeurs_ref", F.col("periode_ref").alias("_period"),
        F.col("hors_reference").alias("_off"),
    )
    joined = table.join(refs, keys, "left").withColumnRenamed("valeur", "_raw")
    ranked = rank_z(joined, "_raw", "valeurs_ref", "_z")
    has = F.col("valeurs_ref").isNotNull()
    fields = table.schema["detail"].dataType.names
    detail = F.struct(
        *[F.col("detail")[f].alias(f) for f in fields],
        F.round("_raw", 4).alias("valeur_brute"),
        F.when(has, F.col("_period")).alias("reference"),
        F.when(has, F.col("_off")).otherwise(True).alias("hors_reference"),
    )
    result = ranked.withColumn("valeur", F.when(has, F.col("_z")).otherwise(F.col("_raw")))
    return result.withColumn("detail", detail).select(*table.columns)


def finalise(table: DataFrame, version: str, classed: bool = True) -> DataFrame:
    """Attach the class and the version of the method."""
    level = stats.classify(F.col("valeur")) if classed else F.lit(None).cast("int")
    return table.withColumn("classe", level).withColumn("version_methodo", F.lit(version))


def with_detail_text(table: DataFrame) -> DataFrame:
    """`detail` as JSON with sorted keys, nulls kept."""
    fields = sorted(table.schema["detail"].dataType.names)
    ordered = F.struct(*[F.col("detail")[f].alias(f) for f in fields])
    return table.withColumn("detail", detail_json(ordered))


def scale_check(
    indices: DataFrame, keys: Sequence[str], start: str, end: str
) -> DataFrame:
    """Mean, standard deviation and share of the extreme classes over the reference weeks; expected
    0, 1, 10 % and 10 %."""
    level = F.col("classe")
    return (
        indices.where((F.col("semaine") >= start) & (F.col("semaine") <= end))
        .where(F.col("valeur").isNotNull())
        .groupBy(*keys)
        .agg(
            F.count("*").alias("n"),
            exact_mean(F.col("valeur")).alias("moyenne"),
            F.stddev_samp("valeur").alias("ecart_type"),
            F.avg((level == 1).cast("int")).alias("part_classe_1"),
            F.avg((level == 7).cast("int")).alias("part_classe_7"),
        )
    )


def weekly_rank_index(totals: DataFrame, zone: str, date: str, value: str, period) -> DataFrame:
    """Rank index of rolling totals against the selected years of the same reference week. Sample
    and values of a (zone, week) come from one grouping, so nothing is joined back."""
    from sluice.operators.reference import select_years

    row = F.struct(cal.iso_year(F.col(date)).alias("year"), F.col(value).alias("v"), F.col(date).alias("d"))
    grouped = totals.groupBy(zone, cal.reference_week(F.col(date)).alias("_week")).agg(
        F.sort_array(F.collect_list(row)).alias("_rows")
    )
    chosen = grouped.withColumn(
        "_valid", F.sort_array(F.array_distinct(F.transform("_rows", lambda r: r["year"])))
    ).withColumn("_choice", select_years(F.col("_valid"), period))
    sampled = chosen.where(F.size("_choice.years") > 0).withColumn(
        "_sample",
        F.sort_array(
            F.transform(
                F.filter("_rows", lambda r: F.array_contains("_choice.years", r["year"])),
                lambda r: r["v"],
            )
        ),
    )
    rows = sampled.select(zone, "_sample", "_choice", F.explode("_rows").alias("_r")).select(
        zone, "_sample", "_choice.period_ref", "_choice.off_reference", "_r.*"
    )
    return rank_z(rows, "v", "_sample").select(
        zone,
        cal.iso_week_label(F.col("d")).alias("semaine"),
        F.col("v").alias(value),
        "valeur",
        stats.classify(F.col("valeur")).alias("classe"),
        F.col("period_ref").alias("periode_ref"),
        F.col("off_reference").alias("hors_reference"),
    )
