"""Map views: week bounds, unpacked details and latest flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import calendar as cal
from sluice.plans.api import fill_pct


def row_key(*columns: str) -> Column:
    return F.concat_ws("|", *columns)


def week_bounds(table: DataFrame) -> DataFrame:
    week = F.col("semaine")
    return table.withColumn("debut", cal.week_monday(week)).withColumn("fin", cal.week_sunday(week))


def latest_per(table: DataFrame, keys: list[str], time: str, name: str = "derniere") -> DataFrame:
    """Flag of the latest time per key. The latest is an aggregate joined back, so a key with most
    of the rows is not one window task."""
    last = table.groupBy(*keys).agg(F.max(time).alias("_last"))
    return table.join(last, keys).withColumn(name, F.col(time) == F.col("_last")).drop("_last")


def latest_overall(table: DataFrame, source: DataFrame, name: str = "derniere") -> DataFrame:
    last = source.agg(F.max("semaine").alias("m"))
    return table.withColumn(name, F.col("semaine") == last.scalar())


def composite_view(composite: DataFrame, zones: DataFrame) -> DataFrame:
    rows = latest_overall(composite.join(zones.select("zone_id", "libelle"), "zone_id"), composite)
    d = F.col("detail")
    return week_bounds(rows).select(
        row_key("zone_id", "semaine").alias("cle"),
        "zone_id", "libelle", "semaine", "debut", "fin", "valeur", "classe",
        d["n_composantes"].alias("n_composantes"),
        d["partiel"].alias("partiel"),
        F.when(F.size(d["manquantes"]) > 0, F.array_join(F.sort_array(d["manquantes"]), ", ")).alias(
            "manquantes"
        ),
        "derniere",
    )


def zone_index_view(zone_index: DataFrame, zones: DataFrame) -> DataFrame:
    kept = zone_index.where(F.col("indice") != "onde")
    rows = latest_overall(kept.join(zones.select("zone_id", "libelle"), "zone_id"), kept)
    return week_bounds(rows).select(
        row_key("zone_id", "semaine", "indice").alias("cle"),
        "zone_id", "libelle", "indice", "semaine", "debut", "fin", "valeur", "classe",
        "n_stations", "derniere",
    )


def campaign_view(zone_index: DataFrame, zones: DataFrame) -> DataFrame:
    kept = zone_index.where(F.col("indice") == "onde")
    rows = latest_per(kept, ["zone_id"], "semaine").join(zones.select("zone_id", "libelle"), "zone_id")
    d = F.col("detail")
    return week_bounds(rows).select(
        row_key("zone_id", "semaine").alias("cle"),
        "zone_id", "libelle", "semaine", "debut", "fin",
        d["date_campagne"].alias("date_campagne"),
        d["type_campagne"].alias("type_campagne"),
        F.col("valeur").alias("part_sans_ecoulement"),
        F.round(100 * F.col("valeur"), 1).alias("pct_sans_ecoulement"),
        "n_stations",
        d["n_assec"].alias("n_assec"),
        d["n_rupture"].alias("n_rupture"),
        "derniere",
    )


def station_index_view(station_index: DataFrame, stations: DataFrame) -> DataFrame:
    rows = latest_overall(station_index.join(stations, "station_id"), station_index)
    return (
        week_bounds(rows)
        .withColumn("anciennete_jours", F.datediff("fin", "date_mesure"))
        .withColumn("cle", row_key("station_id", "semaine", "indice"))
    )


def reservoir_view(reservoir: DataFrame, stations: DataFrame) -> DataFrame:
    rows = latest_per(reservoir, ["station_id"], "date").join(stations, "station_id")
    return rows.select(
        F.concat_ws("|", "station_id", F.date_format("date", "yyyy-MM-dd")).alias("cle"),
        "station_id", "libelle", "zone_id", "date",
        cal.iso_week_label(F.col("date")).alias("semaine"),
        F.trunc("date", "week").alias("debut"),
        cal.sunday_of(F.col("date")).alias("fin"),
        "volume_m3", "capacite_m3",
        F.round(fill_pct(F.col("volume_m3"), F.col("capacite_m3")), 1).alias("remplissage_pct"),
        "derniere",
    )
