"""Reading landed files and shaping them into observation tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import text as tx

# Header of the gridded weather files.
GRID_SCHEMA = (
    "LAMBX int, LAMBY int, DATE string, PRENEI double, PRELIQ double, ETP double, SWI double"
)
MISSING_ALTITUDE = -999.0


def scan_yearly(
    spark: SparkSession, path: str, date_column: str = "date", since: date | None = None
) -> DataFrame:
    """All years of a source written with `year=` folders. With `since`, whole years are pruned
    before any file is opened, then days are filtered. A missing folder is an error."""
    table = spark.read.parquet(path)
    if since is None:
        return table
    return table.where(
        (F.col("year") >= since.year) & (F.col(date_column) >= F.lit(since))
    )


def scan_grid_csv(spark: SparkSession, path: str, cells: DataFrame) -> DataFrame:
    """Gridded weather files (`;`, gzip) kept on the cells of the territory. `cells` has maille_id,
    LAMBX and LAMBY. A gzip file is one task, so the join that drops most rows comes first."""
    raw = spark.read.csv(path, sep=";", header=True, schema=GRID_SCHEMA, enforceSchema=False)
    return raw.join(cells, ["LAMBX", "LAMBY"]).select(
        "maille_id",
        F.to_date("DATE", "yyyyMMdd").alias("date"),
        (F.col("PRELIQ") + F.col("PRENEI")).alias("precip_mm"),
        F.col("ETP").alias("etp_mm"),
        F.col("SWI").alias("swi"),
    )


def flatten_pages(pages: DataFrame, request: str, data: str = "data") -> DataFrame:
    """Records of landed answer pages, one row each."""
    return pages.select(request, F.explode(data).alias("_r")).select(request, "_r.*")


def reconcile_pages(
    pages: DataFrame, request: str, count: str = "count", data: str = "data"
) -> DataFrame:
    """Per request: announced and received records and whether they agree."""
    return pages.groupBy(request).agg(
        F.max(count).alias("announced"), F.sum(F.size(data)).cast("long").alias("received")
    ).withColumn("complete", F.col("announced") == F.col("received"))


def station_key(source: str, code: Column) -> Column:
    return F.concat(F.lit(f"{source}:"), code.cast("string"))


def shape_groundwater(raw: DataFrame, stations: DataFrame, source: str = "piezo") -> DataFrame:
    """Levels with the depth below the mark of the station. `raw` has code, date, niveau, statut;
    `stations` station_id and metadonnees (JSON with `altitude`)."""
    altitude = F.get_json_object("metadonnees", "$.altitude").cast("double")
    marks = stations.select("station_id", altitude.alias("_alt"))
    known = (F.col("_alt").isNotNull()) & (F.col("_alt") != MISSING_ALTITUDE)
    return (
        raw.where(F.col("niveau").isNotNull())
        .withColumn("station_id", station_key(source, F.col("code")))
        .join(marks, "station_id", "left")
        .select(
            "station_id",
            F.to_date("date").alias("date"),
            F.col("niveau").alias("niveau_ngf"),
            F.when(known, F.col("_alt") - F.col("niveau")).alias("profondeur"),
            F.col("statut").alias("qualification"),
        )
    )


def shape_flow(raw: DataFrame, source: str = "hydro") -> DataFrame:
    """Daily flows: null results dropped. `raw` has code, date, resultat, statut."""
    return raw.where(F.col("resultat").isNotNull()).select(
        station_key(source, F.col("code")).alias("station_id"),
        F.to_date("date").alias("date"),
        F.col("resultat").alias("qmj_ls"),
        F.col("statut").alias("qualification"),
    )


def shape_campaign(
    observations: DataFrame, campaigns: DataFrame, stations: DataFrame, source: str = "onde"
) -> tuple[DataFrame, DataFrame]:
    """(observations of known stations with the type of their campaign, unknown stations with
    their number of rows). The campaign code is text on one side and a number on the other."""
    kinds = campaigns.select(
        F.col("code_campagne").cast("string").alias("_code"), F.col("type_campagne")
    )
    rows = (
        observations.where(F.col("modalite").isNotNull())
        .withColumn("station_id", station_key(source, F.col("code_station")))
        .withColumn("_code", F.col("code_campagne").cast("string"))
        .join(kinds, "_code", "left")
        .select("station_id", F.to_date("date").alias("date_campagne"), "modalite", "type_campagne")
    )
    known = stations.select("station_id")
    unknown = rows.join(known, "station_id", "left_anti").groupBy("station_id").agg(
        F.count("*").alias("n")
    )
    return rows.join(known, "station_id", "left_semi"), unknown


def shape_reservoir(raw: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Readings of the territory feed: code from the name, day found in the label, volumes in m3.
    `raw` has nom, libelle_date, volume_m3, capacite_m3; `aliases` code and alias."""
    rows = raw.select(
        tx.code_key(F.col("nom")).alias("code"),
        F.col("nom").alias("libelle"),
        tx.day_in_label(F.col("libelle_date")).alias("date"),
        F.col("volume_m3").cast("double").alias("volume_m3"),
        F.col("capacite_m3").cast("double").alias("capacite_m3"),
        *[c for c in ("x", "y") if c in raw.columns],
    )
    rows = rows.where(F.col("date").isNotNull() & F.col("volume_m3").isNotNull())
    if aliases is None:
        return rows
    renamed = rows.join(aliases.select("code", "alias"), "code", "left")
    return renamed.withColumn("code", F.coalesce("alias", "code")).drop("alias")


def shape_reservoir_national(raw: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Readings of the national layer: volumes in millions of m3 rounded to whole m3, empty texts
    are missing values. `raw` has nom, libelle_date, stock_millions, capacite_millions."""

    def cubic(c: str) -> Column:
        return F.round(F.nullif(F.col(c), F.lit("")).cast("double") * 1_000_000)

    table = raw.withColumn("volume_m3", cubic("stock_millions")).withColumn(
        "capacite_m3", cubic("capacite_millions")
    )
    return shape_reservoir(table, aliases)


def source_with_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """Rows of `primary`, or of `fallback` when the primary feed has none; `source_donnee` records
    the origin. Whether the primary is empty is decided inside the plan."""
    has_primary = primary.limit(1).agg((F.count("*") > 0).alias("_has"))
    return (
        primary.withColumn("source_donnee", F.lit("territoire"))
        .unionByName(
            fallback.where(~has_primary.scalar()).withColumn("source_donnee", F.lit("national"))
        )
    )


def fallback_per_key(primary: DataFrame, fallback: DataFrame, keys: list[str]) -> DataFrame:
    """The same choice made key by key: fallback rows fill the keys the primary does not cover."""
    rest = fallback.join(primary.select(*keys).distinct(), keys, "left_anti")
    return primary.withColumn("source_donnee", F.lit("territoire")).unionByName(
        rest.withColumn("source_donnee", F.lit("national"))
    )


def explode_orders(
    raw: DataFrame,
    lists: Mapping[str, str],
    keep: list[str],
    name: str,
    refuse: bool = False,
    departments: tuple[str, list[str]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Orders whose cells hold parallel JSON lists, one row per position of the lists.

    `lists` maps a result column to its cell; `name` is the result column whose length rules.
    Unreadable, empty or `null` cells are empty lists. An order without a list keeps one row of
    nulls; texts that are empty, `null` or `undefined` are nulls. `departments` is a column and the
    values whose orders are read. Returns (rows, orders whose lists differ in length); with `refuse`
    such an order fails the job that reads the rows, else the second result must be empty."""
    if departments is not None:
        raw = raw.where(F.col(departments[0]).isin(departments[1]))
    arrays = raw.select(
        *keep,
        *[
            F.coalesce(
                F.from_json(cell, "array<string>", {"mode": "PERMISSIVE"}),
                F.array().cast("array<string>"),
            ).alias(column)
            for column, cell in lists.items()
        ],
    )
    same = F.lit(True)
    for column in lists:
        same = same & (F.size(column) == F.size(name))
    bad = arrays.where(~same).select(*keep, *[F.size(c).alias(f"n_{c}") for c in lists])
    fits = same
    if refuse:
        told = F.concat_ws(" ", F.lit("lists of different length in order"), *[F.col(c).cast("string") for c in keep])
        fits = F.when(same, True).otherwise(F.raise_error(told).cast("boolean"))
    rows = (
        arrays.where(fits)
        .select(*keep, F.explode_outer(F.arrays_zip(*lists)).alias("_z"))
        .select(*keep, *[F.col("_z")[c].alias(c) for c in lists])
        .withColumn(name, F.trim(name))
        .withColumns({c: tx.empty_to_null(F.col(c)) for c in lists})
    )
    return rows, bad
