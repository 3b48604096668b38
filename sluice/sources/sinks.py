"""Declared schemas, idempotent merges and exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conform(
    df: DataFrame, schema: Mapping[str, str], keys: Sequence[str], arrival: Sequence[str]
) -> DataFrame:
    """Declared columns with their types; of several rows with one key the last to arrive wins.
    A missing column is an error. The winner is an aggregate, combined before the shuffle."""
    missing = sorted(set(schema) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    typed = df.select(
        *[F.col(c).cast(t).alias(c) for c, t in schema.items()],
        F.struct(*[F.col(a) for a in arrival]).alias("_arrival"),
    )
    rest = [c for c in schema if c not in keys]
    return (
        typed.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "_arrival").alias("_row"))
        .select(*keys, "_row.*")
        .select(*schema)
    )


def merge_observations(
    stored: DataFrame, batch: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Upsert by key. A row whose values did not change keeps its stored form, ingestion day
    included; a changed row is replaced; new rows are added; stored rows absent from the batch
    stay. Two missing values are equal."""
    keys, columns = list(keys), stored.columns
    a = stored.select(*keys, F.struct(*columns).alias("_old"))
    b = batch.select(*keys, F.struct(*columns).alias("_new"))
    joined = a.join(b, keys, "full")
    same = F.lit(True)
    for v in values:
        same = same & F.col("_old")[v].eqNullSafe(F.col("_new")[v])
    keep_old = F.col("_new").isNull() | (F.col("_old").isNotNull() & same)
    return joined.select(F.when(keep_old, F.col("_old")).otherwise(F.col("_new")).alias("_r")).select(
        "_r.*"
    )


def replace_weeks(stored: DataFrame, fresh: DataFrame, weeks: DataFrame) -> DataFrame:
    """Recomputed weeks replace the stored ones; the other weeks are kept."""
    kept = stored.join(weeks.select("semaine").distinct(), "semaine", "left_anti")
    return kept.select(*stored.columns).unionByName(fresh.select(*stored.columns))


def incremental_since(
    stored: DataFrame, feed: DataFrame, station: str, date: str, today: Column, days: int = 90
) -> DataFrame:
    """Rows of a feed to read again: the last `days` days, or more for a station whose last stored
    day is older."""
    last = stored.groupBy(station).agg(F.max(date).alias("_last"))
    start = F.date_sub(today, days)
    since = F.least(start, F.coalesce("_last", start))
    return feed.join(last, station, "left").where(F.col(date) >= since).drop("_last")


def load_audit(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows read and loaded per table, in the order given; `ok` when the counts agree."""
    parts = []
    for i, (name, (read, loaded)) in enumerate(pairs.items()):
        a = read.agg(F.count("*").alias("n_read"))
        b = loaded.agg(F.count("*").alias("n_loaded"))
        parts.append(
            a.select(
                F.lit(i).alias("position"), F.lit(name).alias("table_name"), "n_read",
                b.scalar().alias("n_loaded"),
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.withColumn("ok", F.col("n_read") == F.col("n_loaded"))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Number of rows and sum of row hashes, so the same whatever the order of rows. A row's hash is the
    first 60 bits of the MD5 of its values as text, each after its length, null as `-`: any engine can
    compute it again."""
    text = [F.col(c).cast("string") for c in df.columns]
    fields = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    number = F.conv(F.substring(F.md5(F.concat(*fields)), 1, 15), 16, 10)
    return df.agg(
        F.count("*").alias("n"), F.sum(number.cast("decimal(38,0)")).alias("fingerprint")
    )


def feature_collection(df: DataFrame, geometry: str, properties: Sequence[str]) -> DataFrame:
    """One GeoJSON feature per row, as text; null properties are kept. Written as lines, a folder
    of features is a GeoJSON sequence of any size."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.parse_json(F.col(geometry)).alias("geometry"),
        F.struct(*properties).alias("properties"),
    )
    return df.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("feature"))


def weekly_maps(
    rows: DataFrame, week: str, key: str, properties: Sequence[str], name: str
) -> DataFrame:
    """Per week: map of key to its properties, nulls dropped, as JSON text."""
    entry = F.struct(F.col(key).alias("key"), F.struct(*properties).alias("value"))
    return rows.groupBy(week).agg(
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias(name)
    )


def export_by_year(
    zones: DataFrame,
    stations: DataFrame,
    summary: DataFrame,
    zone_properties: Sequence[str],
    station_properties: Sequence[str],
) -> DataFrame:
    """year, semaine and one JSON text per week with the zones, the stations and the summary.
    `write_export` writes it in one folder per ISO year."""
    z = weekly_maps(zones, "semaine", "zone_id", zone_properties, "zones")
    s = weekly_maps(stations, "semaine", "station_id", station_properties, "stations")
    columns = [c for c in summary.columns if c != "semaine"]
    y = summary.select("semaine", F.to_json(F.struct(*columns)).alias("synthese"))
    weeks = z.join(s, "semaine", "full").join(y, "semaine", "full")
    body = F.concat(
        F.lit('{"semaine":"'), "semaine", F.lit('","zones":'), F.coalesce("zones", F.lit("{}")),
        F.lit(',"stations":'), F.coalesce("stations", F.lit("{}")),
        F.lit(',"synthese":'), F.coalesce("synthese", F.lit("null")), F.lit("}"),
    )
    return weeks.select(F.substring("semaine", 1, 4).alias("year"), "semaine", body.alias("value"))


def write_export(table: DataFrame, path: str) -> None:
    """One folder of lines per ISO year; a year too large for one task is split by AQE."""
    (
        table.hint("rebalance", "year")
        .select("year", "value")
        .write.mode("overwrite")
        .partitionBy("year")
        .text(path)
    )
