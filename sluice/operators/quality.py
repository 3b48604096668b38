"""Audits of tables, feeds and runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import calendar as cal


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    return sorted(set(expected) - set(df.columns))


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def key_audit(df: DataFrame, expected: Sequence[str], key: str, listed: int = 5) -> DataFrame:
    """One row: missing columns, number of duplicated keys and the first few of them."""
    repeated = duplicated_keys(df, [key])
    first = repeated.select(key).orderBy(key).limit(listed)
    examples = first.agg(F.sort_array(F.collect_list(key)).alias("_e"))
    return repeated.agg(
        F.count("*").alias("n_duplicated"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")
    ).select(
        F.lit(",".join(missing_columns(df, expected))).alias("missing"),
        "n_duplicated",
        "n_rows",
        examples.scalar().alias("examples"),
    )


def implausible_values(
    df: DataFrame, rules: Mapping[str, Column], example: Sequence[str]
) -> DataFrame:
    """Rows that break each rule (a true condition is a fault): number and the first example in
    the order of the `example` columns. Rules without a fault are absent."""
    faults = F.filter(
        F.array(*[F.when(condition, F.lit(name)) for name, condition in rules.items()]),
        lambda r: r.isNotNull(),
    )
    return (
        df.select(F.explode(faults).alias("rule"), F.struct(*example).alias("_e"))
        .groupBy("rule")
        .agg(F.count("*").alias("n"), F.min("_e").alias("_e"))
        .select("rule", "n", *[F.col("_e")[c].alias(f"first_{c}") for c in example])
    )


def week_coverage(rain: DataFrame, station_indices: DataFrame, week: str) -> DataFrame:
    """What a week can rely on: last rain day and whether it reaches Sunday, stations with a
    groundwater index and in the composite, stations with a flow index."""
    sunday = cal.week_sunday(F.lit(week))
    last = rain.where(F.col("date") >= F.date_sub(sunday, 7)).agg(F.max("date").alias("_last"))
    rows = station_indices.where(F.col("semaine") == week)
    level = F.col("indice") == "ips"
    counts = rows.agg(
        F.count_if(level).alias("n_ips"),
        F.count_if(level & F.col("dans_composite")).alias("n_ips_composite"),
        F.count_if(F.col("indice") == "debit").alias("n_debit"),
    )
    return counts.select(
        F.lit(week).alias("semaine"),
        last.scalar().alias("last_rain"),
        F.coalesce(last.scalar() >= sunday, F.lit(False)).alias("rain_complete"),
        "n_ips",
        "n_ips_composite",
        "n_debit",
    )


def history_inventory(
    daily: DataFrame,
    station: str,
    date: str,
    today: Column,
    status: Column,
    reference: tuple[int, int],
    months_min: int | None = None,
    days_min: int | None = None,
) -> DataFrame:
    """Per station: first and last day, rows, median gap in days, usable years (with `months_min`
    months or `days_min` days), those in the reference, days since the last row, share of rows
    with a status. One row per station and day expected, so a station is bounded by the calendar."""
    order = Window.partitionBy(station).orderBy(date)
    gaps = daily.select(
        station, date, status.cast("int").alias("_status"),
        F.datediff(date, F.lag(date).over(order)).alias("_gap"),
    )
    per_year = daily.groupBy(station, F.year(date).alias("_y")).agg(
        F.count_distinct(F.month(date)).alias("_months"), F.count_distinct(date).alias("_days")
    )
    usable = F.lit(True)
    if months_min is not None:
        usable = usable & (F.col("_months") >= months_min)
    if days_min is not None:
        usable = usable & (F.col("_days") >= days_min)
    years = per_year.groupBy(station).agg(
        F.count_if(usable).alias("annees_exploitables"),
        F.count_if(usable & F.col("_y").between(*reference)).alias("annees_ref"),
    )
    rows = gaps.groupBy(station).agg(
        F.min(date).alias("premiere"),
        F.max(date).alias("derniere"),
        F.count("*").alias("n_mesures"),
        F.median("_gap").alias("pas_median_j"),
        F.avg("_status").alias("part_statut"),
    )
    return rows.join(years, station).withColumn("retard_j", F.datediff(today, "derniere"))


def feed_comparison(
    a: DataFrame, b: DataFrame, keys: Sequence[str], variables: Sequence[str], same: float = 1e-9
) -> DataFrame:
    """Per variable over the common keys: number of pairs, share of identical values, largest
    absolute gap."""
    left = a.select(*keys, *[F.col(v).alias(f"_a_{v}") for v in variables])
    right = b.select(*keys, *[F.col(v).alias(f"_b_{v}") for v in variables])
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(v).alias("variable"),
                    F.abs(F.col(f"_a_{v}") - F.col(f"_b_{v}")).alias("_gap"),
                )
                for v in variables
            ]
        )
    )
    return (
        left.join(right, list(keys))
        .select(cells.alias("_c"))
        .select("_c.*")
        .groupBy("variable")
        .agg(
            F.count("_gap").alias("n"),
            F.avg((F.col("_gap") < same).cast("int")).alias("part_identique"),
            F.max("_gap").alias("ecart_max"),
        )
    )


def weights_audit(weights: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Zones whose component weights do not sum to 1 (rule `sum`) or that list a component twice
    (rule `component`). `weights` has zone_id, indice, poids."""
    sums = (
        weights.groupBy("zone_id")
        .agg(F.sum(F.col("poids").cast("decimal(20,10)")).cast("double").alias("value"))
        .where(F.abs(F.col("value") - 1) > tolerance)
        .select("zone_id", F.lit("sum").alias("rule"), "value")
    )
    twice = (
        duplicated_keys(weights, ["zone_id", "indice"])
        .groupBy("zone_id")
        .agg(F.count("*").cast("double").alias("value"))
        .select("zone_id", F.lit("component").alias("rule"), "value")
    )
    return sums.unionByName(twice)


def single_membership(members: DataFrame, member: str, group: str) -> DataFrame:
    """Members that belong to more than one group: stations in two splices, source codes in two
    classes."""
    return (
        members.groupBy(member)
        .agg(F.count_distinct(group).alias("n_groups"))
        .where(F.col("n_groups") > 1)
    )


def stale_attributes(
    stored: DataFrame, current: DataFrame, key: str, attribute: str, json: bool = True
) -> DataFrame:
    """Keys on one side only (`stored_only`, `current_only`) and keys whose attribute differs
    (`stale`); the current value wins. JSON objects are compared parsed, not as text."""

    def parsed(c: str) -> Column:
        if not json:
            return F.col(c)
        entries = F.map_entries(F.from_json(F.col(c), "map<string,double>"))
        return F.sort_array(entries)

    a = stored.select(key, F.col(attribute).alias("_a"), F.lit(1).alias("_in_a"))
    b = current.select(key, F.col(attribute).alias("_b"), F.lit(1).alias("_in_b"))
    state = (
        F.when(F.col("_in_b").isNull(), "stored_only")
        .when(F.col("_in_a").isNull(), "current_only")
        .when(~parsed("_a").eqNullSafe(parsed("_b")), "stale")
    )
    return (
        a.join(b, key, "full")
        .select(key, state.alias("state"), F.col("_b").alias("current"))
        .where(F.col("state").isNotNull())
    )


def multi_reading_weeks(df: DataFrame, key: str, date: str) -> DataFrame:
    """Keys and ISO weeks with more than one reading."""
    return (
        df.groupBy(key, cal.iso_week_label(F.col(date)).alias("semaine"))
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
    )


def run_status(errors: DataFrame, failures: DataFrame) -> DataFrame:
    """`failed` with a failed step, `partial` with errors of sources, else `ok`."""
    failed = failures.agg(F.count("*").alias("n"))
    return errors.agg(F.count("*").alias("n_errors")).select(
        "n_errors",
        failed.scalar().alias("n_failures"),
        F.when(failed.scalar() > 0, "failed")
        .when(F.col("n_errors") > 0, "partial")
        .otherwise("ok")
        .alias("status"),
    )


def run_summary(zones: DataFrame, composites: DataFrame, week: str, labels: DataFrame) -> DataFrame:
    """One row per zone for a week: value, class with its label, missing components; a zone
    without a composite misses all of them. `labels` has classe and libelle_classe."""
    rows = composites.where(F.col("semaine") == week).select(
        "zone_id", "valeur", "classe", F.array_join("detail.manquantes", ", ").alias("_missing")
    )
    return (
        zones.join(rows, "zone_id", "left")
        .join(labels, "classe", "left")
        .select(
            "zone_id",
            "libelle",
            "valeur",
            "classe",
            "libelle_classe",
            F.when(F.col("classe").isNull(), "all")
            .otherwise(F.col("_missing"))
            .alias("manquantes"),
        )
    )


def cover_report(scenes: DataFrame, pixels: DataFrame) -> DataFrame:
    """Per month: scenes found, without baseline, dropped as copies and kept, planes, share of
    pixels never valid and mean number of observations of the others. `scenes` is
    `optical.rank_scenes`; `pixels` has mois, n_obs."""
    a = scenes.groupBy("mois").agg(
        F.count("*").alias("scenes_trouvees"),
        F.count_if(F.col("baseline").isNull()).alias("scenes_baseline_inconnue"),
        F.count_if(F.col("baseline").isNotNull() & ~F.col("kept")).alias("scenes_doublons_ecartes"),
        F.count_if(F.col("kept")).alias("scenes_retenues"),
        F.count_distinct(F.when(F.col("kept"), F.struct("jour", "offset"))).alias("plans"),
    )
    valid = F.col("n_obs") > 0
    b = pixels.groupBy("mois").agg(
        F.round(100 * F.avg((~valid).cast("int")), 3).alias("pct_jamais_valide"),
        F.round(F.sum("n_obs") / F.count_if(valid), 2).alias("observations_moyennes"),
    )
    return a.join(b, "mois", "left")
