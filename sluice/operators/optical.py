"""Monthly optical composites on long pixel tables, and the control of radiometric drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.ranking import exact_medians, exact_quantiles, sorted_median
from sluice.session import cut_lineage

# First processing baseline with an offset, the offset, the scale of stored
# integers, their missing value, the cap of a count.
OFFSET_BASELINE, OFFSET, SCALE, NODATA, COUNT_CAP = 4.0, -1000.0, 10_000.0, -32768, 254


def baseline_number(baseline: Column) -> Column:
    return F.coalesce(baseline.try_cast("double"), F.lit(-1.0))


def plane_offset(baseline: Column) -> Column:
    return F.when(baseline_number(baseline) >= OFFSET_BASELINE, OFFSET).otherwise(0.0)


def rank_scenes(scenes: DataFrame) -> DataFrame:
    """Scenes with `offset` and `kept`: per tile and day the highest baseline, then the highest id.
    A scene without a baseline is never kept. The best scene is an aggregate joined back, so a day
    with very many copies is not one window task."""
    known = scenes.withColumn("baseline", F.nullif("baseline", F.lit("")))
    rank = F.struct(baseline_number(F.col("baseline")), F.col("id"))
    best = (
        known.where(F.col("baseline").isNotNull())
        .groupBy("tuile", "jour")
        .agg(F.max_by("id", rank).alias("_best"))
    )
    return (
        known.join(best, ["tuile", "jour"], "left")
        .withColumn("offset", plane_offset(F.col("baseline")))
        .withColumn(
            "kept",
            F.col("baseline").isNotNull() & F.coalesce(F.col("id") == F.col("_best"), F.lit(False)),
        )
        .drop("_best")
    )


def select_scenes(scenes: DataFrame) -> DataFrame:
    """The kept scene of each tile and day, with the number of copies dropped."""
    known = scenes.withColumn("baseline", F.nullif("baseline", F.lit(""))).where(
        F.col("baseline").isNotNull()
    )
    rest = [c for c in scenes.columns if c not in ("tuile", "jour")]
    rank = F.struct(baseline_number(F.col("baseline")), F.col("id"))
    return (
        known.groupBy("tuile", "jour")
        .agg(F.max_by(F.struct(*rest), rank).alias("_s"), (F.count("*") - 1).alias("doublons"))
        .select("tuile", "jour", "_s.*", "doublons")
        .withColumn("offset", plane_offset(F.col("baseline")))
    )


def plane_key(day: Column, offset: Column) -> Column:
    return F.concat_ws("|", F.date_format(day, "yyyy-MM-dd"), offset.cast("long").cast("string"))


def planes(kept: DataFrame) -> DataFrame:
    """One row per plane (day and offset): platforms, baselines, tiles, scenes, mean cloud."""

    def names(c: str) -> Column:
        return F.array_join(F.sort_array(F.collect_set(c)), ",")

    return (
        kept.groupBy("jour", "offset")
        .agg(
            names("plateforme").alias("plateformes"),
            names("baseline").alias("baselines"),
            names("tuile").alias("tuiles"),
            F.count("*").alias("n_scenes"),
            F.avg("nuages_pct").alias("nuages_pct"),
        )
        .withColumn("cle", plane_key(F.col("jour"), F.col("offset")))
    )


def pixel_indices(df: DataFrame, valid_classes: Sequence[int], offset: str = "offset") -> DataFrame:
    """NDVI and NDMI of bands b04, b08, b11 (digital numbers) and mask scl; null where invalid."""

    def reflectance(band: str) -> Column:
        return F.greatest(F.lit(0.0), (F.col(band) + F.col(offset)) / SCALE)

    r04, r08, r11 = reflectance("b04"), reflectance("b08"), reflectance("b11")
    valid = (
        F.col("scl").isin(list(valid_classes))
        & (F.col("b04") > 0) & (F.col("b08") > 0) & (F.col("b11") > 0)
        & (r08 + r04 > 0) & (r08 + r11 > 0)
    )
    return df.withColumn("ndvi", F.when(valid, (r08 - r04) / (r08 + r04))).withColumn(
        "ndmi", F.when(valid, (r08 - r11) / (r08 + r11))
    )


def monthly_median(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per pixel and month: exact median of the valid planes and their number. A group holds the
    planes of one pixel in one month, some thirty values."""
    return df.groupBy(*keys).agg(
        F.median("ndvi").alias("ndvi"),
        F.median("ndmi").alias("ndmi"),
        F.count("ndvi").alias("n_obs"),
    )


def stored_count(count: Column) -> Column:
    """A count in the one byte of the stored images: `COUNT_CAP` stands for that many or more."""
    return F.least(count, F.lit(COUNT_CAP)).cast("short")


def quantise(value: Column) -> Column:
    """Stored integer of an index: half to even, missing as -32768."""
    return F.coalesce(F.rint(value * SCALE), F.lit(float(NODATA))).cast("short")


def integrity_check(df: DataFrame, keys: Sequence[str], max_pct: float = 2.0) -> DataFrame:
    """Per plane and block: percentage of pixels where mask and bands disagree, over the pixels
    seen by either; flagged above `max_pct`."""
    covered = F.col("scl") > 0
    bands = (F.col("b04") > 0) | (F.col("b08") > 0) | (F.col("b11") > 0)
    return (
        df.groupBy(*keys)
        .agg(
            F.count_if(covered != bands).alias("desaccord"), F.count_if(covered | bands).alias("union")
        )
        .where(F.col("union") > 0)
        .withColumn("pct", 100 * F.col("desaccord") / F.col("union"))
        .withColumn("corrompu", F.col("pct") > max_pct)
    )


def stable_class_medians(
    df: DataFrame, classes: DataFrame, plane: Sequence[str], klass: str = "classe"
) -> DataFrame:
    """Median NDVI and NDMI and number of pixels per plane and stable class. A class may hold a
    large share of all pixels, so its medians come from the distributed quantiles."""
    rows = df.where(F.col("ndvi").isNotNull() & F.col("ndmi").isNotNull()).join(
        classes, ["ix", "iy"]
    )
    return exact_medians(rows, [*plane, klass], ["ndvi", "ndmi"], count="n_px")


def drift_residuals(drift: DataFrame, days: int = 7, cover_min: float = 0.5) -> DataFrame:
    """Gap of each plane to the median of the other planes of its class within `days` days (two at
    least), which cancels the season. Planes that see less than `cover_min` of the class are left
    out. A class has a few planes per day, so its window is bounded by the calendar."""
    most = F.max("n_px").over(Window.partitionBy("classe", "mois"))
    seen = drift.withColumn("_cover", F.col("n_px") / most).where(F.col("_cover") >= cover_min)
    frame = (
        Window.partitionBy("classe")
        .orderBy(F.unix_date("date"))
        .rangeBetween(-days, days)
    )
    near = seen.withColumn("_near", F.collect_list(F.struct("cle", "ndvi", "ndmi")).over(frame))
    others = near.withColumn("_others", F.filter("_near", lambda p: p["cle"] != F.col("cle")))

    def residual(c: str) -> Column:
        return F.col(c) - sorted_median(F.transform("_others", lambda p: p[c]))

    return others.where(F.size("_others") >= 2).select(
        "classe", "cle", "date", F.year("date").alias("annee"), "plateformes", "offset",
        residual("ndvi").alias("residu_ndvi"), residual("ndmi").alias("residu_ndmi"),
    )


def drift_groups(residuals: DataFrame, planes_min: int = 5) -> DataFrame:
    """Median residual per class, year and platform (planes mixing platforms left out) and per
    class and offset over the whole period."""
    span = residuals.agg(
        F.concat_ws("-", F.min("annee").cast("string"), F.max("annee").cast("string")).alias("s")
    )
    by_platform = residuals.where(~F.col("plateformes").contains(",")).select(
        "classe", F.col("annee").cast("string").alias("periode"), F.lit("plateforme").alias("critere"),
        F.col("plateformes").alias("groupe"), "residu_ndvi", "residu_ndmi",
    )
    by_offset = residuals.select(
        "classe", span.scalar().alias("periode"), F.lit("offset").alias("critere"),
        F.concat(F.lit("offset "), F.col("offset").cast("long").cast("string")).alias("groupe"),
        "residu_ndvi", "residu_ndmi",
    )
    return (
        by_platform.unionByName(by_offset)
        .groupBy("classe", "periode", "critere", "groupe")
        .agg(
            F.count("*").alias("n_plans"),
            F.median("residu_ndvi").alias("residu_ndvi"),
            F.median("residu_ndmi").alias("residu_ndmi"),
        )
        .where(F.col("n_plans") >= planes_min)
    )


def drift_gaps(groups: DataFrame, threshold: float = 0.03) -> DataFrame:
    """Gap between the highest and the lowest group of a class, period and criterion."""
    gap = {c: F.max(f"residu_{c}") - F.min(f"residu_{c}") for c in ("ndvi", "ndmi")}
    return (
        groups.groupBy("classe", "periode", "critere")
        .agg(
            F.array_join(F.sort_array(F.collect_list("groupe")), ",").alias("groupes"),
            F.count("*").alias("_n"),
            F.sum("n_plans").alias("n_plans"),
            gap["ndvi"].alias("ecart_ndvi"),
            gap["ndmi"].alias("ecart_ndmi"),
        )
        .where(F.col("_n") >= 2)
        .drop("_n")
        .withColumn("anormal", F.greatest("ecart_ndvi", "ecart_ndmi") > threshold)
    )


def observation_share(df: DataFrame, kind: str, limits: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Per kind and calendar month, mean over the years of the percentage of pixels under each
    number of observations and of the median number. Counts are small whole numbers, so the median
    keeps few distinct values even for a very large group."""
    per_year = df.groupBy(kind, "annee", "mois").agg(
        *[(100 * F.avg((F.col("n_obs") < k).cast("int"))).alias(f"sous_{k}") for k in limits],
        F.median("n_obs").alias("mediane"),
    )
    names = [*[f"sous_{k}" for k in limits], "mediane"]
    return per_year.groupBy(kind, "mois").agg(*[F.avg(n).alias(n) for n in names])


def threshold_sweep(df: DataFrame, value: str, role: str, thresholds: Sequence[float]) -> DataFrame:
    """For each threshold: percentage of `persistant` rows at or above it, of `caduc` rows below
    it, their mean, the percentage of `mixte` rows at or above it, and whether it is the best.

    Rows are first counted per role and number of thresholds reached; the sweep runs on that small
    table."""
    levels = sorted(float(x) for x in thresholds)
    reached = F.lit(0)
    for level in levels:
        reached = reached + F.when(F.col(value) >= level, 1).otherwise(0)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(role, reached.alias("_reached"))
        .agg(F.count("*").alias("_n"))
    )
    steps = F.array(
        *[F.struct(F.lit(i + 1).alias("i"), F.lit(v).alias("tau")) for i, v in enumerate(levels)]
    )
    table = counts.withColumn("_s", F.explode(steps)).groupBy("_s.tau")

    def share(name: str, above: bool) -> Column:
        hit = F.col("_reached") >= F.col("_s.i")
        mine = F.col(role) == name
        part = F.sum(F.when(mine & (hit if above else ~hit), F.col("_n")).otherwise(0))
        return 100 * part / F.nullif(F.sum(F.when(mine, F.col("_n")).otherwise(0)), F.lit(0))

    result = table.agg(
        share("persistant", True).alias("persistant_pris_caduc"),
        share("caduc", False).alias("caduc_pris_persistant"),
        share("mixte", True).alias("mixte_vu_caduc"),
    ).withColumn(
        "erreur_moyenne", (F.col("persistant_pris_caduc") + F.col("caduc_pris_persistant")) / 2
    )
    best = result.agg(F.min_by("tau", F.struct("erreur_moyenne", "tau")).alias("b"))
    return result.withColumn("meilleur", F.col("tau") == best.scalar())


def seasonal_contrast(
    df: DataFrame, probabilities: Mapping[str, float], value: str = "ndvi"
) -> DataFrame:
    """Summer mean minus winter mean per pixel and year, median over the years, then quantiles per
    class. `df` has ix, iy, classe, annee, saison (`ete`, `hiver`)."""
    mean = {s: F.avg(F.when(F.col("saison") == s, F.col(value))) for s in ("ete", "hiver")}
    per_year = df.groupBy("ix", "iy", "classe", "annee").agg(
        (mean["ete"] - mean["hiver"]).alias("_gap")
    )
    per_pixel = per_year.groupBy("ix", "iy", "classe").agg(F.median("_gap").alias("ecart"))
    return exact_quantiles(per_pixel, ["classe"], "ecart", probabilities)


def robust_sigma(df: DataFrame, klass: str, value: str) -> DataFrame:
    """Median and 1.4826 x median absolute deviation per class, in two distributed passes."""
    middle = cut_lineage(exact_quantiles(df, [klass], value, {"mediane": 0.5}))
    gaps = df.join(middle, klass).withColumn("_gap", F.abs(F.col(value) - F.col("mediane")))
    spread = exact_quantiles(gaps, [klass], "_gap", {"_mad": 0.5})
    return middle.join(spread.drop("n"), klass).select(
        klass, "n", "mediane", (F.lit(1.4826) * F.col("_mad")).alias("sigma")
    )


def mean_median_gap(
    df: DataFrame, pixel: Sequence[str], value: str, limits: Sequence[float] = (0.02, 0.05, 0.1)
) -> DataFrame:
    """Over the pixels: share whose mean and median of dates differ by more than each limit."""
    per_pixel = df.where(F.col(value).isNotNull()).groupBy(*pixel).agg(
        F.abs(F.avg(value) - F.median(value)).alias("_gap")
    )
    return per_pixel.agg(
        F.count("*").alias("n_px"),
        *[
            F.avg((F.col("_gap") > x).cast("int")).alias(f"part_{str(x).replace('.', '_')}")
            for x in limits
        ],
    )


def scene_availability(scenes: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Scenes per combination of dimensions and all their totals (cube), baseline known or not."""
    known = scenes.withColumn("baseline_connue", F.nullif("baseline", F.lit("")).isNotNull())
    return known.cube(*dimensions).agg(
        F.count("*").alias("n"), F.count_if("baseline_connue").alias("n_baseline_connue")
    )


def class_profile(df: DataFrame, pixel_ha: float, flags: Sequence[str]) -> DataFrame:
    """Per class and place, and per class (place `all`): area, median summer, winter and gap, share
    of summer values under 0.4 and share of each flag. Medians are distributed."""
    rows = df.withColumn("ecart", F.col("ete") - F.col("hiver")).withColumn(
        "lieu", F.explode(F.array("lieu", F.lit("all")))
    )
    keys = ["classe", "lieu"]
    sums = rows.groupBy(*keys).agg(
        (F.count("*") * pixel_ha).alias("ha"),
        (100 * F.avg((F.col("ete") < 0.4).cast("int"))).alias("part_sous_0_4"),
        *[(100 * F.avg(F.col(f).cast("int"))).alias(f"part_{f}") for f in flags],
    )
    return sums.join(exact_medians(rows, keys, ["ete", "hiver", "ecart"]), keys)
