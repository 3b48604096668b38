"""Land-cover class pixels: codes, masks, layers and their areas. Tables are cells (`ix`, `iy`)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.ranking import exact_quantiles

CELL = ["ix", "iy"]
OUTSIDE, NO_CLASS = 255, 0  # fixed values: code outside the territory, code without a class


def map_codes(
    pixels: DataFrame, nomenclature: DataFrame, refuse: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(pixels with the class of their code, codes missing from the nomenclature). `nomenclature`
    has code and classe, null for codes kept in reserve or excluded. With `refuse`, a pixel whose
    code is missing fails the job that reads the first result."""
    known = nomenclature.withColumn("_known", F.lit(True))
    classed = pixels.join(known, "code", "left" if refuse else "inner")
    if refuse:
        told = F.concat(F.lit("unknown land-cover code "), F.coalesce(F.col("code").cast("string"), F.lit("null")))
        classed = classed.where(F.when(F.col("_known"), True).otherwise(F.raise_error(told).cast("boolean")))
    classed = classed.drop("_known")
    unknown = pixels.join(nomenclature, "code", "left_anti").groupBy("code").agg(
        F.count("*").alias("n")
    )
    return classed, unknown


def complete_mask(mask: DataFrame, pixels: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Cells of a mask or of the selected codes, `ajoute` where only the codes bring them."""
    extra = pixels.where(F.col("code").isin(list(codes))).select(*CELL)
    both = mask.select(*CELL, F.lit(0).alias("_s")).unionByName(extra.withColumn("_s", F.lit(1)))
    return both.groupBy(*CELL).agg((F.min("_s") == 1).alias("ajoute"))


def drop_unconfirmed(classes: DataFrame, mask: DataFrame, controlled: Sequence[int]) -> DataFrame:
    """Pixels of a controlled class outside the mask lose their class; `retire` marks them."""
    seen = mask.select(*CELL).distinct().withColumn("_in", F.lit(True))
    joined = classes.join(seen, CELL, "left")
    gone = F.col("classe").isin(list(controlled)) & F.col("_in").isNull()
    return joined.withColumn("retire", gone).withColumn(
        "classe", F.when(gone, NO_CLASS).otherwise(F.col("classe"))
    ).drop("_in")


def override_layer(classes: DataFrame, declared: DataFrame, eroded: DataFrame) -> DataFrame:
    """Declared parcels win: their full footprint erases the class, then their eroded footprint
    writes its own. `eroded` has classe and rang; the highest rank is written last. `efface` marks
    cells that had a class."""
    footprint = declared.select(*CELL).distinct().withColumn("_declared", F.lit(True))
    written = eroded.groupBy(*CELL).agg(F.max_by("classe", "rang").alias("_code"))
    joined = classes.join(footprint, CELL, "left").join(written, CELL, "left")
    inside = F.col("_declared").isNotNull()
    return joined.select(
        *CELL,
        F.coalesce("_code", F.when(inside, NO_CLASS).otherwise(F.col("classe"))).alias("classe"),
        (inside & (F.col("classe") != NO_CLASS)).alias("efface"),
    )


def class_tally(classes: DataFrame, territory: DataFrame, pixel_ha: float) -> DataFrame:
    """Pixels and hectares per class; cells outside the territory count under 255."""
    inside = territory.select(*CELL).distinct().withColumn("_in", F.lit(True))
    code = F.when(F.col("_in").isNotNull(), F.col("classe")).otherwise(OUTSIDE)
    return (
        classes.join(inside, CELL, "left")
        .groupBy(code.alias("classe"))
        .agg(F.count("*").alias("n_px"))
        .withColumn("ha", F.col("n_px") * pixel_ha)
    )


def layered_exclusion(
    domain: DataFrame, layers: Mapping[str, DataFrame], pixel_ha: float
) -> DataFrame:
    """Area each layer removes from the domain beyond the earlier layers, the area it covers alone,
    and the remainder (row `remainder`)."""
    names = list(layers)
    stacked = None
    for rank, name in enumerate(names):
        part = layers[name].select(*CELL, F.lit(rank).alias("_rank"))
        stacked = part if stacked is None else stacked.unionByName(part)
    hits = stacked.groupBy(*CELL).agg(F.collect_set("_rank").alias("_ranks"))
    cells = domain.select(*CELL).distinct().join(hits, CELL, "left")
    first = F.array_min("_ranks")
    rows = cells.select(
        F.explode(
            F.when(
                F.col("_ranks").isNull(),
                F.array(F.struct(F.lit(len(names)).alias("rank"), F.lit(True).alias("new"))),
            ).otherwise(
                F.transform(
                    "_ranks", lambda r: F.struct(r.alias("rank"), (r == first).alias("new"))
                )
            )
        ).alias("_r")
    )
    label = F.element_at(F.array(*[F.lit(n) for n in [*names, "remainder"]]), F.col("rank") + 1)
    return (
        rows.groupBy(F.col("_r.rank").alias("rank"))
        .agg(F.count_if("_r.new").alias("_new"), F.count("*").alias("_all"))
        .select(
            "rank",
            label.alias("couche"),
            (F.col("_new") * pixel_ha).alias("ha_retire"),
            (F.col("_all") * pixel_ha).alias("ha_seule"),
        )
    )


def map_agreement(
    cells: DataFrame, maps: DataFrame, value: str, flags: Sequence[str], pixel_ha: float
) -> DataFrame:
    """For each candidate map (`source`, cells): area, share of the reference core it finds, area
    outside the reference with the median of a value and the share of each flag. `cells` has ix,
    iy, reference, coeur, the value and the flags."""
    core = cells.agg(F.count_if("coeur").alias("n")).scalar()
    joined = maps.select("source", *CELL).distinct().join(cells, CELL)
    outside = ~F.col("reference") & F.col(value).isNotNull()

    def share(condition: Column) -> Column:
        return 100 * F.avg(F.when(outside, condition.cast("int")))

    sums = joined.groupBy("source").agg(
        (F.count("*") * pixel_ha).alias("ha"),
        (100 * F.count_if("coeur")).alias("_found"),
        (F.count_if(outside) * pixel_ha).alias("ha_hors"),
        *[share(F.col(f)).alias(f"hors_{f}") for f in flags],
    ).withColumn("rappel", F.col("_found") / core).drop("_found")
    medians = exact_quantiles(joined.where(outside), ["source"], value, {"hors_mediane": 0.5})
    return sums.join(medians.drop("n"), "source", "left")
