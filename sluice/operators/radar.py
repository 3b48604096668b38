"""Radar pixels: dry reference, flood detection, areas per pass and winter trend."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Mapping, Sequence
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import calendar as cal
from sluice.functions.ranking import exact_medians, exact_quantiles
from sluice.functions.stats import gamma_cdf
from sluice.operators.components import connected_components
from sluice.operators.grid import TILE
from sluice.session import cut_lineage

# Detection and reference parameters of the published series.
DROP_DB, LIMIT_DB, PATCH_PX = 3.0, -16.0, 10
DRY_MONTHS, WINTER_MONTHS = (7, 8, 9), (12, 1, 2, 3)
Z95 = 1.959963984540054
CHUNK = 100_000  # rows of whole tiles a task filters at a time
IMAGE_ROWS = 1_000_000  # larger images have a distributed median
DENSE = 16  # places of a tile for each row of a chunk, up to which tiles are laid out as planes
# Exchanges after which the fifth of nine values is their median.
MEDIAN_OF_9 = (
    (1, 2), (4, 5), (7, 8), (0, 1), (3, 4), (6, 7), (1, 2), (4, 5), (7, 8), (0, 3),
    (5, 8), (4, 7), (3, 6), (1, 4), (2, 5), (4, 7), (4, 2), (6, 4), (4, 2),
)
EXACT_KENDALL = 33  # largest sample whose null distribution is tabulated


def to_decibel(power: Column) -> Column:
    return F.when(power > 0, 10 * F.log10(power))


def select_passes(scenes: DataFrame, orbit: int, start: str, end: str) -> DataFrame:
    """Passes of one relative orbit in a date range; the scenes of a day are one pass."""
    return (
        scenes.where((F.col("orbite") == orbit) & F.col("date").between(start, end))
        .groupBy("date")
        .agg(F.count("*").alias("n_scenes"), F.sort_array(F.collect_set("plateforme")).alias("plateformes"))
    )


def _centi(value: Column) -> Column:
    return F.rint(value * 100) / 100


def dry_reference(
    df: DataFrame,
    site: Sequence[str],
    months: Sequence[int] = DRY_MONTHS,
    period: tuple[int, int] | None = None,
    today: Column | None = None,
) -> DataFrame:
    """Per pixel and year: median of the passes of the dry months, to 0.01 dB (`annee`), and the
    fixed reference, median of the yearly ones of `period` (all without one; `annee` null). With
    `today`, a season that is not over is left out. Groups hold one season of passes."""
    if today is not None:
        df = df.where(cal.season_complete(F.year("date"), today, max(months)))
    return with_fixed_reference(yearly_reference(df, site, months), site, period)


def yearly_reference(df: DataFrame, site: Sequence[str], months: Sequence[int] = DRY_MONTHS) -> DataFrame:
    """Per pixel and year, the median of the passes of the dry months."""
    return (
        df.where(F.month("date").isin(list(months)) & F.col("db").isNotNull())
        .groupBy(*site, "ix", "iy", F.year("date").alias("annee"))
        .agg(_centi(F.median("db")).alias("ref"))
    )


def with_fixed_reference(
    yearly: DataFrame, site: Sequence[str], period: tuple[int, int] | None = None
) -> DataFrame:
    """Yearly references and the median of those of `period`, by `variante`."""
    chosen = yearly if period is None else yearly.where(F.col("annee").between(*period))
    fixed = chosen.groupBy(*site, "ix", "iy").agg(_centi(F.median("ref")).alias("ref"))
    return yearly.withColumn("variante", F.lit("hydro")).unionByName(
        fixed.withColumn("annee", F.lit(None).cast("int")).withColumn("variante", F.lit("fixe"))
    )


def _median(near: np.ndarray) -> np.ndarray:
    """Medians of nine rows of values, those that are not finite left out; NaN where none is."""
    n = np.isfinite(near).sum(axis=0)
    p = list(near)
    for i, j in MEDIAN_OF_9:
        p[i], p[j] = np.minimum(p[i], p[j]), np.maximum(p[i], p[j])
    out, few = p[4], np.flatnonzero(n < 9)
    if len(few):
        ordered, n = np.sort(near[:, few], axis=0), n[few]  # missing values last
        rows = np.arange(len(few))
        median = (ordered[np.maximum(n - 1, 0) // 2, rows] + ordered[np.minimum(n // 2, 8), rows]) / 2
        out[few] = np.where(n > 0, median, np.nan)
    return out


def _hash(*columns: str) -> Column:
    return F.xxhash64(*columns)


def median_filter_3x3(
    df: DataFrame, image: Sequence[str], value: str, name: str = "lisse", tile: int = TILE
) -> DataFrame:
    """3 x 3 median of each image: missing pixels first take the median of the image, and pixels
    beyond an edge repeat the edge. Rows without a pixel are outside the image.

    The image median is taken of images with a missing pixel only; that of an image of more than `IMAGE_ROWS`
    pixels is distributed. Rows with their halo are then dealt by (image, tile) and sorted by its hash, and a task filters
    whole tiles, many at a time: one shuffle of about the size of the table, where sending every pixel to its nine
    neighbours would move nine times as much. Other columns ride along."""
    image = list(image)
    df = cut_lineage(df)  # read by the median, the box and the tiles
    box = cut_lineage(
        df.groupBy(*image).agg(
            F.min("ix").alias("_x0"), F.max("ix").alias("_x1"),
            F.min("iy").alias("_y0"), F.max("iy").alias("_y1"),
            F.count(value).alias("_known"), F.count("*").alias("_rows"),
        )
    )
    gaps = box.where("_known > 0 AND _known < _rows").select(*image, "_known")
    small = df.join(gaps.where(F.col("_known") <= IMAGE_ROWS).select(*image), image, "left_semi")
    middle = small.groupBy(*image).agg(F.median(F.col(value).cast("double")).alias("_mid"))
    wide = gaps.where(F.col("_known") > IMAGE_ROWS).select(*image)
    if not wide.isEmpty():
        large = exact_quantiles(df.join(wide, image, "left_semi"), image, value, {"_mid": 0.5}).drop("n")
        middle = middle.unionByName(large)
    filled = df.join(box.drop("_known", "_rows").join(middle, image, "left"), image).withColumn(
        "_v", F.coalesce(F.col(value).cast("double"), "_mid")
    ).drop("_mid")

    def tiles(axis: str, low: str, high: str) -> Column:
        """Tiles of the image whose halo holds the row; beyond its box there are none to filter."""
        first = F.greatest(F.col(axis) - 1, F.col(low))
        return F.sequence(F.floor(first / tile), F.floor(F.least(F.col(axis) + 1, F.col(high)) / tile))

    halo = (
        filled.withColumn("_tx", F.explode(tiles("ix", "_x0", "_x1"))).withColumn("_ty", F.explode(tiles("iy", "_y0", "_y1")))
        .withColumn("_hash", _hash(*image, "_tx", "_ty"))
        .repartition(*image, "_tx", "_ty").sortWithinPartitions("_hash")
    )
    columns = [*image, "ix", "iy", *[c for c in df.columns if c not in {*image, "ix", "iy"}]]
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in columns) + f", `{name}` double"

    def changes(table: pa.Table) -> np.ndarray:
        """Rows whose (image, tile) is not that of the row before."""
        change = np.zeros(table.num_rows, bool)
        for c in (*image, "_tx", "_ty"):
            codes = table[c].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            change[1:] |= codes[1:] != codes[:-1]
        return change

    def smooth(table: pa.Table) -> pa.RecordBatch | None:
        change, place = changes(table), table["_hash"].to_numpy()
        if (change[1:] & (place[1:] == place[:-1])).any():  # tiles of one hash lie mixed
            table = table.sort_by([(c, "ascending") for c in (*image, "_tx", "_ty")])
            change = changes(table)
        x, y, tx, ty, x0, x1, y0, y1 = (table[c].to_numpy() for c in ("ix", "iy", "_tx", "_ty", "_x0", "_x1", "_y0", "_y1"))
        side = tile + 2
        base = np.cumsum(change) * (side * side)
        left, low = tx * tile - 1, ty * tile - 1
        values = table["_v"].to_numpy(zero_copy_only=False)
        place = base + (x - left) * side + y - low
        size = int(base[-1]) + side * side
        if size <= DENSE * len(x):
            plane = np.full(size, np.nan)
            plane[place[::-1]] = values[::-1]  # of repeated pixels the first
        else:
            plane, order = None, np.argsort(place, kind="stable")
            place, values = place[order], values[order]
        mine = np.flatnonzero((x // tile == tx) & (y // tile == ty))
        x, y, base, left, low, x0, x1, y0, y1 = (v[mine] for v in (x, y, base, left, low, x0, x1, y0, y1))
        columns_at = [base + (np.clip(x + d, x0, x1) - left) * side for d in (-1, 0, 1)]
        rows_at = [np.clip(y + d, y0, y1) - low for d in (-1, 0, 1)]
        near = np.empty((9, len(mine)))
        for i, wanted in enumerate(c + r for c in columns_at for r in rows_at):
            if plane is not None:
                near[i] = plane[wanted]
            else:
                at = np.minimum(np.searchsorted(place, wanted), len(place) - 1)
                near[i] = np.where(place[at] == wanted, values[at], np.nan)
        out = table.select(columns).take(pa.array(mine)).append_column(name, pa.array(_median(near)))
        return out.combine_chunks().to_batches()[0] if len(mine) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                if sum(b.num_rows for b in held) < CHUNK:
                    continue
            table = pa.Table.from_batches(held) if held else None
            if table is None or not table.num_rows:
                continue
            place = table["_hash"].to_numpy()
            # the last tile may go on in the next batch
            whole = table.num_rows if batch is None else int(np.searchsorted(place, place[-1]))
            if whole:
                done = smooth(table.slice(0, whole))
                if done is not None:
                    yield done
            held = table.slice(whole).to_batches()

    return halo.mapInArrow(run, schema)


def detect_change(
    smooth: Column, ref_smooth: Column, valid: Column, drop: float = DROP_DB, limit: float = LIMIT_DB
) -> Column:
    """Darker than the reference by more than `drop`, dark, and not already dark in it."""
    return valid & (smooth - ref_smooth < -drop) & (smooth < limit) & (ref_smooth >= limit)


def _joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of the part each of `n` pixels is in, by links `a` to `b`: roots are hooked to the least
    root they meet, then chains are followed, until both ends of every link agree."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return label
        la, lb = la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label = label[label]


def pixel_patches(flagged: DataFrame, image: Sequence[str], tile: int = TILE) -> DataFrame:
    """Flagged pixels with the `patch` (4-connected component, named by `image` and the first pixel of one of
    its parts) they belong to and its size, `taille`. Repeated pixels count once; pixels without a coordinate
    are left out; a null in `image` is an image of its own.

    Two levels: parts inside a tile are found in its task, an Arrow batch of at most tile x tile pixels.
    Only parts that meet another one across the border of two tiles are nodes of the distributed loop, so
    it handles borders and never pixels. One row per part is joined back to the pixels."""
    image = list(image)
    cells = flagged.select(*image, "ix", "iy").where("ix IS NOT NULL AND iy IS NOT NULL").distinct()
    types = dict(cells.dtypes)
    schema = ", ".join(f"`{c}` {t}" for c, t in cells.dtypes) + f", _ly {types['iy']}, _lx {types['ix']}"
    places = [F.floor(F.col(c) / tile).cast("long").alias(n) for c, n in (("ix", "_tx"), ("iy", "_ty"))]

    def parts_of_tile(table: pa.Table) -> pa.Table:
        x, y = table["ix"].to_numpy().astype("int64"), table["iy"].to_numpy().astype("int64")
        key = (y - y.min()) * (tile + 1) + x - x.min()  # one empty place after each row
        order = np.argsort(key)
        key, rows = key[order], table.take(pa.array(order))
        links = []
        for step in (1, tile + 1):
            at = np.minimum(np.searchsorted(key, key + step), len(key) - 1)
            links.append(np.stack([np.arange(len(key)), at])[:, key[at] == key + step])
        a, b = np.concatenate(links, axis=1)
        first = order[_joined(len(key), a, b)]
        out = rows.select([*image, "ix", "iy"])
        out = out.append_column("_ly", table["iy"].take(pa.array(first)))
        return out.append_column("_lx", table["ix"].take(pa.array(first)))

    labelled = cut_lineage(
        cells.select("*", *places).groupBy(*image, "_tx", "_ty").applyInArrow(parts_of_tile, schema)
        .select(*image, "ix", "iy", F.struct(*image, "_ly", "_lx").alias("_part"))
    )

    def meets(along: str, across: str) -> DataFrame:
        """Parts on both sides of the borders that `along` crosses."""
        place = F.struct(*image, F.col(along).alias("_u"), F.col(across).alias("_v"))
        before = F.struct(*image, (F.col(along) + 1).cast(types[along]).alias("_u"), F.col(across).alias("_v"))
        last = labelled.where(F.pmod(F.col(along), F.lit(tile)) == tile - 1).select(before.alias("_at"), F.col("_part").alias("a"))
        first = labelled.where(F.pmod(F.col(along), F.lit(tile)) == 0).select(place.alias("_at"), F.col("_part").alias("b"))
        return last.join(first, "_at").select("a", "b")

    edges = cut_lineage(meets("ix", "iy").unionByName(meets("iy", "ix")).distinct())
    nodes = edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id"))).distinct()
    merged = connected_components(nodes, edges).select(F.col("id").alias("_part"), "component")
    parts = cut_lineage(
        labelled.groupBy("_part").agg(F.count("*").alias("_n")).join(merged, "_part", "left")
        .select("_part", "_n", F.coalesce("component", "_part").alias("patch"))
    )
    sizes = parts.groupBy("patch").agg(F.sum("_n").alias("taille"))
    named = parts.drop("_n").join(sizes, "patch")
    return labelled.join(named, "_part").select(*image, "ix", "iy", "patch", "taille")


def min_patch_size(flagged: DataFrame, image: Sequence[str], minimum: int = PATCH_PX) -> DataFrame:
    """Flagged pixels of patches of at least `minimum` pixels."""
    return pixel_patches(flagged, image).where(F.col("taille") >= minimum).drop("patch", "taille")


def area_by_regime(
    df: DataFrame, keys: Sequence[str], regimes: Sequence[str], pixel_ha: float
) -> DataFrame:
    """Flooded hectares of the domain, per regime and elsewhere, and percentage observable. `df`
    has crue, ok, domaine (booleans) and regime (text, null outside all regimes)."""
    inside = F.col("domaine")
    flood = F.col("crue") & inside
    return df.groupBy(*keys).agg(
        (F.count_if(flood) * pixel_ha).alias("surface_ha"),
        (100 * F.count_if(F.col("ok") & inside) / F.nullif(F.count_if(inside), F.lit(0))).alias(
            "pct_valides"
        ),
        *[
            (F.count_if(flood & (F.col("regime") == r)) * pixel_ha).alias(f"ha_{r}")
            for r in regimes
        ],
        (F.count_if(flood & F.col("regime").isNull()) * pixel_ha).alias("ha_autres"),
    )


def passages(
    pixels: DataFrame,
    domain: DataFrame,
    regimes: Sequence[str],
    pixel_ha: float,
    minimum: int = PATCH_PX,
    tile: int = TILE,
    variants: Sequence[str] = ("hydro", "fixe"),
    drop: float = DROP_DB,
    limit: float = LIMIT_DB,
    period: tuple[int, int] | None = None,
    today: Column | None = None,
) -> DataFrame:
    """All passes with each reference variant: areas, or nulls where the reference is missing.

    `pixels` has marais, ix, iy, date, db on the full grid of each pass; `domain` marais, ix, iy,
    domaine, regime. Passes and references are smoothed once and written aside for the joins."""
    pixels = cut_lineage(pixels)
    refs = dry_reference(pixels, ["marais"], period=period, today=today)
    refs = refs.where(F.col("variante").isin(list(variants)))
    asked = pixels.select("marais", "date").distinct().withColumn(
        "variante", F.explode(F.array(*[F.lit(v) for v in variants]))
    )
    smooth = smooth_references(refs, domain, tile)
    return detect_passes(pixels, asked, smooth, domain, regimes, pixel_ha, minimum, tile, drop, limit)


REFERENCE_IMAGE = ["marais", "variante", "annee_ref"]


def smooth_references(refs: DataFrame, domain: DataFrame, tile: int = TILE) -> DataFrame:
    """Every reference on the full grid of its site, with its 3 x 3 median `ref_lisse` and `domaine`; written once."""
    refs = refs.withColumn("annee_ref", F.coalesce("annee", F.lit(0)))
    known = refs.select(*REFERENCE_IMAGE).distinct()
    full = domain.select("marais", "ix", "iy", "domaine").join(known, "marais").join(
        refs.select(*REFERENCE_IMAGE, "ix", "iy", "ref"), [*REFERENCE_IMAGE, "ix", "iy"], "left"
    )
    return cut_lineage(median_filter_3x3(full, REFERENCE_IMAGE, "ref", "ref_lisse", tile))


def detect_passes(
    pixels: DataFrame,
    asked: DataFrame,
    ref_smooth: DataFrame,
    domain: DataFrame,
    regimes: Sequence[str],
    pixel_ha: float,
    minimum: int = PATCH_PX,
    tile: int = TILE,
    drop: float = DROP_DB,
    limit: float = LIMIT_DB,
) -> DataFrame:
    """The areas of the passes `asked` (marais, date, variante), against the references of
    `smooth_references`."""
    year = F.when(F.col("variante") != "fixe", cal.season_reference_year(F.col("date")))
    asked = asked.withColumn("annee_ref", F.coalesce(year, F.lit(0)))
    passes = asked.join(ref_smooth.select(*REFERENCE_IMAGE).distinct(), REFERENCE_IMAGE, "left_semi")
    joined = passes.join(pixels, ["marais", "date"]).join(ref_smooth, [*REFERENCE_IMAGE, "ix", "iy"])
    ok = F.col("db").isNotNull() & F.col("ref").isNotNull()
    keys = ["marais", "date", "variante", "annee_ref"]
    joined = joined.select(*keys, "ix", "iy", "domaine", "ref_lisse", ok.alias("ok"), F.when(ok, F.col("db")).alias("_seen"))
    low = detect_change(F.col("lisse"), F.col("ref_lisse"), F.col("ok"), drop, limit)
    smooth = cut_lineage(
        median_filter_3x3(joined, keys, "_seen", "lisse", tile)
        .select(*keys, "ix", "iy", "ok", "domaine", low.alias("_low"))
    )
    # all pixels are only counted; those of patches, which are few, are joined with their regime
    inside = F.col("domaine")
    seen = smooth.groupBy(*keys).agg(F.count_if(F.col("ok") & inside).alias("_ok"), F.count_if(inside).alias("_inside"))
    kept = min_patch_size(smooth.where("_low").select(*keys, "ix", "iy"), keys, minimum).join(domain, ["marais", "ix", "iy"])
    wet = kept.where(inside).groupBy(*keys).agg(
        F.count("*").alias("surface_ha"),
        *[F.count_if(F.col("regime") == r).alias(f"ha_{r}") for r in regimes],
        F.count_if(F.col("regime").isNull()).alias("ha_autres"),
    )
    areas = seen.join(wet, keys, "left").select(
        *keys,
        (F.coalesce("surface_ha", F.lit(0)) * pixel_ha).alias("surface_ha"),
        (100 * F.col("_ok") / F.nullif(F.col("_inside"), F.lit(0))).alias("pct_valides"),
        *[(F.coalesce(c, F.lit(0)) * pixel_ha).alias(c) for c in (*[f"ha_{r}" for r in regimes], "ha_autres")],
    )
    return asked.join(areas, keys, "left")


def _areas(df: DataFrame) -> list[str]:
    return ["surface_ha", *[c for c in df.columns if c.startswith("ha_")]]


def observable(passes: DataFrame, pct_min: float = 0.0) -> DataFrame:
    return passes.where(F.col("surface_ha").isNotNull() & (F.col("pct_valides") >= pct_min))


def monthly_area(passes: DataFrame, pct_min: float = 0.0) -> DataFrame:
    """Median of the areas of a month's passes and their number. A month holds a few passes."""
    rows = observable(passes, pct_min)
    return rows.groupBy(
        "marais", "variante", F.date_format("date", "yyyy-MM").alias("mois")
    ).agg(
        *[F.median(c).alias(c) for c in _areas(rows)],
        F.count("*").alias("n_passages"),
        F.median("pct_valides").alias("pct_valides"),
    )


def winter_areas(passes: DataFrame, pct_min: float = 0.0, passes_min: int = 3) -> DataFrame:
    """Median area per winter, of the winters with enough passes and one in each month."""
    return (
        observable(passes, pct_min)
        .withColumn("hiver", cal.winter_label(F.col("date")))
        .where(F.col("hiver").isNotNull())
        .groupBy("marais", "variante", "hiver")
        .agg(
            F.median("surface_ha").alias("surface_ha"),
            F.count("*").alias("_n"),
            F.count_distinct(F.month("date")).alias("_m"),
        )
        .where((F.col("_n") >= passes_min) & (F.col("_m") == len(WINTER_MONTHS)))
        .drop("_n", "_m")
    )


def kendall_exact_rows(largest: int = EXACT_KENDALL) -> list[tuple[int, int, float]]:
    """(n, c, p): two-sided probability of at most c inversions (or as few agreements) among the
    orders of n values, c up to half the pairs."""
    rows, counts = [], [1]
    for n in range(2, largest + 1):
        wider = [0] * (len(counts) + n - 1)
        for i, v in enumerate(counts):
            for j in range(n):
                wider[i + j] += v
        counts = wider
        pairs, below = n * (n - 1) // 2, 0
        for c in range(pairs // 2 + 1):
            below += counts[c]
            rows.append((n, c, min(1.0, 2 * below / factorial(n))))
    return rows


def trend_test(
    yearly: DataFrame, keys: Sequence[str], year: str, value: str, minimum: int = 5
) -> DataFrame:
    """Theil-Sen slope with its 95 % interval, Kendall tau-b and its p value, per key.

    There is one value per year, so a key is a short array and the pairs of years are formed
    inside its row. The p value is exact for short series without ties (a table of at most a few
    thousand rows), else the normal approximation."""
    keys = list(keys)
    series = yearly.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.sort_array(
            F.collect_list(F.struct(F.col(year).alias("x"), F.col(value).cast("double").alias("y")))
        ).alias("_s")
    )
    pairs = F.flatten(
        F.transform(
            "_s",
            lambda a: F.transform(
                F.filter("_s", lambda b: b["x"] > a["x"]),
                lambda b: (b["y"] - a["y"]) / (b["x"] - a["x"]),
            ),
        )
    )
    n = F.size("_s")
    total = F.size("_slopes")
    rows = series.withColumn("_slopes", F.sort_array(pairs)).withColumn(
        "_ties",
        F.transform(
            "_s", lambda a: F.size(F.filter("_s", lambda b: b["y"] == a["y"]))
        ),
    )

    def fold(term) -> Column:
        return F.aggregate("_ties", F.lit(0.0), lambda acc, k: acc + term(k))

    def count(condition) -> Column:
        return F.size(F.filter("_slopes", condition))

    rows = rows.select(
        *keys,
        n.alias("n"),
        F.array_min(F.transform("_s", lambda a: a["x"])).alias("first"),
        F.array_max(F.transform("_s", lambda a: a["x"])).alias("last"),
        F.sort_array(F.transform("_s", lambda a: a["y"])).alias("_y"),
        "_slopes",
        total.alias("_total"),
        count(lambda v: v > 0).alias("_con"),
        count(lambda v: v < 0).alias("_dis"),
        fold(lambda k: (k - 1) / 2).alias("_tied"),
        fold(lambda k: (k - 1) * (2 * k + 5)).alias("_t1"),
        fold(lambda k: (k - 1) * (k - 2)).alias("_t0"),
    )
    nn = F.col("n").cast("double")
    sigma = F.sqrt((nn * (nn - 1) * (2 * nn + 5) - F.col("_t1")) / 18)
    low = F.greatest(F.rint((F.col("_total") - Z95 * sigma) / 2) - 1, F.lit(0.0))
    high = F.least(F.rint((F.col("_total") + Z95 * sigma) / 2), F.col("_total") - 1)

    def middle(array: str) -> Column:
        m = F.size(array)
        a = F.get(array, F.floor((m - 1) / 2).cast("int"))
        return (a + F.get(array, F.floor(m / 2).cast("int"))) / 2

    gap = F.col("_con") - F.col("_dis")
    tau = gap / F.nullif(
        F.sqrt(F.col("_total") * (F.col("_total") - F.col("_tied"))), F.lit(0.0)
    )
    m = nn * (nn - 1)
    variance = (m * (2 * nn + 5) - F.col("_t1")) / 18
    enough = F.col("n") >= minimum
    tested = rows.select(
        *keys,
        "n",
        "first",
        "last",
        middle("_y").alias("median"),
        F.when(enough, middle("_slopes")).alias("slope"),
        F.when(enough, F.get("_slopes", low.cast("int"))).alias("slope_low"),
        F.when(enough, F.get("_slopes", high.cast("int"))).alias("slope_high"),
        F.when(enough, tau).alias("tau"),
        F.when(enough & (F.col("_tied") == 0), F.least("_con", "_dis")).alias("_c"),
        F.when(enough & (variance > 0), gap * gap / variance / 2).alias("_half"),
    )
    spark = yearly.sparkSession
    exact = spark.createDataFrame(kendall_exact_rows(), "n int, _c int, _p double")
    joined = tested.join(F.broadcast(exact), ["n", "_c"], "left")
    # erfc(|z| / sqrt 2) is 1 - P(1/2, z^2 / 2)
    normal = 1 - gamma_cdf(F.col("_half"), F.lit(0.5), F.lit(1.0))
    # with at most one pair against the trend the exact value is 2 / n! or 2 / (n - 1)! for any n
    ends = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.col("n") - F.col("_c"), F.lit(1)).cast("int")),
        F.lit(2.0), lambda total, i: total / i,
    )
    steep = F.when((F.col("n") > EXACT_KENDALL) & (F.col("_c") <= 1), ends)
    return joined.select(
        *keys, "n", "first", "last", "median", "slope", "slope_low", "slope_high", "tau",
        F.coalesce("_p", steep, normal).alias("p"),
    )


def winter_trend(passes: DataFrame, pct_min: float = 0.0, passes_min: int = 3) -> DataFrame:
    return trend_test(
        winter_areas(passes, pct_min, passes_min), ["marais", "variante"], "hiver", "surface_ha"
    )


def permanent_mask(
    df: DataFrame, dark: Column, thresholds: Sequence[float], pixel_ha: float, share: float = 0.5
) -> tuple[DataFrame, DataFrame]:
    """(area whose share of dark passes exceeds each threshold, per site; per site and year: area
    of the year's mask, of the fixed one, and their Jaccard index). `df` has marais, ix, iy, date,
    db; passes without a value do not count."""
    seen = df.where(F.col("db").isNotNull()).withColumn("_dark", dark.cast("int"))
    yearly = seen.groupBy("marais", "ix", "iy", F.year("date").alias("annee")).agg(
        F.sum("_dark").alias("_d"), F.count("*").alias("_n")
    )
    fixed = yearly.groupBy("marais", "ix", "iy").agg(
        (F.sum("_d") / F.sum("_n")).alias("part")
    )
    sweep = F.explode(F.array(*[F.lit(float(x)) for x in thresholds]))
    areas = (
        fixed.withColumn("seuil", sweep)
        .groupBy("marais", "seuil")
        .agg((F.count_if(F.col("part") > F.col("seuil")) * pixel_ha).alias("ha"))
    )
    years = yearly.select("marais", "annee").distinct()
    grid = fixed.select("marais", "ix", "iy", (F.col("part") > share).alias("_fixed")).join(
        years, "marais"
    )
    mine = yearly.select(
        "marais", "ix", "iy", "annee", (F.col("_d") / F.col("_n") > share).alias("_year")
    )
    both = grid.join(mine, ["marais", "ix", "iy", "annee"], "left").fillna({"_year": False})
    f, y = F.col("_fixed"), F.col("_year")
    agreement = both.groupBy("marais", "annee").agg(
        (F.count_if(y) * pixel_ha).alias("ha_annee"),
        (F.count_if(f) * pixel_ha).alias("ha_fixe"),
        (F.count_if(f & y) / F.greatest(F.count_if(f | y), F.lit(1))).alias("jaccard"),
        (F.count_if(y & ~f) * pixel_ha).alias("ha_annee_hors_fixe"),
        (F.count_if(f & ~y) * pixel_ha).alias("ha_fixe_hors_annee"),
    )
    return areas, agreement


def pixel_correlation(
    df: DataFrame, series: DataFrame, keys: Sequence[str], time: str, value: str, other: str,
    minimum: int = 20,
) -> DataFrame:
    """Pearson correlation of each pixel with an external series; null under `minimum` passes."""
    pairs = df.join(series.select(time, other), time).where(
        F.col(value).isNotNull() & F.col(other).isNotNull()
    )
    return pairs.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.when(F.count("*") >= minimum, F.corr(value, other)).alias("r"),
    )


def correlated_share(correlations: DataFrame, threshold: float = -0.5) -> DataFrame:
    known = correlations.where(F.col("r").isNotNull())
    return known.agg(
        F.count("*").alias("n_px"), F.avg((F.col("r") < threshold).cast("int")).alias("part")
    )


def distance_bands(
    df: DataFrame, distance: str, flag: str, limits: Sequence[float], pixel_ha: float
) -> DataFrame:
    """Area, flagged area and flagged share per band of distance (band i ends at limits[i])."""
    band = F.lit(0)
    for limit in limits:
        band = band + F.when(F.col(distance) > limit, 1).otherwise(0)
    return df.groupBy(band.alias("bande")).agg(
        (F.count("*") * pixel_ha).alias("ha"),
        (F.count_if(flag) * pixel_ha).alias("ha_signale"),
        F.avg(F.col(flag).cast("int")).alias("part"),
    )


def margin_areas(
    df: DataFrame, distance: str, flag: str, margins: Sequence[float], pixel_ha: float
) -> DataFrame:
    """For each margin: area removed at or within it, flagged area left beyond it and its share.
    Counted per band first, then summed over the bands of each margin."""
    ordered = sorted(float(m) for m in margins)
    bands = distance_bands(df, distance, flag, ordered, pixel_ha)
    steps = F.explode(
        F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).alias("marge")) for i, m in enumerate(ordered)])
    )
    kept = F.col("bande") > F.col("_s.i")
    return (
        bands.withColumn("_s", steps)
        .groupBy("_s.marge")
        .agg(
            F.sum(F.when(~kept, F.col("ha")).otherwise(0.0)).alias("ha_retire"),
            F.sum(F.when(kept, F.col("ha_signale")).otherwise(0.0)).alias("ha_signale_reste"),
            F.sum(F.when(kept, F.col("ha")).otherwise(0.0)).alias("_kept"),
        )
        .withColumn("part_reste", F.col("ha_signale_reste") / F.nullif("_kept", F.lit(0.0)))
        .drop("_kept")
    )


def detection_scores(
    df: DataFrame, variants: Mapping[str, Column], truth: str, keys: Sequence[str]
) -> DataFrame:
    """True and false positives, misses, precision and recall of each variant (name -> condition).
    Counts are aggregated wide, so pixels are not repeated per variant."""
    t = F.col(truth)
    counts = []
    for name, condition in variants.items():
        c = F.coalesce(condition, F.lit(False))
        counts.append(
            F.struct(
                F.lit(name).alias("variante"),
                F.count_if(c & t).alias("tp"),
                F.count_if(c & ~t).alias("fp"),
                F.count_if(~c & t).alias("fn"),
            )
        )
    rows = df.groupBy(*keys).agg(F.array(*counts).alias("_v"))
    one = F.lit(1)
    return (
        rows.select(*keys, F.explode("_v").alias("_v"))
        .select(*keys, "_v.*")
        .withColumn("precision", F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), one))
        .withColumn("rappel", F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), one))
    )


def common_coverage(
    df: DataFrame, references: DataFrame, orbits: int, thresholds: Sequence[float], pixel_ha: float,
    drop: float = DROP_DB, limit: float = LIMIT_DB,
) -> DataFrame:
    """Flooded area per orbit, date and threshold, on all pixels and on those whose reference is
    valid in all orbits. `df` has orbite, date, ix, iy, db; `references` orbite, ix, iy, ref."""
    known = references.where(F.col("ref").isNotNull())
    common = (
        known.groupBy("ix", "iy").agg(F.count_distinct("orbite").alias("_n"))
        .where(F.col("_n") == orbits).select("ix", "iy", F.lit(True).alias("_common"))
    )
    rows = df.where(F.col("db").isNotNull()).join(known, ["orbite", "ix", "iy"]).join(
        common, ["ix", "iy"], "left"
    )
    inside = F.col("_common").isNotNull()
    base = (F.col("db") - F.col("ref") < -drop) & (F.col("ref") >= limit)
    cells = []
    for x in thresholds:
        hit = base & (F.col("db") < x)
        cells.append(
            F.struct(
                F.lit(float(x)).alias("absolu"),
                (F.count_if(hit) * pixel_ha).alias("crue_ha"),
                (F.count_if(hit & inside) * pixel_ha).alias("crue_commun_ha"),
            )
        )
    return (
        rows.groupBy("orbite", "date")
        .agg(
            (F.count("*") * pixel_ha).alias("couvert_ha"),
            (F.count_if(inside) * pixel_ha).alias("commun_ha"),
            F.array(*cells).alias("_c"),
        )
        .select("orbite", "date", "couvert_ha", "commun_ha", F.explode("_c").alias("_c"))
        .select("orbite", "date", "couvert_ha", "commun_ha", "_c.*")
    )


def baseline_pair_gap(old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Median difference of each value between two processings of the same pixels, per key."""
    cell = [*keys, "ix", "iy"]
    a = old.select(*cell, *[F.col(v).alias(f"_a_{v}") for v in values])
    b = new.select(*cell, *[F.col(v).alias(f"_b_{v}") for v in values])
    gaps = a.join(b, cell).select(
        *keys, *[(F.col(f"_b_{v}") - F.col(f"_a_{v}")).alias(v) for v in values]
    )
    return exact_medians(gaps, keys, values)


def separation_profile(
    df: DataFrame, keys: Sequence[str], label: str, value: str,
    probabilities: Mapping[str, float], thresholds: Sequence[float],
) -> DataFrame:
    """Quantiles of a value inside and outside a labelled area and share under each threshold."""
    groups = [*keys, label]
    shares = df.where(F.col(value).isNotNull()).groupBy(*groups).agg(
        *[
            F.avg((F.col(value) < x).cast("int")).alias(f"part_lt_{str(abs(x)).replace('.', '_')}")
            for x in thresholds
        ]
    )
    return exact_quantiles(df, groups, value, probabilities).join(shares, groups)
