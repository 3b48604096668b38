from collections import deque

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluice.operators import grid, optical, radar, spatial
from sluice.operators.components import connected_components


def frame(spark, mask, **extra):
    x, y = np.nonzero(mask)
    return spark.createDataFrame(pd.DataFrame({"ix": x.astype("int32"), "iy": y.astype("int32"), **extra}))


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1_000, 1_001 + i) for i in range(300)]
    edges = spark.createDataFrame(path + star, "a long, b long")
    nodes = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    got = dict(connected_components(nodes, edges).collect())
    assert {got[i] for i in range(201)} == {0}
    assert {got[i] for i in range(1_000, 1_301)} == {1_000}


def test_components_of_shapes_with_many_local_minima(spark):
    n = 1_000
    arms = [(i, i + 1) for i in range(n // 2)] + [(i, i + 1) for i in range(n, n // 2 + 1, -1)]
    u_shape = [(a, b) for a, b in arms if 0 <= min(a, b) and max(a, b) <= n] + [(n // 2, n // 2 + 1)]
    zigzag = [(10_000 + i, 20_000 + i) for i in range(n)] + [(20_000 + i, 10_001 + i) for i in range(n)]
    comb = [(30_000 + i, 30_001 + i) for i in range(n)] + [(30_000 + i, 29_000 - i) for i in range(0, n, 3)]
    edges = spark.createDataFrame(u_shape + zigzag + comb, "a long, b long")
    nodes = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    got = connected_components(nodes, edges).toPandas()
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in u_shape + zigzag + comb:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert {r.id: r.component for r in got.itertuples()} == {x: find(x) for x in parent}


@pytest.mark.parametrize("tile", [4, 16, 256])
def test_dilation_further_than_a_tile(spark, tile):
    one = spark.createDataFrame([("a", 0, 0)], "im string, ix int, iy int")
    assert grid.dilate_cells(one, ["im"], 40, tile).count() == 2 * 40 * 41 + 1


def test_patches_equal_a_flood_fill(spark):
    mask = np.random.default_rng(8).random((40, 30)) < 0.45
    sizes = np.zeros(mask.shape, int)
    seen = np.zeros(mask.shape, bool)
    for start in zip(*np.nonzero(mask)):
        if seen[start]:
            continue
        seen[start], patch, todo = True, [], deque([start])
        while todo:
            x, y = todo.popleft()
            patch.append((x, y))
            for q in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if 0 <= q[0] < 40 and 0 <= q[1] < 30 and mask[q] and not seen[q]:
                    seen[q] = True
                    todo.append(q)
        for q in patch:
            sizes[q] = len(patch)
    df = frame(spark, mask).withColumn("im", F.lit("a"))
    for r in radar.pixel_patches(df, ["im"]).collect():
        assert r["taille"] == sizes[r["ix"], r["iy"]]


@pytest.mark.parametrize("tile", [4, 256])
def test_median_filter_repeats_the_edge(spark, tile):
    rng = np.random.default_rng(9)
    image = rng.normal(size=(13, 11))
    image[3, 4] = image[0, 0] = np.nan
    x, y = np.indices(image.shape)
    pdf = pd.DataFrame({"im": "a", "ix": x.ravel().astype("int32"), "iy": y.ravel().astype("int32"), "v": image.ravel()})
    df = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None).cast("double")))
    got = radar.median_filter_3x3(df, ["im"], "v", tile=tile).toPandas()
    full = np.pad(np.where(np.isnan(image), np.nanmedian(image), image), 1, mode="edge")
    for r in got.itertuples():
        assert r.lisse == pytest.approx(np.median(full[r.ix : r.ix + 3, r.iy : r.iy + 3]))


@pytest.mark.parametrize("tile", [4, 256])
def test_erode_and_dilate(spark, tile):
    mask = np.zeros((20, 20), bool)
    mask[3:12, 5:14] = True
    df = frame(spark, mask).withColumn("k", F.lit(1))
    kept = {(r["ix"], r["iy"]) for r in grid.erode_cells(df, "k", tile).collect()}
    assert kept == {(x, y) for x in range(4, 11) for y in range(6, 13)}
    one = df.where("ix = 7 AND iy = 8")
    grown = {(r["ix"], r["iy"]) for r in grid.dilate_cells(one, [], 2, tile).collect()}
    assert grown == {(7 + a, 8 + b) for a in range(-2, 3) for b in range(-2, 3) if abs(a) + abs(b) <= 2}


def test_partition_covers_the_territory(spark):
    cells = pd.DataFrame([(x, y) for x in range(20) for y in range(10)], columns=["ix", "iy"])
    territory = spark.createDataFrame(cells)
    zone = np.where(cells["ix"] < 10, "A", "B")
    claimed = cells.assign(zone_id=zone, rang=(zone == "B").astype(int))
    claimed = claimed[~((cells["ix"] == 4) & (cells["iy"] == 4))]  # a gap inside A
    island = pd.DataFrame({"ix": [15], "iy": [5], "zone_id": ["A"], "rang": [0]})  # A inside B
    claims = spark.createDataFrame(pd.concat([claimed, island]))
    got = spatial.partition_zones(claims, territory, 5).toPandas()
    assert len(got) == 200 and got["zone_id"].notna().all()
    owner = {(r.ix, r.iy): r.zone_id for r in got.itertuples()}
    assert owner[(4, 4)] == "A" and owner[(15, 5)] == "B"


def test_gap_far_from_any_zone_takes_the_nearest(spark):
    cells = pd.DataFrame([(x, 0) for x in range(60)], columns=["ix", "iy"])
    claimed = cells[(cells["ix"] < 10) | (cells["ix"] >= 50)]
    claimed = claimed.assign(zone_id=np.where(claimed["ix"] < 10, "A", "B"), rang=0)
    island = pd.DataFrame({"ix": [200], "iy": [3]})  # touches nothing
    territory = spark.createDataFrame(pd.concat([cells, island]))
    got = spatial.partition_zones(spark.createDataFrame(claimed), territory, 5).toPandas()
    owner = {(r.ix, r.iy): r.zone_id for r in got.itertuples()}
    assert got["zone_id"].notna().all() and owner[(200, 3)] == "B"
    none = spatial.partition_zones(spark.createDataFrame(claimed).limit(0), territory, 5)
    assert none.where("zone_id IS NOT NULL").count() == 0 and none.count() == 61


def test_dry_reference_of_a_period_and_of_seasons_that_are_over(spark):
    rows = [("M", 0, 0, f"{y}-08-01", float(-y % 100)) for y in range(2015, 2021)]
    px = spark.createDataFrame(rows, "marais string, ix int, iy int, date string, db double").withColumn("date", F.to_date("date"))
    today = F.lit("2020-09-30").cast("date")
    got = {r.annee: r.ref for r in radar.dry_reference(px, ["marais"], period=(2015, 2017), today=today).collect()}
    assert sorted(y for y in got if y) == [2015, 2016, 2017, 2018, 2019] and got[None] == -2016 % 100


def test_refusals(spark):
    from sluice.operators import landcover
    from sluice.sources import scans

    px = spark.createDataFrame([(0, 0, 1), (1, 0, 2)], "ix int, iy int, code int")
    names = spark.createDataFrame([(1, 5)], "code int, classe int")
    assert landcover.map_codes(px, names)[0].count() == 1
    with pytest.raises(Exception, match="unknown land-cover code 2"):
        landcover.map_codes(px, names, refuse=True)[0].collect()
    raw = spark.createDataFrame(
        [(1, "17", '[" a ","null"]', '["x","undefined"]'), (2, "79", '["a"]', '["x","y"]')], "id int, dep string, noms string, types string"
    )
    lists = {"nom": "noms", "type": "types"}
    rows, bad = scans.explode_orders(raw, lists, ["id"], "nom")
    assert {(r.nom, r.type) for r in rows.collect()} == {("a", "x"), (None, None)} and bad.count() == 1
    with pytest.raises(Exception, match="lists of different length in order 2"):
        scans.explode_orders(raw, lists, ["id"], "nom", refuse=True)[0].collect()
    one, _ = scans.explode_orders(raw, lists, ["id"], "nom", refuse=True, departments=("dep", ["17"]))
    assert one.count() == 2


def test_same_reflectance_with_and_without_offset(spark):
    rows = [(2000, 4000, 3000, 4, 0.0), (3000, 5000, 4000, 4, -1000.0), (2000, 0, 3000, 4, 0.0), (2000, 4000, 3000, 9, 0.0)]
    df = spark.createDataFrame(rows, "b04 int, b08 int, b11 int, scl int, offset double")
    got = optical.pixel_indices(df, [4, 5]).collect()
    assert got[0]["ndvi"] == pytest.approx(got[1]["ndvi"]) and got[0]["ndmi"] == pytest.approx(got[1]["ndmi"])
    assert got[2]["ndvi"] is None and got[3]["ndvi"] is None


def drift(spark, bias):
    rows = []
    for i in range(120):
        day = pd.Timestamp("2020-01-01") + pd.Timedelta(days=3 * i)
        platform = "ABC"[i % 3]
        v = 0.5 + 0.2 * np.sin(i / 19) + (bias if platform == "B" else 0)
        rows.append((f"p{i}", "pin", day.date(), day.strftime("%Y-%m"), platform, 0.0, 1000, float(v), float(v) / 2))
    return spark.createDataFrame(
        rows, "cle string, classe string, date date, mois string, plateformes string, offset double, n_px long, ndvi double, ndmi double"
    )


@pytest.mark.parametrize(("bias", "alarm"), [(0.0, False), (0.06, True)])
def test_season_alone_raises_no_alarm(spark, bias, alarm):
    groups = optical.drift_groups(optical.drift_residuals(drift(spark, bias)))
    gaps = optical.drift_gaps(groups).where("critere = 'plateforme'").collect()
    assert [r["anormal"] for r in gaps] == [alarm]


def test_flooded_square(spark):
    """A dark square of 20 x 20 pixels: the filter rounds its four corners, a small patch goes."""
    rows = []
    for x in range(40):
        for y in range(40):
            flood = (8 <= x < 28 and 8 <= y < 28) or (x in (34, 35) and y in (34, 35))
            for day, wet in (("2020-08-05", False), ("2021-01-10", True)):
                rows.append(("m", x, y, day, -20.0 if wet and flood else -10.0))
    pixels = spark.createDataFrame(rows, "marais string, ix int, iy int, d string, db double").select(
        "marais", "ix", "iy", F.to_date("d").alias("date"), "db"
    )
    domain = pixels.select("marais", "ix", "iy", F.lit(True).alias("domaine"), F.lit(None).cast("string").alias("regime")).distinct()
    got = radar.passages(pixels, domain, [], 1.0, variants=["hydro"]).where("date = '2021-01-10'").first()
    assert got["surface_ha"] == 396 and got["pct_valides"] == 100


def test_median_filter_of_scattered_pixels_in_many_images(spark, monkeypatch):
    """Images in sparse tiles with missing pixels, chunks of a few rows; no column is joined back by pixel."""
    rng = np.random.default_rng(4)
    rows = [
        (im, int(x), int(y), None if rng.random() < 0.2 else float(rng.integers(0, 50)), f"{im}{x}")
        for im in ("a", "b", "c", None)
        for x, y in {tuple(p) for p in rng.integers(-9, 12, (90, 2))}
    ]
    df = spark.createDataFrame(rows, "im string, ix int, iy int, v double, note string")
    monkeypatch.setattr(radar, "CHUNK", 20)
    monkeypatch.setattr(radar, "IMAGE_ROWS", 70)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 9)
    try:
        result = radar.median_filter_3x3(df, ["im"], "v", tile=4)
        got = {(r["im"], r["ix"], r["iy"]): (r["lisse"], r["v"], r["note"]) for r in result.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    seen = {}
    for im in ("a", "b", "c"):
        image = {(x, y): v for i, x, y, v, _ in rows if i == im}
        middle = np.median([v for v in image.values() if v is not None])
        filled = {k: middle if v is None else v for k, v in image.items()}
        lo, hi = np.min(list(image), axis=0), np.max(list(image), axis=0)
        for x, y in image:
            near = [tuple(np.clip((x + a, y + b), lo, hi)) for a in (-1, 0, 1) for b in (-1, 0, 1)]
            seen[im, x, y] = (np.median([filled[q] for q in near if q in filled]), image[x, y], f"{im}{x}")
    assert got == seen
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Join" in line and "ix#" in line for line in plan.splitlines())


def test_pixels_of_an_archive_are_made_once(spark, monkeypatch):
    from registry import QUERIES, load
    from registry import radar_queries as rq

    load()
    made, make = [], rq.pixels
    monkeypatch.setattr(rq, "pixels", lambda t: made.append(1) or make(t))
    assert QUERIES["passages_units"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(made) == 1


def test_median_filter_of_tiles_with_one_hash(spark, monkeypatch):
    """Rows of tiles whose hashes are equal lie mixed; planes and searches give the same."""
    rng = np.random.default_rng(6)
    rows = [
        (im, int(x), int(y), None if rng.random() < 0.2 else float(rng.integers(0, 50)))
        for im in "abc" for x, y in {tuple(p) for p in rng.integers(-9, 12, (150, 2))}
    ]
    df = spark.createDataFrame(rows, "im string, ix int, iy int, v double").repartition(5)
    want = {tuple(r) for r in radar.median_filter_3x3(df, ["im"], "v", tile=4).select("im", "ix", "iy", "lisse").collect()}
    monkeypatch.setattr(radar, "_hash", lambda *c: F.lit(7).cast("long"))
    for dense in (0, 16):
        monkeypatch.setattr(radar, "DENSE", dense)
        got = radar.median_filter_3x3(df, ["im"], "v", tile=4).select("im", "ix", "iy", "lisse").collect()
        assert {tuple(r) for r in got} == want and len(got) == len(rows)


def test_median_of_nine():
    near = np.random.default_rng(1).integers(0, 6, (9, 500)).astype(float)
    near[np.random.default_rng(2).random(near.shape) < 0.1] = np.nan
    near[:, 0] = np.nan
    got = radar._median(near.copy())
    assert np.isnan(got[0]) and (got[1:] == np.nanmedian(near[:, 1:], axis=0)).all()


def test_passes_join_only_pixels_of_patches(spark):
    """Counts of all pixels need no join by pixel after the filter; the dry image has no patch and areas of 0."""
    from datetime import date

    pixels = spark.createDataFrame(
        [("M", x, y, date(2020, m, 1), -10.0 if m == 8 or x > 3 else -20.0) for x in range(6) for y in range(4) for m in (8, 11)],
        "marais string, ix int, iy int, date date, db double",
    )
    domain = pixels.select("marais", "ix", "iy").distinct().select(
        "*", (F.col("iy") > 0).alias("domaine"), F.when(F.col("ix") < 2, "ouvert").alias("regime")
    )
    result = radar.passages(pixels, domain, ["ouvert"], 1.0, variants=["fixe"], minimum=2, tile=4)
    got = {r["date"].month: (r["surface_ha"], r["pct_valides"], r["ha_ouvert"], r["ha_autres"]) for r in result.collect()}
    assert got == {8: (0.0, 100.0, 0.0, 0.0), 11: (12.0, 100.0, 6.0, 6.0)}
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Join LeftOuter" in line and "ix#" in line for line in plan.splitlines())


def test_pixel_medians_of_small_groups(spark):
    """Even, odd and repeated values, nulls among them and a group of nulls; no aggregate that holds maps of values."""
    from types import SimpleNamespace

    from registry.radar_queries import seen

    rng = np.random.default_rng(8)
    rows = [(int(p), None if rng.random() < 0.2 else float(rng.integers(1, 9))) for p in range(90) for _ in range(1 + p % 7)]
    lines = spark.createDataFrame([*rows, (99, None)], "l_partkey long, l_quantity double").withColumn(
        "l_shipdate", F.lit("1998-05-03").cast("timestamp")
    )
    result = seen(SimpleNamespace(lineitem=lines))
    want = lines.groupBy("l_partkey").agg(F.median(-F.col("l_quantity") / 2).alias("db")).collect()
    assert {(r.iy * 64 + r.ix, r.db) for r in result.collect()} == {tuple(r) for r in want}
    assert result.count() == 91 and "ObjectHashAggregate" not in result._jdf.queryExecution().executedPlan().toString()
