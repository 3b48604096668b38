"""Snapshots are all or nothing; long series take up where the last run ended."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from sluice.operators import radar as ra
from sluice.plans.resume import pending_units, resume, resume_passages
from sluice.sources import snapshots
from sluice.sources.snapshots import AuditFailed, Conflict, SnapshotStore


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "store"))


def table(spark, rows):
    return spark.createDataFrame(rows, "annee int, k int, v string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_run_that_dies_between_files_leaves_the_old_snapshot(spark, store, monkeypatch):
    first = [(2001, 1, "a"), (2002, 2, "b")]
    with store.transaction() as t:
        t.replace_parts("x", table(spark, first), "annee")
        t.replace("y", table(spark, first))
    with pytest.raises(ZeroDivisionError), store.transaction() as t:
        t.replace_parts("x", table(spark, [(2001, 9, "z")]), "annee")
        1 / 0  # y is not written any more
    assert rows(store.read("x")) == rows(store.read("y")) == first

    broken = F.udf(lambda v: 1 // 0 if v == "z" else 1, "int")  # the write itself dies, after one file
    with pytest.raises(Exception), store.transaction() as t:
        new = table(spark, [(2001, 1, "c"), (2002, 2, "z")])
        t.replace_parts("x", new.withColumn("k", broken("v")), "annee")
    assert rows(store.read("x")) == first and store.versions() == [1]

    monkeypatch.setattr(SnapshotStore, "_publish", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError), store.transaction() as t:
        t.replace("y", table(spark, []))
    assert rows(store.read("y")) == first


def test_the_first_to_publish_wins(spark, store):
    a, b = store.transaction(), store.transaction()
    a.replace("x", table(spark, [(2001, 1, "a")]))
    b.replace("x", table(spark, [(2001, 1, "b")]))
    assert a.commit() == 1
    with pytest.raises(Conflict):
        b.commit()
    assert rows(store.read("x")) == [(2001, 1, "a")]
    with store.transaction() as c:
        c.replace("x", table(spark, []))
    assert rows(store.read("x")) == [] and rows(store.read("x", version=1)) == [(2001, 1, "a")]


def test_only_touched_parts_change(spark, store):
    with store.transaction() as t:
        t.replace_parts("x", table(spark, [(y, k, "old") for y in (2001, 2002, 2003) for k in (1, 2)]), "annee")
    before = {p["part"]: p["folder"] for p in store.tables()["x"].parts}
    with store.transaction() as t:
        assert t.replace_parts("x", table(spark, [(2002, 7, "new")]), "annee", also=["2003"]) == ["2002", "2003"]
    after = {p["part"]: p["folder"] for p in store.tables()["x"].parts}
    assert after["2001"] == before["2001"] and after["2002"] != before["2002"] and "2003" not in after
    assert rows(store.read("x")) == [(2001, 1, "old"), (2001, 2, "old"), (2002, 7, "new")]
    assert rows(store.read("x", parts=["2002"])) == [(2002, 7, "new")]
    with pytest.raises(ValueError, match="without a part"), store.transaction() as t:
        t.replace_parts("x", table(spark, [(None, 1, "a")]), "annee")
    assert store.versions() == [1, 2]


def test_counts_are_audited_before_the_swap(spark, store, monkeypatch):
    honest = snapshots.SnapshotStore._frame
    monkeypatch.setattr(snapshots.SnapshotStore, "_frame", lambda self, t, parts=None: honest(self, t, parts).limit(1))
    with pytest.raises(AuditFailed, match="2 rows in, 1 read back"), store.transaction() as t:
        t.replace("x", table(spark, [(2001, 1, "a"), (2001, 2, "a")]))
    assert store.versions() == []


def test_units(spark):
    wanted = spark.createDataFrame([("a", 2001), ("a", 2002), ("a", 2003), ("b", 2001), ("b", 2001)], "s string, annee int")
    ledger = spark.createDataFrame(
        [("a", 2001, "p1", True), ("a", 2002, "p1", False), ("b", 2001, "p0", True)],
        "s string, annee int, parameters string, closed boolean",
    )
    keys, redo = ["s", "annee"], F.col("annee") >= 2003
    assert rows(pending_units(wanted, ledger, keys, "p1", redo)) == [("a", 2002, True), ("a", 2003, False), ("b", 2001, True)]
    assert pending_units(wanted, None, keys, "p1", redo).count() == 4


def test_a_run_that_dies_keeps_the_years_it_published(spark, store):
    wanted = spark.createDataFrame([("a", y) for y in (2001, 2002, 2003)], "s string, annee int")
    seen = []

    def compute(units):
        seen.extend(r.annee for r in units.collect())
        if seen == [2001, 2002]:
            raise RuntimeError("lost")
        return units.withColumn("v", F.col("annee") * 2)

    keys = ["s", "annee"]
    with pytest.raises(RuntimeError):
        resume(store, "x", wanted, keys, "p", F.lit(False), compute)
    assert rows(store.read("x")) == [("a", 2001, 4002)]
    resume(store, "x", wanted, keys, "p", F.lit(False), compute)
    assert seen == [2001, 2002, 2002, 2003] and store.read("x").count() == 3
    assert resume(store, "x", wanted, keys, "p", F.lit(False), compute) == []
    resume(store, "x", wanted, keys, "other parameters", F.lit(False), compute)
    assert seen[4:] == [2001, 2002, 2003] and store.read("x").count() == 3


def archive(spark):
    """One site of 6 x 6 pixels, eight passes a year, darker every winter."""
    passes = [(date(y, m, 5), -10.0 - (8 if m in (1, 2, 12) else 0) - (y - 2001) / 4) for y in (2001, 2002, 2003) for m in (1, 2, 4, 7, 8, 9, 11, 12)]
    cells = spark.range(36).selectExpr("'m' AS marais", "int(id % 6) AS ix", "int(id div 6) AS iy")
    days = spark.createDataFrame(passes, "date date, base double")
    return cells.join(days).selectExpr("marais", "ix", "iy", "date", "base + ix / 3D AS db")


def test_passages_of_a_growing_archive(spark, store):
    pixels = archive(spark).cache()
    domain = pixels.select("marais", "ix", "iy").distinct().selectExpr("*", "true AS domaine", "'r' AS regime")
    settings = dict(regimes=["r"], pixel_ha=0.01, period=(2001, 2001), tile=4)

    def run(until, source, parameters="p"):
        day = F.lit(until).cast("date")
        return resume_passages(
            store, pixels.where(F.col("date") <= day).select("marais", "date"), source.where(F.col("date") <= day),
            domain, today=day, parameters=parameters, **settings,
        )

    run(date(2002, 11, 20), pixels)
    assert store.read("passages").agg(F.max("date")).first()[0] == date(2002, 11, 5)
    # finished years are not read again: their pixels may be gone
    later = run(date(2003, 12, 31), pixels.where("year(date) >= 2002"))
    assert [len(made) for made in later] == [1, 2]
    want = ra.passages(pixels, domain, ["r"], 0.01, period=(2001, 2001), tile=4)
    columns = ["marais", "date", "variante", "annee_ref", "surface_ha", "pct_valides", "ha_r", "ha_autres"]
    assert rows(store.read("passages").select(columns).fillna(-1)) == rows(want.select(columns).fillna(-1))
    assert want.where("surface_ha > 0").count() > 0
    assert [len(made) for made in run(date(2003, 12, 31), pixels.limit(0))] == [0, 1]  # the year in progress only
