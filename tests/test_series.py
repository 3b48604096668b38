from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluice.functions import calendar as cal
from sluice.operators import reference as ref
from sluice.operators.asof import asof_forward, asof_join
from sluice.operators.cleaning import shift_late_readings
from sluice.operators.radar import kendall_exact_rows, trend_test
from sluice.operators.series import despike_fill
from sluice.sources import sinks
from sluice.sources.snapshots import SnapshotStore


def days(start, n):
    return [date.fromisoformat(start) + timedelta(days=i) for i in range(n)]


def test_rolling_mean_needs_five_of_seven(spark):
    missing = {date(2020, 1, 5), date(2020, 1, 6), date(2020, 1, 12), date(2020, 1, 13), date(2020, 1, 14)}
    rows = [("a", d, float(i)) for i, d in enumerate(days("2020-01-01", 21)) if d not in missing]
    df = spark.createDataFrame(rows, "s string, d date, v double")
    got = {r["d"]: r["q7"] for r in ref.rolling_mean_min(df, ["s"], "d", "v").collect()}
    series = pd.Series({pd.Timestamp(d): v for _, d, v in rows}).asfreq("D")
    want = series.rolling(7, min_periods=5).mean().dropna()
    assert set(got) == {t.date() for t in want.index}
    for t, v in want.items():
        assert got[t.date()] == pytest.approx(v)


def test_totals_need_every_day(spark):
    rows = [("z", d, 1.0) for d in days("2020-01-01", 60) if d != date(2020, 1, 20)]
    df = spark.createDataFrame(rows, "z string, d date, v double")
    got = ref.rolling_sum_full(df, ["z"], "d", "v", {"t": 30}).collect()
    assert [r["d"] for r in got] == [date(2020, 2, 23)]
    assert got[0]["total"] == 30


def test_splice_takes_the_first_gauge_with_a_value(spark):
    old = [("b", d, 1.0) for d in days("2020-01-01", 10)]
    new = [("a", d, 2.0) for d in days("2020-01-06", 10)]
    df = spark.createDataFrame(old + new, "s string, d date, v double")
    splices = spark.createDataFrame([("a", "a", 0), ("b", "a", 1)], "station string, site string, priority int")
    got = ref.splice_series(df, "s", "d", "v", splices).collect()
    assert len(got) == 15 and {r["s"] for r in got} == {"a"}
    assert sum(r["v"] for r in got) == 5 * 1 + 10 * 2


def test_pettitt_equals_its_definition(spark):
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for k in range(6):
        x = np.round(rng.normal(size=20) + (np.arange(20) >= 12) * k, 1)
        rows += [(k, 2000 + i, float(v)) for i, v in enumerate(x)]
        u = [abs(sum(np.sign(x[j] - x[i]) for i in range(t + 1) for j in range(t + 1, 20))) for t in range(19)]
        want[k] = (2000 + int(np.argmax(u)) + 1, max(u))
    df = spark.createDataFrame(rows, "k int, year int, value double")
    for r in ref.pettitt_breaks(df, ["k"]).collect():
        assert (r["annee_rupture"], r["k"]) == want[r["k"]] or (r["annee_rupture"],) == want[r["k"]][:1]


def test_asof_with_a_hot_key_equals_pandas(spark):
    rng = np.random.default_rng(4)
    t = pd.to_datetime("2024-01-01") + pd.to_timedelta(np.sort(rng.integers(0, 40 * 86_400, 3_000)), "s")
    right = pd.DataFrame({"k": np.where(rng.random(3_000) < 0.8, "hot", "cold"), "t": t, "v": np.arange(3_000.0)})
    right = right.drop_duplicates(["k", "t"], keep="last")
    a = pd.to_datetime("2023-12-25") + pd.to_timedelta(np.sort(rng.integers(0, 60 * 86_400, 800)), "s")
    left = pd.DataFrame({"k": rng.choice(["hot", "cold", "none"], 800), "a": a, "id": np.arange(800)})
    args = (spark.createDataFrame(left), spark.createDataFrame(right), ["k"], "a", "t", ["v"])
    for period in ("day", "month"):
        got = asof_join(*args, period=period).toPandas().sort_values("id")["v"].to_numpy()
        want = pd.merge_asof(left, right, left_on="a", right_on="t", by="k").sort_values("id")["v"]
        np.testing.assert_array_equal(got, want.to_numpy())
    got = asof_forward(*args, period="day").toPandas().sort_values("id")["v"].to_numpy()
    want = pd.merge_asof(left, right, left_on="a", right_on="t", by="k", direction="forward", allow_exact_matches=False)
    np.testing.assert_array_equal(got, want.sort_values("id")["v"].to_numpy())


@pytest.mark.parametrize("block", [11, 100_000])
def test_despike_equals_pandas_across_blocks(spark, block):
    rng = np.random.default_rng(6)
    v = np.cumsum(rng.normal(0, 0.05, 300))
    v[rng.choice(300, 30, replace=False)] += 2
    v[100:106] += np.array([3, -3, 3, -3, 3, -3])
    t = pd.date_range("2024-01-01", periods=300, freq="10min")
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "t": t, "v": v}))
    got = despike_fill(df, ["k"], "t", "v", block=block).toPandas().sort_values("t")
    m = pd.Series(v, index=t)
    med = m.rolling(7, center=True, min_periods=3).median()
    want = m.where((m - med).abs() < 0.4).interpolate(limit=3).dropna()
    assert len(got) == len(want)
    np.testing.assert_allclose(got["v"].to_numpy(), want.to_numpy(), rtol=1e-12)


def test_kendall_null_distribution():
    table = {(n, c): p for n, c, p in kendall_exact_rows(6)}
    assert table[(5, 0)] == pytest.approx(2 / 120)
    assert table[(5, 1)] == pytest.approx(2 * 5 / 120)
    assert table[(4, 3)] == 1.0


def test_trend_by_definition(spark):
    y = [3.0, 9.0, 4.0, 12.0, 7.0, 15.0, 11.0, 20.0]
    df = spark.createDataFrame([("a", 2000 + i, v) for i, v in enumerate(y)], "k string, x int, y double")
    r = trend_test(df, ["k"], "x", "y").first()
    slopes = sorted((y[j] - y[i]) / (j - i) for i in range(8) for j in range(i + 1, 8))
    con, dis = sum(s > 0 for s in slopes), sum(s < 0 for s in slopes)
    assert r["slope"] == pytest.approx(np.median(slopes))
    assert r["tau"] == pytest.approx((con - dis) / 28)
    assert r["p"] == {(n, c): p for n, c, p in kendall_exact_rows(8)}[(8, dis)]
    assert r["slope_low"] < r["slope"] < r["slope_high"]


def test_trend_with_ties_uses_the_normal_law(spark):
    y = [1.0, 1.0, 2.0, 2.0, 3.0, 4.0]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(y)], "k string, x int, y double")
    r = trend_test(df, ["k"], "x", "y").first()
    from statistics import NormalDist

    var = (6 * 5 * 17 - 2 * (2 * 1 * 9)) / 18
    assert r["tau"] == pytest.approx(13 / np.sqrt(15 * 13))
    assert r["p"] == pytest.approx(2 * (1 - NormalDist().cdf(13 / np.sqrt(var))), rel=1e-6)


def test_late_reading_moves_only_into_an_empty_week(spark):
    rows = [
        ("a", 1, date(2025, 2, 16)), ("a", 2, date(2025, 2, 25)), ("a", 3, date(2025, 3, 2)),
        ("b", 4, date(2025, 2, 23)), ("b", 5, date(2025, 2, 25)), ("b", 6, date(2025, 3, 2)),
        ("c", 7, date(2025, 2, 25)),
    ]
    df = spark.createDataFrame(rows, "code string, id int, date date")
    got = {r["id"]: (r["date"], r["moved"]) for r in shift_late_readings(df, "code", "date", ["date", "id"]).collect()}
    assert got[2] == (date(2025, 2, 23), True)
    assert all(not got[i][1] for i in (1, 3, 4, 5, 6, 7))


def test_merge_keeps_unchanged_rows_and_repeats_nothing(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "table"))
    schema = "s string, date date, v double, seen string"
    d = days("2019-12-30", 4)
    first = spark.createDataFrame([("a", x, float(i), "mon") for i, x in enumerate(d)], schema)
    again = spark.createDataFrame(
        [("a", d[0], 0.0, "tue"), ("a", d[1], 9.0, "tue"), ("a", d[3], None, "tue"), ("b", d[2], 5.0, "tue")], schema
    )
    for batch in (first, again, again):
        store.merge("t", batch, ["s", "date"], ["v"])
    got = {(r["s"], r["date"]): (r["v"], r["seen"]) for r in store.read("t").collect()}
    assert got == {
        ("a", d[0]): (0.0, "mon"), ("a", d[1]): (9.0, "tue"), ("a", d[2]): (2.0, "mon"),
        ("a", d[3]): (None, "tue"), ("b", d[2]): (5.0, "tue"),
    }


def test_fingerprint_ignores_order(spark):
    df = spark.range(500).withColumn("x", F.col("id") % 7)
    a = sinks.table_fingerprint(df).first()
    b = sinks.table_fingerprint(df.orderBy(F.desc("id"))).first()
    c = sinks.table_fingerprint(df.where("id <> 3")).first()
    assert a == b and a["fingerprint"] != c["fingerprint"]


def test_windows_of_a_day(spark):
    df = spark.createDataFrame([(date(2020, 12, 31),)], "d date")
    got = df.select(F.explode(cal.containing_windows(F.col("d"), 15)).alias("w")).select("w.*").collect()
    assert [(r["year"], r["week"]) for r in got] == [(2020, 51), (2020, 52), (2021, 1)]


def test_missing_weeks_are_not_shuffled(spark):
    from sluice.operators.studies import missing_weeks

    rows = [("a", "2004-12-20"), ("a", "2005-01-16"), ("a", "2005-01-10"), ("b", "2001-03-05"), ("c", None)]
    df = spark.createDataFrame(rows, "k string, d string").select("k", F.to_date("d").alias("d"))
    result = missing_weeks(df, "k", "d")
    assert sorted(tuple(r) for r in result.collect()) == [("a", "2004-W53"), ("a", "2005-W01")]
    assert "Join" not in result._jdf.queryExecution().optimizedPlan().toString()
