from math import exp, lgamma, log
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.functions import calendar as cal
from sluice.functions import stats
from sluice.functions.ranking import average_ranks, exact_quantiles, group_auc, spearman
from sluice.operators.indices import rank_z
from sluice.operators.reference import ReferencePeriod, fit_gamma, select_years


def test_probit_matches_the_normal_quantile(spark):
    ps = [1e-12, 1e-6, 0.01, 0.07, 0.3, 0.5, 0.8, 0.925, 0.99, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r[0] for r in df.select(stats.probit(F.col("p"))).collect()]
    want = [NormalDist().inv_cdf(p) for p in ps]
    assert got == pytest.approx(want, rel=1e-13, abs=1e-14)


def test_probit_ends(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (None,)], "p double")
    got = [r[0] for r in df.select(stats.probit(F.col("p"))).collect()]
    assert got == [float("-inf"), float("inf"), None, None]


def test_rank_of_a_small_sample(spark):
    sample = [4.0, 5.0, 6.0, 7.0, 8.0]
    df = spark.createDataFrame([(6.0, sample), (3.0, sample), (9.0, sample)], "v double, s array<double>")
    z = {r["v"]: r["valeur"] for r in rank_z(df, "v", "s").collect()}
    assert z[6.0] == pytest.approx(0, abs=1e-15)
    assert z[9.0] == pytest.approx(NormalDist().inv_cdf(5.56 / 6.12), rel=1e-12)
    assert z[3.0] == pytest.approx(-z[9.0], rel=1e-12)


@pytest.mark.parametrize(
    ("value", "klass"),
    [(-1.28, 1), (-1.27, 2), (-0.25, 3), (0.0, 4), (0.25, 4), (1.28, 6), (1.29, 7), (None, None)],
)
def test_class_edges(spark, value, klass):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(stats.classify(F.col("v"))).first()[0] == klass


def test_gamma_recovery(spark):
    x = np.random.default_rng(1).gamma(3, 20, 20_000)
    df = spark.createDataFrame([("a", float(v)) for v in x] + [("a", 0.0)] * 2_000, "k string, v double")
    row = fit_gamma(df, ["k"], "v").first()
    assert row["forme"] == pytest.approx(3, rel=0.03)
    assert row["echelle"] == pytest.approx(20, rel=0.03)
    assert row["q0"] == pytest.approx(2_000 / 22_000)


def test_gamma_without_fit_is_null(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 0.0), ("b", 5.0), ("b", 5.0)], "k string, v double")
    assert [r["forme"] for r in fit_gamma(df, ["k"], "v").collect()] == [None, None]


def test_gamma_cdf_known_values(spark):
    # shape 1 is exponential; shape 2 is 1 - e^-x (1 + x)
    xs = [0.01, 0.5, 1.0, 3.0, 20.0]
    df = spark.createDataFrame([(x, k) for x in xs for k in (1.0, 2.0)], "x double, k double")
    for r in df.withColumn("p", stats.gamma_cdf(F.col("x"), F.col("k"), F.lit(1.0))).collect():
        want = 1 - exp(-r["x"]) * (1 if r["k"] == 1 else 1 + r["x"])
        assert r["p"] == pytest.approx(want, rel=1e-12)


RULES = [
    ([1991, 1992, 1993, 2005], (1991, 2000, 3, None), None, ([1991, 1992, 1993], "1991-2000", False)),
    ([2001, 2002, 2003, 2004], (1991, 2000, 3, 2003), None, ([2001, 2002, 2003], "2001-2003", True)),
    ([2001, 2004, 2005, 2006], (1991, 2000, 3, 2003), None, ([2001, 2004, 2005], "2001-2005", True)),
    ([2001, 2002], (1991, 2000, 3, None), None, ([], "", True)),
    ([1991, 1992, 1993, 1999, 2000], (1991, 2000, 3, None), 1999, ([1999, 2000], "1999-2000", True)),
]


@pytest.mark.parametrize(("valid", "period", "broken", "want"), RULES)
def test_year_selection(spark, valid, period, broken, want):
    p = ReferencePeriod(*period, after_break=2)
    df = spark.createDataFrame([(valid, broken)], "y array<int>, b int")
    r = df.select(select_years(F.col("y"), p, F.col("b")).alias("c")).first()["c"]
    assert (list(r["years"]), r["period_ref"], r["off_reference"]) == want


def test_weeks_and_their_bounds(spark):
    days = ["2024-12-30", "2021-01-03", "2020-12-31", "2015-12-28"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
    label = cal.iso_week_label(F.col("d"))
    rows = df.select(
        label.alias("w"), cal.week_monday(label).cast("string").alias("a"),
        cal.week_sunday(label).cast("string").alias("b"), cal.reference_week(F.col("d")).alias("r"),
    ).collect()
    assert [r["w"] for r in rows] == ["2025-W01", "2020-W53", "2020-W53", "2015-W53"]
    assert [(r["a"], r["b"]) for r in rows][0] == ("2024-12-30", "2025-01-05")
    assert [r["r"] for r in rows] == [1, 52, 52, 52]


def test_ranks_and_quantiles_of_a_hot_group(spark):
    """One group holds most rows and many ties; results equal numpy's."""
    rng = np.random.default_rng(3)
    hot = rng.integers(0, 3_000, 20_000) / 7
    cold = rng.normal(size=50)
    df = spark.createDataFrame(
        [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in cold], "k string, v double"
    )
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", {"a": 0.05, "m": 0.5, "b": 0.95}).collect()}
    for k, x in (("hot", hot), ("cold", cold)):
        assert [got[k]["a"], got[k]["m"], got[k]["b"]] == pytest.approx(np.quantile(x, [0.05, 0.5, 0.95]))
    ranks = {r["v"]: r["rank"] for r in average_ranks(df.where("k = 'hot'"), ["k"], "v").collect()}
    ordered = np.sort(hot)
    for v in (ordered[0], ordered[777], ordered[-1]):
        lo, hi = np.searchsorted(ordered, [v], "left")[0], np.searchsorted(ordered, [v], "right")[0]
        assert ranks[v] == (lo + 1 + hi) / 2


def test_auc_by_pairs(spark):
    rng = np.random.default_rng(5)
    v, a = rng.integers(0, 12, 200) / 4, rng.random(200) < 0.3
    df = spark.createDataFrame([(bool(x), float(y)) for x, y in zip(a, v)], "a boolean, v double")
    got = group_auc(df, [], "v", F.col("a")).first()["auc"]
    pairs = [(p < q) + (p == q) / 2 for p in v[a] for q in v[~a]]
    assert got == pytest.approx(np.mean(pairs), rel=1e-12)


def test_auc_without_both_kinds_is_null(spark):
    df = spark.createDataFrame([(True, 1.0), (True, 2.0)], "a boolean, v double")
    assert group_auc(df, [], "v", F.col("a")).first()["auc"] is None


def test_spearman_needs_three_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 9.0), ("a", 2.0, 8.0), ("b", 1.0, 3.0), ("b", 2.0, 2.0), ("b", 3.0, 1.0)], "k string, x double, y double")
    got = {r["k"]: r["rho"] for r in spearman(df, ["k"], "x", "y").collect()}
    assert got["a"] is None
    assert got["b"] == pytest.approx(-1)


@pytest.mark.parametrize("k", [1e-2, 1.0, 1e3, 9_999.0, 1e4, 1e5, 1e7, 1e9, 1e11])
def test_gamma_cdf_at_its_shape(k):
    """P(k, k) is 1 - exp(-1) at 1 and tends to 1/2 + 1 / (3 sqrt(2 pi k))."""
    import pandas as pd

    one = pd.Series([1.0])
    got = stats.gamma_cdf.func(pd.Series([k]), pd.Series([k]), one)[0]
    if k >= 1e3:
        root = (2 * np.pi * k) ** 0.5
        assert got == pytest.approx(0.5 + 1 / (3 * root) + 1 / (540 * k * root), abs=1e-9)
    else:
        assert got == pytest.approx({1e-2: 0.9603474235215095, 1.0: 1 - exp(-1)}[k], abs=1e-12)


def test_gamma_cdf_of_a_large_shape_by_the_poisson_sum():
    import pandas as pd

    k = 20_000
    for x in (19_500.0, 20_000.0, 20_300.0):
        want = 1 - sum(exp(i * log(x) - x - lgamma(i + 1)) for i in range(k))
        got = stats.gamma_cdf.func(pd.Series([x]), pd.Series([float(k)]), pd.Series([1.0]))[0]
        assert got == pytest.approx(want, abs=1e-9)


def test_trend_of_a_long_series_that_only_rises(spark):
    """Beyond the table the exact value is still used for at most one pair against the trend."""
    from math import factorial

    from sluice.operators.radar import trend_test

    rows = [("up", y, float(y)) for y in range(40)]
    rows += [("swap", y, float({5: 6, 6: 5}.get(y, y))) for y in range(40)]
    got = {r.k: r.p for r in trend_test(spark.createDataFrame(rows, "k string, y int, v double"), ["k"], "y", "v").collect()}
    assert got["up"] == pytest.approx(2 / factorial(40), rel=1e-9)
    assert got["swap"] == pytest.approx(2 / factorial(39), rel=1e-9)
