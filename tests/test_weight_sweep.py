"""All combinations of weights against pairs counted one by one."""

import random

import pytest
from pyspark.sql import functions as F

from sluice.functions.stats import CLASS_LIMITS
from sluice.operators import studies as st


def mean(values, weights):
    parts = [(v, w) for v, w in zip(values, weights) if v is not None]
    below = sum(w for _, w in parts)
    return sum(v * w for v, w in parts) / below if below else None


def number(value):
    return sum(value > x for x in CLASS_LIMITS)


def test_sweep_equals_pairs(spark):
    r = random.Random(4)
    rows = []
    for zone in ("a", "b", "c"):
        for week in range(40):
            values = [None if r.random() < 0.3 else r.choice([-2.0, -1.0, 0.0, 0.5, 2.0]) for _ in range(3)]
            level = None if r.random() < 0.1 else r.randrange(4) if zone != "c" else 0  # no alert in c
            rows.append((zone, week, level, *values))
    rows.append(("d", 0, 3, None, None, None))  # no value at all
    df = spark.createDataFrame(rows, "zone_id string, semaine int, niveau int, a double, b double, c double")
    now = {"a": 0.5, "b": 0.25, "c": 0.25}
    got = st.weight_sweep(df, ["a", "b", "c"], now, F.col("niveau") >= 2, F.col("semaine") % 2, 0.25)
    combos = st.weight_combinations(3, 0.25)
    assert len(combos) == 15
    want = {}
    for zone in "abcd":
        for period in (0, 1):
            mine = [x for x in rows if x[0] == zone and x[1] % 2 == period]
            for w in combos:
                valued = [(mean(x[3:], w), mean(x[3:], now.values()), x[2]) for x in mine]
                valued = [v for v in valued if v[0] is not None]
                if not valued:
                    continue
                ones = [v for v, _, level in valued if level is not None and level >= 2]
                zeros = [v for v, _, level in valued if level is not None and level < 2]
                won = sum((p < q) + (p == q) / 2 for p in ones for q in zeros)
                auc = won / (len(ones) * len(zeros)) if ones and zeros else None
                changed = [number(v) != number(n) for v, n, _ in valued]
                want[zone, period, w] = len(ones), len(zeros), auc, sum(changed) / len(changed)
    found = {(x.zone_id, x.periode, (x.w_a, x.w_b, x.w_c)): x for x in got.collect()}
    assert found.keys() == want.keys()
    for key, (ones, zeros, auc, share) in want.items():
        x = found[key]
        assert (x.n_positive, x.n_negative, x.auc) == (ones, zeros, auc)
        assert x.part_changee == pytest.approx(share)
        group = [v[2] for k, v in want.items() if k[:2] == key[:2] and v[2] is not None]
        assert x.n_proches == sum(v >= max(group) - 0.01 for v in group)
    assert st.weight_sweep(df.limit(0), ["a", "b", "c"], now, F.col("niveau") >= 2, F.lit("x")).count() == 0


def test_query_sweeps_every_triple(spark, monkeypatch):
    from registry import core, study_queries

    r = random.Random(5)
    weeks = [(z, f"{y}-W{w:02d}", y, r.randrange(4), r.gauss(0, 1), r.gauss(0, 1)) for z in ("a", "b") for y in (1998, 1999) for w in range(1, 21)]
    table = spark.createDataFrame(weeks, "zone_id string, semaine string, annee int, niveau int, valeur double, ips double")
    monkeypatch.setattr(study_queries, "stored_table", lambda t: table)
    rows = core.QUERIES["weight_sweep"](spark, "unused").collect()
    want = {(i, j, 20 - i - j) for i in range(21) for j in range(21 - i)}
    assert len(want) == 231 and len(rows) == 4 * 231
    for key in ((z, p) for z in "ab" for p in "ab"):
        mine = [x for x in rows if (x.zone_id, x.periode) == key]
        assert {tuple(round(w * 20) for w in (x.w_a, x.w_b, x.w_c)) for x in mine} == want
        assert all(abs(x.w_a + x.w_b + x.w_c - 1) < 1e-12 for x in mine)
