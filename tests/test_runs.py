"""Runs of the interval in force against a look at every day."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import validation as va

ROW = "k string, a date, b date, rank struct<u:int,v:int>, name string"
DAY = dt.date(2020, 1, 5)  # a Sunday


def plain(rows, step):
    """{(key, day): name in force}"""
    found = {}
    for k, a, b, rank, name in rows:
        if k is None or a is None or b is None:
            continue
        while a <= b:
            mine = (rank[0], rank[1] is not None, rank[1] or 0, b)
            if (k, a) not in found or found[k, a][0] < mine:
                found[k, a] = (mine, name)
            a += dt.timedelta(step)
    return {at: name for at, (_, name) in found.items()}


def spread(runs, step):
    days = runs.select("k", F.explode(F.sequence("a", "b", F.expr(f"interval {step} days"))).alias("day"), "name").collect()
    assert len(days) == len({(r.k, r.day) for r in days})  # runs never overlap
    return {(r.k, r.day): r.name for r in days}


@pytest.mark.parametrize("step, by_start", [(7, True), (7, False), (1, False)])
def test_runs_equal_a_look_at_every_day(spark, step, by_start):
    rng = random.Random(step + by_start)
    rows = []
    for i in range(700):
        a = rng.randrange(0, 120)
        b = a + rng.choice([-1, 0, 1, 3, 10, 90])
        rank = (a if by_start else rng.randrange(30), rng.choice([None, i]))
        rows.append((rng.choice(["x", "x", "y", "z", None]), DAY + dt.timedelta(step * a), DAY + dt.timedelta(step * b), rank, f"r{i}"))
    rows += [("w", DAY, DAY + dt.timedelta(step * 50), (1, 1), "long"), ("w", DAY + dt.timedelta(step * 9), DAY + dt.timedelta(step * 9), (2, 1), "short")]
    rows += [("x", None, DAY, (99, 1), "open"), ("x", DAY, None, (99, 1), "open")]
    # of rows that tie in rank and end, one is enough
    seen, unique = set(), []
    for r in rows:
        if (r[0], r[3], r[2]) not in seen:
            seen.add((r[0], r[3], r[2]))
            unique.append(r)
    frame = spark.createDataFrame(unique, ROW)
    runs = va.runs_in_force(frame, ["k"], "a", "b", "rank", step)
    assert sorted(runs.columns) == sorted(frame.columns)
    assert spread(runs, step) == plain(unique, step)
    whole = runs.where("k = 'w'").orderBy("a").collect()
    assert [(r.name, (r.b - r.a).days // step) for r in whole] == [("long", 8), ("short", 0), ("long", 40)]


def test_rows_do_not_grow_with_length(spark):
    """A thousand orders of forty years each: the first aggregate sees a thousand rows, the runs are as many."""
    rows = [("x", DAY + dt.timedelta(7 * i), DAY + dt.timedelta(7 * i + 14000), (i, i), f"r{i}") for i in range(1000)]
    runs = va.runs_in_force(spark.createDataFrame(rows, ROW), ["k"], "a", "b", "rank", 7)
    assert runs.count() == 1000
    plan = runs._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan.lower()


def test_no_intervals_and_repeated_rows(spark):
    assert va.runs_in_force(spark.createDataFrame([], ROW), ["k"], "a", "b", "rank").isEmpty()
    row = ("x", DAY, DAY, (1, None), "r")
    got = va.runs_in_force(spark.createDataFrame([row, row], ROW), ["k"], "a", "b", "rank").collect()
    assert [(r.a, r.b, r.name) for r in got] == [(DAY, DAY, "r")]
