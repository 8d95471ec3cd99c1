from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from catchframe.functions import interval_join, runs_of
from catchframe.operators import modelio


def test_runs(spark):
    cases = spark.createDataFrame([(1, [3, 1, 2, 7, 7, None, 9]), (2, []), (3, [None]), (4, [-1, 0, 5])], "id int, n array<int>")
    got = {r.id: [tuple(x) for x in r.runs] for r in cases.select("id", runs_of(F.col("n")).alias("runs")).collect()}
    assert got == {1: [(1, 3), (7, 7), (9, 9)], 2: [], 3: [], 4: [(-1, 0), (5, 5)]}


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_interval_join_finds_each_pair_once(spark, rows, width):
    rng = random.Random(5)
    keys = ["a", "b", None]
    points = [(rng.choice(keys), rng.randrange(-50, 60), i) for i in range(300)] + [("a", None, 900)]
    ranges = [(rng.choice(keys), (f := rng.randrange(-60, 60)), f + rng.randrange(-3, 40), i) for i in range(40)]
    ranges += [("a", None, 3, 90), ("a", 3, None, 91), ("b", 5, 5, 92), ("b", 5, 5, 93)]
    got = interval_join(
        spark.createDataFrame(points, "k string, at int, p int"),
        spark.createDataFrame(ranges, "k string, first int, last int, r int"), ["k"], "at", width=width,
    )
    assert got.columns == ["k", "at", "p", "r"]
    wanted = [
        (p, r) for k, at, p in points for own, first, last, r in ranges
        if k == own and None not in (at, first, last) and first <= at <= last
    ]
    assert sorted(map(tuple, got.select("p", "r").collect())) == sorted(wanted)
    nothing = spark.createDataFrame([], "k string, first int, last int, r int")
    assert interval_join(spark.createDataFrame(points, "k string, at int, p int"), nothing, ["k"], "at").count() == 0


def test_interval_join_without_keys_and_with_a_bad_width(spark, rows):
    points = spark.createDataFrame([(1,), (5,), (9,)], "at int")
    ranges = spark.createDataFrame([(1, 5, "x"), (5, 40, "y")], "first int, last int, name string")
    assert rows(interval_join(points, ranges, [], "at", width=4)) == [(1, "x"), (5, "x"), (5, "y"), (9, "y")]
    with pytest.raises(ValueError, match="width"):
        interval_join(points, ranges, [], "at", width=0)


def test_retro_catch_of_many_keys_follows_its_definition(spark):
    rng = random.Random(7)
    stocks = ["s0", "s1", None]
    catch = [(s, y, float(y)) for s in stocks for y in range(1940, 2024) for _ in range(1 + (y == 2001))]
    retro = [
        (s, p, sem, y + half, 1.0, 0.1)
        for s in stocks for p in range(4) for sem in (1, 2) for y in rng.sample(range(1990, 2024), 20) for half in (0.0, 0.5)
    ] + [("s0", 2, 1, None, 1.0, 0.1)]
    out = modelio.retro_catch_input(
        spark.createDataFrame(catch, "stock string, year int, landings double"),
        spark.createDataFrame(retro, "stock string, peel int, semester int, time double, obs double, cv double"), keys=["stock"],
    )
    wanted = sorted(
        (str(s), p, float(y), obs, 2 if y <= 1998 else 1) for s, y, obs in catch for p in (1, 2, 3)
        if 1950 <= y <= 1998 or (s, p, 1, float(y), 1.0, 0.1) in retro
    )
    assert sorted((str(r.stock), r.peel, r.time, r.obs, r.stdevfac) for r in out.collect()) == wanted
