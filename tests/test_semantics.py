from __future__ import annotations

import math
from statistics import NormalDist

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catchframe.functions import (
    clean_nan, conditional_pivot, half_even, if_else, na_sum, not_in, null_safe_join, number_text, poison_avg,
    in_order, normal_quantile, poison_sum, ranked, ratio, running_sums, sig_round, split_to_numbers, to_double, to_int, two_measure_sum, z_value,
)
from catchframe.operators import composition, profile
from catchframe.operators.recode import code_order, merge_codes, recode, recode_by_table
from catchframe import codes


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_sums(spark, rows):
    df = spark.createDataFrame(
        [("a", 1.0, 2.0), ("a", None, 3.0), ("b", None, None), ("c", 4.0, None)], "k string, x double, y double"
    )
    out = df.groupBy("k").agg(
        na_sum("x").alias("n"), poison_sum("x").alias("p"), poison_avg("x").alias("m"),
        two_measure_sum("x", "y").alias("t"),
    )
    assert rows(out) == [("a", 1.0, None, None, 6.0), ("b", 0.0, None, None, 0.0), ("c", 4.0, 4.0, 4.0, 4.0)]


def test_ratio(spark):
    cases = [(1.0, 0.0, math.inf), (-1.0, 0.0, -math.inf), (0.0, 0.0, None), (None, 0.0, None), (1.0, None, None), (1.0, 4.0, 0.25)]
    for n, d, want in cases:
        got = one(spark, ratio(F.lit(n).cast("double"), F.lit(d).cast("double")))[0]
        assert got == want, (n, d)


def test_missing_rules(spark, rows):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "x string")
    assert rows(df.filter(not_in("x", ["a"]))) == [(None,), ("b",)]
    picked = df.select(if_else(F.col("x") == "a", F.lit(1), F.lit(0)))
    assert rows(picked) == [(None,), (0,), (1,)]
    assert one(spark, clean_nan(F.lit(float("nan"))), clean_nan(F.lit(2.0))) == (None, 2.0)


def test_numbers_from_text(spark):
    texts = {"12": 12.0, " 1.5e3 ": 1500.0, "12F": None, "12d": None, "-": None, ".": None, "": None, ".5": 0.5, "NaN": None}
    for text, want in texts.items():
        assert one(spark, to_double(F.lit(text)))[0] == want, text
    assert one(spark, to_int(F.lit("2003")), to_int(F.lit("x"))) == (2003, None)
    assert one(spark, split_to_numbers(F.lit("1,200 3.5\t x")))[0] == [1200.0, 3.5, None]
    assert one(spark, split_to_numbers(F.lit("1,200 3.5 x ")))[0] == [1200.0, 3.5, None]
    assert one(spark, split_to_numbers(F.lit("")))[0] == [] and one(spark, split_to_numbers(F.lit(" 1")))[0] == [None, 1.0]
    assert one(spark, number_text(F.lit(10.0)), number_text(F.lit(0.2))) == ("10", "0.2")


def test_rounding(spark):
    assert one(spark, half_even(F.lit(0.5)), half_even(F.lit(1.5)), half_even(F.lit(2.5))) == (0.0, 2.0, 2.0)
    cases = {0.0: 0.0, 0.00123456: 0.00123, 1234.6: 1230.0, -98765.0: -99000.0, 2.0: 2.0, 0.1: 0.1, 19.96: 20.0, 0.2345: 0.23, 1000.0: 1000.0}
    for x, want in cases.items():
        assert one(spark, sig_round(F.lit(x)))[0] == pytest.approx(want, rel=1e-12), x


def test_normal_quantiles():
    assert z_value(0.5) == 0.0
    assert z_value(0.975) == pytest.approx(1.959963984540054)
    assert z_value(0.35) == pytest.approx(-z_value(0.65))


def test_null_safe_full_join(spark, rows):
    a = spark.createDataFrame([(1, "a"), (None, "b")], "k int, x string")
    b = spark.createDataFrame([(None, "c"), (2, "d")], "k int, y string")
    assert rows(null_safe_join(a, b, ["k"], "full")) == [(None, "b", "c"), (1, "a", None), (2, None, "d")]


def test_pivot_keeps_missing_cells(spark, rows):
    df = spark.createDataFrame([("g", "A", 1.0), ("g", "A", None), ("h", "B", None), ("i", "B", 2.0)], "k string, c string, x double")
    wide = conditional_pivot(df, ["k"], "c", {"a": "A", "b": "B"}, "x", na_sum)
    assert rows(wide) == [("g", 1.0, None), ("h", None, 0.0), ("i", None, 2.0)]
    wide = conditional_pivot(df, ["k"], "c", {"a": "A", "b": "B"}, "x", poison_sum)
    assert rows(wide) == [("g", None, None), ("h", None, None), ("i", None, 2.0)]


def test_recode(spark, rows):
    df = spark.createDataFrame([("Germany",), ("Germany, Fed. Rep. of",), ("Atlantis",), (None,)], "c string")
    coded = df.select(recode("c", codes.COUNTRY_NAMES).alias("c"))
    assert rows(coded) == [(None,), (None,), ("DE",), ("DE",)]
    ranks = coded.select(code_order("c", codes.COUNTRY_NAMES).alias("r"))
    assert rows(ranks) == [(None,), (None,), (6,), (6,)]
    assert rows(df.select(merge_codes("c", ["Atlantis"], "X"))) == [(None,), ("Germany",), ("Germany, Fed. Rep. of",), ("X",)]
    dim = spark.createDataFrame([("Germany", "DE"), ("Atlantis", "AT")], "raw string, code string")
    assert rows(recode_by_table(df, dim, "c")) == [(None,), (None,), ("AT",), ("DE",)]


def test_unique_codes(spark, rows):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("a", "x"), ("b", None), ("c", "y"), ("c", "z")], "k string, c string")
    assert rows(composition.unique_codes(df, "c", keys=["k"])) == [("a", "x"), ("b", None), ("c", "y"), ("c", "z")]


values = st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6).map(lambda x: round(x, 3))), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values)
def test_profile_against_brute_force(spark, xs):
    known = sorted(x for x in xs if x is not None)
    got = profile.column_profile(spark.createDataFrame([(x,) for x in xs], "x double"), ["x"]).first()

    def quantile(q):
        h = (len(known) - 1) * q
        lo, hi = math.floor(h), math.ceil(h)
        return known[lo] + (h - lo) * (known[hi] - known[lo])

    assert got["n_missing"] == len(xs) - len(known)
    for name, q in profile.QUARTILES.items():
        assert got[name] == (pytest.approx(quantile(q)) if known else None)
    assert got["mean"] == (pytest.approx(sum(known) / len(known), abs=1e-6) if known else None)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(0, 200)), min_size=1, max_size=60))
def test_running_sums_and_ranks_against_brute_force(spark, xs):
    data = [(i % 2 or None, i, None if x is None else float(x)) for i, x in enumerate(xs)]
    df = spark.createDataFrame(data, "k int, i int, x double")
    out = running_sums(ranked(df, ["k"], [F.col("i")], "place"), ["k"], [F.col("i")], {"r": "x"}, total_by=[])
    for row in out.collect():
        before = [x for k, i, x in data if k == row["k"] and i <= row["i"]]
        assert row["r"] == (None if None in before else sum(before)) and row["place"] == len(before) - 1
        assert row["r_total"] == (sum(x for _, _, x in data if x is not None) if any(x is not None for _, _, x in data) else None)


@pytest.mark.parametrize("weight", [1.0, None])
def test_ties_are_spread_over_tasks(spark, weight):
    """20,000 equal weights, or none at all, in one group: several range partitions, and no window over all of them."""
    df = spark.range(0, 20_000, 1, 4).select(F.lit("k").alias("k"), F.col("id"), F.lit(weight).cast("double").alias("w"))
    # So few rows would be put into one partition again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    placed = in_order(df, ["k"], [F.col("w"), F.col("id")])
    sizes = [r["count"] for r in placed.groupBy("__part").count().collect()]
    out = running_sums(df, ["k"], [F.col("w"), F.col("id")], {"r": "w"})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(sizes) < 15_000
    wrong = F.col("r") != F.col("id") + 1 if weight else F.col("r").isNotNull()
    assert out.filter(wrong).count() == 0 and out.count() == 20_000


def test_normal_quantile(spark):
    ps = [1e-300, 1e-20, 1e-9, 0.001, 0.02425, 0.07, 0.075, 0.35, 0.5, 0.6, 0.925, 0.93, 0.999, 1 - 1e-12]
    df = spark.createDataFrame([(p,) for p in [*ps, 0.0, 1.0, -0.1, 1.5, None, float("nan")]], "p double")
    got = [r["z"] for r in df.select(normal_quantile("p").alias("z")).collect()]
    assert got[:len(ps)] == [pytest.approx(NormalDist().inv_cdf(p), rel=1e-12, abs=1e-14) for p in ps]
    assert got[len(ps):] == [-math.inf, math.inf, None, None, None, None]


def test_profile_counts_only_brackets(spark, monkeypatch):
    """50,000 different values: the brackets hold a few of them, and the quartiles are exact."""
    seen = {}
    real = profile.running_sums
    monkeypatch.setattr(profile, "running_sums", lambda df, *a, **k: (seen.update(n=df.count()), real(df, *a, **k))[1])
    got = profile.column_profile(spark.range(0, 50_001, 1, 6).select((F.col("id") * 7919 % 50_001).cast("double").alias("x")), ["x"]).first()
    assert (got["min"], got["q1"], got["median"], got["q3"], got["max"]) == (0.0, 12_500.0, 25_000.0, 37_500.0, 50_000.0)
    assert seen["n"] < 500
