from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catchframe.operators import overview

OVER = "stock string, area string, season string, country string, fleet string, category string, catch_wt double"
OVER_ROWS = [
    ("s1", "27.4", "1", "BE", "F1", "Landings", 100.0),
    ("s1", "27.4", "1", "BE", "F1", "BMS landing", 5.0),
    ("s1", "27.4", "1", "NL", "F2", "Landings", 50.0),
    ("s1", "27.4", "1", "NL", "F2", "Logbook Registered Discard", 9.0),
    ("s1", "27.4", "1", None, "F3", "Landings", 7.0),
    ("s1", "27.7", "2", "NL", "F2", "Landings", 50.0),
]
NUM = "stock string, area string, season string, country string, fleet string, category string, sampled_catch double"
NUM_ROWS = [
    ("s1", "27.4", "1", "BE", "F1", "L", 20.0),
    ("s1", "27.4", "1", "BE", "F1", "L", 30.0),
    ("s1", "27.4", "1", None, "F3", "L", 1.0),
    ("s1", "27.7", "2", "NL", "F2", "L", None),
    ("s1", "27.7", "2", "NL", "F2", "L", 3.0),
]


@pytest.fixture
def tables(spark):
    return spark.createDataFrame(OVER_ROWS, OVER), spark.createDataFrame(NUM_ROWS, NUM)


def test_join_keeps_every_match(tables, rows):
    joined = overview.overview_join(*tables)
    assert rows(joined, "country", "fleet", "category", "catch_wt", "sampled_catch", "sampled") == sorted([
        ("BE", "F1", "L", 100.0, 20.0, True), ("BE", "F1", "L", 100.0, 30.0, True), ("BE", "F1", "D", 5.0, None, False),
        ("NL", "F2", "L", 50.0, None, False), (None, "F3", "L", 7.0, 1.0, True),
        ("NL", "F2", "L", 50.0, None, False), ("NL", "F2", "L", 50.0, 3.0, True),
    ], key=lambda t: tuple((v is not None, str(v)) for v in t))
    assert rows(overview.overview_exclusions(tables[0])) == [(9.0, 5.0)]


def test_counted_weights_equal_the_join(tables, rows):
    dims = ["area", "season", "fleet", "country", "category", "sampled"]
    full = overview.overview_join(*tables).groupBy(*dims).agg(F.sum("catch_wt"))
    short = overview.overview_weights(*tables).groupBy(*dims).agg(F.sum("catch_wt"))
    assert rows(full) == rows(short)


def test_hot_stratum_is_not_multiplied(spark):
    over = spark.createDataFrame(OVER_ROWS[:1] * 400, OVER)
    num = spark.createDataFrame(NUM_ROWS[:1] * 300, NUM)
    short = overview.overview_weights(over, num)
    assert short.count() == 400
    assert short.agg(F.sum("catch_wt")).first()[0] == 400 * 300 * 100.0


def test_summary_modes(tables, rows):
    joined = overview.overview_weights(*tables)
    weights = overview.stratum_summary(joined, ["fleet", "country", "sampled"], "LandWt")
    assert [tuple(r) for r in weights.collect()] == [
        ("F1", "BE", True, 200.0), ("F2", "NL", True, 50.0), ("F2", "NL", False, 100.0)
    ]
    dis = overview.stratum_summary(joined, ["fleet"], "DisWt")
    assert rows(dis) == [("F1", 5.0)]
    ratio = overview.stratum_summary(joined, ["fleet", "sampled"], "DisRatio")
    assert rows(ratio) == [("F1", False, True, 5 / 205)]
    only = overview.stratum_summary(joined, ["sampled"], "DisRatio")
    assert rows(only) == [(False, False, 5 / 105), (False, True, 5 / (5 + 257))]
    provided = overview.stratum_summary(joined, ["fleet", "sampled"], "DiscProvided")
    assert rows(provided) == [("F1", True, 200.0), ("F2", False, 150.0), ("F3", False, 7.0)]


def test_percent_runs_to_100_per_panel(tables):
    joined = overview.overview_weights(*tables)
    out = overview.stratum_summary(joined, ["fleet", "area", "season"], "LandPercent").collect()
    for panel in {(r["area"], r["season"]) for r in out}:
        part = [r for r in out if (r["area"], r["season"]) == panel]
        assert max(r["cumulative"] for r in part) == pytest.approx(100.0)
        assert sum(r["percent"] for r in part) == pytest.approx(100.0)
    whole = overview.stratum_summary(joined, ["fleet", "area"], "LandPercent", individual_totals=False).collect()
    assert sum(r["percent"] for r in whole) == pytest.approx(100.0)
    capped = overview.stratum_summary(joined, ["fleet"], "LandPercent", ymax=10).collect()
    assert max(r["percent_capped"] for r in capped) == 10.0
    assert sum(r["percent"] for r in capped) == pytest.approx(100.0)


def test_a_cap_leaves_the_order(spark):
    df = spark.createDataFrame([("A", 10.0), ("B", 30.0), ("C", 20.0)], "fleet string, catch_wt double").withColumns(
        {"category": F.lit("L"), "sampled": F.lit(False)}
    )
    out = overview.stratum_summary(df, ["fleet"], "LandWt", ymax=5).collect()
    assert [(r["fleet"], r["land_wt"], r["land_wt_capped"]) for r in out] == [("B", 30.0, 5.0), ("C", 20.0, 5.0), ("A", 10.0, 5.0)]


def test_provided_discards_come_first(spark):
    df = spark.createDataFrame(
        [("A", "L", 900.0), ("B", "L", 5.0), ("B", "D", 1.0)], "fleet string, category string, catch_wt double"
    ).withColumn("sampled", F.lit(True))
    first = lambda dims: overview.stratum_summary(df, dims, "DiscProvided").first()["fleet"]
    assert first(["fleet", "sampled"]) == "B" and first(["fleet"]) == "A"


def test_ties_and_missing_weights(spark):
    df = spark.createDataFrame(
        [("A", "x", 2.0), ("B", "x", 2.0), ("A", "y", 2.0), ("C", "y", None)], "fleet string, country string, catch_wt double"
    ).withColumns({"category": F.lit("L"), "sampled": F.lit(False)})
    out = overview.stratum_summary(df, ["fleet", "country"], "LandPercent").collect()
    assert [(r["fleet"], r["country"]) for r in out] == [("C", "y"), ("A", "y"), ("B", "x"), ("A", "x")]
    assert [r["cumulative"] for r in out] == [None] * 4


def test_wrong_arguments(tables):
    joined = overview.overview_weights(*tables)
    for dims, mode in ((["fleet"], "CatchWt"), (["gear"], "LandWt"), ([], "LandWt"), (["fleet"], "DisRatio")):
        with pytest.raises(ValueError):
            overview.stratum_summary(joined, dims, mode)
