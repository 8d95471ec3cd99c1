from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from catchframe.operators import composition, lengths

SCHEMA = "year int, area string, season string, country string, fleet string, category string, origin string, caton double"
ROWS = [
    (2014, "27.4.a", "1", "Netherlands", "TBB_DEF_70-99", "Landings", "Imported_Data", 1000.0),
    (2014, "27.4.b", "1", "Netherlands", "TBB_DEF_70-99", "Landings", "Imported_Data", 300.0),
    (2014, "27.4.b", "1", "Netherlands", "TBB_DEF_70-99", "Discards", "Raised_Discards", 200.0),
    (2014, "27.3.a.20", "2", "Denmark", "OTB_CRU_90", "Landings", "Imported_Data", None),
    (2014, "27.3.a.20", "2", "Denmark", "OTB_CRU_90", "Discards", "Imported_Data", 5.0),
    (2014, "27.7.d", "2", "France", "GTR_DEF", "Logbook Registered Discard", "Imported_Data", 5.0),
    (2014, "27.7.d", "2", "France", "GTR_DEF", "Landings", "Imported_Data", 0.0),
    (2014, "27.7.d", "2", "France", "GTR_DEF", "Discards", "Imported_Data", 0.0),
    (2015, "27.7.e", "2", "Atlantis", "GTR_DEF", "Landings", "Imported_Data", 0.0),
    (2015, "27.7.e", "2", "Atlantis", "GTR_DEF", "Discards", "Imported_Data", 3.0),
    (2015, "27.9", "2", "France", "GTR_DEF", None, "Imported_Data", 3.0),
]


@pytest.fixture
def catch(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_category_table(catch, rows):
    out = composition.catch_category_with_total(catch)
    got = rows(out.filter("year = 2014"), "area", "country", "discards", "landings", "total", "discard_ratio", "dl_ratio")
    assert got == sorted([
        ("27.4", "NL", None, 1000.0, None, None, None),
        ("27.4", "NL", 200.0, 300.0, 500.0, 40.0, 200 / 300),
        ("27.3.a", "DK", 5.0, None, None, None, None),
        ("27.7.de", "FR", 0.0, 0.0, 0.0, 0.0, 0.0),
        ("Total", None, 205.0, 1300.0, 500.0, 205 / 1505 * 100, 205 / 1300),
    ], key=lambda t: tuple((v is not None, str(v)) for v in t))
    late = rows(out.filter("year = 2015"), "area", "country", "dl_ratio", "total")
    assert ("27.7.de", None, math.inf, 3.0) in late
    assert (None, "FR", None, None) in late


def test_total_is_sum_of_detail(catch):
    detail = composition.catch_category_table(catch)
    total = composition.category_total_row(detail)
    for row in total.collect():
        part = [r for r in detail.collect() if r["year"] == row["year"]]
        for c in ("discards", "landings", "total"):
            assert row[c] == sum(r[c] or 0.0 for r in part)


def test_detail_and_long_form(catch, rows):
    detail = composition.detailed_catches(catch)
    assert detail.columns == ["species", "area", "units", "country", "year", "landings", "discards"]
    assert detail.filter("area is null").count() == 0
    long = composition.discard_measures(catch)
    assert long.count() == 5 * composition.catch_category_with_total(catch).count()
    cells = long.filter("variable = 'total'").select("year", "area", "country", F.col("value").alias("total"))
    assert rows(cells) == rows(composition.catch_category_with_total(catch), "year", "area", "country", "total")


def test_shares(catch, rows):
    known = catch.filter("caton is not null")
    assert rows(composition.gear_share(known.filter("year = 2014")), "gear", "catch") == [("GTR", 5.0), ("OTB", 5.0), ("TBB", 1500.0)]
    for fn in (composition.gear_share, composition.gear_fine_share, composition.season_share):
        got = fn(known).groupBy("year").agg(F.sum("perc").alias("p")).collect()
        assert {round(r["p"], 9) for r in got} == {100.0}
    poisoned = composition.season_share(catch.filter("year = 2014"))
    assert rows(poisoned, "season", "catch", "perc") == [("1", 1500.0, None), ("2", None, None)]
    assert {r["perc"] for r in composition.season_share(known, keys=()).collect()} != {None}


def test_country_share_is_within_country(catch, rows):
    out = composition.country_area_share(catch.filter("country = 'Netherlands'"))
    assert rows(out, "area", "landings", "perc") == [("27.4.a", 1000.0, 1000 / 1300 * 100), ("27.4.b", 300.0, 300 / 1300 * 100)]


def test_discard_percent_and_origin(catch, rows):
    out = composition.discard_percent_by_gear(catch.filter("country = 'Netherlands'"))
    assert rows(out, "area", "gear", "caton_sum", "perc") == [("27.4.b", "TBB", 200.0, 40.0)]
    assert rows(composition.origin_sums(catch)) == [("Imported_Data", None), ("Raised_Discards", 200.0)]


RAISE = "ord int, group string, count int, gear_group string, category string, caton double, perc double"


def test_raising(spark, rows):
    df = spark.createDataFrame([
        (1, "g1", 2, "TBB", "Landings", 10.0, 0.2),
        (2, "g1", 2, "TBB", "Landings", 30.0, 0.4),
        (3, "g1", 1, "TBB", "Landings", 7.0, None),
        (4, "g1", 1, "MIS", "Landings", 9.0, 0.9),
        (5, "g2", 1, "TBB", "Landings", 7.0, 0.5),
        (6, "g3", 2, "TBB", "Landings", None, 0.5),
        (7, "g3", 1, "TBB", "Landings", 1.0, 0.5),
        (8, None, 2, "TBB", "Landings", 2.0, 0.5),
        (9, None, 1, "TBB", "Landings", 1.0, None),
        (10, "g4", 2, "TBB", "Landings", 1.0, 0.5),
    ], RAISE)
    got = {r["ord"]: r["percraise"] for r in composition.raise_percent(df).collect()}
    assert got[3] == pytest.approx(0.35)
    assert {k: v for k, v in got.items() if k != 3} == {1: None, 2: None, 5: None, 6: None, 7: None, 8: None, 9: 0.5, 10: None}
    lists = composition.raise_lists(df)
    members = lists.orderBy("ord").collect()
    texts = {g: [(r["percraise_includes"], r["percraise_weights"]) for r in members if r["group"] == g] for g in ("g1", "g4", None)}
    assert texts["g1"] == [("0.2", "10"), ("0.4", "30"), ("NA", "NA")]
    assert not texts["g4"] and texts[None]


def test_landings_with_discards(spark, rows):
    schema = "stock string, country string, area string, season string, fleet string, category string, origin string, caton double, age_or_length double"
    df = spark.createDataFrame([
        ("s", "BE", "27.4", "1", "F1", "Landings", "Imported_Data", 100.0, 10.0),
        ("s", "BE", "27.4", "1", "F1", "Landings", "Imported_Data", 100.0, 20.0),
        ("s", "BE", "27.4", "1", "F1", "Discards", "Imported_Data", 5.0, None),
        ("s", "NL", "27.4", "1", "F2", "Landings", "Imported_Data", 300.0, None),
        ("s", "NL", "27.4", "1", "F2", "Discards", "Raised_Discards", 5.0, None),
    ], schema)
    assert rows(composition.landings_with_discards(df)) == [(25.0,)]
    text = df.withColumn("caton", F.col("caton").cast("string"))
    assert rows(composition.landings_with_discards(text, keys=["stock"])) == [("s", 25.0)]
    poisoned = df.unionByName(df.limit(1).withColumns({"caton": F.lit(None).cast("double"), "fleet": F.lit("F9")}))
    assert rows(composition.landings_with_discards(poisoned)) == [(None,)]


def test_lengths(spark, rows):
    df = spark.createDataFrame([
        ("OTB_a", "D", 1.0, 2.0), ("OTB_a", "L", 3.0, None), ("TBB_b", "L", 5.0, 1.0), ("TBB_b", "Logbook Registered Discard", 9.0, 9.0),
    ], "fleet string, category string, UndeterminedLngt100 double, UndeterminedLngt110 double")
    assert rows(lengths.length_frequency(df)) == [(100, 18.0), (110, None)]
    assert rows(lengths.length_frequency(df, by_category=True)) == [("D", 100, 1.0), ("D", 110, 2.0), ("L", 100, 8.0), ("L", 110, None)]
    assert rows(lengths.length_frequency(df, by_gear=True), "category", "gear", "length", "freq") == [
        ("D", "OTB", 100, 1.0), ("D", "OTB", 110, 2.0), ("L", "OTB", 100, 3.0), ("L", "OTB", 110, None),
        ("L", "TBB", 100, 5.0), ("L", "TBB", 110, 1.0),
    ]
    with pytest.raises(ValueError):
        lengths.length_frequency(df.select("fleet"))
