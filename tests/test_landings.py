from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catchframe.operators import landings, quota, tables

HIST = "species string, division string, country string, X1950 string, X1951 string, X2005 string, X2006 string"
HIST_ROWS = [
    ("Brill", "III a", "Denmark", "12", "-", "3", "9"),
    ("Brill", "IV b", "Germany, Fed. Rep. of", ".", "7", "<0.5", "1"),
    ("Brill", "IV a", "Germany", "1", "2", None, "1"),
    ("Brill", "VII d", "Atlantis", "5", "12 F", "2", "2"),
    ("Turbot", "IV a", "Belgium", "4", "4", "4", "4"),
    ("Brill", "VII a", "France", "8", "8", "8", "8"),
]


def test_historical(spark, rows):
    wide = spark.createDataFrame(HIST_ROWS, HIST)
    out = landings.historical_landings(wide)
    assert rows(out, "species", "area", "units", "country", "year", "landings") == sorted([
        ("BLL", "27.3.a", "TLW", "DK", 1950, 12.0),
        ("BLL", "27.3.a", "TLW", "DK", 2005, 3.0),
        ("BLL", "27.4", "TLW", "DE", 1950, 1.0),
        ("BLL", "27.4", "TLW", "DE", 1951, 9.0),
        ("BLL", "27.7.de", "TLW", None, 1950, 5.0),
        ("BLL", "27.7.de", "TLW", None, 2005, 2.0),
    ], key=lambda t: tuple((v is not None, str(v)) for v in t))
    by_year = out.groupBy("year").agg(F.sum("landings")).collect()
    assert {r[0]: r[1] for r in by_year}[1950] == 18.0


def test_years_are_chosen_before_the_unpivot(spark):
    wide = spark.createDataFrame(HIST_ROWS, HIST)
    assert landings.year_columns(wide, 1951, 2005) == {"X1951": 1951, "X2005": 2005}
    with pytest.raises(ValueError):
        landings.unpivot_years(wide, ["species"], 1800, 1801)


DATASET = "species string, area string, units string, country string, `2006` string, `2007` string, `2021` string"
DATASET_ROWS = [
    ("BLL", "27.3.a", "TLW", "DK", "10.5", None, "4"),
    ("BLL", "27.7.d", "TLW", "GB", "3", "2", "1"),
    ("BLL", "27.7.e", "TLW", "IM", "1", "1", "1"),
    ("TUR", "27.4", "TLW", "NL", "9", "8", "7"),
    ("BLL", "27.4.a", "TLW", "NL", "9", "8", "7"),
]


def test_dataset(spark, rows):
    out = landings.dataset_landings(spark.createDataFrame(DATASET_ROWS, DATASET))
    assert rows(out, "area", "country", "year", "landings") == [
        ("27.3.a", "DK", 2006, 10.5), ("27.3.a", "DK", 2007, 0.0), ("27.3.a", "DK", 2021, 4.0),
        ("27.7.de", "UK", 2006, 4.0), ("27.7.de", "UK", 2007, 3.0), ("27.7.de", "UK", 2021, 2.0),
    ]


PRELIM = "year int, species_latin string, area string, country string, ams double, bms double"
PRELIM_ROWS = [
    (2022, "Scophthalmus rhombus", "27_3_A_20", "DK", 3.5, None),
    (2022, "Scophthalmus rhombus", "27_4_B", "GB", 2.0, 0.1),
    (2022, "Scophthalmus maximus", "27_4_B", "GB", 6.0, 0.2),
    (2022, "Scophthalmus rhombus", "27_7_D", "FR", None, None),
]


def test_preliminary_and_bms(spark, rows):
    df = spark.createDataFrame(PRELIM_ROWS, PRELIM)
    out = landings.preliminary_landings(df)
    assert rows(out, "area", "country", "landings") == [
        ("27.3.a", "DK", 3.5), ("27.4", "UK", 2.1), ("27.7.de", "FR", 0.0)
    ]
    assert rows(landings.bms_landings(df), "year", "country", "area", "bms") == [
        (2022, "DK", "27_3_A_20", 0.0), (2022, "FR", "27_7_D", 0.0), (2022, "UK", "27_4_B", 0.1)
    ]


def test_two_species_rules(spark, rows):
    prelim = spark.createDataFrame([*PRELIM_ROWS, (2022, "Scophthalmus rhombus", "27_4_A", "NL", None, 1.0)], PRELIM)
    out = quota.two_species_preliminary(prelim)
    assert rows(out) == [(2022, None, 6.2, None)]
    wide = spark.createDataFrame([("BLL", "27.2.a", "TLW", "GB", "1", None, "3"), *DATASET_ROWS], DATASET)
    assert rows(quota.two_species_dataset(wide)) == [(2006, 1.0, 9.0, 10.0), (2007, 0.0, 8.0, 8.0), (2021, 3.0, 7.0, 10.0)]
    hist = quota.two_species_historical(spark.createDataFrame(HIST_ROWS, HIST))
    assert rows(hist) == [(2005, 0.0, 4.0, 4.0)]


def test_uptake_keeps_both_sides(spark, rows):
    yearly = spark.createDataFrame([(2000, 1.0, 2.0, 3.0), (2001, None, 1.0, None), (2003, 1.0, 1.0, 2.0)], "year int, brill double, turbot double, total double")
    tac = spark.createDataFrame([(2000, 6.0), (2001, 5.0), (2002, 7.0)], "year int, tac double")
    assert rows(quota.quota_uptake(yearly, tac), "year", "total", "tac", "uptake") == [
        (2000, 3.0, 6.0, 50.0), (2001, None, 5.0, None), (2002, None, 7.0, None), (2003, 2.0, None, None)
    ]


def test_spliced_series(spark, rows):
    official = spark.createDataFrame([(2012, 5.0), (2012, 6.0), (2013, None), (2013, 4.0), (2014, 9.0)], "year int, landings double")
    detailed = spark.createDataFrame([(2013, 1000.0, 1.0), (2014, 3000.0, 500.0), (2014, None, None)], "year int, landings double, discards double")
    assert rows(landings.spliced_catch_series(official, detailed), "year", "landings", "discards", "total") == [
        (2012, 11.0, None, None), (2013, None, None, None), (2014, 3.0, 0.5, 3.5)
    ]


SUMMARY = "year int, country string, area string, landings double"


def test_country_tables(spark, rows):
    df = spark.createDataFrame([
        (2000, "UK", "27.3.a", 10.0), (2000, "DK", "27.3.a", 2.5), (2000, None, "27.3.a", 1.0), (2000, "FR", "27.3.a", 4.0),
        (2001, "UK", "27.3.a", 10.0), (2001, "IE", "27.3.a", 1.0), (2001, "DK", "27.3.a", 3.5),
        (2000, "UK", "27.4", 1.0), (2000, "GG", "27.4", 2.0), (2000, None, "27.4", 4.0),
        (2000, "CI", "27.7.de", 1.0), (2000, "JE", "27.7.de", 2.0), (2000, "FR", "27.7.de", 5.0), (2000, None, "27.7.de", 50.0),
    ], SUMMARY)
    summary = tables.landings_summary(df)
    poison = tables.table_poison(summary)
    assert poison.columns == ["year", "BE", "DE", "DK", "NL", "NO", "SE", "UK", "total"]
    assert rows(poison, "year", "DK", "UK", "total") == [(2000, 2.0, 0.0, 8.0), (2001, 4.0, 11.0, 14.0)]
    safe = tables.table_poison(summary, null_mode="safe")
    assert rows(safe, "year", "UK", "total") == [(2000, 10.0, 18.0), (2001, 11.0, 14.0)]
    assert rows(tables.table_total_first(summary), "year", "UK", "total") == [(2000, 3.0, 7.0)]
    assert rows(tables.table_explicit_total(summary), "year", "CI", "FR", "total") == [(2000, 3.0, 5.0, 8.0)]
    with pytest.raises(ValueError):
        tables.table_poison(summary, null_mode="other")


def test_shares_sum_to_100(spark):
    df = spark.createDataFrame([(2000, "UK", "a", 1.0), (2000, "DK", "a", 2.0), (2000, "DK", "b", None), (2001, "DK", "b", 7.0)], SUMMARY)
    for fn in (tables.area_share, tables.country_share):
        sums = fn(df).groupBy("year").agg(F.sum("perc").alias("p")).collect()
        assert {round(r["p"], 9) for r in sums} == {100.0}


def test_assessment_summary(spark):
    names = list(tables.SUMMARY_NAMES)
    df = spark.createDataFrame([tuple(range(len(names)))], names)
    out = tables.assessment_summary(df)
    assert out.columns == list(tables.SUMMARY_NAMES.values())
    assert tuple(out.first()) == tuple(range(len(names)))
