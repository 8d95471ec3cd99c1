from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from catchframe.functions import z_value
from catchframe.operators import indices, modelio, states

INDEX = "index string, time double, obs double, cv double"
INDEX_ROWS = [("sem1", 2000.0, 1.0, 0.1), ("sem1", 2001.0, 3.0, 0.3), ("sem2", 2000.0, 4.0, 0.2), ("hist", 1983.0, 2.0, 0.4), ("hist", 1984.0, None, 0.4)]


@pytest.fixture
def index(spark):
    return spark.createDataFrame(INDEX_ROWS, INDEX)


def test_normalised_and_combined(index, rows):
    assert rows(indices.normalised_index(index), "index", "time", "normalized") == [
        ("hist", 1983.0, None), ("hist", 1984.0, None), ("sem1", 2000.0, 0.5), ("sem1", 2001.0, 1.5), ("sem2", 2000.0, 1.0)
    ]
    parts = [(index.filter(F.col("index") == k), name, by) for k, name, by in (("sem1", "A", 0.0), ("sem2", "B", 0.5))]
    combined = indices.combined_index(*parts)
    assert rows(combined, "index", "time", "normalized") == [("A", 2000.0, 0.5), ("A", 2001.0, 1.5), ("B", 2000.5, 1.0)]
    assert rows(indices.labelled_index(index, {"sem1": ("A", 0.0), "sem2": ("B", 0.5)})) == rows(combined.select(*index.columns, "normalized"))
    band = indices.deviation_band(combined).filter("index = 'B'").first()
    assert (band["lower"], band["upper"]) == (pytest.approx(0.5), pytest.approx(1.5))
    assert indices.deviation_band(indices.normalised_index(index)).filter("lower is not null").count() == 0


def test_model_input(spark, index, rows):
    assert rows(modelio.index_input(index), "index", "time", "obs", "stdevfac") == [
        ("hist", 1983.0, 2.0, 1.0), ("hist", 1984.0, None, 1.0), ("sem1", 2000.0, 1.0, pytest.approx(0.5)),
        ("sem1", 2001.0, 3.0, pytest.approx(1.5)), ("sem2", 2000.66, 4.0, 1.0),
    ]
    catch = spark.createDataFrame([(1998, 5.0), (1999, 6.0), (2001, 7.0)], "year int, landings double")
    assert rows(modelio.catch_input(catch)) == [(1998.0, 5.0, 2), (1999.0, 6.0, 1), (2001.0, 7.0, 1)]
    assert rows(modelio.year_spine(catch)) == [(1998,), (1999,), (2000,), (2001,)]
    assert rows(modelio.management_interval(catch)) == [(1998, 2001, 4, 2003, 2004)]


RETRO = "peel int, semester int, time double, obs double, cv double"


@pytest.fixture
def retro(spark):
    data = [
        (p, s, 2000.0 + y, 10.0 * s + y + p / 10, 0.1 * (y + 1))
        for p in range(3) for s in (1, 2) for y in range(4 - p)
    ]
    return spark.createDataFrame(data, RETRO)


def test_retro_input(spark, retro, index, rows):
    catch = spark.createDataFrame([(y, float(y)) for y in (1949, 1950, 1998, 1999, 2000, 2001, 2002, 2003)], "year int, landings double")
    out = modelio.retro_catch_input(catch, retro)
    assert rows(out, "peel", "time", "stdevfac") == [
        (1, 1950.0, 2), (1, 1998.0, 2), (1, 2000.0, 1), (1, 2001.0, 1), (1, 2002.0, 1),
        (2, 1950.0, 2), (2, 1998.0, 2), (2, 2000.0, 1), (2, 2001.0, 1),
    ]
    hist = index.filter("index = 'hist'")
    plain = modelio.retro_index_input(retro, hist)
    sizes = {(r["peel"], r["index"]): r["n"] for r in plain.groupBy("peel", "index").agg(F.count("*").alias("n")).collect()}
    assert sizes == {(1, "sem1"): 3, (1, "sem2"): 3, (1, "hist"): 2, (2, "sem1"): 2, (2, "sem2"): 2, (2, "hist"): 2}
    means = plain.groupBy("peel", "index").agg(F.avg("stdevfac").alias("m")).collect()
    assert all(r["m"] == pytest.approx(1.0) for r in means)
    keyed = modelio.retro_index_input(retro.withColumn("stock", F.lit("s")), hist.withColumn("stock", F.lit("s")), keys=["stock"])
    assert rows(keyed.drop("stock")) == rows(plain)


def test_retro_aligned(retro, rows):
    out = indices.retro_aligned(retro, 2, 2)
    assert rows(out) == [
        (2000.0, 20.0, 20.1, 20.2), (2001.0, 21.0, 21.1, 21.2), (2002.0, 22.0, 22.1, None), (2003.0, 23.0, None, None)
    ]
    with pytest.raises(ValueError):
        indices.retro_aligned(retro, 3, 2)


STATES = "stock string, run int, quantity string, time double, est double, sd double, in_est boolean, dt double"


def state_rows(run=0, last=2003, factor=1.0):
    out = []
    for q, base in (("logBBmsy", 1.2), ("logFFmsy", 0.8), ("logB", 100.0), ("logF", 0.2)):
        for step in range(4 * (last - 2000)):
            t = 2000 + step / 4
            out.append(("s", run, q, t, math.log(base * factor * (1 + step / 50)), 0.1, t < last - 0.5, 0.25))
    return out


@pytest.fixture
def fitted(spark):
    return spark.createDataFrame(state_rows(), STATES)


def test_interval_and_fractiles(fitted):
    band = states.state_interval(fitted, quantities=["logB"]).orderBy("time").collect()
    assert all(r["in_est"] for r in band) and len(band) == 10
    assert band[0]["estimate"] == pytest.approx(100.0)
    assert band[0]["upper"] == pytest.approx(100.0 * math.exp(1.959963984540054 * 0.1))
    series = states.fractile_series(fitted).orderBy("year").collect()
    assert list(series[0].asDict()) == ["stock", "year", "BBmsy_0.35", "FFmsy_0.65"]
    assert series[0]["BBmsy_0.35"] == pytest.approx(1.2 * (1 + 3 / 50) * math.exp(z_value(0.35) * 0.1))
    median = states.fractile_series(fitted, ["logB"], [0.5]).orderBy("year").first()
    assert median["B_0.5"] == pytest.approx(100.0 * (1 + 3 / 50))
    first = states.fractile_series(fitted, ["logB"], [0.5], "first").orderBy("year").first()
    assert first["B_0.5"] == pytest.approx(100.0)
    short = fitted.filter("time < 2002.5")
    assert states.fractile_series(short, complete_only=True, steps=4).count() == 2
    for bad in ({"what": ["logB"]}, {"when": "median"}, {"complete_only": True}):
        with pytest.raises(ValueError):
            states.fractile_series(fitted, **bad)


def test_last_step_may_be_missing(spark):
    df = spark.createDataFrame([("s", "logB", 2000.0, 1.0, 0.1), ("s", "logB", 2000.5, None, None)], "stock string, quantity string, time double, est double, sd double")
    assert states.fractile_series(df, ["logB"], [0.5]).first()["B_0.5"] is None


def test_status(fitted):
    row = states.status_at(fitted, 2002.25).first()
    assert row["bbmsy_last"] == pytest.approx(1.2 * (1 + 9 / 50) * math.exp(z_value(0.35) * 0.1))
    assert row["ffmsy_last"] == pytest.approx(0.8 * (1 + 9 / 50) * math.exp(z_value(0.65) * 0.1))


def test_mohns_rho_and_runs(spark, rows):
    data = [r for run in range(4) for r in state_rows(run, 2003 - (run > 1), 1 + run / 10)]
    df = spark.createDataFrame(data, STATES).withColumn("est", F.exp("est"))
    rho = states.mohns_rho(df, quantities=["logBBmsy"])
    assert rows(rho) == [("s", "logBBmsy", 0.2)]
    runs = spark.createDataFrame([("s", 0, 0), ("s", 1, 0), ("s", 2, 1), ("s", 3, None)], "stock string, run int, convergence int")
    labels = states.converged_runs(df, runs).select("run", "label").distinct()
    assert rows(labels) == [(0, "All"), (1, "-1")]
    assert rows(states.excluded_runs(runs)) == [("s", 2, "2, 3")]


def test_annual_stock(spark, fitted):
    row = states.annual_stock(fitted).orderBy("year").first()
    b = [100.0 * (1 + i / 50) for i in range(4)]
    f = [0.2 * (1 + i / 50) for i in range(4)]
    assert row["biomass"] == pytest.approx(100.0)
    assert row["harvest"] == pytest.approx(sum(f) / 4)
    assert row["catch"] == pytest.approx(sum(x * y * 0.25 for x, y in zip(b, f)))
    assert row["landings"] == row["catch"] and row["discards"] == 0.0
    given = spark.createDataFrame([("s", 2000, 3.0)], "stock string, year int, discards double")
    rows_ = states.annual_stock(fitted, given).orderBy("year").collect()
    assert rows_[0]["landings"] == pytest.approx(row["catch"] - 3.0) and rows_[1]["landings"] is None


def test_production_and_advice(spark):
    params = spark.createDataFrame([("s", 2.0, 2.0, 10.0, 0.4, 5.0, 2.0)], "stock string, m double, n double, K double, Fmsy double, Bmsy double, MSY double")
    got = states.production_params(params).first()
    assert (got["r"], got["p"], got["k"]) == (pytest.approx(0.8), 1.0, 10.0)
    scenarios = spark.createDataFrame([("s", "a", 90.0, 1e-9, 1.25)], "stock string, scenario string, landings_pred double, ffmsy double, bbmsy double")
    constants = spark.createDataFrame([("s", 10.0, 1.0, 80.0, 0.0)], "stock string, mean_discard_pct double, biomass_ref double, last_tac double, last_advice double")
    line = states.advice_line(scenarios, constants).first()
    assert (line["total_catch"], line["projected_landings"], line["projected_discards"]) == (100.0, 90.0, 10.0)
    assert (line["f_fmsy"], line["b_bmsy"], line["biomass_change"], line["tac_change"]) == (0.0, 1.25, 20.0, 25.0)
    assert line["advice_change"] == math.inf


def test_fractiles_by_table(spark):
    rows = spark.createDataFrame(state_rows(), STATES)
    wanted = spark.createDataFrame([("logBBmsy", 0.35), ("logBBmsy", 0.5), ("logFFmsy", 0.65), ("logFFmsy", None)], "quantity string, fractile double")
    got = {(r["quantity"], r["year"], r["fractile"]): r["value"] for r in states.fractiles_by_table(rows, wanted).collect()}
    for r in states.fractile_series(rows).collect():
        assert got["logBBmsy", r["year"], 0.35] == pytest.approx(r["BBmsy_0.35"], rel=1e-12)
        assert got["logFFmsy", r["year"], 0.65] == pytest.approx(r["FFmsy_0.65"], rel=1e-12)
        assert got["logFFmsy", r["year"], None] is None
    assert len(got) == 4 * 3


def test_stand_ins_raise_for_other_years(spark):
    from catchframe.checks import standins

    rows = spark.createDataFrame([(1995,), (2005,)], "year int")
    assert rows.filter("year = 1995").select(standins.listed("year", standins.YEARS).alias("y")).first()["y"] == 1995
    for bad in (rows, spark.createDataFrame([(None,)], "year int")):
        with pytest.raises(Exception, match="outside of the stand-ins"):
            bad.select(standins.listed("year", standins.YEARS)).collect()
