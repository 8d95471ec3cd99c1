from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catchframe import get_session, plans, shared_dir
from catchframe.sources import schemas


def put(path, text):
    path.write_text(text)
    return str(path)


@pytest.fixture
def files(spark, tmp_path):
    prelim = "Year,Species.Latin.Name,Area,Country,AMS.Catch.TLW.,BMS.Catch.TLW.\n"
    detailed = spark.createDataFrame([
        (2013, "27.4.a", "1", "Belgium", "TBB_DEF", "Landings", "Imported_Data", 5000.0),
        (2014, "27.4.a", "1", "Belgium", "TBB_DEF", "Landings", "Imported_Data", 1000.0),
        (2014, "27.4.a", "1", "Belgium", "TBB_DEF", "Discards", "Imported_Data", 500.0),
        (2014, "27.7.d", "1", "France", "TBB_DEF", "Discards", "Imported_Data", 250.0),
    ], schemas.DETAILED_CATCHES)
    detailed.write.partitionBy("year").parquet(str(tmp_path / "detailed"))
    return plans.CatchFiles(
        historical=put(tmp_path / "h.csv", "Species,Division,Country,1999,2000,2005\nBrill,IV a,Belgium,1,2,3\nTurbot,IV a,Belgium,4,5,6\n"),
        dataset=put(tmp_path / "d.csv", "Species,Area,Units,Country,2006,2014\nBLL,27.4,TLW,BE,7,8\nTUR,27.4,TLW,BE,9,0 c\n"),
        preliminary=[
            put(tmp_path / "p22.csv", prelim + "2022,Scophthalmus rhombus,27_4_B,BE,3,1\n2022,Scophthalmus maximus,27_4_B,BE,2,\n"),
            put(tmp_path / "p23.csv", prelim + "2023,Scophthalmus rhombus,27_7_D,FR,5,\n2023,Scophthalmus rhombus,27_4_B,FR,1,\n"),
        ],
        detailed=str(tmp_path / "detailed"),
        quota=put(tmp_path / "q.csv", "Year,Agreed TAC 2a4\n2000,70\n2030,1\n"),
        combined_quota=put(tmp_path / "c.csv", "Year,Agreed TAC 2a3a47de\n2023,12\n"),
    )


def test_catch_run(spark, files, tmp_path, rows):
    tables = plans.catch_tables(spark, files)
    assert rows(tables["official_landings"], "year", "country", "landings") == [
        (1999, "BE", 1.0), (2000, "BE", 2.0), (2005, "BE", 3.0), (2006, "BE", 7.0), (2014, "BE", 8.0),
        (2022, "BE", 4.0), (2023, "FR", 1.0), (2023, "FR", 5.0),
    ]
    assert rows(tables["catch_series"], "year", "landings", "discards", "total") == [
        (1999, 1.0, None, None), (2000, 2.0, None, None), (2005, 3.0, None, None), (2006, 7.0, None, None),
        (2014, 1.0, 0.75, 1.75),
    ]
    assert rows(tables["quota_uptake"], "year", "total", "uptake") == [
        (2000, 7.0, 10.0), (2005, 9.0, None), (2006, 16.0, None), (2014, 8.0, None), (2022, 6.0, None),
        (2023, None, None), (2030, None, None),
    ]
    assert rows(tables["combined_quota_uptake"], "year", "total", "uptake") == [(2023, 6.0, 50.0)]
    paths = plans.write_tables(tables, str(tmp_path / "out"))
    assert set(paths) == set(tables)
    assert spark.read.csv(paths["catch_series"], header=True).count() == 5
    parquet = plans.write_tables({"series": tables["catch_series"]}, str(tmp_path / "out2"), form="parquet")
    assert spark.read.parquet(parquet["series"]).count() == 5
    with pytest.raises(ValueError):
        plans.write_tables({}, "x", form="orc")


def test_report_run(spark, files, rows):
    official = plans.catch_tables(spark, files)["official_landings"]
    tables = plans.report_tables(official)
    assert rows(tables["landings_4"], "year", "BE", "total")[0] == (1999, 1.0, 1.0)
    assert set(tables) == {"landings_3a", "landings_4", "landings_7de", "area_share", "country_share"}


def test_model_and_assessment_runs(spark, rows):
    keys = ["stock"]
    catch = spark.createDataFrame([("s", y, 1.0) for y in (1997, 1998, 1999, 2000)], "stock string, year int, landings double")
    index = spark.createDataFrame(
        [("s", k, t, 1.0 + i, 0.1) for k in ("sem1", "sem2", "hist") for i, t in enumerate((1999.0, 2000.0))],
        "stock string, index string, time double, obs double, cv double",
    )
    retro = spark.createDataFrame(
        [("s", p, s, t, 1.0, 0.1) for p in (0, 1) for s in (1, 2) for t in ((1999.0, 2000.0), (1999.0,))[p]],
        "stock string, peel int, semester int, time double, obs double, cv double",
    )
    model = plans.model_tables(catch, index, retro, keys=keys)
    assert model["catch_obs"].count() == 4 and model["index_obs"].count() == 6
    assert rows(model["retro_catch_obs"], "peel", "time") == [(1, 1997.0), (1, 1998.0), (1, 1999.0)]
    assert model["retro_index_obs"].count() == 4

    fitted = spark.createDataFrame(
        [("s", r, q, 2000.0 + t / 4, 0.1 * r, 0.1, True, 0.25) for r in (0, 1, 2) for q in ("logB", "logF", "logBBmsy", "logFFmsy") for t in range(4 - r)],
        "stock string, run int, quantity string, time double, est double, sd double, in_est boolean, dt double",
    )
    runs = spark.createDataFrame([("s", 0, 0), ("s", 1, 0), ("s", 2, 1)], "stock string, run int, convergence int")
    params = spark.createDataFrame([("s", 2.0, 2.0, 10.0, 0.4, 5.0, 2.0)], schemas.PARAMS)
    scenarios = spark.createDataFrame([("s", "a", 90.0, 0.5, 1.25)], "stock string, scenario string, landings_pred double, ffmsy double, bbmsy double")
    constants = spark.createDataFrame([("s", 10.0, 1.0, 80.0, 90.0)], schemas.ADVICE_CONSTANTS)
    out = plans.assessment_tables(fitted, runs, params, scenarios, constants, status_time=2000.5)
    for name, df in out.items():
        assert df.count() > 0, name
    rho = out["mohns_rho"].collect()
    assert {r["rho"] for r in rho} == {0.105} and len(rho) == 2


def test_index_run(spark, tmp_path, rows):
    files = plans.IndexFiles(
        put(tmp_path / "1.csv", '"",timeI,ObsI,CV\n"1",2000,1,0.1\n"2",2001,3,NA\n'),
        put(tmp_path / "2.csv", '"","ObsI","timeI","CV"\n"1",4,2000.5,0.2\n'),
        put(tmp_path / "h.csv", "timeI,ObsI,CV\n1983,2,0.4\n1984,2,0.4\n"),
    )
    out = plans.index_tables(spark, files)
    assert rows(out["index_sem2"], "time", "obs", "cv") == [(2000.5, 4.0, 0.2)]
    assert rows(out["index"], "index", "time", "cv") == [
        ("hist", 1983.0, 0.4), ("hist", 1984.0, 0.4), ("sem1", 2000.0, 0.1), ("sem1", 2001.0, None), ("sem2", 2000.5, 0.2),
    ]
    sd = 0.125 ** 0.5
    assert [r[:3] + (pytest.approx(r[3]),) for r in rows(out["index_band"], "index", "time", "normalized", "upper")] == [
        ("Comb.idx.Sem.1", 2000.0, 0.5, 0.5 + sd), ("Comb.idx.Sem.1", 2001.0, 1.5, 1.5 + sd),
        ("Comb.idx.Sem.2", 2001.0, 1.0, 1 + sd), ("Hist.idx.Q1", 1983.0, 1.0, 1 + sd), ("Hist.idx.Q1", 1984.0, 1.0, 1 + sd),
    ]
    catch = spark.createDataFrame([(2000, 1.0)], "year int, landings double")
    assert plans.model_tables(catch, out["index"])["index_obs"].count() == 5


def test_scenario_run_and_summary(spark, rows):
    states = spark.createDataFrame(
        [("s", sc, q, t, e) for sc, e in (("a", 0.0), ("b", 1.0)) for q in ("logCpred", "logFFmsy", "logBBmsy") for t in (2002.0, 2003.0)]
        + [("s", "gone", "logCpred", 1990.0, 0.0)],
        "stock string, scenario string, quantity string, time double, est double",
    )
    catch = spark.createDataFrame([("s", 1999, 5.0, 1.0), ("s", 2000, 6.0, None)], "stock string, year int, landings double, discards double")
    constants = spark.createDataFrame([("s", 10.0, 1.0, 80.0, 90.0)], schemas.ADVICE_CONSTANTS)
    out = plans.scenario_tables(states, catch, constants)
    assert rows(out["scenario_inputs"], "scenario", "landings_pred", "ffmsy", "interval_end") == [
        ("a", 1.0, 1.0, 2003), ("b", pytest.approx(2.718281828), pytest.approx(2.718281828), 2003), ("gone", None, None, 2003),
    ]
    assert out["advice"].count() == 3
    fitted = spark.createDataFrame(
        [("s", q, t, 0.0, 0.1, t < 2001) for q in ("logFFmsy", "logBBmsy", "logB") for t in (1999.0, 1999.5, 2000.5, 2001.0)],
        "stock string, quantity string, time double, est double, sd double, in_est boolean",
    )
    assert rows(plans.summary_table(fitted, catch), "Year", "Landings", "Discards", "FishingPressure", "StockSize") == [
        (1999, 5.0, 1.0, 1.0, 1.0), (2000, 6.0, None, None, None),
    ]


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark) != shared_dir(spark)
    assert get_session("again").conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.range(1).select(F.lit(1)).count() == 1


HEADER = "Year,Species Latin Name,Area,Country,AMS Catch(TLW),BMS Catch(TLW)\n"


def test_yearly_refresh(spark, tmp_path):
    """A second run reads one new file; the other years keep their files; a file for a known year replaces that year."""
    from catchframe.plans import refresh_preliminary

    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))

    def put(name, year, *weights):
        path = tmp_path / "in" / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(HEADER + "".join(f"{year},Scophthalmus rhombus,27_4_B,DK,{w},\n" for w in weights))

    def files():
        return {p.parent.name: {q.name for q in p.parent.glob("*.parquet")} for p in (tmp_path / "out").glob("year=*/*.parquet")}

    def years():
        return {(r["year"], r["ams"]) for r in spark.read.parquet(out).collect()}

    put("a.csv", 2020, 1, 2)
    put("b.csv", 2021, 3)
    assert refresh_preliminary(spark, source, out, log) == 2 and years() == {(2020, 1.0), (2020, 2.0), (2021, 3.0)}
    before = files()
    put("c.csv", 2022, 4)
    assert refresh_preliminary(spark, source, out, log) == 1 and years() == {(2020, 1.0), (2020, 2.0), (2021, 3.0), (2022, 4.0)}
    assert {k: v for k, v in files().items() if k != "year=2022"} == before
    assert refresh_preliminary(spark, source, out, log) == 0
    put("b2.csv", 2021, 5)
    assert refresh_preliminary(spark, source, out, log) == 1 and years() == {(2020, 1.0), (2020, 2.0), (2021, 5.0), (2022, 4.0)}
    assert files()["year=2020"] == before["year=2020"]
    put("d.csv", 2023, 6)
    with (tmp_path / "in" / "d.csv").open("a") as f:
        f.write("2024,Scophthalmus rhombus,27_4_B,DK,7,\n")
    with pytest.raises(Exception, match="one year"):
        refresh_preliminary(spark, source, out, log)


def test_text_is_parsed_once_per_run(spark, files):
    """The tables of a run read its stored rows: no text file is left in their plans but the newest one's."""
    tables = plans.catch_tables(spark, files)
    for name in ("official_landings", "bms_landings", "catch_series", "quota_uptake"):
        read = {path.rsplit("/", 1)[1] for path in tables[name].inputFiles()}
        assert not read & {"h.csv", "d.csv", "p22.csv", "p23.csv"}, name
