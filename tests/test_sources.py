from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catchframe import sources
from catchframe.operators import composition, landings, lengths, overview
from catchframe.sources import schemas
from catchframe.sources.sectioned import REPORT_NAMES, WIDTH


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


@pytest.fixture
def small_splits(spark):
    """Files cut into many splits, as on a cluster."""
    settings = {
        "spark.sql.files.maxPartitionBytes": "900", "spark.sql.files.openCostInBytes": "10",
        "spark.sql.files.minPartitionNum": "1",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_header_names():
    assert sources.header_name("1950") == "X1950"
    assert sources.header_name("AMS Catch(TLW)") == "AMS.Catch.TLW."
    assert sources.header_name('"Species"') == "Species"


def test_historical_and_dataset(spark, tmp_path, rows):
    hist = put(tmp_path / "h.csv", 'Species,Division,Country,1950,2005\nBrill,III a,"Germany, Fed. Rep. of",12,-\nBrill,IV a,NA,,3\n')
    wide = sources.read_historical(spark, hist)
    assert wide.columns == ["species", "division", "country", "X1950", "X2005"]
    assert rows(landings.historical_landings(wide), "country", "year", "landings") == [(None, 2005, 3.0), ("DE", 1950, 12.0)]
    data = put(tmp_path / "d.csv", "Species,Area,Units,Country,2006,2007\nBLL,27.4,TLW,NL,0 c,2\nBLL,27.4,TLW,GB,1.5,\n")
    wide = sources.read_dataset(spark, data)
    assert rows(landings.dataset_landings(wide), "country", "year", "landings") == [
        ("NL", 2006, 0.0), ("NL", 2007, 2.0), ("UK", 2006, 1.5), ("UK", 2007, 0.0)
    ]


A = "Year,Species Latin Name,Area,Country,AMS Catch(TLW),BMS Catch(TLW)\n"
B = "Year,Area,Species.Latin.Name,Country,AMS_Catch,BMS_Catch\n"


def test_preliminary_variants(spark, tmp_path, rows):
    a = put(tmp_path / "a.csv", A + "2022,Scophthalmus rhombus,27_4_B,GB,2,0.5\n2022,Scophthalmus rhombus,27_4_A,DK,3,\n")
    b = put(tmp_path / "b.csv", B + "2023,27_4_B,Scophthalmus rhombus,GB,2,0.5\n2023,27_4_A,Scophthalmus rhombus,DK,3,x\n")
    df = sources.read_preliminary(spark, [a, b])
    assert df.columns == ["year", "species_latin", "area", "country", "ams", "bms"]
    out = landings.preliminary_landings(df)
    assert rows(out, "year", "country", "landings") == [(2022, "DK", 3.0), (2022, "UK", 2.5), (2023, "DK", 3.0), (2023, "UK", 2.5)]
    lines = sources.scan_lines(spark, [a, b])
    tops = sources.first_lines(lines, sources.file_splits(lines), 1)
    assert sorted(r["top"][0] for r in tops.collect()) == sorted([A.strip(), B.strip()])


def test_two_years_in_a_file(spark, tmp_path):
    a = put(tmp_path / "a.csv", A + "2022,Scophthalmus rhombus,27_4_B,GB,2,0.5\n2023,Scophthalmus rhombus,27_4_A,DK,3,\n")
    with pytest.raises(Exception, match="one year"):
        sources.read_preliminary(spark, a).collect()
    assert sources.read_preliminary(spark, a, one_year_per_file=False).count() == 2


def test_quota_and_clean_table(spark, tmp_path, rows):
    q = put(tmp_path / "q.csv", "Year,Agreed TAC 2a4\n2000,9000\n2001,NA\n")
    assert rows(sources.read_quota(spark, q, "Agreed TAC 2a4")) == [(2000, 9000.0), (2001, None)]
    i = put(tmp_path / "i.csv", '"","timeI","ObsI","CV"\n"1",2000,1.5,0.1\n"2",2001,NA,0.2\n')
    table = sources.read_clean_table(
        spark, i, schemas.INDEX, rename={"timeI": "time", "ObsI": "obs", "CV": "cv"}, drop_first=True
    )
    assert rows(table) == [(2000.0, 1.5, 0.1), (2001.0, None, 0.2)]


def test_each_file_has_its_own_header(spark, tmp_path, rows):
    put(tmp_path / "h" / "a.csv", "Species,Division,Country,2006,2007\nBrill,III a,BE,1,2\n")
    put(tmp_path / "h" / "b.csv", "Country,Species,Division,2007,2008,2009\nDK,Brill,IV a,70,80,90\n")
    wide = sources.read_historical(spark, str(tmp_path / "h"))
    assert rows(wide, "country", "X2006", "X2007", "X2008", "X2009") == [("BE", "1", "2", None, None), ("DK", None, "70", "80", "90")]
    put(tmp_path / "p" / "year=2001" / "q.tsv", "Year\tTAC\n2001\t5\n")
    table = sources.scan_text_table(spark, str(tmp_path / "p"), sep="\t")
    assert table.columns == ["Year", "TAC"] and rows(table) == [("2001", "5")]


def test_quoted_length_table(spark, tmp_path, rows):
    put(tmp_path / "l" / "lfq_2023_v2.txt", 'top\n\n"Fleets"\t"CatchCategory"\t"UndLngt100"\n"OTB\ta"\t"D"\t"1"\nTBB\tD\t3\n')
    table = sources.read_length_table(spark, str(tmp_path / "l"))
    assert rows(table) == [(2023, "OTB\ta", "D", 1.0), (2023, "TBB", "D", 3.0)]
    put(tmp_path / "n" / "lfq.txt", "top\n\nFleets\tCatchCategory\tUndLngt100\nTBB\tD\t3\n")
    with pytest.raises(Exception, match="no year"):
        sources.read_length_table(spark, str(tmp_path / "n")).collect()


def test_overview_files(spark, tmp_path, rows):
    over = put(tmp_path / "o.tsv",
               "Stock\tCountry\tArea\tSeason\tA\tB\tFl\tC\tD\tWt\tCat\tRep\tLast\n"
               "s1\tBE\t27.4\t1\tx\tx\tF1\tx\tx\t100\tLandings\tR\tz\n"
               "s1\tNL\t27.4\t1\tx\tx\tF2\tx\tx\t9\tLogbook Registered Discard\tR\tz\n")
    num = put(tmp_path / "n.tsv",
              "A\tB\tArea\tSeason\tCountry\tC\tCat\tD\tFl\tX\tSampledCatch\nx\tx\t27.4\t1\tBE\tx\tL\tx\tF1\tx\t20\n")
    joined = overview.overview_join(sources.read_overview(spark, over), sources.read_sampled_numbers(spark, num))
    assert rows(joined, "fleet", "catch_wt", "sampled") == [("F1", 100.0, True)]


def test_length_files_with_different_columns(spark, tmp_path, rows):
    put(tmp_path / "l" / "freq_2020.txt", "top\nline\nFleets\tCatchCategory\tUndLngt100\tUndLngt110\nOTB_a\tD\t1\t2\nTBB_b\tL\t3\t4\n")
    put(tmp_path / "l" / "freq_2021.txt", "top\nline\nFleets\tCatchCategory\tUndLngt110\nOTB_a\tD\t7\n")
    table = sources.read_length_table(spark, str(tmp_path / "l"))
    out = lengths.length_frequency(table, keys=["year"])
    assert rows(out) == [(2020, 100, 4.0), (2020, 110, 6.0), (2021, 100, None), (2021, 110, 7.0)]


def _report(n, split_every):
    names = [*REPORT_NAMES, *[f"U{i}" for i in range(WIDTH - len(REPORT_NAMES))]]
    lines = ["Report", "TABLE 1.", "a\tb\t", "", "TABLE 2.", "some\ttitle", "\t".join(names) + "\t", "\t".join(["-"] * WIDTH) + "\t"]
    want = []
    for i in range(n):
        cells = {n: "" for n in names} | {
            "Stock": "s", "Country": f"c{i % 7}", "Area": "27.4", "Season": "1", "Fleet": f"F{i % 5}",
            "CatchCategory": "Landings" if i % 3 else "Discards", "CATONRaisedOrImported": "Imported_Data" if i % 2 else "Raised_Discards",
            "CATON": str(1000 * (i + 1)), "AgeOrLength": str(i),
        }
        row = [cells[c] for c in names]
        want.append(row)
        cut = 5 + i % 20 if split_every and i % split_every == 0 else None
        lines += ["\t".join(row)] if cut is None else ["\t".join(row[:cut]), "\t".join(row[cut:])]
        if i % 11 == 0:
            lines.append("")
    return "\n".join(lines) + "\n", names, want


@pytest.mark.parametrize("split_every", [0, 4])
def test_sectioned_report_over_many_splits(spark, tmp_path, small_splits, split_every):
    wanted = {}
    for k in range(2):
        text, names, want = _report(60 + 40 * k, split_every)
        put(tmp_path / "r" / f"report{k}.txt", text)
        wanted[f"report{k}.txt"] = sorted(want)
    section = sources.scan_section(spark, str(tmp_path / "r"))
    assert sources.scan_lines(spark, str(tmp_path / "r")).select("file", "block").distinct().count() > 10
    got = {}
    for row in section.collect():
        assert list(row["names"]) == names
        got.setdefault(row["file"].rsplit("/", 1)[1], []).append(list(row["cells"]))
    assert {k: sorted(v) for k, v in got.items()} == wanted


def test_report_cells_over_several_lines(spark, tmp_path, small_splits):
    text, names, _ = _report(0, 0)
    want, lines = [], text
    for i in range(60):
        row = [str(i), *["x"] * (WIDTH - 1)]
        cells = list(row)
        if i % 4 == 0:
            # Every eighth cell is longer than a file split.
            row[3] = f'say "{i}"\n\n\ttab' + "\nline" * (400 if i % 8 == 0 else 1)
            cells[3] = '"' + row[3].replace('"', '""') + '"'
        want.append(row)
        lines += "\t".join(cells) + "\n"
    put(tmp_path / "r" / "several.txt", lines)
    # Quotes inside of a cell that does not begin with one are plain, and so is their number.
    net = ["9", '5" net', *["y"] * (WIDTH - 2)]
    put(tmp_path / "r" / "plain.txt", text + "\t".join(net) + "\n")
    found = sources.scan_section(spark, str(tmp_path / "r")).collect()
    assert sorted(list(r["cells"]) for r in found) == sorted([*want, net])
    assert all(list(r["names"]) == names for r in found)
    put(tmp_path / "o" / "open.txt", text + "\t".join(["1", '"never closed', *["y"] * (WIDTH - 2)]) + "\n")
    with pytest.raises(ValueError, match="not closed"):
        sources.scan_section(spark, str(tmp_path / "o"))


def test_catch_report_to_percent(spark, tmp_path):
    text, _, want = _report(50, 4)
    report = sources.read_catch_report(spark, put(tmp_path / "r.txt", text))
    assert report.schema["caton"].dataType == schemas.DOUBLE
    covered = {(r[1], r[4]) for r in want if r[5] == "Discards" and r[6] == "Imported_Data"}
    landed = [(float(r[7]), (r[1], r[4]) in covered) for r in want if r[5] == "Landings"]
    expected = 100 * sum(w for w, hit in landed if hit) / sum(w for w, _ in landed)
    assert composition.landings_with_discards(report.drop("file")).first()[0] == pytest.approx(expected)


def test_report_lines_that_differ_in_other_columns(spark, tmp_path):
    text, names, want = _report(9, 0)
    same = list(want[1])
    same[-1] = "other"
    text += "\t".join(same) + "\n"
    report = sources.read_catch_report(spark, put(tmp_path / "r.txt", text))
    assert report.drop("file").distinct().count() == 10
    quoted = list(want[1])
    quoted[5] = '"Land\tings"'
    report = sources.read_catch_report(spark, put(tmp_path / "q.txt", text + "\t".join(quoted) + "\n" + "\t".join(want[2]) + "\n"))
    assert report.count() == 12 and report.filter("category = 'Land\tings'").count() == 1


def test_sinks(spark, tmp_path, rows):
    df = spark.createDataFrame([(2000, 'a,"b"', None), (2001, None, 1.5)], "year int, name string, x double")
    plain, quoted = (sources.write_csv(df, str(tmp_path / n), quote=q) for n, q in (("p", False), ("q", True)))
    for path in (plain, quoted):
        back = spark.read.options(header="true", nullValue="NA", escape='"').csv(path)
        assert rows(back) == [("2000", 'a,"b"', None), ("2001", None, "1.5")]
    assert any(line.startswith('"2001"') for f in (tmp_path / "q").glob("*.csv") for line in f.read_text().splitlines())
    table = sources.write_table(df, str(tmp_path / "t"), partition_by=["year"])
    assert rows(spark.read.parquet(table), "year", "name", "x") == rows(df)
    plan = spark.read.parquet(table).filter(F.col("year") == 2000)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


CELLS = ['IV ""a""', "x,y", "Br\nill", "two\n\nblank \n lines", '"', 'a"\n"b', "", "end\\", "tab\there", "été\n,"]


def csv_text(rows):
    """Rows as quoted text, written without the library."""
    quoted = [",".join('"' + str(c).replace('"', '""') + '"' for c in row) for row in rows]
    return "n,name,other\n" + "\n".join(quoted) + "\n"


def test_quoted_cells_over_many_splits(spark, tmp_path, small_splits):
    """Doubled quotes, separators and line breaks in cells; records run over the ends of splits of under 1 KB."""
    want, files = [], {}
    for k in range(2):
        made = [(100_000 * k + i, CELLS[(i * 7 + k) % len(CELLS)] + "z" * (i % 90), CELLS[(i + k) % len(CELLS)]) for i in range(400)]
        made[50] = (100_000 * k + 50, "long\n" * 900 + "cell", "x")  # one record over several whole splits
        want += made
        files[k] = put(tmp_path / "q" / f"f{k}.csv", csv_text(made))
    put(tmp_path / "q" / "calm.csv", "other,n\nplain,7\n")
    back = sources.scan_text_table(spark, str(tmp_path / "q"))
    lines = sources.scan_lines(spark, str(tmp_path / "q"))
    assert lines.select("file", "block").distinct().count() > 30
    got = sorted((int(r["n"]), r["name"] or "", r["other"] or "") for r in back.collect())
    assert got == sorted([*want, (7, "", "plain")])


def shuffled_rows(df):
    """Rows that the run of a query wrote to shuffles, from the metrics of its final plan."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        if kind == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_quoted_cells_inside_of_splits_are_not_shuffled(spark, tmp_path):
    """Records over several lines are put together where they are read; only those over the end of a split are shuffled."""
    rows = [(i, "three\n\nlines", "x") for i in range(20_000)]
    put(tmp_path / "q" / "a.csv", csv_text(rows))
    put(tmp_path / "l" / "r_2001.txt", "a\nb\nFleets\tCatchCategory\tUndeterminedLngt10\n" + '"a\nb"\tLandings\t1\n' * 20_000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes", None)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        back = sources.scan_text_table(spark, str(tmp_path / "q"))
        table = sources.read_length_table(spark, str(tmp_path / "l"))
        assert sorted((int(r["n"]), r["name"], r["other"]) for r in back.collect()) == rows
        assert table.count() == 20_000
        # Two splits meet in one record of three lines at most.
        splits = sources.file_splits(sources.scan_lines(spark, [str(tmp_path / "q"), str(tmp_path / "l")])).count()
        assert splits > 6
        assert shuffled_rows(back) + shuffled_rows(table) <= 3 * splits
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes") if old is None else spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("most", [50_000, 0])
def test_records_over_batches_and_without_broadcast(spark, tmp_path, small_splits, monkeypatch, most):
    """Records longer than a batch and than a split; too many splits for a broadcast; text that is not UTF-8."""
    monkeypatch.setattr("catchframe.sources.lines.MOST_BROADCAST", most)
    made = [(i, CELLS[i % len(CELLS)] + "\nz" * (i % 90), "x") for i in range(300)]
    made[40] = (40, "long\n" * 900 + "cell", "x")
    put(tmp_path / "q" / "a.csv", csv_text(made))
    for k in range(12):
        put(tmp_path / "q" / f"calm{k}.csv", f"other,n\nplain,{1000 + k}\n")
    (tmp_path / "q" / "latin.csv").write_bytes('n,name\n2000,"\u00e9"\n2001,"\u00e9"",\n\u00e9"\n'.encode("latin-1"))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sources.scan_text_table(spark, str(tmp_path / "q")).collect()
        # Lines from elsewhere come in any order.
        mixed = sources.scan_lines(spark, str(tmp_path / "q"))
        mixed = mixed.repartition(3, F.rand(1)).sortWithinPartitions(F.desc("line"))
        again = sources.scan_text_table(spark, str(tmp_path / "q"), lines=mixed).collect()
        fleets = [f"fleet {i}\n" + "\n" * (i % 40) + '""quoted""' for i in range(300)]
        put(tmp_path / "l" / "r_2001.txt", 'a 12" mesh\nb\nFleets\tCatchCategory\tUndeterminedLngt10\n' + "".join(f'"{f}"\tLandings\t1\n' for f in fleets))
        table = sources.read_length_table(spark, str(tmp_path / "l")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = [*made, *[(1000 + k, "", "plain") for k in range(12)], (2000, "\ufffd", ""), (2001, '\ufffd",\n\ufffd', "")]
    for found in (got, again):
        assert sorted((int(r["n"]), r["name"] or "", r["other"] or "") for r in found) == sorted(want)
    assert sorted(r["fleet"] for r in table) == sorted(f.replace('""', '"') for f in fleets)


def test_quoted_cells_after_skipped_lines(spark, tmp_path, small_splits):
    """Fleets with separators, quotes and line breaks over many splits; a lone quote in a skipped line means nothing."""
    folder = tmp_path / "lengths"
    folder.mkdir()
    wanted = []
    for year in (2001, 2002, 2003):
        body = []
        for i in range(400):
            fleet = ("TBB", 'a "b"\tc', "line\nbreak\t", "\n\n" * 40 + "x", '"')[i % 5 if year > 2001 else 0] + str(i)
            cell = '"' + fleet.replace('"', '""') + '"' if set(fleet) & set('"\t\n') else fleet
            body.append(f"{cell}\tLandings\t{i}")
            wanted.append((year, fleet, "Landings", float(i)))
        top = ['a 12" mesh', "all"][:: 1 if year == 2002 else -1]
        (folder / f"r_{year}.txt").write_text("\n".join([*top, '"Fleets"\tCatchCategory\tUndeterminedLngt10', *body]) + "\n")
    (folder / "r_2004.txt").write_text("only\n")
    got = sources.read_length_table(spark, str(folder))
    assert got.rdd.getNumPartitions() > 3
    assert sorted(map(tuple, got.select("year", "fleet", "category", "UndeterminedLngt10").collect())) == sorted(wanted)
    (folder / "r_2005.txt").write_text('a\nb\nFleets\tCatchCategory\tUndeterminedLngt10\n"open\tLandings\t1\n')
    with pytest.raises(ValueError, match="not closed"):
        sources.read_length_table(spark, str(folder))
    (folder / "r_2005.txt").write_text('a\nb\n"Fle\nets"\tCatchCategory\tUndeterminedLngt10\n')
    with pytest.raises(Exception, match="several lines|not closed"):
        sources.read_length_table(spark, str(folder)).collect()


def test_csv_round_trip(spark, tmp_path, small_splits):
    df = spark.createDataFrame([(i, c or "none", float(i)) for i, c in enumerate(CELLS * 30)], "n int, name string, x double")
    for quote in (False, True):
        path = sources.write_csv(df, str(tmp_path / f"c{quote}"), quote=quote)
        assert sorted(map(tuple, sources.read_clean_table(spark, path, df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_broken_quoting_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="not closed"):
        sources.scan_text_table(spark, put(tmp_path / "a.csv", 'n,name\n1,"open\n2,b\n'))
    wide = sources.scan_text_table(spark, put(tmp_path / "b.csv", "n,name\n1,a,b\n2,c\n"))
    with pytest.raises(Exception, match="more cells"):
        wide.collect()
    assert sources.scan_text_table(spark, put(tmp_path / "c.csv", "n,name\n1,a,\n2\n")).count() == 2
    with pytest.raises(ValueError, match="several lines"):
        sources.scan_text_table(spark, put(tmp_path / "d.csv", 'n,"na\nme"\n1,a\n'))


def test_parts_in_report_order(spark, tmp_path):
    df = spark.createDataFrame([(i * 37 % 101, CELLS[i % len(CELLS)] or "none") for i in range(101)], "n int, name string")
    path = sources.write_parts(df, str(tmp_path / "r"), [F.col("n").desc()], rows=10, quote=True)
    back = sources.read_parts(spark, path, df.schema).orderBy("place").collect()
    assert [r["n"] for r in back] == list(range(100, -1, -1)) and [r["place"] for r in back] == list(range(101))
    assert {r["n"]: r["name"] for r in back} == {r["n"]: r["name"] for r in df.collect()}
    manifest = spark.read.parquet(f"{path}/_manifest").orderBy("part").collect()
    assert [(r["part"], r["rows"], r["first"]) for r in manifest] == [(i, 10 if i < 10 else 1, 10 * i) for i in range(11)]
    put(tmp_path / "r" / "part=3" / "more.csv", "n,name\n1,added\n")
    with pytest.raises(Exception, match="disagree on part 3"):
        sources.read_parts(spark, path, df.schema).collect()
