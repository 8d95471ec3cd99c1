"""Queries whose input is first written as files of the shapes that the readers expect.

The files are made by Spark from the driver tables in a new shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchframe import codes, sources
from catchframe.checks import standins as data
from catchframe.functions import na_sum
from catchframe.operators import composition, indices, landings, lengths, overview, tables
from catchframe.plans.index import IndexFiles, index_tables
from catchframe.plans.refresh import refresh_preliminary
from catchframe.session import shared_dir
from catchframe.sources import schemas
from catchframe.sources.sectioned import REPORT_NAMES, WIDTH


def _write_csv(df: DataFrame, path: str, **options: str) -> str:
    df.write.options(header="true", **options).csv(path)
    return path


def _write_reports(rows: DataFrame, files: DataFrame, path: str, head: list[str]) -> str:
    """One text file ``<column>=<value>/part-*`` per row of ``files``: the head lines, then its rows.

    ``rows`` are aggregated strata, so a file is bounded by the code lists.
    """
    by = files.columns
    top = files.select(*by, F.posexplode(F.array(*[F.lit(h) for h in head])).alias("__place", "value"))
    body = rows.select(*by, F.lit(len(head)).alias("__place"), "value")
    (
        top.unionByName(body)
        .repartition(32, *by)
        .sortWithinPartitions(*by, "__place")
        .drop("__place")
        .write.partitionBy(*by)
        .text(path)
    )
    return path


def _with(fields: list[T.StructField], *text: str) -> T.StructType:
    return T.StructType([*fields, *[T.StructField(name, schemas.TEXT) for name in text]])


def csv_na_token(spark, sf):
    """Catch data set through CSV with its own missing-value token."""
    path = _write_csv(data.dataset_wide(spark, sf), shared_dir(spark), nullValue=codes.NA_TOKEN)
    return landings.dataset_landings(sources.read_dataset(spark, path))


def historical_csv_scan(spark, sf):
    """Historical wide file through CSV with plain year headers, which become ``X<year>``."""
    wide = data.historical_wide(spark, sf)
    names = {"species": "Species", "division": "Division", "country": "Country"}
    plain = wide.toDF(*[names.get(c, c.removeprefix("X")) for c in wide.columns])
    path = _write_csv(plain, shared_dir(spark))
    return landings.historical_landings(sources.read_historical(spark, path), first_year=1996, before_year=2001)


def mixed_header_scan(spark, sf):
    """Historical files of which some have their columns in another order and lack a year."""
    wide = data.historical_wide(spark, sf)
    names = {"species": "Species", "division": "Division", "country": "Country"}
    plain = wide.toDF(*[names.get(c, c.removeprefix("X")) for c in wide.columns])
    folder, odd = shared_dir(spark), F.coalesce(F.crc32("Country") % 2 == 1, F.lit(False))
    _write_csv(plain.filter(~odd), f"{folder}/a")
    _write_csv(plain.filter(odd).select(*reversed(plain.columns)).drop("1995"), f"{folder}/b")
    return landings.historical_landings(sources.read_historical(spark, folder), first_year=1996, before_year=2001)


def detailed_tsv_scan(spark, sf):
    """Sums by origin of detailed catches from tab-separated files."""
    fields = ["stock", "year", "season", "area", "origin", "caton"]
    path = _write_csv(data.catch_long(spark, sf, fields), shared_dir(spark), sep="\t", nullValue="NA")
    schema = _with([f for f in schemas.DETAILED_CATCHES.fields if f.name in fields], "stock")
    back = sources.read_clean_table(spark, path, schema, sep="\t")
    return composition.origin_sums(back, keys=("stock", "year", "season", "area"))


def schema_drift(spark, sf):
    """Preliminary landings from year files, every second one with the other column names."""
    rows = data.preliminary(spark, sf).drop("stock").withColumn("y", F.col("year"))
    first = ["Year", "Species Latin Name", "Area", "Country", "AMS Catch(TLW)", "BMS Catch(TLW)", "y"]
    second = ["Year", "Species.Latin.Name", "Area", "Country", "AMS_Catch", "BMS_Catch", "y"]
    folder = shared_dir(spark)
    for name, header, odd in (("a", first, 1), ("b", second, 0)):
        part = rows.filter(F.col("year") % 2 == odd).toDF(*header)
        part.write.partitionBy("y").options(header="true").csv(f"{folder}/{name}")
    return landings.preliminary_landings(sources.read_preliminary(spark, [f"{folder}/a", f"{folder}/b"]))


def skip_lines_scan(spark, sf):
    """Length tables with two lines before the header, one file per year."""
    wide = data.length_wide(spark, sf)
    columns = [c for c in wide.columns if c != "year"]
    header = "\t".join({"fleet": "Fleets", "category": "CatchCategory"}.get(c, c) for c in columns)
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in columns]
    rows = wide.select("year", F.concat_ws("\t", *cells).alias("value"))
    years = data.catch_long(spark, sf, ["year"]).distinct()
    path = _write_reports(rows, years, shared_dir(spark), ["Length report", "all fleets", header])
    table = sources.read_length_table(spark, path, year_pattern=r"year=(\d{4})")
    return lengths.length_frequency(table, keys=("year",), by_category=True, by_gear=True)


def sectioned_report_scan(spark, sf):
    """Coverage of landings by discards from sectioned reports; some rows run over two lines."""
    by = ["stock", "year", "country", "area", "season", "fleet", "category", "origin"]
    lines = data.catch_long(spark, sf, [*by, "weight", "length"]).withColumn("fleet", F.substring("fleet", 1, 3))
    lines, length = lines.withColumn("length", data.listed("length", data.LENGTHS)), F.col("length")
    strata = lines.groupBy(*by).agg(
        F.sum("weight").alias("caton"), *[F.count(F.when(length == n, 1)).alias(f"n{n}") for n in data.LENGTHS]
    )
    classes = F.array(*[F.struct(F.lit(n).alias("length"), F.col(f"n{n}").alias("n")) for n in data.LENGTHS])
    rows = strata.withColumn("class", F.explode(F.filter(classes, lambda c: c["n"] > 0)))
    cells = {
        "Area": F.when(F.col("area") == "27.3.a", F.rpad("area", 30, " ")).otherwise(F.col("area")),
        "CANUM": F.col("class.n").cast("string"),
        "AgeOrLength": F.col("class.length").cast("string"),
        "WECA": F.lit("NA"),
        "Sex": F.lit(""),
        "LECA": F.lit(""),
    }
    names = [*REPORT_NAMES, *[f"Extra{i}" for i in range(len(REPORT_NAMES), WIDTH)]]
    tokens = [
        cells[n] if n in cells else F.col(REPORT_NAMES[n]).cast("string") if n in REPORT_NAMES else F.lit("x")
        for n in names
    ]
    half = F.when(F.col("class.length") == 30, "\n").otherwise("\t")
    text = F.concat(F.concat_ws("\t", *tokens[:13]), half, F.concat_ws("\t", *tokens[13:]))
    head = ["Catch and sample report", "TABLE 1.", "a\tb\t", "", "TABLE 2.", "title\tunit",
            "\t".join(names) + "\t", "\t".join("-" for _ in names) + "\t"]
    files = data.catch_long(spark, sf, ["year", "stock"]).distinct()
    path = _write_reports(rows.select("year", "stock", text.alias("value")), files, shared_dir(spark), head)
    report = sources.read_catch_report(spark, path)
    report = report.withColumn("year", F.regexp_extract("file", r"year=(\d{4})", 1).cast("int")).drop("file")
    return composition.landings_with_discards(report, keys=("stock", "year"))


def tsv_overview_scan(spark, sf):
    """Overview and sampled numbers through tab-separated files with columns known by position."""
    folder = shared_dir(spark)
    wide = data.overview(spark, sf)
    filler = [F.lit("x").alias(f"Extra{i}") for i in range(5)]
    over = wide.select(
        F.col("stock").alias("Stock"), F.col("country").alias("Country"), F.col("area").alias("Area"),
        F.col("season").alias("Season"), filler[0], filler[1], F.col("fleet").alias("Fleets"), filler[2], filler[3],
        F.col("catch_wt").alias("Caton"), F.col("category").alias("Category"), filler[4],
        F.lit("last").alias("Dropped"),
    )
    numbers = data.sampled_numbers(spark, sf).select(
        F.lit("x").alias("A"), F.lit("x").alias("B"), F.col("area").alias("Area"), F.col("season").alias("Season"),
        F.col("country").alias("Country"), F.lit("x").alias("C"), F.col("category").alias("Cat"),
        F.lit("x").alias("D"), F.col("fleet").alias("Fl"), F.col("stock").alias("stock"),
        F.col("sampled_catch").alias("SampledCatch"),
    )
    _write_csv(over, f"{folder}/overview", sep="\t", nullValue="NA")
    _write_csv(numbers, f"{folder}/numbers", sep="\t", nullValue="NA")
    joined = overview.overview_weights(
        sources.read_overview(spark, f"{folder}/overview"),
        sources.read_sampled_numbers(spark, f"{folder}/numbers"),
        keys=("stock",),
    )
    return overview.stratum_summary(joined, ["fleet", "area", "sampled"], "LandWt", keys=("stock",))


def clean_table_scan(spark, sf):
    """Index tables with a leading row-number column, normalised after the scan."""
    rows = data.indices(spark, sf).select(
        F.monotonically_increasing_id().alias("rn"), "stock", "index",
        F.col("time").alias("timeI"), F.col("obs").alias("ObsI"), F.col("cv").alias("CV"),
    )
    path = _write_csv(rows, shared_dir(spark), nullValue="NA")
    schema = _with(schemas.INDEX.fields, "stock", "index")
    table = sources.read_clean_table(
        spark, path, schema, rename={"timeI": "time", "ObsI": "obs", "CV": "cv"}, drop_first=True
    )
    return indices.normalised_index(table, keys=("stock", "index"))


def index_files(spark, sf):
    """The run over the three survey files, two of them with row numbers, to the labelled series with their band."""
    names, folder = {"time": "timeI", "obs": "ObsI", "cv": "CV"}, shared_dir(spark)
    paths = {}
    for name in ("sem1", "sem2", "hist"):
        rows = data.indices(spark, sf).filter(F.col("index") == name).drop("index").withColumnsRenamed(names)
        if name != "hist":
            rows = rows.select(F.monotonically_increasing_id().alias(" "), *rows.columns)
        paths[name] = _write_csv(rows, f"{folder}/{name}", nullValue="NA")
    files = IndexFiles(paths["sem1"], paths["sem2"], paths["hist"])
    return index_tables(spark, files, keys=("stock",))["index_band"]


def quoted_csv_sink(spark, sf):
    """Detailed catches through the quoted CSV sink and back."""
    fields = ["stock", "year", "area", "season", "country", "category", "origin", "caton"]
    path = sources.write_csv(data.catch_long(spark, sf, fields), f"{shared_dir(spark)}/detailed", quote=True)
    schema = _with([f for f in schemas.DETAILED_CATCHES.fields if f.name in fields], "stock")
    back = sources.read_clean_table(spark, path, schema)
    return composition.catch_category_with_total(back, keys=("stock", "year"))


def table_sink(spark, sf):
    """Detailed catches through the partitioned Parquet sink, read back with partition pruning."""
    fields = ["stock", "year", "season", "area", "category", "caton"]
    catch = data.catch_long(spark, sf, fields)
    path = sources.write_table(catch, f"{shared_dir(spark)}/detailed", partition_by=["year"])
    back = spark.read.parquet(path).filter(F.col("year") > 1997)
    return composition.season_share(back, keys=("stock", "year", "area"))


def quoted_cells_scan(spark, sf):
    """Names with doubled quotes, separators and line breaks through CSV files and back."""
    rows = data.catch_long(spark, sf, ["stock", "year", "country", "area", "caton"])
    name = F.concat(F.lit('"'), F.col("country"), F.lit('", "'), F.col("area"), F.lit('"\n'), F.col("stock"), F.lit(",\n\nend"))
    path = sources.write_csv(rows.select("year", name.alias("name"), "caton"), shared_dir(spark))
    schema = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("name", schemas.TEXT), T.StructField("caton", schemas.DOUBLE)])
    back = sources.read_clean_table(spark, path, schema)
    return back.groupBy("name", "year").agg(F.count(F.lit(1)).alias("n"), na_sum("caton").alias("caton"))


def report_parts(spark, sf):
    """Landings in report order through numbered parts, read back with their places."""
    summary = tables.landings_summary(data.official(spark, sf), keys=("stock",))
    order = [F.col("area"), F.col("country").asc_nulls_last(), F.col("year").desc(), F.col("stock")]
    path = sources.write_parts(summary, shared_dir(spark), order, rows=100, quote=True)
    fields = [T.StructField("stock", schemas.TEXT), T.StructField("year", T.IntegerType()), T.StructField("country", schemas.TEXT),
              T.StructField("area", schemas.TEXT), T.StructField("landings", schemas.DOUBLE)]
    return sources.read_parts(spark, path, T.StructType(fields))


def yearly_refresh(spark, sf):
    """Preliminary landings in two runs: the second one reads the new files and rewrites their years only."""
    rows = data.preliminary(spark, sf).drop("stock").withColumn("y", F.col("year"))
    header = ["Year", "Species Latin Name", "Area", "Country", "AMS Catch(TLW)", "BMS Catch(TLW)", "y"]
    folder = shared_dir(spark)
    for old in (True, False):
        part = rows.filter((F.col("year") < 1999) == old).toDF(*header)
        part.write.mode("append").partitionBy("y").options(header="true").csv(f"{folder}/in")
        refresh_preliminary(spark, f"{folder}/in", f"{folder}/out", f"{folder}/log")
    return landings.preliminary_landings(spark.read.parquet(f"{folder}/out"))


FILE_QUERIES = (
    csv_na_token, historical_csv_scan, mixed_header_scan, detailed_tsv_scan, schema_drift, skip_lines_scan, sectioned_report_scan,
    tsv_overview_scan, clean_table_scan, index_files, quoted_csv_sink, table_sink, quoted_cells_scan, report_parts, yearly_refresh,
)
