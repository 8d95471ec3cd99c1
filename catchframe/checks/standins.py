"""Operator inputs made from the driver tables.

Dimension joins are added only where a query needs their columns; their strategy
is left to Spark, which knows the table sizes.  Every row of a fact table takes
part in every query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catchframe import codes

# Country label by nation number; the last three labels are in no code list.
NATION_LABELS = (*codes.COUNTRY_NAMES, "Atlantis", "Lyonesse", "Ys")
# Short country code by nation number, for files that carry codes.
NATION_CODES = (
    "BE", "GG", "JE", "CI", "DK", "FR", "DE", "IE", "IM", "NL", "NO", "SE", "UK", "GB", "PL",
    "BE", "DK", "FR", "DE", "NL", "NO", "SE", "UK", "GB", "IE",
)
# Areas of the code lists, and some that are in none.
AREAS = (*sorted(codes.DETAILED_AREAS), "27.2.a")
DATASET_AREAS = (*codes.DATASET_AREAS, "27.2.a", "27.4.a")
PRELIMINARY_AREAS = (*codes.PRELIMINARY_AREAS, "27_2_A_2", "27_7_A")
DIVISIONS = (*[d for d in codes.DIVISIONS if "+" not in d], "II a2", "VII a")
# Columns of the wide stand-ins; a row of another year or length fails the query.
YEARS = tuple(range(1995, 2002))
LENGTHS = tuple(range(0, 60, 10))


# Schemas of the driver tables in use, so that reading one starts no job.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def choose(labels: Sequence[str], number: Column) -> Column:
    """Label by number, from a constant array."""
    return F.get(F.array(*[F.lit(x) for x in labels]), number.cast("int"))


def listed(column: str, values: Sequence[int]) -> Column:
    """A column whose values are all in a list; another or a missing one fails the job."""
    other = F.raise_error(F.concat(F.lit(f"{column} outside of the stand-ins: "), F.coalesce(F.col(column).cast("string"), F.lit("none"))))
    return F.when(F.col(column).isin(list(values)), F.col(column)).otherwise(other.cast("int"))


def line_items(spark: SparkSession, sf: str, dims: Sequence[str] = ()) -> DataFrame:
    """Line items with the derived numbers and, where wanted, nation number and fleet.

    Dates and keys become small numbers before the joins, so a shuffle join moves
    narrow rows.
    """
    year, area = F.year("l_shipdate"), F.col("l_suppkey") * 7 + F.col("l_linenumber")
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_partkey", "l_linenumber", "l_quantity",
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
        (F.col("l_partkey") % 3).alias("stock_no"), (F.col("l_partkey") % 5 % 3).alias("species_no"),
        area.alias("area_no"), year.alias("year"), F.quarter("l_shipdate").alias("season"),
    )
    if "nation" in dims:
        # The labels go by nation number, which the supplier has: no join to the nation table,
        # and Spark knows the size of the plain supplier scan.
        supplier = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
        lines = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    if "part" in dims:
        fleet = F.concat_ws("_", F.substring("p_type", 1, 3), F.substring("p_brand", 7, 2))
        part = table(spark, sf, "part").select("p_partkey", fleet.alias("fleet"))
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return lines


def _stock() -> Column:
    return F.concat(F.lit("S"), F.col("stock_no").cast("string"))


def _category() -> Column:
    flag, status = F.col("flag"), F.col("status")
    return (
        F.when(flag == "A", codes.DISCARDS)
        .when(flag == "N", codes.LANDINGS)
        .when(status == "F", codes.LOGBOOK)
        .otherwise(codes.BMS)
    )


def _caton() -> Column:
    """Quantity with missing weights, zero landings in one area and zero catch in another."""
    place, year, flag = F.col("area_no") % 10, F.col("year"), F.col("flag")
    return (
        F.when((F.col("l_suppkey") % 7 == 0) & (F.col("l_quantity") == 13), F.lit(None))
        .when((place == 8) & (year == 1996) & (flag == "N"), F.lit(0.0))
        .when((place == 7) & (year == 1997) & flag.isin("N", "A"), F.lit(0.0))
        .otherwise(F.col("l_quantity"))
    )


def catch_long(spark: SparkSession, sf: str, fields: Sequence[str]) -> DataFrame:
    """Detailed catches, one row per line item, with only the wanted fields."""
    dims = [dim for dim, field in (("nation", "country"), ("part", "fleet")) if field in fields]
    known = {
        "stock": _stock(),
        "area": choose(AREAS, F.col("area_no") % 10),
        "category": _category(),
        "origin": F.when(F.col("status") == "F", codes.IMPORTED).otherwise("Raised_Discards"),
        "caton": _caton(),
        "weight": F.col("l_quantity"),
        "length": (F.floor(F.col("l_quantity") / 10) * 10).cast("int"),
        "country": choose(NATION_LABELS, F.col("n_nationkey")) if "nation" in dims else None,
    }
    return line_items(spark, sf, dims).select(*[known[f].alias(f) if f in known else f for f in fields])


def preliminary(spark: SparkSession, sf: str) -> DataFrame:
    """Preliminary landings, one row per line item."""
    latin = (*codes.SPECIES_LATIN.values(), "Pleuronectes platessa")
    nation, quantity = F.col("n_nationkey"), F.col("l_quantity")
    return line_items(spark, sf, ["nation"]).select(
        _stock().alias("stock"),
        "year",
        choose(latin, F.col("species_no")).alias("species_latin"),
        choose(PRELIMINARY_AREAS, F.col("area_no") % 10).alias("area"),
        choose(NATION_CODES, nation).alias("country"),
        F.when(~((nation == 0) & (F.col("year") == 1999)) & (quantity != 13), quantity).alias("ams"),
        F.when((nation != 0) & (F.col("l_linenumber") % 3 != 0), F.col("l_linenumber").cast("double")).alias("bms"),
    )


def _wide(df: DataFrame, ids: Sequence[str], prefix: str, cell) -> DataFrame:
    """Text cells per year, from sums of the line quantities."""
    sums = df.withColumn("year", listed("year", YEARS)).groupBy(*ids).agg(
        *[F.sum(F.when(F.col("year") == y, F.col("weight"))).cast("long").alias(f"{prefix}{y}") for y in YEARS]
    )
    return sums.select(*ids, *[cell(F.col(f"{prefix}{y}")).alias(f"{prefix}{y}") for y in YEARS])


def historical_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Historical wide table with code tokens among the numbers."""
    lines = line_items(spark, sf, ["nation"]).select(
        choose(("Brill", "Turbot", "Plaice"), F.col("species_no")).alias("species"),
        choose(DIVISIONS, F.col("area_no") % 9).alias("division"),
        choose(NATION_LABELS, F.col("n_nationkey")).alias("country"),
        "year",
        F.col("l_quantity").alias("weight"),
    )

    def cell(c: Column) -> Column:
        r = c % 11
        text = c.cast("string")
        return (
            F.when(r == 0, "-").when(r == 1, ".").when(r == 2, "<0.5")
            .when(r == 3, F.concat(text, F.lit(" F"))).when(r == 4, "0").otherwise(text)
        )

    return _wide(lines, ["species", "division", "country"], "X", cell)


def dataset_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Catch data set, wide, with missing cells."""
    lines = line_items(spark, sf, ["nation"]).select(
        choose(("BLL", "TUR", "PLE"), F.col("species_no")).alias("species"),
        choose(DATASET_AREAS, F.col("area_no") % 6).alias("area"),
        F.lit("TLW").alias("units"),
        choose(NATION_CODES, F.col("n_nationkey")).alias("country"),
        "year",
        F.col("l_quantity").alias("weight"),
    )
    return _wide(
        lines, ["species", "area", "units", "country"], "",
        lambda c: F.when(c % 7 != 0, F.concat(c.cast("string"), F.lit(".5"))),
    )


def official(spark: SparkSession, sf: str) -> DataFrame:
    """Clean official landings with half values; one country lacks some years."""
    code = choose(NATION_CODES, F.col("n_nationkey"))
    rows = line_items(spark, sf, ["nation"]).select(
        _stock().alias("stock"),
        choose(("27.3.a", "27.4", "27.7.de"), F.col("area_no") % 3).alias("area"),
        # In every third year the rows of one country are another's, so that it has gaps.
        F.when((code == "IE") & (F.col("year") % 3 == 0), "DE").when(code != "PL", code).alias("country"),
        "year",
        F.when(F.col("l_quantity") != 13, F.col("l_quantity") / 2).alias("landings"),
    )
    return rows


def raising(spark: SparkSession, sf: str) -> DataFrame:
    """Strata for raising, one row per event; ``ord`` is unique."""
    e = table(spark, sf, "events")
    return e.select(
        F.concat(F.lit("S"), (F.col("user_id") % 3).cast("string")).alias("stock"),
        F.when(F.col("user_id") % 11 != 5, F.concat(F.lit("g"), (F.col("user_id") % 11).cast("string"))).alias("group"),
        F.when(F.col("event_type") == "error", "MIS").otherwise("TBB").alias("gear_group"),
        F.when(F.col("event_type") == "signup", codes.DISCARDS).otherwise(codes.LANDINGS).alias("category"),
        (F.col("event_id") % 3 + 1).cast("int").alias("count"),
        F.when((F.col("user_id") % 11 != 7) | (F.col("event_id") % 13 != 4), F.floor("value").cast("double")).alias("caton"),
        F.when(F.col("event_id") % 5 != 3, (F.col("event_id") % 64) / F.lit(64.0)).alias("perc"),
        F.col("event_id").alias("ord"),
    )


def _event_stock() -> Column:
    """Two stocks with a third of all events each, and one stock per user of the rest."""
    number = F.when(F.col("user_id") % 3 == 0, F.col("user_id") + 3).otherwise(F.col("user_id") % 3)
    return F.concat(F.lit("S"), number.cast("string"))


QUANTITIES = {
    "view": "logB", "click": "logF", "signup": "logBBmsy", "error": "logFFmsy", "purchase": "logCpred",
}


def series(spark: SparkSession, sf: str) -> DataFrame:
    """Model states on the log scale: four steps per 'year', one quantity per event type."""
    e = table(spark, sf, "events")
    quantity = F.lit(None).cast("string")
    for kind, name in QUANTITIES.items():
        quantity = F.when(F.col("event_type") == kind, F.lit(name)).otherwise(quantity)
    steps = e.groupBy(
        _event_stock().alias("stock"),
        quantity.alias("quantity"),
        (F.dayofmonth("ts") + F.floor(F.hour("ts") / 6) / F.lit(4.0)).cast("double").alias("time"),
    ).agg(F.avg(F.floor("value") + 1).alias("obs"), F.count("*").alias("n"))
    return steps.select(
        "stock", "quantity", "time", "obs",
        F.log("obs").alias("est"),
        (F.lit(1) + F.col("n") % 7).cast("double").alias("cv"),
        (F.lit(0.1) + F.lit(0.01) * (F.col("n") % 7)).cast("double").alias("sd"),
        (F.col("time") <= 28).alias("in_est"),
        F.lit(0.25).cast("double").alias("dt"),
    )


def retro_states(spark: SparkSession, sf: str, peels: int = 5) -> DataFrame:
    """Runs with ``run`` days removed; estimates off by a known factor."""
    runs = series(spark, sf).withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(peels))))
    kept = runs.filter(F.floor("time") <= 30 - F.col("run"))
    return kept.withColumn("nat", F.col("obs") * (1 + F.col("run") / F.lit(7.0)))


def indices(spark: SparkSession, sf: str) -> DataFrame:
    """Three survey series per stock, one value per day; one series has a missing value, others lack days."""
    e = table(spark, sf, "events")
    label = F.when(F.col("event_type").isin("view", "click"), "sem1").when(
        F.col("event_type").isin("signup", "error"), "sem2"
    ).otherwise("hist")
    days = e.groupBy(
        _event_stock().alias("stock"),
        label.alias("index"),
        F.dayofmonth("ts").cast("double").alias("time"),
    ).agg(F.avg(F.floor("value") + 1).alias("obs"), F.count("*").alias("n"))
    return days.select(
        "stock", "index", "time",
        F.when(~((F.col("stock") == "S2") & (F.col("index") == "hist") & (F.col("time") == 3)), F.col("obs")).alias("obs"),
        (F.lit(1) + F.col("n") % 7).cast("double").alias("cv"),
    )


def retro_indices(spark: SparkSession, sf: str, peels: int = 5) -> DataFrame:
    """Two semester series per stock and peel; peel i is i days shorter."""
    base = indices(spark, sf).filter(F.col("index") != "hist")
    runs = base.withColumn("peel", F.explode(F.sequence(F.lit(0), F.lit(peels))))
    return runs.filter(F.col("time") <= 30 - F.col("peel")).select(
        "stock", "peel", F.when(F.col("index") == "sem1", 1).otherwise(2).alias("semester"), "time",
        (F.col("obs") * (1 + F.col("peel") / F.lit(7.0))).alias("obs"), "cv",
    )


def daily_catch(spark: SparkSession, sf: str) -> DataFrame:
    """Catch series per stock and day, the 'years' of the model input."""
    e = table(spark, sf, "events")
    return e.groupBy(
        _event_stock().alias("stock"),
        F.dayofmonth("ts").alias("year"),
    ).agg(F.count("*").cast("double").alias("landings"))


def quota(spark: SparkSession, sf: str) -> DataFrame:
    """Agreed quota per year: two years moved away, one year without landings."""
    o = table(spark, sf, "orders")
    yearly = o.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").cast("double").alias("tac"))
    shifted = yearly.filter(F.col("year") == 1995).withColumn("year", F.lit(2030))
    gaps = F.when(F.col("year").isin(1997, 2000), F.col("year") - 100).otherwise(F.col("year"))
    return yearly.withColumn("year", gaps).unionByName(shifted)


def overview(spark: SparkSession, sf: str) -> DataFrame:
    """Stock overview: one row per stratum, category and origin."""
    by = ["stock", "country", "area", "season", "fleet", "category", "origin"]
    lines = catch_long(spark, sf, [*by, "caton"]).withColumn("fleet", F.substring("fleet", 1, 3))
    lines = lines.withColumn("area", F.substring("area", 1, 4))
    lines = lines.withColumn("country", F.when(F.col("country") != "Ys", F.col("country")))
    return lines.groupBy(*by).agg(F.sum("caton").alias("catch_wt"))


def sampled_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Sampled numbers: one row per stratum and length class; only imported catches match the overview."""
    by = ["stock", "country", "area", "season", "fleet", "category", "length"]
    lines = catch_long(spark, sf, [*by, "origin", "weight"])
    # Other rows belong to a fleet that the overview does not have.
    own = (F.col("origin") == codes.IMPORTED) & (F.col("length") >= 20)
    lines = lines.withColumns({
        "fleet": F.when(own, F.substring("fleet", 1, 3)).otherwise("none"),
        "area": F.substring("area", 1, 4),
        "country": F.when(F.col("country") != "Ys", F.col("country")),
        "category": F.substring("category", 1, 1),
    })
    sums = lines.groupBy(*by).agg(F.sum("weight").alias("w"))
    return sums.withColumn("sampled_catch", F.when(F.col("length") != 30, F.col("w"))).drop("w")


def length_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Length table: one row per year, fleet and category with a column per length."""
    by = ["year", "fleet", "category"]
    lines = catch_long(spark, sf, [*by, "length"])
    return lines.withColumn("length", listed("length", LENGTHS)).groupBy(*by).agg(
        *[
            F.sum(F.when(F.col("length") == n, 1.0)).alias(f"UndeterminedLngt{n}")
            for n in LENGTHS
        ]
    )
