"""One query per operator over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchframe import codes, plans
from catchframe.checks import file_queries
from catchframe.checks import standins as data
from catchframe.functions import split_to_numbers
from catchframe.operators import composition, indices, landings, lengths, modelio, overview, profile, quota, states, tables
from catchframe.operators.recode import code_order, recode

Query = Callable[[SparkSession, str], DataFrame]
STOCK = ("stock",)
STOCK_YEAR = ("stock", "year")
QUERIES: dict[str, Query] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, so that two engines can be compared."""
    return df.select(*[
        (F.round(F.col(f"`{f.name}`"), digits) + 0.0).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf: rounded(fn(spark, sf))
    return fn


# Ingest and harmonise


@query
def landings_two_measure_sum(spark, sf):
    return landings.preliminary_landings(data.preliminary(spark, sf), keys=STOCK)


@query
def bms_by_area(spark, sf):
    return landings.bms_landings(data.preliminary(spark, sf), keys=STOCK)


@query
def hist_landings_unpivot(spark, sf):
    return landings.historical_landings(data.historical_wide(spark, sf), first_year=1996, before_year=2001)


@query
def official_landings_recode(spark, sf):
    return landings.dataset_landings(data.dataset_wide(spark, sf))


@query
def official_union(spark, sf):
    return landings.combined_landings(
        landings.dataset_landings(data.dataset_wide(spark, sf)),
        landings.historical_landings(data.historical_wide(spark, sf), first_year=1996, before_year=2001),
        landings.preliminary_landings(data.preliminary(spark, sf)),
    )


@query
def code_harmonise(spark, sf):
    catch = data.catch_long(spark, sf, ["country", "area", "season", "caton"])
    coded = catch.select(
        recode("country", codes.COUNTRY_NAMES).alias("country"),
        recode("country", codes.REPORT_COUNTRIES).alias("report_country"),
        recode(recode("country", codes.COUNTRY_NAMES), codes.ISLANDS_TO_UK).alias("country_ol"),
        recode("area", codes.AREA_GROUPS).alias("area"),
        recode(data.choose(tuple(codes.GEAR_GROUPS), F.col("season") * 3 - 1), codes.GEAR_GROUPS).alias("gear_group"),
        "caton",
    ).withColumn("country_rank", code_order("country", codes.COUNTRY_NAMES))
    by = ["country", "country_rank", "report_country", "country_ol", "area", "gear_group"]
    return coded.groupBy(*by).agg(F.count("*").alias("n_rows"), F.sum("caton").alias("caton_sum"))


# Catch composition

DETAIL = ["stock", "year", "area", "country", "category", "caton"]


@query
def catch_category_table(spark, sf):
    return composition.catch_category_with_total(data.catch_long(spark, sf, DETAIL), keys=STOCK_YEAR)


@query
def catches_detail(spark, sf):
    return composition.detailed_catches(data.catch_long(spark, sf, DETAIL), keys=STOCK_YEAR)


@query
def discard_measures_long(spark, sf):
    return composition.discard_measures(data.catch_long(spark, sf, DETAIL), keys=STOCK_YEAR)


@query
def gear_share(spark, sf):
    return composition.gear_share(data.catch_long(spark, sf, ["stock", "year", "season", "fleet", "caton"]), keys=("stock", "year", "season"))


@query
def gear_fine_share(spark, sf):
    return composition.gear_fine_share(data.catch_long(spark, sf, ["stock", "year", "season", "fleet", "caton"]), keys=("stock", "year", "season"))


@query
def season_share(spark, sf):
    return composition.season_share(data.catch_long(spark, sf, ["stock", "year", "area", "season", "caton"]), keys=("stock", "year", "area"))


@query
def country_area_share(spark, sf):
    return composition.country_area_share(data.catch_long(spark, sf, DETAIL), keys=STOCK_YEAR)


@query
def discard_ratio_gear(spark, sf):
    catch = data.catch_long(spark, sf, ["stock", "year", "area", "fleet", "category", "caton"])
    return composition.discard_percent_by_gear(catch, keys=STOCK_YEAR)


@query
def origin_sums(spark, sf):
    return composition.origin_sums(data.catch_long(spark, sf, ["stock", "year", "season", "area", "origin", "caton"]), keys=("stock", "year", "season", "area"))


@query
def raise_percent(spark, sf):
    return composition.raise_percent(data.raising(spark, sf), keys=STOCK)


@query
def raise_lists(spark, sf):
    return composition.raise_lists(data.raising(spark, sf), keys=STOCK)


@query
def landings_with_discards(spark, sf):
    by = ["stock", "year", "country", "area", "season", "fleet", "category", "origin"]
    catch = data.catch_long(spark, sf, [*by, "weight", "caton", "length"])
    # Only one year has missing weights, so that the other years are known.
    weight = F.when(F.col("year") == 1999, F.col("caton")).otherwise(F.col("weight"))
    lines = catch.withColumn("caton", weight).drop("weight").withColumnRenamed("length", "age_or_length")
    return composition.landings_with_discards(lines, keys=STOCK_YEAR)


@query
def unique_codes(spark, sf):
    catch = data.catch_long(spark, sf, ["stock", "year", "area", "country"])
    coded = catch.withColumn("country", recode("country", codes.COUNTRY_NAMES))
    coded = coded.withColumn("country", F.when(F.col("area") != "27.2.a", F.col("country")))
    return composition.unique_codes(coded, "country", keys=("stock", "year", "area"))


@query
def text_numbers(spark, sf):
    docs = data.table(spark, sf, "documents").select("doc_id", split_to_numbers("text").alias("numbers"))
    known = F.col("known")
    return docs.withColumn("known", F.array_compact("numbers")).select(
        "doc_id",
        F.size("numbers").cast("long").alias("n_tokens"),
        F.size(known).cast("long").alias("n_numbers"),
        F.array_max(known).alias("largest"),
        F.array_min(known).alias("smallest"),
    )


# Sampling coverage


def _joined(spark, sf):
    return overview.overview_weights(data.overview(spark, sf), data.sampled_numbers(spark, sf), keys=STOCK)


@query
def overview_join(spark, sf):
    joined = overview.overview_join(
        data.overview(spark, sf), data.sampled_numbers(spark, sf), keys=STOCK, columns=("length", "sampled_catch")
    )
    return joined.select("stock", *overview.MATCH, "origin", "catch_wt", "length", "sampled_catch", "sampled")


@query
def overview_exclusions(spark, sf):
    return overview.overview_exclusions(data.overview(spark, sf), keys=STOCK)


@query
def stratum_weights(spark, sf):
    return overview.stratum_summary(_joined(spark, sf), ["fleet", "country", "sampled"], "LandWt", keys=STOCK)


@query
def stratum_discard_weights(spark, sf):
    return overview.stratum_summary(_joined(spark, sf), ["fleet", "season", "sampled"], "DisWt", keys=STOCK, ymax=900)


@query
def stratum_percent_cumulative(spark, sf):
    dims = ["fleet", "country", "season", "area", "sampled"]
    return overview.stratum_summary(_joined(spark, sf), dims, "LandPercent", keys=STOCK, ymax=10)


@query
def stratum_percent_overall(spark, sf):
    return overview.stratum_summary(
        _joined(spark, sf), ["country", "season"], "LandPercent", keys=STOCK, individual_totals=False
    )


@query
def stratum_discard_ratio(spark, sf):
    return overview.stratum_summary(_joined(spark, sf), ["fleet", "country", "area", "sampled"], "DisRatio", keys=STOCK)


@query
def sampled_discard_ratio(spark, sf):
    """Both sampled flags only: all pairs of them per stock."""
    return overview.stratum_summary(_joined(spark, sf), ["sampled"], "DisRatio", keys=STOCK)


@query
def stratum_discards_provided(spark, sf):
    dims = ["fleet", "country", "season", "area", "sampled"]
    return overview.stratum_summary(_joined(spark, sf), dims, "DiscProvided", keys=STOCK)


# Length frequencies


@query
def length_freq(spark, sf):
    return lengths.length_frequency(data.length_wide(spark, sf), keys=("year",))


@query
def length_freq_cat(spark, sf):
    return lengths.length_frequency(data.length_wide(spark, sf), keys=("year",), by_category=True)


@query
def length_freq_cat_gear(spark, sf):
    return lengths.length_frequency(data.length_wide(spark, sf), keys=("year",), by_category=True, by_gear=True)


@query
def column_profile(spark, sf):
    lines = data.table(spark, sf, "lineitem").withColumn(
        "l_discount", F.when(F.col("l_discount") != 0.05, F.col("l_discount"))
    )
    return profile.column_profile(lines, ["l_quantity", "l_extendedprice", "l_discount"])


# Catch series and quota uptake


@query
def catch_series_splice(spark, sf):
    detail = composition.detailed_catches(data.catch_long(spark, sf, DETAIL), keys=STOCK_YEAR)
    return landings.spliced_catch_series(data.official(spark, sf), detail, keys=STOCK, splice_year=1998)


def _two_species(spark, sf):
    return quota.stacked_species(
        quota.two_species_historical(data.historical_wide(spark, sf), first_year=1995, last_year=1996),
        quota.two_species_dataset(data.dataset_wide(spark, sf)).filter(F.col("year").between(1997, 1999)),
        quota.two_species_preliminary(data.preliminary(spark, sf)).filter(F.col("year") >= 2000),
    )


@query
def two_species_wide(spark, sf):
    return _two_species(spark, sf)


@query
def quota_uptake(spark, sf):
    return quota.quota_uptake(_two_species(spark, sf), data.quota(spark, sf))


@query
def quota_uptake_all(spark, sf):
    return quota.quota_uptake(
        # Only one year has missing weights, so that the other years are known.
        quota.yearly_preliminary(data.preliminary(spark, sf).withColumn(
            "ams", F.when(F.col("ams").isNull() & (F.col("year") != 1996), 0.0).otherwise(F.col("ams"))
        )),
        data.quota(spark, sf),
    )


# Report tables


def _summary(spark, sf):
    return tables.landings_summary(data.official(spark, sf), keys=STOCK)


@query
def landings_summary(spark, sf):
    return _summary(spark, sf)


@query
def table_poison(spark, sf):
    return tables.table_poison(_summary(spark, sf), keys=STOCK)


@query
def table_poison_safe(spark, sf):
    return tables.table_poison(_summary(spark, sf), keys=STOCK, null_mode="safe")


@query
def table_total_first(spark, sf):
    return tables.table_total_first(_summary(spark, sf), keys=STOCK)


@query
def table_explicit_total(spark, sf):
    return tables.table_explicit_total(_summary(spark, sf), keys=STOCK)


@query
def area_share_year(spark, sf):
    return tables.area_share(_summary(spark, sf), keys=STOCK)


@query
def country_share_year(spark, sf):
    return tables.country_share(_summary(spark, sf), keys=STOCK)


@query
def assessment_summary(spark, sf):
    catch = data.daily_catch(spark, sf).withColumn("discards", F.lit(0.0))
    return plans.summary_table(data.series(spark, sf), catch)


# Indices and model input


@query
def index_normalised(spark, sf):
    return indices.normalised_index(data.indices(spark, sf), keys=("stock", "index"))


def _combined(spark, sf):
    return indices.labelled_index(data.indices(spark, sf), indices.SERIES_LABELS, keys=STOCK)


@query
def index_combined(spark, sf):
    return _combined(spark, sf)


@query
def index_band(spark, sf):
    return indices.deviation_band(_combined(spark, sf), keys=STOCK)


@query
def index_cv_weight(spark, sf):
    return indices.relative_cv(data.indices(spark, sf), keys=("stock", "index"))


@query
def catch_weight_step(spark, sf):
    catch = landings.spliced_catch_series(
        data.official(spark, sf),
        composition.detailed_catches(data.catch_long(spark, sf, DETAIL), keys=STOCK_YEAR),
        keys=STOCK, splice_year=1998,
    )
    return modelio.with_catch_weight(catch.select("stock", "year", "landings"))


@query
def year_spine(spark, sf):
    # The rows of 1998 count for 1999: the spine fills the gap.
    year = F.when(F.col("year") == 1998, 1999).otherwise(F.col("year"))
    rows = data.official(spark, sf).select("stock", "area", year.alias("year"))
    return modelio.year_spine(rows, keys=("stock", "area"))


@query
def management_interval(spark, sf):
    return modelio.management_interval(data.official(spark, sf), keys=("stock", "country"))


@query
def model_catch_input(spark, sf):
    return modelio.catch_input(data.daily_catch(spark, sf), keys=STOCK, last_early=10)


@query
def model_index_input(spark, sf):
    return modelio.index_input(data.indices(spark, sf), keys=STOCK)


@query
def retro_catch_input(spark, sf):
    return modelio.retro_catch_input(
        data.daily_catch(spark, sf), data.retro_indices(spark, sf).withColumn("time", F.greatest("time", F.lit(12.0))),
        keys=STOCK, first_year=1, last_early=10,
    )


@query
def retro_index_input(spark, sf):
    hist = data.indices(spark, sf).filter(F.col("index") == "hist")
    return modelio.retro_index_input(data.retro_indices(spark, sf), hist, keys=STOCK)


@query
def retro_aligned(spark, sf):
    return indices.retro_aligned(data.retro_indices(spark, sf), 2, 5, keys=STOCK)


# Model output


@query
def mohn_rho(spark, sf):
    rows = data.retro_states(spark, sf).drop("est").withColumnRenamed("nat", "est")
    return states.mohns_rho(rows, digits=None)


def _runs(spark, sf):
    return data.retro_states(spark, sf).groupBy("stock", "run").agg(
        F.when((F.col("run") == 2) | ((F.col("run") == 4) & (F.col("stock") == "S1")), 1)
        .when((F.col("run") == 5) & (F.col("stock") == "S2"), F.lit(None)).otherwise(0).alias("convergence")
    )


@query
def converged_runs(spark, sf):
    rows = states.converged_runs(data.retro_states(spark, sf), _runs(spark, sf))
    return rows.select("stock", "run", "label", "quantity", "time", "nat")


@query
def excluded_runs(spark, sf):
    return states.excluded_runs(_runs(spark, sf))


@query
def state_ci(spark, sf):
    rows = states.state_interval(data.series(spark, sf), quantities=["logB", "logBBmsy", "logF", "logFFmsy"])
    return rows.select("stock", "quantity", "time", "lower", "estimate", "upper")


@query
def fractile_series(spark, sf):
    return states.fractile_series(data.series(spark, sf))


@query
def fractile_series_modes(spark, sf):
    """First, mean and sum of the sub-steps of complete years."""
    series = data.series(spark, sf)
    parts = [
        states.fractile_series(series, ("logBBmsy",), (0.35,), when, complete_only=True, steps=4).withColumn("mode", F.lit(when))
        for when in ("first", "mean", "sum")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def fractile_table(spark, sf):
    """Fractiles from a table: nineteen of them, dealt to two quantities."""
    wanted = data.table(spark, sf, "part").select(
        F.when(F.col("p_size") % 2 == 0, "logBBmsy").otherwise("logFFmsy").alias("quantity"),
        ((F.col("p_size") % 19 + 1) / F.lit(20.0)).alias("fractile"),
    ).distinct()
    return states.fractiles_by_table(data.series(spark, sf), wanted)


@query
def status_at(spark, sf):
    return states.status_at(data.series(spark, sf), 20.25)


def _scenarios(spark, sf):
    rows = data.series(spark, sf).withColumn("scenario", F.explode(F.array(F.lit("base"), F.lit("half"))))
    est = F.col("est") - F.when(F.col("scenario") == "half", 0.7).otherwise(0.1)
    catch = data.daily_catch(spark, sf)
    constants = catch.groupBy("stock").agg(
        F.lit(12.5).alias("mean_discard_pct"), F.lit(40.0).alias("biomass_ref"),
        F.max("landings").alias("last_tac"), F.min("landings").alias("last_advice"),
    )
    until_20 = catch.withColumn("year", F.least("year", F.lit(20)))
    return plans.scenario_tables(rows.withColumn("est", est), until_20, constants)


@query
def scenario_inputs(spark, sf):
    return _scenarios(spark, sf)["scenario_inputs"]


@query
def advice_line(spark, sf):
    return _scenarios(spark, sf)["advice"]


@query
def annual_stock(spark, sf):
    discards = data.daily_catch(spark, sf).select("stock", "year", (F.col("landings") / 4).alias("discards"))
    # Year 7 has none: they count for a year without states.
    moved = discards.withColumn("year", F.when(F.col("year") == 7, 107).otherwise(F.col("year")))
    return states.annual_stock(data.series(spark, sf), moved)


@query
def production_params(spark, sf):
    params = data.table(spark, sf, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("stock"),
        F.col("p_retailprice").alias("m"),
        ((F.col("p_size") % 7 + 3) / F.lit(2.0)).alias("n"),
        (F.col("p_retailprice") * F.col("p_size")).alias("K"),
        F.lit(0.5).alias("Fmsy"), F.col("p_retailprice").alias("Bmsy"), F.col("p_size").cast("double").alias("MSY"),
    )
    return states.production_params(params)


@query
def sig_round(spark, sf):
    prices = data.table(spark, sf, "orders").select(
        "o_orderkey",
        (F.col("o_totalprice") * F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(-1)).alias("price"),
        (F.col("o_totalprice") / 100000000).alias("small"),
    )
    return states.rounded_columns(prices, {"price": "price_advice", "small": "small_advice"}).drop("small")


for _fn in file_queries.FILE_QUERIES:
    query(_fn)
