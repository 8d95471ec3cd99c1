"""Input tables of the external assessment model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchframe.functions import interval_join, null_safe_join, runs_of
from catchframe.functions.intervals import FIRST, LAST
from catchframe.operators.indices import relative_cv

# The first catch year, the last year with the early weight, and
# the shift of second-semester indices inside the model input.
FIRST_YEAR = 1950
LAST_EARLY_YEAR = 1998
SEMESTER2_SHIFT = 0.66


def catch_weight(year: Column | str = "year", last_early: int = LAST_EARLY_YEAR) -> Column:
    """Catch weight: 2 up to ``last_early``, 1 after it."""
    year = F.col(year) if isinstance(year, str) else year
    return F.when(year <= last_early, F.lit(2)).when(year > last_early, F.lit(1))


def with_catch_weight(df: DataFrame, *, last_early: int = LAST_EARLY_YEAR) -> DataFrame:
    return df.withColumn("stdevfac", catch_weight(last_early=last_early))


def year_spine(df: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """One row per year from the first to the last year of each key."""
    ends = df.groupBy(*keys).agg(F.min("year").alias("__a"), F.max("year").alias("__b"))
    return ends.select(*keys, F.explode(F.sequence("__a", "__b")).alias("year"))


def management_interval(df: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """First and last year, number of years in the range, and the management interval."""
    first, last = F.min("year"), F.max("year")
    return df.groupBy(*keys).agg(
        first.alias("first_year"),
        last.alias("last_year"),
        (last - first + 1).alias("n_years"),
        (last + 2).alias("interval_start"),
        (last + 3).alias("interval_end"),
    )


def catch_input(catch: DataFrame, *, keys: Sequence[str] = (), last_early: int = LAST_EARLY_YEAR) -> DataFrame:
    """Catch observations of the model: time, observed landings, weight."""
    return catch.select(
        *keys,
        F.col("year").cast("double").alias("time"),
        F.col("landings").alias("obs"),
        catch_weight(last_early=last_early).alias("stdevfac"),
    )


def index_input(
    index: DataFrame,
    *,
    keys: Sequence[str] = (),
    shifted: Sequence[str] = ("sem2",),
    shift: float = SEMESTER2_SHIFT,
) -> DataFrame:
    """Index observations of the model: shifted time, observation, relative weight per series."""
    time = F.when(F.col("index").isin(list(shifted)), F.col("time") + shift).otherwise(F.col("time"))
    weighted = relative_cv(index, keys=[*keys, "index"])
    return weighted.select(*keys, "index", time.alias("time"), "obs", "stdevfac")


def retro_catch_input(
    catch: DataFrame,
    retro: DataFrame,
    *,
    keys: Sequence[str] = (),
    first_year: int = FIRST_YEAR,
    last_early: int = LAST_EARLY_YEAR,
) -> DataFrame:
    """Catch observations of each peel: early years and the years of its first-semester index.

    The kept years of a peel are a few ranges, found in one pass; catches are read once and joined to
    the ranges that hold their year.
    """
    base = retro.filter((F.col("semester") == 1) & (F.col("peel") > 0))
    whole = F.when(F.col("time") == F.floor("time"), F.col("time").cast("int"))
    late = F.when(~whole.between(first_year, last_early), whole)
    early = F.struct(F.lit(first_year).alias(FIRST), F.lit(last_early).alias(LAST))
    peels = base.groupBy(*keys, "peel").agg(runs_of(F.collect_set(late)).alias("__late"))
    ranges = peels.select(*keys, "peel", F.inline(F.concat(F.array(early), "__late")))
    rows = interval_join(catch.select(*keys, "year", "landings"), ranges, keys, "year")
    return rows.select(
        *keys,
        "peel",
        F.col("year").cast("double").alias("time"),
        F.col("landings").alias("obs"),
        catch_weight(last_early=last_early).alias("stdevfac"),
    )


def retro_index_input(
    retro: DataFrame,
    historical: DataFrame,
    *,
    keys: Sequence[str] = (),
    shift: float = SEMESTER2_SHIFT,
) -> DataFrame:
    """Index observations of each peel: its own two semesters and the historical series.

    The historical series has the same weights in every peel: they are taken once, before the series meets the peels.
    """
    peeled = retro.filter(F.col("peel") > 0)
    own = peeled.select(
        *keys,
        "peel",
        F.concat(F.lit("sem"), F.col("semester").cast("string")).alias("index"),
        (F.col("time") + F.when(F.col("semester") == 2, shift).otherwise(0.0)).alias("time"),
        "obs",
        "cv",
    )
    peels = peeled.select(*keys, "peel").distinct()
    fixed = relative_cv(historical.select(*keys, F.lit("hist").alias("index"), "time", "obs", "cv"), keys=[*keys, "index"])
    if keys:
        fixed = null_safe_join(fixed, peels, keys, "inner")
    else:
        bounds = peels.agg(F.array_sort(F.collect_set("peel")).alias("__peels"))
        fixed = fixed.crossJoin(F.broadcast(bounds)).withColumn("peel", F.explode("__peels")).drop("__peels")
    columns = [*keys, "peel", "index", "time", "obs", "stdevfac"]
    return relative_cv(own, keys=[*keys, "peel", "index"]).select(*columns).unionByName(fixed.select(*columns))
