"""Two-species yearly landings and quota uptake."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchframe import codes
from catchframe.functions import conditional_pivot, na_sum, not_in, null_safe_join, poison_sum, ratio, to_double
from catchframe.operators.landings import unpivot_years


def two_species_historical(
    wide: DataFrame,
    *,
    keys: Sequence[str] = (),
    species: Mapping[str, str] = codes.SPECIES_RAW,
    divisions: Sequence[str] = codes.QUOTA_DIVISIONS,
    first_year: int = 2000,
    last_year: int = 2005,
) -> DataFrame:
    """Yearly landings of two species side by side, from the historical wide file."""
    chosen = wide.filter(F.col("species").isin(list(species.values())) & F.col("division").isin(list(divisions)))
    long = unpivot_years(chosen, [*keys, "species"], first_year, last_year)
    return _side_by_side(long.filter(not_in("value", codes.CODE_TOKENS)), keys, species, to_double("value"))


def two_species_dataset(
    wide: DataFrame,
    *,
    keys: Sequence[str] = (),
    species: Mapping[str, str] = codes.SPECIES_CODES,
    areas: Sequence[str] = codes.QUOTA_DATASET_AREAS,
) -> DataFrame:
    """The same from the catch data set."""
    chosen = wide.filter(F.col("species").isin(list(species.values())) & F.col("area").isin(list(areas)))
    return _side_by_side(unpivot_years(chosen, [*keys, "species"]), keys, species, to_double("value"))


def two_species_preliminary(
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    species: Mapping[str, str] = codes.SPECIES_LATIN,
    areas: Sequence[str] = codes.QUOTA_PRELIMINARY_AREAS,
) -> DataFrame:
    """The same from preliminary files: a missing BMS weight is 0, a missing AMS weight is not."""
    chosen = df.filter(F.col("species_latin").isin(list(species.values())) & F.col("area").isin(list(areas)))
    by = [*keys, "year"]
    ams = conditional_pivot(
        chosen,
        by,
        "species_latin",
        species,
        F.struct(F.col("ams").alias("ams"), F.coalesce("bms", F.lit(0.0)).alias("bms")),
        poison_pair,
    )
    return _with_total(ams, keys, list(species))


def poison_pair(pair):
    """Sum of both weights, missing if one AMS weight is missing."""
    ams, bms = pair["ams"], pair["bms"]
    return F.when(F.bool_and(F.when(pair.isNotNull(), ams.isNotNull())), F.sum(ams) + F.sum(bms))


def stacked_species(*parts: DataFrame) -> DataFrame:
    """Stack yearly tables with the same columns."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def quota_uptake(landings: DataFrame, quota: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Landings (``year``, ``total``) next to the agreed quota (``year``, ``tac``) and percent taken up."""
    both = null_safe_join(landings, quota.select(*keys, "year", "tac"), [*keys, "year"], "full")
    return both.withColumn("uptake", F.when(F.col("total").isNotNull(), ratio("total", "tac") * 100))


def yearly_preliminary(
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    latin: Sequence[str] = ("Scophthalmus rhombus",),
    areas: Sequence[str] = codes.COMBINED_QUOTA_AREAS,
) -> DataFrame:
    """Preliminary landings per year over a combined area, input of ``quota_uptake``."""
    total = poison_sum("ams") + poison_sum(F.coalesce("bms", F.lit(0.0)))
    return (
        df.filter(F.col("species_latin").isin(list(latin)) & F.col("area").isin(list(areas)))
        .groupBy(*keys, "year")
        .agg(total.alias("total"))
    )


def _side_by_side(long: DataFrame, keys: Sequence[str], species: Mapping[str, str], value) -> DataFrame:
    wide = conditional_pivot(long, [*keys, "year"], "species", species, value, na_sum)
    return _with_total(wide, keys, list(species))


def _with_total(wide: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return wide.select(*keys, "year", *names, total.alias("total"))
