"""Landings from the three kinds of official files, and the spliced catch series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchframe import codes
from catchframe.functions import digits, na_sum, not_in, poison_sum, to_double, two_measure_sum
from catchframe.operators.recode import merge_codes, recode

CLEAN_COLUMNS = ("species", "area", "units", "country", "year", "landings")


def year_columns(df: DataFrame, first: int | None = None, last: int | None = None) -> dict[str, int]:
    """``{column: year}`` of the year-named columns (``X1950`` or ``1950``) in a range.

    Years are chosen before the unpivot, so other years never leave the scan.
    """
    found = {}
    for name in df.columns:
        text = name[1:] if name[:1] in ("X", "x") else name
        if len(text) == 4 and text.isdigit():
            year = int(text)
            if (first is None or year >= first) and (last is None or year <= last):
                found[name] = year
    return found


def unpivot_years(
    df: DataFrame, ids: Sequence[str], first: int | None = None, last: int | None = None, value: str = "value"
) -> DataFrame:
    """Wide year columns to rows ``(*ids, year, value)``; missing cells are kept."""
    names = list(year_columns(df, first, last))
    if not names:
        raise ValueError("no year column in the chosen range")
    long = df.unpivot(list(ids), names, "__year", value)
    return long.withColumn("year", digits("__year")).drop("__year").select(*ids, "year", value)


def historical_landings(
    wide: DataFrame,
    *,
    keys: Sequence[str] = (),
    species: str = "Brill",
    divisions: Mapping[str, str] = codes.DIVISIONS,
    countries: Mapping[str, str] = codes.COUNTRY_NAMES,
    first_year: int = 1950,
    before_year: int = 2006,
    species_out: str = "BLL",
    units: str = codes.UNITS,
) -> DataFrame:
    """Clean landings from the historical wide file (species, division, country, X1950...)."""
    chosen = wide.filter((F.col("species") == species) & F.col("division").isin(list(divisions)))
    long = unpivot_years(chosen, [*keys, "division", "country"], first_year, before_year - 1)
    return (
        long.filter(not_in("value", codes.CODE_TOKENS))
        .withColumn("country", recode("country", countries))
        .withColumn("area", recode("division", divisions))
        .groupBy(*keys, "year", "country", "area")
        .agg(na_sum(to_double("value")).alias("landings"))
        .filter(F.col("landings") > 0)
        .select(*keys, *_labelled(species_out, units))
    )


def dataset_landings(
    wide: DataFrame,
    *,
    keys: Sequence[str] = (),
    species: str = "BLL",
    areas: Sequence[str] = codes.DATASET_AREAS,
    merged: Sequence[str] = ("GB", "IM"),
    known: Sequence[str] = tuple(dict.fromkeys(codes.COUNTRY_NAMES.values())),
    area_groups: Mapping[str, str] = codes.AREA_GROUPS,
) -> DataFrame:
    """Clean landings from the catch data set (species, area, units, country, 2006...)."""
    chosen = wide.filter((F.col("species") == species) & F.col("area").isin(list(areas)))
    long = unpivot_years(chosen, [*keys, "species", "area", "units", "country"])
    return (
        long.withColumn("country", recode(merge_codes("country", merged, "UK"), {c: c for c in known}))
        .withColumn("area", recode("area", area_groups))
        .groupBy(*keys, "species", "area", "units", "country", "year")
        .agg(na_sum(to_double("value")).alias("landings"))
        .select(*keys, *CLEAN_COLUMNS)
    )


def preliminary_landings(
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    latin: Sequence[str] = ("Scophthalmus rhombus",),
    areas: Mapping[str, str] = codes.PRELIMINARY_AREAS,
    species_out: str = "BLL",
    units: str = codes.UNITS,
) -> DataFrame:
    """Clean landings from preliminary files (year, species_latin, area, country, ams, bms)."""
    return (
        df.filter(F.col("species_latin").isin(list(latin)) & F.col("area").isin(list(areas)))
        .withColumn("country", merge_codes("country", ["GB"], "UK"))
        .withColumn("area", recode("area", areas))
        .groupBy(*keys, "species_latin", "area", "year", "country")
        .agg(two_measure_sum("ams", "bms").alias("landings"))
        .select(*keys, *_labelled(species_out, units))
    )


def bms_landings(
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    latin: Sequence[str] = ("Scophthalmus rhombus",),
    areas: Sequence[str] = tuple(codes.PRELIMINARY_AREAS),
) -> DataFrame:
    """Landings below minimum size per year, country and raw area."""
    return (
        df.filter(F.col("species_latin").isin(list(latin)) & F.col("area").isin(list(areas)))
        .withColumn("country", merge_codes("country", ["GB"], "UK"))
        .groupBy(*keys, "year", "country", "area")
        .agg(na_sum("bms").alias("bms"))
    )


def combined_landings(*parts: DataFrame) -> DataFrame:
    """Stack clean landings; a column that a part lacks is missing there."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def spliced_catch_series(
    official: DataFrame,
    detailed: DataFrame,
    *,
    keys: Sequence[str] = (),
    splice_year: int = 2014,
    kg_per_unit: float = 1000.0,
) -> DataFrame:
    """Official landings before ``splice_year``, detailed landings and discards from then on.

    ``total`` is missing for the early years, which have no discards.
    """
    early = (
        official.filter(F.col("year") < splice_year)
        .groupBy(*keys, "year")
        .agg(poison_sum("landings").alias("landings"))
    )
    late = (
        detailed.filter(F.col("year") >= splice_year)
        .groupBy(*keys, "year")
        .agg(
            na_sum(F.col("landings") / kg_per_unit).alias("landings"),
            na_sum(F.col("discards") / kg_per_unit).alias("discards"),
        )
    )
    stacked = early.unionByName(late, allowMissingColumns=True)
    return stacked.withColumn("total", F.col("landings") + F.col("discards"))


def _labelled(species: str, units: str):
    return (
        F.lit(species).alias("species"), "area", F.lit(units).alias("units"), "country", "year", "landings",
    )
