"""Report tables: landings by year and country, shares, assessment summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchframe.functions import conditional_pivot, half_even, na_sum
from catchframe.operators.composition import share_of

# The country columns shown per area group.
COUNTRIES_3A = ("BE", "DE", "DK", "NL", "NO", "SE", "UK")
COUNTRIES_4 = ("BE", "DE", "DK", "FR", "UK", "NL", "NO", "SE")
COUNTRIES_7DE = ("BE", "DE", "DK", "FR", "UK", "IE", "NL", "CI")


def landings_summary(df: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Landings per year, country and area."""
    return df.groupBy(*keys, "year", "country", "area").agg(na_sum("landings").alias("landings"))


def table_poison(
    summary: DataFrame,
    area: str = "27.3.a",
    *,
    keys: Sequence[str] = (),
    into: str = "UK",
    absorbed: str = "IE",
    show: Sequence[str] = COUNTRIES_3A,
    null_mode: str = "poison",
) -> DataFrame:
    """Year x country table in which ``into`` takes ``absorbed`` before missing cells become 0.

    ``poison``: a year without one of the two loses both, also in the total.
    ``safe``: the known one is kept.  The total has all other countries, shown or
    not, and rows without a country.
    """
    if null_mode not in ("poison", "safe"):
        raise ValueError("null_mode is 'poison' or 'safe'")
    others = na_sum(F.when(~F.coalesce(F.col("country").isin(into, absorbed), F.lit(False)), F.col("landings")))
    wide = _by_country(summary, area, keys, {*show, into, absorbed}, others.alias("__others"))
    merged = F.col(into) + F.col(absorbed)
    if null_mode == "safe":
        merged = _zero(into) + _zero(absorbed)
    wide = wide.withColumn(into, merged)
    total = F.col("__others") + _zero(into)
    return _rounded(wide, keys, {**{c: _zero(c) for c in show}, "total": total})


def table_total_first(
    summary: DataFrame,
    area: str = "27.4",
    *,
    keys: Sequence[str] = (),
    into: str = "UK",
    absorbed: Sequence[str] = ("GG", "IE", "IM"),
    show: Sequence[str] = COUNTRIES_4,
) -> DataFrame:
    """Year x country table: total over all rows first, then 0 for missing, then the merge."""
    wide = _by_country(summary, area, keys, {*show, into, *absorbed}, na_sum("landings").alias("__total"))
    cells = {c: _zero(c) for c in show}
    cells[into] = reduce(Column.__add__, [_zero(c) for c in [*absorbed, into]])
    return _rounded(wide, keys, {**cells, "total": F.col("__total")})


def table_explicit_total(
    summary: DataFrame,
    area: str = "27.7.de",
    *,
    keys: Sequence[str] = (),
    into: str = "CI",
    absorbed: Sequence[str] = ("GG", "JE"),
    show: Sequence[str] = COUNTRIES_7DE,
) -> DataFrame:
    """Year x country table whose total is the sum of the shown countries only."""
    wide = _by_country(summary, area, keys, {*show, into, *absorbed})
    cells = {c: _zero(c) for c in show}
    cells[into] = reduce(Column.__add__, [_zero(c) for c in [into, *absorbed]])
    return _rounded(wide, keys, {**cells, "total": reduce(Column.__add__, cells.values())})


def area_share(summary: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Landings per year and area with the percent of the year."""
    return _year_share(summary, keys, "area")


def country_share(summary: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Landings per year and country with the percent of the year."""
    return _year_share(summary, keys, "country")


# Column names of the assessment summary export.
SUMMARY_NAMES = {
    "Year": "Year",
    "Landings": "Landings",
    "Discards": "Discards",
    "F/Fmsy": "FishingPressure",
    "F/Fmsy_lower": "Low_FishingPressure",
    "F/Fmsy_upper": "High_FishingPressure",
    "B/Bmsy": "StockSize",
    "B/Bmsy_lower": "Low_StockSize",
    "B/Bmsy_upper": "High_StockSize",
}


def assessment_summary(
    df: DataFrame, *, keys: Sequence[str] = (), names: Mapping[str, str] = SUMMARY_NAMES
) -> DataFrame:
    """Assessment summary under the export's column names."""
    return df.select(*keys, *[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def _by_country(summary: DataFrame, area: str, keys: Sequence[str], countries: set[str], *extra: Column) -> DataFrame:
    one_area = summary.filter(F.col("area") == area)
    columns = {c: c for c in sorted(countries)}
    return conditional_pivot(one_area, [*keys, "year"], "country", columns, "landings", na_sum, extra)


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0.0))


def _rounded(wide: DataFrame, keys: Sequence[str], cells: Mapping[str, Column]) -> DataFrame:
    return wide.select(*keys, "year", *[half_even(v).alias(c) for c, v in cells.items()])


def _year_share(summary: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    known = summary.withColumn("landings", F.coalesce("landings", F.lit(0.0)))
    return share_of(known, [by], [*keys, "year"], value="landings", out="landings")
