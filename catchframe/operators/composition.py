"""Catch composition: categories, shares by gear, season and country, raising and coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from catchframe import codes
from catchframe.functions import (
    attach,
    conditional_pivot,
    if_else,
    na_sum,
    not_in,
    null_safe_join,
    number_text,
    poison_over,
    poison_sum,
    ratio,
    to_double,
)
from catchframe.operators.recode import recode

TOTAL = "Total"


def catch_category_table(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("year",),
    dropped: Sequence[str] = (codes.LOGBOOK, codes.BMS),
    area_groups: Mapping[str, str] = codes.DETAILED_AREAS,
    countries: Mapping[str, str] = codes.COUNTRY_NAMES,
) -> DataFrame:
    """Discards and landings per (raw area, raw country) with ratios.

    Area and country are recoded after the sums, so one (area, country) may have
    several rows.
    """
    wide = conditional_pivot(
        df.filter(not_in("category", dropped)),
        [*keys, "area", "country"],
        "category",
        {"discards": codes.DISCARDS, "landings": codes.LANDINGS},
        "caton",
        poison_sum,
    )
    total = F.col("discards") + F.col("landings")
    return wide.select(
        *keys,
        recode("area", area_groups).alias("area"),
        recode("country", countries).alias("country"),
        "discards",
        "landings",
        total.alias("total"),
        if_else(total > 0, _discard_percent(), F.lit(0.0)).alias("discard_ratio"),
        if_else(total > 0, ratio("discards", "landings"), F.lit(0.0)).alias("dl_ratio"),
    )


def category_total_row(detail: DataFrame, *, keys: Sequence[str] = ("year",)) -> DataFrame:
    """One total row per key over a category table.

    ``total`` sums the known row totals only and may be below discards + landings.
    """
    sums = detail.groupBy(*keys).agg(*[na_sum(c).alias(c) for c in ("discards", "landings", "total")])
    return sums.select(
        *keys,
        F.lit(TOTAL).alias("area"),
        "discards",
        "landings",
        "total",
        _discard_percent().alias("discard_ratio"),
        if_else(F.col("total") > 0, ratio("discards", "landings"), F.lit(0.0)).alias("dl_ratio"),
    )


def catch_category_with_total(df: DataFrame, *, keys: Sequence[str] = ("year",), **options) -> DataFrame:
    """Detail rows and total row of all keys in one table."""
    detail = catch_category_table(df, keys=keys, **options)
    return detail.unionByName(category_total_row(detail, keys=keys), allowMissingColumns=True)


def detailed_catches(
    df: DataFrame, *, keys: Sequence[str] = ("year",), species: str = "BLL", units: str = codes.UNITS, **options
) -> DataFrame:
    """Category table as clean catches; rows without an area group are left out."""
    detail = catch_category_table(df, keys=keys, **options)
    return detail.filter(F.col("area") != TOTAL).select(
        *[k for k in keys if k != "year"],
        F.lit(species).alias("species"), "area", F.lit(units).alias("units"), "country", "year",
        "landings", "discards",
    )


def discard_measures(df: DataFrame, *, keys: Sequence[str] = ("year",), **options) -> DataFrame:
    """Category table with total rows in long form, missing cells kept."""
    table = catch_category_with_total(df, keys=keys, **options)
    measures = ["discards", "landings", "total", "discard_ratio", "dl_ratio"]
    return table.unpivot([*keys, "area", "country"], measures, "variable", "value")


def share_of(
    df: DataFrame, by: Sequence[Column | str], within: Sequence[str], *, value: str = "caton", out: str = "catch"
) -> DataFrame:
    """Sum of ``value`` per ``within`` + ``by`` and its percent of the ``within`` total.

    The window runs over the aggregated strata, never over raw rows.
    """
    sums = df.groupBy(*within, *by).agg(poison_sum(value).alias(out))
    if not within:
        whole = attach(sums, sums.agg(poison_sum(out).alias("__whole")), [])
    else:
        whole = sums.withColumn("__whole", poison_over(out, W.partitionBy(*within)))
    return whole.withColumn("perc", ratio(out, "__whole") * 100).drop("__whole")


def gear_share(df: DataFrame, *, keys: Sequence[str] = ("year",), length: int = 3) -> DataFrame:
    """Share by gear: the first ``length`` characters of the fleet."""
    return share_of(df, [F.substring("fleet", 1, length).alias("gear")], keys)


def gear_fine_share(df: DataFrame, *, keys: Sequence[str] = ("year",)) -> DataFrame:
    """Share by fine gear: seven characters of the fleet."""
    return gear_share(df, keys=keys, length=7)


def season_share(df: DataFrame, *, keys: Sequence[str] = ("year",)) -> DataFrame:
    return share_of(df, ["season"], keys)


def country_area_share(df: DataFrame, *, keys: Sequence[str] = ("year",)) -> DataFrame:
    """Landings per country and area with the area's percent within the country."""
    landings = df.filter(F.col("category") == codes.LANDINGS)
    return share_of(landings, ["area"], [*keys, "country"], out="landings")


def discard_percent_by_gear(df: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Discards in percent of all categories per gear and area."""
    by_gear = df.withColumn("gear", F.substring("fleet", 1, 3))
    shares = share_of(by_gear, ["category"], [*keys, "area", "gear"], out="caton_sum")
    return shares.filter(F.col("category") == codes.DISCARDS)


def origin_sums(df: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Catch by raised or imported origin."""
    return df.groupBy(*keys, "origin").agg(poison_sum("caton").alias("caton_sum"))


def _raise_rows(df: DataFrame) -> DataFrame:
    kept = df.filter((F.col("category") != codes.DISCARDS) & (F.col("gear_group") != "MIS"))
    return kept.withColumn("weight", if_else(F.col("count") == 2, F.col("caton"), F.lit(None)))


def raise_percent(df: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Percent for unallocated landings: the group's weighted mean where ``count == 1``.

    Sums per group come from one partial aggregation and are joined back; the
    text lists of the group are in ``raise_lists``.
    """
    rows = _raise_rows(df)
    counted = (F.col("count") == 2) & F.col("perc").isNotNull()
    group = [*keys, "group"]
    sums = rows.groupBy(*group).agg(
        na_sum(F.when(counted, F.col("perc") * F.col("weight"))).alias("__n"),
        na_sum(F.when(counted, F.col("weight"))).alias("__d"),
        F.coalesce(F.bool_or(counted & F.col("weight").isNull()), F.lit(False)).alias("__bad"),
    )
    mean = F.when(~F.col("__bad"), ratio("__n", "__d"))
    return (
        attach(rows, sums, group)
        .withColumn("percraise", if_else(F.col("count") == 1, mean, F.lit(None)))
        .drop("__n", "__d", "__bad")
    )


def raise_lists(df: DataFrame, *, keys: Sequence[str] = (), order: str = "ord") -> DataFrame:
    """Members of the percent and weight lists of each group that has a ``count == 1`` row.

    One row per member with its ``order`` and both texts; a group's rows in that order, and
    the texts joined by ', ', are its lists.  A list is never gathered, so a missing or
    repeated order is no matter.
    """
    rows = _raise_rows(df)
    group = [*keys, "group"]
    wanted = rows.filter(F.col("count") == 1).select(*group).distinct()
    members = rows.select(
        *group, order,
        F.coalesce(number_text("perc"), F.lit("NA")).alias("percraise_includes"),
        F.coalesce(number_text("weight"), F.lit("NA")).alias("percraise_weights"),
    )
    return null_safe_join(members, wanted, group, "left_semi")


SAMPLE_COLUMNS = ("sex", "age_or_length", "canum", "weca", "leca")
STRATUM = ("stock", "country", "area", "season", "fleet")


def landings_with_discards(
    df: DataFrame, *, keys: Sequence[str] = (), drop: Sequence[str] = SAMPLE_COLUMNS, kg_per_unit: float = 1000.0
) -> DataFrame:
    """Percent of the landings whose stratum has imported discards.

    Sample rows of one catch line differ only in the dropped columns and are
    merged first.  One aggregation per stratum then carries both the discard
    flag and the landings, in place of a semi-join on stratum ids.  A padded area
    code is a stratum of its own.

    Only landings need their full line to be told apart.  Imported discards keep
    their stratum and other rows nothing but the keys, so most of them are merged
    before the shuffle.
    """
    if isinstance(df.schema["caton"].dataType, T.StringType):
        df = df.withColumn("caton", to_double("caton"))
    landing = F.coalesce(F.col("category") == codes.LANDINGS, F.lit(False))
    imported = (F.col("origin") == codes.IMPORTED) & (F.col("category") == codes.DISCARDS)
    used = landing | F.coalesce(imported, F.lit(False))
    stratum = list(dict.fromkeys([*keys, *(c for c in STRATUM if c in df.columns)]))
    kept = {"category": used, "origin": used, **{c: used for c in stratum if c not in keys}}
    lines = df.select(
        *keys,
        *[F.when(kept.get(c, landing), F.col(c)).alias(c) for c in df.columns if c not in keys and c not in drop],
    ).distinct()
    landing = F.col("category") == codes.LANDINGS
    per_stratum = lines.groupBy(*stratum).agg(
        F.coalesce(
            F.bool_or((F.col("origin") == codes.IMPORTED) & (F.col("category") == codes.DISCARDS)), F.lit(False)
        ).alias("covered"),
        na_sum(F.when(landing, F.col("caton") / kg_per_unit)).alias("landed"),
        F.coalesce(F.bool_and(F.when(landing, F.col("caton").isNotNull())), F.lit(True)).alias("known"),
    )
    covered = F.col("covered")
    sums = per_stratum.groupBy(*keys).agg(
        na_sum(F.when(covered, F.col("landed"))).alias("__part"),
        na_sum("landed").alias("__all"),
        F.bool_and("known").alias("__known"),
    )
    return sums.select(
        *keys, F.when(F.col("__known"), ratio("__part", "__all") * 100).alias("perc_landings_with_discards")
    )


def unique_codes(df: DataFrame, code: str, *, keys: Sequence[str]) -> DataFrame:
    """Distinct known codes per key, one row each; a key without any has one missing row.

    Whether a key has a known code is aggregated and joined back, so a key with many codes
    is not one window.
    """
    pairs = df.select(*keys, code).distinct()
    known = pairs.groupBy(*keys).agg(F.bool_or(F.col(code).isNotNull()).alias("__any"))
    return attach(pairs, known, list(keys)).filter(F.col(code).isNotNull() | ~F.col("__any")).drop("__any")


def _discard_percent() -> Column:
    return ratio("discards", F.col("landings") + F.col("discards")) * 100
