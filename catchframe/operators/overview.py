"""Sampling coverage: stock overview joined to sampled numbers, and stratum summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchframe import codes
from catchframe.functions import na_sum, null_safe_join, poison_sum, ratio, running_sums

MATCH = ("area", "season", "fleet", "country", "category")
DIMENSIONS = ("fleet", "country", "season", "area", "sampled")
MODES = ("LandWt", "LandPercent", "DisWt", "DisRatio", "DiscProvided")


def overview_exclusions(overview: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Weight left out as logbook discards and weight moved from BMS landings to discards."""
    out = []
    for name, label in (("logbook_excluded", codes.LOGBOOK), ("bms_recategorised", codes.BMS)):
        out.append(na_sum(F.when(F.col("category") == label, F.col("catch_wt"))).alias(name))
    return overview.groupBy(*keys).agg(*out)


def prepared_overview(overview: DataFrame) -> DataFrame:
    """Overview rows without logbook discards, BMS landings as discards, category as one letter."""
    category = F.when(F.col("category") == codes.BMS, F.lit(codes.DISCARDS)).otherwise(F.col("category"))
    return overview.filter(F.col("category") != codes.LOGBOOK).withColumn("category", F.substring(category, 1, 1))


def overview_join(
    overview: DataFrame, sampled: DataFrame, *, keys: Sequence[str] = (), columns: Sequence[str] = ("sampled_catch",)
) -> DataFrame:
    """Overview left-joined to the sampled numbers; every sample row gives a row.

    ``sampled`` has the one-letter category and one row per stratum and length class.
    """
    on = [*keys, *MATCH]
    joined = null_safe_join(prepared_overview(overview), sampled.select(*on, *columns), on, "left")
    return joined.withColumn("sampled", F.col("sampled_catch").isNotNull())


def overview_weights(overview: DataFrame, sampled: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """The joined overview for weight sums, without multiplying rows.

    Sample rows are first counted per stratum, by known and missing catch.  An
    overview row then stands for its ``n`` joined rows and carries ``catch_wt``
    times ``n``, so sums over it equal sums over the full join at any number of
    matches per stratum.
    """
    on = [*keys, *MATCH]
    known = F.col("sampled_catch").isNotNull()
    counts = sampled.groupBy(*on).agg(
        F.count(F.when(known, 1)).alias("__known"), F.count(F.when(~known, 1)).alias("__unknown")
    )
    joined = null_safe_join(prepared_overview(overview), counts, on, "left")
    unknown = F.when(F.col("__known").isNull(), F.lit(1)).otherwise(F.col("__unknown"))
    parts = F.array(
        F.struct(F.lit(True).alias("sampled"), F.coalesce("__known", F.lit(0)).alias("n")),
        F.struct(F.lit(False).alias("sampled"), unknown.alias("n")),
    )
    return (
        joined.withColumn("__part", F.explode(F.filter(parts, lambda p: p["n"] > 0)))
        .withColumn("sampled", F.col("__part.sampled"))
        .withColumn("catch_wt", F.col("catch_wt") * F.col("__part.n"))
        .drop("__part", "__known", "__unknown")
    )


def stratum_summary(
    df: DataFrame,
    dims: Sequence[str] = ("fleet", "country", "sampled"),
    mode: str = "LandPercent",
    *,
    keys: Sequence[str] = (),
    individual_totals: bool = True,
    ymax: float | None = None,
    mark_sampled: bool = True,
) -> DataFrame:
    """Strata of the joined overview by any of fleet, country, season, area, sampled.

    Modes: ``LandWt``, ``DisWt`` (weights), ``LandPercent`` (percent and running
    percent per season/area panel), ``DisRatio`` (discards over catch, for all
    pairs of sampled flags), ``DiscProvided`` (are discards known).  A stratum
    with a missing dimension is left out.  Rows come in report order.  ``ymax`` adds the
    value cut at that height in a column of its own (``_capped``).
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}, known are {', '.join(MODES)}")
    unknown = set(dims) - set(DIMENSIONS)
    if unknown or not dims:
        raise ValueError(f"dims must be some of {', '.join(DIMENSIONS)}")
    dims = [d for d in DIMENSIONS if d in dims]
    by_sampled = "sampled" in dims
    plain = [d for d in dims if d != "sampled"]
    df = df.dropna(subset=list(dims))
    if mode == "DisRatio":
        if not by_sampled:
            raise ValueError("DisRatio needs the sampled dimension")
        return _discard_ratio(df, keys, plain)
    if mode == "DiscProvided":
        return _discards_provided(df, keys, plain, by_sampled)

    letter, name = ("D", "dis_wt") if mode == "DisWt" else ("L", "land_wt")
    strata = (
        df.filter(F.col("category") == letter)
        .groupBy(*keys, *dims)
        .agg(poison_sum("catch_wt").alias(name))
    )
    value = F.col(name)
    if mode == "LandPercent":
        strata = _percent(strata, keys, dims, individual_totals)
        value, name = F.col("percent"), "percent"
    if ymax is not None:
        cap = ymax * 1.06 if mark_sampled and by_sampled else ymax
        strata = strata.withColumn(f"{name}_capped", F.when(value.isNotNull(), F.least(value, F.lit(float(cap)))))
    weight = "dis_wt" if mode == "DisWt" else "land_wt"
    return strata.orderBy(*keys, *_report_order(dims, weight))


def panel_columns(dims: Sequence[str]) -> list[str]:
    """The season and area columns that split a summary into panels."""
    season, area = "season" in dims, "area" in dims
    detail = "country" in dims or "fleet" in dims
    if area and season:
        return ["area", "season"] if detail or "sampled" in dims else []
    if area:
        return ["area"]
    return ["season"] if season and detail else []


def _report_order(dims: Sequence[str], weight: str) -> list[Column]:
    """Sampled first, then heavy strata; ties by the dimensions from last to first."""
    first = [F.desc("sampled")] if "sampled" in dims else []
    return first + [F.desc_nulls_first(weight)] + [F.desc(d) for d in reversed(dims)]


def _percent(strata: DataFrame, keys: Sequence[str], dims: Sequence[str], individual: bool) -> DataFrame:
    """Percent and running percent of the strata of each panel.

    Equal and missing weights are told apart by the dimensions, so they are spread over tasks like others.
    """
    panel = [*keys, *panel_columns(dims)]
    strata = running_sums(
        strata, panel, _report_order(dims, "land_wt"), {"__run": "land_wt"}, total_by=panel if individual else list(keys)
    )
    whole = F.coalesce("__run_total", F.lit(0.0))
    return strata.withColumns({
        "percent": ratio(100 * F.col("land_wt"), whole),
        "cumulative": ratio(100 * F.col("__run"), whole),
    }).drop("__run", "__run_total")


def _sums(df: DataFrame, letter: str, by: Sequence[str], name: str) -> DataFrame:
    return df.filter(F.col("category") == letter).groupBy(*by).agg(poison_sum("catch_wt").alias(name))


def _discard_ratio(df: DataFrame, keys: Sequence[str], plain: Sequence[str]) -> DataFrame:
    """Both sides have at most two rows per join key, one per sampled flag."""
    flagged = df.withColumn("__one", F.lit(1))
    on = [*keys, *plain, "__one"]
    dis = _sums(flagged, "D", [*on, "sampled"], "__d").withColumnRenamed("sampled", "sampled_d")
    land = _sums(flagged, "L", [*on, "sampled"], "__l").withColumnRenamed("sampled", "sampled_l")
    both = null_safe_join(dis, land, on, "full")
    return (
        both.withColumn("d_ratio", ratio("__d", F.col("__d") + F.col("__l")))
        .filter(F.col("d_ratio").isNotNull())
        .select(*keys, *plain, "sampled_d", "sampled_l", "d_ratio")
        .orderBy(*keys, F.desc("sampled_l"), F.desc("sampled_d"), F.desc("d_ratio"), *[F.desc(d) for d in reversed(plain)])
    )


def _discards_provided(df: DataFrame, keys: Sequence[str], plain: Sequence[str], by_sampled: bool) -> DataFrame:
    """With the sampled dimension the flag takes its place in the order: strata with discards first."""
    flagged = df.withColumn("__one", F.lit(1))
    on = [*keys, *plain, "__one"]
    both = null_safe_join(_sums(flagged, "D", on, "__d"), _sums(flagged, "L", on, "land_wt"), on, "full")
    provided = ratio("__d", F.col("__d") + F.col("land_wt")).isNotNull()
    return (
        both.select(*keys, *plain, provided.alias("provided"), "land_wt")
        .distinct()
        .orderBy(
            *keys, *([F.desc("provided")] if by_sampled else []), F.desc_nulls_first("land_wt"), *[F.desc(d) for d in reversed(plain)]
        )
    )
