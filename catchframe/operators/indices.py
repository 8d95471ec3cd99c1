"""Survey indices: normalisation, stacking, deviation band, weights, retrospective alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchframe.functions import attach, poison_avg, ranked, ratio, stored

SERIES = ("index",)
# Label and time shift of each survey series in the combined table.
SERIES_LABELS = {"sem1": ("Comb.idx.Sem.1", 0.0), "sem2": ("Comb.idx.Sem.2", 0.5), "hist": ("Hist.idx.Q1", 0.0)}


def relative_to_mean(
    df: DataFrame, value: str, out: str, *, keys: Sequence[str] = SERIES, store_means: bool = False
) -> DataFrame:
    """``value`` divided by its mean per series; one missing value makes the series missing.

    With ``store_means`` the means are written first, which costs a job and saves
    the shuffle of the observations.
    """
    means = df.groupBy(*keys).agg(poison_avg(value).alias("__mean"))
    return attach(df, stored(means) if store_means else means, list(keys)).withColumn(out, ratio(value, "__mean")).drop("__mean")


def normalised_index(df: DataFrame, *, keys: Sequence[str] = SERIES) -> DataFrame:
    """Index observations relative to the series mean."""
    return relative_to_mean(df, "obs", "normalized", keys=keys)


def relative_cv(df: DataFrame, *, keys: Sequence[str] = SERIES) -> DataFrame:
    """Observation weight: coefficient of variation relative to the series mean."""
    return relative_to_mean(df, "cv", "stdevfac", keys=keys)


def combined_index(*series: tuple[DataFrame, str, float], keys: Sequence[str] = ()) -> DataFrame:
    """Stack ``(series, label, time shift)`` and normalise each of them."""
    stacked = None
    for df, label, shift in series:
        part = df.withColumns({"index": F.lit(label), "time": F.col("time") + shift})
        stacked = part if stacked is None else stacked.unionByName(part)
    return normalised_index(stacked, keys=[*keys, "index"])


def labelled_index(df: DataFrame, labels: Mapping[str, tuple[str, float]], *, keys: Sequence[str] = ()) -> DataFrame:
    """``combined_index`` for series kept in one table: ``{index: (label, time shift)}``."""
    chosen = df.filter(F.col("index").isin(list(labels)))
    shift, label = F.lit(0.0), F.col("index")
    for index, (name, by) in labels.items():
        label = F.when(F.col("index") == index, F.lit(name)).otherwise(label)
        shift = F.when(F.col("index") == index, F.lit(by)).otherwise(shift)
    shifted = chosen.withColumns({"time": F.col("time") + shift, "index": label})
    return normalised_index(shifted, keys=[*keys, "index"])


def deviation_band(df: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Normalised index -/+ the sample deviation over all series of a key together."""
    known = F.bool_and(F.col("normalized").isNotNull())
    sd = df.groupBy(*keys).agg(F.when(known, F.stddev_samp("normalized")).alias("__sd"))
    return (
        attach(df, sd, list(keys))
        .withColumn("lower", F.col("normalized") - F.col("__sd"))
        .withColumn("upper", F.col("normalized") + F.col("__sd"))
        .drop("__sd")
    )


def retro_aligned(retro: DataFrame, semester: int, peels: int, *, keys: Sequence[str] = ()) -> DataFrame:
    """Base series and peels side by side, aligned by position; a shorter peel ends in missing cells.

    ``retro`` has ``(*keys, peel, semester, time, obs)``; peel 0 is the base.  A peel above
    ``peels`` fails the job.  Positions come from range partitions, so a series may have any number of rows.
    """
    if semester not in (1, 2):
        raise ValueError(f"there is no semester {semester}")
    above = F.raise_error(F.concat(F.lit("peel beyond the last one: "), F.col("peel").cast("string"))).cast("int")
    one = retro.filter(F.col("semester") == semester).withColumn("peel", F.when(F.col("peel") > peels, above).otherwise(F.col("peel")))

    def cell(peel: int):
        return F.max(F.when(F.col("peel") == peel, F.col("obs")))

    wide = (
        ranked(one, [*keys, "peel"], [F.col("time"), F.col("obs")], "__place")
        .groupBy(*keys, "__place")
        .agg(
            F.max(F.when(F.col("peel") == 0, F.col("time"))).alias("time"),
            cell(0).alias("base"),
            *[cell(p).alias(f"peel{p}") for p in range(1, peels + 1)],
        )
    )
    return wide.drop("__place")
