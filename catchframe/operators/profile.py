"""Column profile: minimum, quartiles, mean, maximum and missing count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchframe.functions import clean_nan, null_safe_join, running_sums, stored

QUARTILES = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
# The sketch is off by a ten-thousandth of the rows at most; a bracket is three of these to either side.
ACCURACY = 10_000
MARGIN = 3.0 / ACCURACY


def column_profile(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = ()) -> DataFrame:
    """One row per column with exact quartiles, interpolated between neighbours.

    A quantile sketch brackets each quartile first.  A second pass counts equal values inside the brackets
    only; the values between two brackets are one row with their number, least and largest.  What is shuffled
    is some ten-thousandths of the rows, not all different values.  Ranks come from a running count over
    range partitions.  A quartile outside its bracket and its neighbours fails the job.
    """
    long = df.select(*keys, *[clean_nan(F.col(c).cast("double")).alias(c) for c in columns]).unpivot(
        list(keys), list(columns), "column", "value"
    )
    by = [*keys, "column"]
    value = F.col("value")
    inner = [q for q in QUARTILES.values() if 0 < q < 1]
    places = [x for q in inner for x in (q - MARGIN, q + MARGIN)]
    sketch = stored(long.groupBy(*by).agg(
        F.percentile_approx(value, F.array(*map(F.lit, places)), ACCURACY).alias("__at"),
        F.count(value).alias("__size"), F.sum(value).alias("__sum"), F.count_if(value.isNull()).alias("n_missing"),
    ))
    edges = [F.element_at("__at", i + 1) for i in range(len(places))]
    inside, region = F.lit(False), F.lit(0)
    for low, high in zip(edges[::2], edges[1::2]):
        inside = inside | value.between(low, high)
        region = region + F.when(value > high, 1).otherwise(0)
    cells = (
        null_safe_join(long.where(value.isNotNull()), sketch.select(*by, "__at"), by, "left")
        .groupBy(*by, F.when(~inside, region).alias("__region"), F.when(inside, value).alias("__value"))
        .agg(F.count(F.lit(1)).alias("__c"), F.min(value).alias("__low"), F.max(value).alias("__high"))
    )
    # Of the values between brackets only the ends can be a quartile's neighbour.
    known = F.struct(F.col("__low").alias("value"), F.lit(0).alias("__between"), F.col("__c").alias("__n"))
    ends = F.when(F.col("__c") < 2, F.array(known)).otherwise(F.array(
        F.struct(F.col("__low").alias("value"), F.lit(0).alias("__between"), F.lit(1).cast("long").alias("__n")),
        F.struct(F.col("__low").alias("value"), F.lit(1).alias("__between"), (F.col("__c") - 2).alias("__n")),
        F.struct(F.col("__high").alias("value"), F.lit(2).alias("__between"), F.lit(1).cast("long").alias("__n")),
    ))
    listed = F.when(F.col("__region").isNull(), F.array(known)).otherwise(ends)
    counts = cells.select(*by, F.explode(listed).alias("__x")).select(*by, "__x.*").where("__n > 0")
    upto = running_sums(counts, by, [F.col("value"), F.col("__between")], {"__upto": "__n"})
    sized = null_safe_join(upto, sketch.drop("__at"), by, "left")

    size, n = F.col("__size"), F.col("__n")
    picks = []
    for name, q in QUARTILES.items():
        place = (size - 1) * q
        for part, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            hit = (at < F.col("__upto")) & (at >= F.col("__upto") - n)
            missed = F.raise_error(F.lit("a quartile lies outside of its bracket")).cast("double")
            picks.append(F.max(F.when(hit, F.when(F.col("__between") == 1, missed).otherwise(value))).alias(f"__{name}_{part}"))
    picked = null_safe_join(sketch.drop("__at"), sized.groupBy(*by).agg(*picks), by, "left")

    def between(name: str, q: float) -> Column:
        place = (size - 1) * q
        lo, hi = F.col(f"__{name}_lo"), F.col(f"__{name}_hi")
        # Equal neighbours need no step between them; two infinities have none.
        return F.when(lo == hi, lo).otherwise(lo + (place - F.floor(place)) * (hi - lo)).alias(name)

    return picked.select(
        *by,
        *[between(name, q) for name, q in QUARTILES.items()],
        F.try_divide("__sum", "__size").alias("mean"),
        "n_missing",
    )
