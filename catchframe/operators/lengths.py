"""Length frequencies from tables with one column per length class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchframe.functions import digits, poison_sum

# Labels of the two categories that a split keeps.
CATEGORY_LABELS = ("D", "Discards", "L", "Landings")


def length_columns(df: DataFrame, mark: str = "Lngt") -> list[str]:
    return [c for c in df.columns if mark in c]


def length_frequency(
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    by_category: bool = False,
    by_gear: bool = False,
    mark: str = "Lngt",
    categories: Sequence[str] = CATEGORY_LABELS,
) -> DataFrame:
    """Sum of each length column, as rows ``(length, freq)``.

    The columns are summed first, in one aggregation, and turned to rows after
    it, so only one row per group is unpivoted.  With ``by_category`` only the
    discard and landing categories are kept; ``by_gear`` adds the gear.
    """
    columns = length_columns(df, mark)
    if not columns:
        raise ValueError(f"no column name contains {mark!r}")
    by = list(keys)
    if by_category or by_gear:
        df = df.filter(F.col("category").isin(list(categories)))
        by.append("category")
    if by_gear:
        df = df.withColumn("gear", F.substring("fleet", 1, 3))
        by.append("gear")
    sums = df.groupBy(*by).agg(*[poison_sum(F.col(f"`{c}`")).alias(c) for c in columns])
    long = sums.unpivot(by, columns, "__name", "freq")
    return long.select(*by, digits("__name").alias("length"), "freq")
