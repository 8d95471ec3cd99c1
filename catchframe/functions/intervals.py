"""Points joined to the ranges that hold them, and runs of whole numbers as ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchframe.functions.frames import null_safe_join

FIRST, LAST = "first", "last"


def runs_of(numbers: Column) -> Column:
    """An array of whole numbers as its runs of neighbours: sorted structs of ``first`` and ``last``.

    Repeated and missing numbers do not count; an empty array has no runs.  The work is quadratic in the different numbers,
    so it is meant for years and the like.
    """
    known = F.array_sort(F.array_distinct(F.array_compact(numbers)))
    starts = F.filter(known, lambda n: ~F.array_contains(known, n - 1))
    ends = F.filter(known, lambda n: ~F.array_contains(known, n + 1))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias(FIRST), b.alias(LAST)))


def interval_join(
    points: DataFrame, ranges: DataFrame, keys: Sequence[str], point: str, *, width: int = 32
) -> DataFrame:
    """One row per point and range of the same key that holds it, ends included.

    ``ranges`` has ``(*keys, ..., first, last)`` in whole numbers.  Both sides are joined on the key and the point's bin of
    ``width``: a point is in one bin and is not repeated, a range is repeated once per bin that it touches, so each pair
    is found once and a key with many rows is dealt to its bins.  Missing keys match each other; a missing point or end,
    or a range that ends before it starts, matches nothing.  The columns ``first`` and ``last`` go.
    """
    if width < 1:
        raise ValueError("a bin needs a width of 1 or more")

    def bin_of(c: str) -> Column:
        return F.floor(F.col(c) / width)

    placed = points.filter(F.col(point).isNotNull()).withColumn("__bin", bin_of(point))
    renamed = ranges.withColumnsRenamed({FIRST: "__first", LAST: "__last"}).filter(F.col("__first") <= F.col("__last"))
    cut = renamed.withColumn("__bin", F.explode(F.sequence(bin_of("__first"), bin_of("__last"))))
    pairs = null_safe_join(placed, cut, [*keys, "__bin"], "inner")
    return pairs.filter(F.col(point).between(F.col("__first"), F.col("__last"))).drop("__bin", "__first", "__last")
