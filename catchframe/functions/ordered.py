"""Ranks and running sums by range partitions: no group is one window, however many rows or ties it has.

Rows are dealt to range partitions by ``(keys, order)`` and sorted there.  The sorted table
is stored, since the partition bounds come from a sample and must not be drawn again.  Sums per
partition and key are a small table; their running sums are the starts of the partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catchframe.functions.frames import null_safe_join, stored

AT = "__at"
PART = "__part"


def in_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``df`` with ``__at``, which grows along ``keys`` and ``order``, and ``__part``, the range partition.

    The upper bits of ``__at`` are the partition, the lower ones the row in it.  Rows that are equal
    in ``keys`` and ``order`` share a partition: end ``order`` in columns that tell them apart.
    """
    by = [*[F.col(f"`{k}`") for k in keys], *order]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(AT, F.monotonically_increasing_id())
    return stored(placed.withColumn(PART, F.shiftright(AT, 33)))


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """``df`` with the place of each row in its key, from 0, as a long; the rows are not shuffled after the sort."""
    placed = in_order(df, keys, order)
    sums = placed.groupBy(*keys, PART).agg(F.min(AT).alias("__first"), F.count(F.lit(1)).alias("__n"))
    starts = stored(sums.withColumn("__start", F.coalesce(F.sum("__n").over(_earlier(keys)), F.lit(0))).drop("__n"))
    joined = null_safe_join(placed, starts, [*keys, PART], "left")
    return joined.withColumn(out, F.col(AT) - F.col("__first") + F.col("__start")).drop(AT, PART, "__first", "__start")


def running_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], sums: Mapping[str, str], *, total_by: Sequence[str] | None = None
) -> DataFrame:
    """``df`` with running sums ``{out: value}`` per key; a missing value makes it and all later sums missing.

    The window runs inside one key of one range partition.  ``out + "_total"`` is the sum of the known values per
    ``total_by``, which are some of the keys; without it, per key.
    """
    placed = in_order(df, keys, order)
    cell = [*keys, PART]
    per_cell = placed.groupBy(*cell).agg(*[
        c for out, value in sums.items() for c in (
            F.sum(value).alias(f"__{out}_sum"), F.bool_and(F.col(f"`{value}`").isNotNull()).alias(f"__{out}_known"),
        )
    ])
    whole = W.partitionBy(*(keys if total_by is None else total_by))
    starts = stored(per_cell.select(*cell, *[
        c for out in sums for c in (
            F.coalesce(F.sum(f"__{out}_sum").over(_earlier(keys)), F.lit(0)).alias(f"__{out}_start"),
            F.coalesce(F.bool_and(f"__{out}_known").over(_earlier(keys)), F.lit(True)).alias(f"__{out}_ok"),
            F.sum(f"__{out}_sum").over(whole).alias(f"{out}_total"),
        )
    ]))
    inside = W.partitionBy(*cell).orderBy(AT).rowsBetween(W.unboundedPreceding, W.currentRow)
    here = placed.select("*", *[
        F.when(F.bool_and(F.col(f"`{value}`").isNotNull()).over(inside), F.sum(value).over(inside)).alias(f"__{out}_here")
        for out, value in sums.items()
    ])
    joined = null_safe_join(here, starts, cell, "left")
    done = joined.withColumns({
        out: F.when(F.col(f"__{out}_ok"), F.col(f"__{out}_start") + F.col(f"__{out}_here")) for out in sums
    })
    return done.drop(AT, PART, *[f"__{out}_{x}" for out in sums for x in ("start", "ok", "here")])


def _earlier(keys: Sequence[str]) -> W:
    """The earlier range partitions of a key: one row each."""
    return W.partitionBy(*keys).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
