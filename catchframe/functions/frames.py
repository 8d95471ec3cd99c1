"""Join and pivot helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchframe.functions.semantics import poison_avg, poison_sum
from catchframe.session import shared_dir


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` in which missing keys match each other.

    ``<=>`` stays an equi-join for Spark, so AQE may broadcast a small side or
    split a skewed partition.
    """
    tmp = {k: f"__r_{k}" for k in keys}
    renamed = right.withColumnsRenamed(tmp)

    def same(k: str) -> Column:
        l, r = left[k], renamed[tmp[k]]
        # Without missing keys '=' means the same and keeps an existing partitioning.
        can_miss = left.schema[k].nullable and right.schema[k].nullable
        return l.eqNullSafe(r) if can_miss else l == r

    cond = reduce(lambda a, b: a & b, [same(k) for k in keys])
    out = left.join(renamed, cond, how)
    if how in ("left_semi", "left_anti"):
        return out
    if how in ("full", "right"):
        out = out.withColumns({k: F.coalesce(F.col(k), F.col(tmp[k])) for k in keys})
    return out.drop(*tmp.values())


def attach(df: DataFrame, stat: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Put one statistics row per key next to each row of ``df``.

    The statistics come from a ``groupBy`` with map-side partial aggregation and
    are joined back, so that a key with a large part of all rows never has to
    fit in one window partition.  Without keys ``stat`` is a global aggregate of
    exactly one row; that one row is the only thing broadcast by hint.
    """
    if not keys:
        return df.crossJoin(F.broadcast(stat))
    return null_safe_join(df, stat, keys, "left")


def stored(df: DataFrame) -> DataFrame:
    """Write a small table to the shared folder and read it back.

    Spark then knows its size and broadcasts it by its own limit, so a large
    table joined to it is not shuffled; the file also outlives lost executors.
    """
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def conditional_pivot(
    df: DataFrame,
    keys: Sequence[str],
    on: str,
    columns: Mapping[str, str],
    value: Column | str,
    agg: Callable[[Column], Column],
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Pivot with known values ``{output column: value of on}``.

    One hash aggregation with one conditional aggregate per value: a single
    shuffle of partial results.  A cell without rows is missing.
    """
    value = F.col(value) if isinstance(value, str) else value
    cells = [agg_where(agg, value, F.col(on) == F.lit(wanted)).alias(name) for name, wanted in columns.items()]
    return df.groupBy(*keys).agg(*cells, *extra)


def agg_where(agg: Callable[[Column], Column], value: Column, hit: Column) -> Column:
    """``agg`` over the rows where ``hit`` holds, missing without such rows."""
    inside = F.when(hit, value)
    if agg in (poison_sum, poison_avg):
        known = F.bool_and(F.when(hit, value.isNotNull()))
        return F.when(known, F.sum(inside) if agg is poison_sum else F.avg(inside))
    return F.when(F.count(F.when(hit, 1)) > 0, agg(inside))
