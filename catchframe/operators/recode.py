"""Code harmonisation: many raw labels to one code, unlisted labels to missing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchframe.functions import null_safe_join
from catchframe.functions.semantics import as_col


def recode(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Look a label up in a constant map; no join and no shuffle."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), as_col(c))


def merge_codes(c: Column | str, codes: Sequence[str], into: str) -> Column:
    """Rename some codes and keep all others, missing ones included."""
    c = as_col(c)
    return F.when(c.isin(list(codes)), F.lit(into)).otherwise(c)


def code_order(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Position of a code in the ordered code list, for sorting."""
    pairs = [F.lit(x) for i, code in enumerate(dict.fromkeys(mapping.values())) for x in (code, i)]
    return F.try_element_at(F.create_map(*pairs), as_col(c))


def recode_by_table(df: DataFrame, dim: DataFrame, column: str, raw: str = "raw", code: str = "code") -> DataFrame:
    """Same lookup for a map kept as a table with one row per raw label.

    Spark picks the join from the table's size; no hint is given.
    """
    lookup = dim.dropDuplicates([raw]).select(F.col(raw).alias(column), F.col(code).alias("__code"))
    out = null_safe_join(df, lookup, [column], "left")
    return out.withColumn(column, F.col("__code")).drop("__code")
