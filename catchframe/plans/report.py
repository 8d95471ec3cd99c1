"""Official landings to report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from catchframe.operators import tables


def report_tables(official: DataFrame, *, keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Country tables of the three area groups and the yearly shares."""
    summary = tables.landings_summary(official, keys=keys)
    return {
        "landings_3a": tables.table_poison(summary, keys=keys),
        "landings_4": tables.table_total_first(summary, keys=keys),
        "landings_7de": tables.table_explicit_total(summary, keys=keys),
        "area_share": tables.area_share(summary, keys=keys),
        "country_share": tables.country_share(summary, keys=keys),
    }
