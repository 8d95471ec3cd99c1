"""Write a run's tables."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame

from catchframe.sources import write_csv, write_table


def write_tables(
    tables: Mapping[str, DataFrame], folder: str, *, form: str = "csv", quoted: Collection[str] = ("detailed",)
) -> dict[str, str]:
    """Each table to ``folder/<name>`` as CSV or Parquet; returns the paths."""
    if form not in ("csv", "parquet"):
        raise ValueError("form is 'csv' or 'parquet'")
    paths = {}
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{name}"
        paths[name] = write_table(df, path) if form == "parquet" else write_csv(df, path, quote=name in quoted)
    return paths
