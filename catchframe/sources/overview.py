"""Stock overview and sampled numbers, tab-separated, columns partly known by position only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchframe.functions import to_double
from catchframe.sources.delimited import named_at, scan_text_table

# Positions (from 1) of the renamed columns.
OVERVIEW_POSITIONS = {7: "Fleet", 10: "CatchWt", 11: "CatchCat", 12: "ReportCat"}
NUMBERS_POSITIONS = {7: "CatchCat", 9: "Fleet"}
NUMBERS_KEPT = (3, 4, 5, 7, 9, 10, 11)


def read_overview(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Stock overview: all columns but the last one, the known ones under clean names."""
    raw = scan_text_table(spark, paths, sep="\t", names=named_at(OVERVIEW_POSITIONS, last=False))
    known = {
        "Stock": "stock", "Country": "country", "Area": "area", "Season": "season", "Fleet": "fleet",
        "CatchCat": "category", "CatchWt": "catch_wt", "ReportCat": "report_category",
    }
    named = raw.withColumnsRenamed(known).withColumn("catch_wt", to_double("catch_wt"))
    first = list(known.values())
    return named.select(*first, *[F.col(f"`{c}`") for c in named.columns if c not in first])


def read_sampled_numbers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Sampled numbers at age or length: the kept positions under clean names."""
    renamed = named_at(NUMBERS_POSITIONS)

    def names(header: list[str]) -> list[str | None]:
        return [n if i in NUMBERS_KEPT else None for i, n in enumerate(renamed(header), start=1)]

    known = {
        "Area": "area", "Season": "season", "Country": "country", "CatchCat": "category",
        "Fleet": "fleet", "SampledCatch": "sampled_catch",
    }
    kept = scan_text_table(spark, paths, sep="\t", names=names)
    return kept.withColumnsRenamed(known).withColumn("sampled_catch", to_double("sampled_catch"))
