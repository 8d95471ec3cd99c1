"""Files to catch tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchframe import sources
from catchframe.functions import clean_nan, stored
from catchframe.operators import composition, landings, quota
from catchframe.sources import schemas


@dataclass(frozen=True)
class CatchFiles:
    """Where the inputs are.  ``preliminary`` is in the order of the years; the last one is the newest."""

    historical: str
    dataset: str
    preliminary: Sequence[str]
    detailed: str
    quota: str
    combined_quota: str
    quota_column: str = "Agreed TAC 2a4"
    combined_quota_column: str = "Agreed.TAC.2a3a47de"


def catch_tables(spark: SparkSession, files: CatchFiles, *, splice_year: int = 2014) -> dict[str, DataFrame]:
    """All tables of the catch run, by name.

    The text files are parsed once, when the run is built: their typed rows are stored for the tables that share them.
    """
    historical = stored(sources.read_historical(spark, files.historical))
    dataset = stored(sources.read_dataset(spark, files.dataset))
    preliminary = stored(sources.read_preliminary(spark, list(files.preliminary)))
    newest = sources.read_preliminary(spark, [files.preliminary[-1]])

    # Stored by year, so earlier years are never read.
    detailed = spark.read.schema(schemas.DETAILED_CATCHES).parquet(files.detailed)
    detailed = detailed.filter(F.col("year") >= splice_year).withColumn("caton", clean_nan("caton"))

    official = landings.combined_landings(
        landings.dataset_landings(dataset),
        landings.historical_landings(historical),
        landings.preliminary_landings(preliminary),
    )
    catches = composition.detailed_catches(detailed)
    yearly = quota.stacked_species(
        quota.two_species_historical(historical),
        quota.two_species_dataset(dataset),
        quota.two_species_preliminary(preliminary),
    )
    return {
        "official_landings": official,
        "bms_landings": landings.bms_landings(preliminary),
        "detailed": detailed,
        "detailed_catches": catches,
        "discard_measures": composition.discard_measures(detailed),
        "catch_series": landings.spliced_catch_series(official, catches, splice_year=splice_year),
        "quota_uptake": quota.quota_uptake(yearly, sources.read_quota(spark, files.quota, files.quota_column)),
        "combined_quota_uptake": quota.quota_uptake(
            quota.yearly_preliminary(newest),
            sources.read_quota(spark, files.combined_quota, files.combined_quota_column, mangle=True),
        ),
    }
