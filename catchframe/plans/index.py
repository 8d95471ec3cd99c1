"""Survey files to index tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchframe import sources
from catchframe.operators import indices
from catchframe.sources import schemas
from catchframe.sources.delimited import Paths

HEADER = {"timeI": "time", "ObsI": "obs", "CV": "cv"}


@dataclass(frozen=True)
class IndexFiles:
    """Where the survey files are.  The two semester files begin with a column of row numbers, the historical ones do not."""

    semester1: Paths
    semester2: Paths
    historical: Paths


def index_tables(spark: SparkSession, files: IndexFiles, *, keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The three series as they are, stacked for the model (``index``), and normalised under their labels with the band.

    ``keys`` are text columns of the files, such as a stock.
    """
    schema = T.StructType([*[T.StructField(k, schemas.TEXT) for k in keys], *schemas.INDEX.fields])
    series = {
        name: sources.read_clean_table(spark, paths, schema, rename=HEADER, drop_first=name != "hist")
        for name, paths in (("sem1", files.semester1), ("sem2", files.semester2), ("hist", files.historical))
    }
    stacked = None
    for name, df in series.items():
        part = df.select(*keys, F.lit(name).alias("index"), *schemas.INDEX.names)
        stacked = part if stacked is None else stacked.unionByName(part)
    combined = indices.labelled_index(stacked, indices.SERIES_LABELS, keys=keys)
    return {
        **{f"index_{name}": df for name, df in series.items()},
        "index": stacked,
        "index_band": indices.deviation_band(combined, keys=keys),
    }
