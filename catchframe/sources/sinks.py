"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from catchframe.functions import ranked
from catchframe.sources.delimited import scan_with_files, typed

PART_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, *, quote: bool = False, na: str = "NA") -> str:
    """Clean table as a folder of CSV files with headers; ``quote`` quotes every cell.

    A quote inside of a cell is doubled; separators and line breaks stand in quotes.
    """
    df.write.mode("overwrite").options(**_options(quote, na)).csv(path)
    return path


def _options(quote: bool, na: str) -> dict[str, str]:
    return {"header": "true", "nullValue": na, "quoteAll": str(quote).lower(), "quote": '"', "escape": '"'}


def write_table(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), only_new: bool = False) -> str:
    """Typed table as Parquet, partitioned so that readers can prune.

    Rows are rebalanced by the partition columns first: few files per value, and
    AQE splits a value that holds a large part of all rows.  With ``only_new`` the partitions that ``df`` has no
    row of stay as they are.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if only_new:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return path


def write_parts(
    df: DataFrame, path: str, order: Sequence[Column], *, rows: int = PART_ROWS, quote: bool = False, na: str = "NA"
) -> str:
    """Table in report order: numbered parts ``part=<n>`` of at most ``rows`` rows, and a manifest of them.

    The order is made by range partitions, so no task sorts the table.  The manifest, a table in ``_manifest``, has
    a row per part: ``part``, ``rows`` and ``first``, the place of its first row.
    """
    placed = ranked(df, [], order, "__place").withColumn("part", F.floor(F.col("__place") / rows))
    # A part is one task and one file: its rows are bounded.
    spread = placed.repartition("part").sortWithinPartitions("part", "__place").drop("__place")
    spread.write.mode("overwrite").partitionBy("part").options(**_options(quote, na)).csv(path)
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.min("__place").alias("first"))
    parts.write.mode("overwrite").parquet(f"{path}/_manifest")
    return path


def read_parts(spark: SparkSession, path: str, schema: T.StructType, *, na: str = "NA") -> DataFrame:
    """The rows of ``write_parts`` with ``place``, from 0, in the order in which they were written.

    A part with another number of rows than the manifest says fails the job.
    """
    manifest = spark.read.parquet(f"{path}/_manifest")
    raw = scan_with_files(spark, path, na=na, mangle=False, positions=True)
    part = F.regexp_extract("__file", r"part=(\d+)", 1).cast("long")
    numbered = raw.withColumn("__part", part).withColumn(
        "__n", F.row_number().over(W.partitionBy("__part").orderBy("__block", "__line"))
    ).withColumn("__all", F.count(F.lit(1)).over(W.partitionBy("__part")))
    joined = numbered.join(manifest, numbered["__part"] == manifest["part"], "full")
    wrong = F.raise_error(F.concat(F.lit("rows and manifest disagree on part "), F.coalesce("__part", "part").cast("string"))).cast("long")
    place = F.when(F.col("__all") == F.col("rows"), F.col("first") + F.col("__n") - 1).otherwise(wrong)
    return joined.select(*[typed(f"`{f.name}`", f.dataType).alias(f.name) for f in schema.fields], place.alias("place"))
