"""Yearly refresh: files that were not read before, and the years that they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catchframe.sources import read_preliminary, write_table

# Columns of a listing of files; the content is not read.
LISTING = "path string, modificationTime timestamp, length long, content binary"


def refresh_preliminary(spark: SparkSession, folder: str, out: str, log: str, *, pattern: str = "*.csv") -> int:
    """Read the preliminary files of ``folder`` that no earlier run has read and rewrite their years in ``out``.

    A file source keeps the names of the files that it has seen in ``log``; one run takes all that is there.  ``out`` is
    partitioned by year, and years without a new file keep their files as they are.  A run that is lost
    half-way is done again with the same files, which rewrites the same years.  Returns the number of new files.
    """
    read: list[str] = []

    def take(batch: DataFrame, _: int) -> None:
        # One path per new file.
        paths = sorted(row["path"] for row in batch.collect())
        if paths:
            write_table(read_preliminary(spark, paths), out, partition_by=["year"], only_new=True)
            read.extend(paths)

    files = spark.readStream.format("binaryFile").schema(LISTING).options(
        recursiveFileLookup="true", pathGlobFilter=pattern
    ).load(folder).select("path")
    run = files.writeStream.foreachBatch(take).option("checkpointLocation", log).trigger(availableNow=True).start()
    run.awaitTermination()
    return len(read)
