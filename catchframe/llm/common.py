"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchframe.session import shared_dir

# White space of the word rule: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
PIECE_BYTES = 2 << 20
ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` by a function of this package, which workers find where the driver found it.

    On a cluster the package is installed, or shipped with ``--py-files``.
    """
    paths = df.sparkSession.sparkContext.environment
    if ROOT not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(p for p in (paths.get("PYTHONPATH"), ROOT) if p)
    return df.mapInArrow(run, schema)


def stored(df: DataFrame, name: str, partitions: Sequence[str] = ()) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and outlives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}"
    writer = df.write.partitionBy(*partitions) if partitions else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; -1 for a missing id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus, F.lit(-1)).cast("int")


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``limit`` bytes together, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    group = np.cumsum(np.asarray(sizes, dtype=np.int64)) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def with_columns_of_text(
    df: DataFrame,
    column: str,
    make: Callable[[], Callable[[list], Sequence[pa.Array]]],
    fields: Sequence[T.StructField],
    keep: bool = True,
) -> DataFrame:
    """All columns of ``df`` and the columns that a function makes of lists of texts.

    ``make`` builds the function once in each task.  A column of ``df`` with the name
    of a new one is replaced.  Without ``keep`` the text does not come back from Python.
    """
    df = df.drop(*[f.name for f in fields if f.name.lower() != column.lower()])
    schema = T.StructType([*[f for f in df.schema.fields if keep or f.name != column], *fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for part in pieces(batch, column):
                made = fn(part.column(part.schema.get_field_index(column)).to_pylist())
                held = [c for c, name in zip(part.columns, part.schema.names) if keep or name != column]
                yield pa.RecordBatch.from_arrays([*held, *made], names=names)
            # What a worker does not need between batches goes back to the machine.
            pa.default_memory_pool().release_unused()

    return map_arrow(df, run, schema)
