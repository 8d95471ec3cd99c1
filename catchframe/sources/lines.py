"""Line scans with positions, for files that are more than one plain table.

Lines are read with splittable text scans.  A line's place in its file is
``(block, line)``: the start of the file split it was read from, and an id that
grows by one per line inside a split.

A quoted cell may hold line breaks, and such a record may run over file splits.  Whether a line starts inside of
quotes follows from the number of lines before it with an odd number of quotes.  One
small row per split holds that number, and a running sum over a file's splits gives each split's start.  Records
inside of a split are put together where its lines are read; only the lines of a record over the end of a split are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catchframe.functions import map_batches, stored, to_double

Paths = str | Sequence[str]
# Beyond so many rows a table with a row per file or file split is not broadcast.
MOST_BROADCAST = 50_000
SPLIT = ["file", "block"]
LAST_LINE = 2**63 - 1


def scan_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """Rows ``(file, block, line, value)``."""
    raw = spark.read.option("recursiveFileLookup", "true").text(paths if isinstance(paths, str) else list(paths))
    return placed_lines(raw)


def placed_lines(text: DataFrame) -> DataFrame:
    """Rows ``(file, block, line, value)`` of a text source, at rest or streamed."""
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value"),
    )


def odd_quotes(value: Column | str = "value") -> Column:
    """Does a line open or close a quoted cell?  A doubled quote inside of a cell does neither."""
    value = F.col(value) if isinstance(value, str) else value
    # Bytes, not characters: in text that is not UTF-8 a letter may seem to take in the quote after it.
    return (F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))) % 2 == 1


def file_splits(lines: DataFrame) -> DataFrame:
    """One stored row per file split: ``file``, ``block``, ``first`` (id of its first line), ``odd`` (lines with odd quotes).

    ``first_odd`` and ``last_odd`` are the ids of the first and last of these lines.
    """
    odd = F.when(odd_quotes(), F.col("line"))
    return stored(lines.groupBy(*SPLIT).agg(
        F.min("line").alias("first"), F.count(odd).alias("odd"), F.min(odd).alias("first_odd"), F.max(odd).alias("last_odd")
    ))


def first_lines(lines: DataFrame, splits: DataFrame, n: int) -> DataFrame:
    """One stored row per file: ``file``, ``first`` (id of its first line) and ``top``, its first ``n`` lines."""
    tops = splits.filter(F.col("block") == 0).select("file", "first")
    near = lines.filter(F.col("block") == 0).join(tops, "file").filter(F.col("line") - F.col("first") < n)
    rows = near.groupBy("file", "first").agg(F.array_sort(F.collect_list(F.struct("line", "value"))).alias("l"))
    return stored(rows.select("file", "first", F.transform("l", lambda x: x["value"]).alias("top")))


def joined_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in the order of their splits, each from the start of a record to the end of one, as records with the place of their first line."""
    held: list[pa.RecordBatch] = []
    inside, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        places, ids = batch.select(["file", "block", "line"]), np.asarray(batch.column("line"))
        falls = np.flatnonzero(np.diff(ids) <= 0).tolist()
        for a, b in [*([(last, 0)] if last else []), *[(places.slice(i, 1), i + 1) for i in falls]]:
            (a,), (b,) = a.to_pylist(), places.slice(b, 1).to_pylist()
            if (a["file"], a["block"]) == (b["file"], b["block"]) and a["line"] >= b["line"]:
                raise ValueError(f"lines of {a['file']} out of order")
        open_after = (inside + np.cumsum(np.asarray(pc.count_substring(batch.column("value"), '"')))) % 2
        last, inside = places.slice(batch.num_rows - 1, 1), int(open_after[-1])
        ends = np.flatnonzero(open_after == 0) + 1
        if not len(ends):
            held.append(batch)
            continue
        n, end = sum(h.num_rows for h in held), int(ends[-1])
        done = pa.concat_batches([*held, batch.slice(0, end)])
        held = [batch.slice(end)] if end < batch.num_rows else []
        cuts = pa.array(np.concatenate([[0], ends + n]), pa.int32())
        texts = pc.binary_join(pa.ListArray.from_arrays(cuts, done.column("value")), "\n")
        starts = done.select(["file", "block", "line"]).take(cuts.slice(0, len(ends)))
        yield pa.RecordBatch.from_arrays([*starts.columns, texts], names=["file", "block", "line", "value"])
    if held:
        raise ValueError("a record has no end")


def beside(lines: DataFrame, small: DataFrame, on: str | list[str]) -> tuple[DataFrame, bool]:
    """``lines`` with the columns of a stored table that has one row per file or split, and if they stay in their order."""
    if small.count() <= MOST_BROADCAST:
        return lines.join(F.broadcast(small), on), True
    return lines.join(small, on), False


def quoted_records(lines: DataFrame, splits: DataFrame, *, ordered: bool = False) -> DataFrame:
    """Rows ``(file, block, line, value)`` with lines that belong to one record put together.

    A record has the place of its first line.  A file whose last quote is not closed raises ``ValueError``.
    ``ordered`` says that the lines come in the order of their scan; others are sorted by split first.
    """
    odd = splits.filter("odd > 0")
    if odd.isEmpty():
        return lines
    broken = odd.groupBy("file").agg(F.sum("odd").alias("n")).filter("n % 2 = 1").agg(F.min("file")).first()[0]
    if broken is not None:
        raise ValueError(f"a quoted cell is not closed in {broken}")
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = splits.withColumn("__start", F.coalesce(F.sum("odd").over(earlier), F.lit(0))).withColumn("__end", F.col("__start") + F.col("odd"))
    # A split that starts inside of a record has the end of it up to its first line with odd quotes, if there is one;
    # one that ends inside of a record has the start of it from its last such line on.
    head = F.when(F.col("__start") % 2 == 1, F.when(F.col("odd") > 0, F.col("first_odd")).otherwise(LAST_LINE)).otherwise(-1)
    tail = F.when((F.col("__end") % 2 == 1) & (F.col("odd") > 0), F.col("last_odd")).otherwise(LAST_LINE)
    busy = stored(starts.filter("odd > 0 OR __start % 2 = 1").select(
        *SPLIT, head.alias("__head"), tail.alias("__tail"),
        F.floor(F.col("__start") / 2).alias("__before"), F.floor(F.col("__end") / 2).alias("__after"),
    ))
    columns = ["file", "block", "line", "value"]
    placed, broadcast = beside(lines, busy, SPLIT)
    calm = lines.join(F.broadcast(busy) if broadcast else busy, SPLIT, "left_anti").select(columns)
    in_head, in_tail = F.col("line") <= F.col("__head"), F.col("line") >= F.col("__tail")
    over = placed.filter(in_head | in_tail).groupBy("file", F.when(in_head, F.col("__before")).otherwise(F.col("__after")).alias("__record")).agg(
        F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("l")
    ).select("file", F.col("l")[0]["block"].alias("block"), F.col("l")[0]["line"].alias("line"),
             F.array_join(F.transform("l", lambda x: x["value"]), "\n").alias("value"))
    if not (ordered and broadcast):
        # A partitioning of one's own is not cut for skew, so a split's lines stay in one task.
        placed = lines.repartition(*SPLIT).join(busy, SPLIT).sortWithinPartitions(*SPLIT, "line")
    inside = placed.filter(~in_head & ~in_tail).select(columns)
    return calm.unionByName(map_batches(inside, joined_lines, "file string, block long, line long, value string")).unionByName(over)


def cells_of(value: Column | str, sep: str = "\t") -> Column:
    """Cells of a line as an array; quotes around a cell are taken off and may hold the separator."""
    value = F.col(value) if isinstance(value, str) else value
    plain = F.split(value, sep)
    # A separator counts outside quotes only: an even number of quotes follows it.
    quoted = F.transform(
        F.split(value, f'{sep}(?=(?:[^"]*"[^"]*")*[^"]*$)'),
        lambda t: F.regexp_replace(F.regexp_replace(t, '(?s)^ *"(.*)" *$', "$1"), '""', '"'),
    )
    return F.when(F.contains(value, F.lit('"')), quoted).otherwise(plain)


def header_and_body(
    spark: SparkSession, paths: str | Sequence[str], *, skip: int = 2, sep: str = "\t"
) -> tuple[DataFrame, DataFrame]:
    """``(file, names)`` and ``(file, cells)`` of tables whose header follows ``skip`` lines.

    Header and skipped lines lie in a file's first split.  The header table is stored, so it is read
    once and Spark knows its size.  Quotes in skipped lines mean nothing; a quoted cell of the body may hold
    separators, doubled quotes and line breaks, and run over file splits.  A header over several lines fails the job.
    """
    lines = scan_lines(spark, paths)
    splits = file_splits(lines)
    tops = first_lines(lines, splits, skip + 1)
    several = F.raise_error(F.concat(F.lit("a header runs over several lines in "), F.col("file"))).cast("string")
    top_line = F.get("top", F.lit(skip))
    found = tops.filter(F.size("top") > skip).select("file", F.when(odd_quotes(top_line), several).otherwise(top_line).alias("line"))
    header = found.select("file", F.transform(cells_of("line", sep), F.trim).alias("names"))
    # The lines before the body neither open nor close a cell.
    own = tops.select("file", F.lit(0).cast("long").alias("block"), F.size(F.filter("top", odd_quotes)).alias("__top"))
    counted = splits.join(own, ["file", "block"], "left").withColumn("odd", F.col("odd") - F.coalesce("__top", F.lit(0))).drop("__top")
    number = F.when(F.col("block") == 0, F.col("line") - F.col("first"))
    placed, ordered = beside(lines, tops.select("file", "first"), "file")
    placed = placed.filter(number.isNull() | (number > skip)).drop("first")
    body = quoted_records(placed, counted, ordered=ordered).filter(F.trim("value") != "")
    return header, body.select("file", cells_of("value", sep).alias("cells"))


def scan_skip_lines(spark: SparkSession, paths: str | Sequence[str], *, skip: int = 2, sep: str = "\t") -> DataFrame:
    """Rows ``(file, cells, names)``; ``names`` is the file's own header, so files may differ."""
    header, body = header_and_body(spark, paths, skip=skip, sep=sep)
    return body.join(header, "file")


def read_length_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    skip: int = 2,
    mark: str = "Lngt",
    year_pattern: str = r"(?<!\d)(\d{4})(?!\d)(?=[^/]*$)",
) -> DataFrame:
    """Length tables as ``(year, fleet, category, <length columns>)``; the year is in the file's name.

    The last match of ``year_pattern`` counts; a file without one fails the job.

    The length columns of all files are the union of their headers; a file
    without one of them has missing cells there.
    """
    header, body = header_and_body(spark, paths, skip=skip)
    names = header.select(F.explode("names").alias("n")).filter(F.col("n").contains(mark)).distinct().collect()
    lengths = sorted(
        (row["n"] for row in names), key=lambda n: (int("".join(ch for ch in n if ch.isdigit()) or 0), n)
    )
    wanted = {"Fleets": "fleet", "CatchCategory": "category", **{n: n for n in lengths}}
    # Where each column stands is looked up once per file, not per row.
    places = header.select("file", *[
        (F.array_position("names", old) - 1).cast("int").alias(f"__at{i}") for i, old in enumerate(wanted)
    ])
    cells = {new: F.get("cells", F.when(F.col(f"__at{i}") >= 0, F.col(f"__at{i}"))) for i, new in enumerate(wanted.values())}
    return body.join(places, "file").select(
        F.coalesce(
            F.try_element_at(F.regexp_extract_all("file", F.lit(year_pattern), F.lit(1)), F.lit(-1)).cast("int"),
            F.raise_error(F.concat(F.lit("no year in the name of "), F.col("file"))).cast("int"),
        ).alias("year"),
        *[(to_double(c) if new in lengths else c).alias(new) for new, c in cells.items()],
    )
