"""Sectioned text reports: a marker line, then a stream of tab-separated tokens in rows of fixed width."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catchframe.functions import map_batches, stored, to_double
from catchframe.sources.lines import MOST_BROADCAST, SPLIT, file_splits, quoted_records, scan_lines

# Layout of the catch-and-sample report.
MARKER = "TABLE 2."
WIDTH = 27
HEADER_AFTER = 3
ROWS_AFTER_HEADER = 56

REPORT_NAMES = {
    "Stock": "stock",
    "Country": "country",
    "Area": "area",
    "Season": "season",
    "Fleet": "fleet",
    "CatchCategory": "category",
    "CATONRaisedOrImported": "origin",
    "CATON": "caton",
    "CANUM": "canum",
    "WECA": "weca",
    "AgeOrLength": "age_or_length",
    "Sex": "sex",
    "LECA": "leca",
}


# A cell in quotes, or one without; quotes inside of a cell without are plain.
CELL = re.compile(r' *"((?:[^"]|"")*)" *(?=\t|\Z)|([^\t]*)')
# A cell that begins with a quote and is not closed in its line.
LEFT_OPEN = re.compile(r'(?:^|\t) *"(?:[^"]|"")*$')
SUMMARY_ARROW = pa.schema([
    ("file", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("mark", pa.int64()), ("open", pa.bool_()),
    ("after", pa.list_(pa.string())), ("head", pa.list_(pa.string())), ("tail", pa.list_(pa.string())),
])
SUMMARY = "file string, block long, n long, mark long, open boolean, after array<string>, head array<string>, tail array<string>"


def tokens(line: str) -> list[str]:
    """Tokens of a line; quotes around a token are taken off and may hold the separator."""
    if '"' not in line:
        return line.split("\t")
    out, at = [], 0
    while at <= len(line):
        cell = CELL.match(line, at)
        out.append(cell[2] if cell[1] is None else cell[1].replace('""', '"'))
        at = cell.end() + 1
    return out


def split_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.Array, bool]]:
    """Per run of lines of one file split: its first row, all tokens, and if a line ends inside of a cell.

    The lines are in the last column, and come in the order of their splits.  Blank lines have no tokens; empty cells are tokens.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column(0).dictionary_encode().indices, batch.column(1)
        changes = (np.diff(np.asarray(files)) != 0) | (np.diff(np.asarray(blocks)) != 0)
        cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
        for a, b in pairwise(cuts):
            lines = batch.column(batch.num_columns - 1).slice(a, b - a)
            lines = lines.filter(pc.not_equal(pc.utf8_trim(lines, " "), ""))
            row = batch.slice(a, 1).drop_columns(batch.schema.names[-1:]).to_pylist()[0]
            if pc.any(pc.match_substring(lines, '"')).as_py():
                texts = lines.to_pylist()
                yield row, pa.array([t for line in texts for t in tokens(line)], pa.string()), any(map(LEFT_OPEN.search, texts))
            else:
                yield row, pc.split_pattern(lines, "\t").flatten(), False


def split_summary(lines: DataFrame, marker: str, width: int, header_end: int) -> DataFrame:
    """One stored row per file split, made in one scan without a shuffle.

    ``n`` tokens; ``mark``, the place of the first marker; ``open``, if a line ends inside of a cell; ``after``, it and the tokens
    up to the header's end; ``head`` and ``tail``, the first and last tokens that rows or a header over several splits need.
    """
    reach = max(width - 1, header_end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        for row, here, left_open in split_tokens(batches):
            if not done or any(done[-1][c] != row[c] for c in SPLIT):
                done.append({**row, "n": 0, "mark": None, "open": False, "after": [], "head": [], "tail": []})
            now = done[-1]
            now["open"] |= left_open
            now["head"] += here[:reach - len(now["head"])].to_pylist()
            if now["mark"] is not None:
                now["after"] += here[:header_end - len(now["after"])].to_pylist()
            elif (at := pc.index(here, marker).as_py()) >= 0:
                now["mark"], now["after"] = now["n"] + at, here[at:at + header_end].to_pylist()
            now["n"] += len(here)
            ends = now["tail"] + here[max(len(here) - width + 1, 0):].to_pylist()
            now["tail"] = ends[max(len(ends) - width + 1, 0):]
        if done:
            yield pa.RecordBatch.from_pylist(done, SUMMARY_ARROW)

    return stored(map_batches(lines.select("file", "block", "value"), run, SUMMARY))


def whole_records(lines: DataFrame, splits: DataFrame) -> DataFrame | None:
    """``lines`` with cells over several lines put together, in no order; ``None`` if there are none.

    Only files with a line that ends inside of a cell are looked at; one that never closes it raises ``ValueError``.
    """
    files = splits.filter("open").select("file").distinct()
    if files.isEmpty():
        return None
    return quoted_records(lines, file_splits(lines.join(files, "file", "left_semi")), ordered=True)


def _straddling(splits: DataFrame, width: int) -> DataFrame:
    """Rows ``(file, cells)`` that run over the end of a split, put together from the splits' ends."""
    at, n = F.col("at"), F.col("n")
    end = at + n
    rest, over = at % width, end % width

    def piece(row: Column, place: Column, cells: Column) -> Column:
        return F.struct(row.cast("long").alias("row"), place.cast("long").alias("place"), cells.alias("cells"))

    lead = piece(F.floor(at / width), at, F.slice("head", F.lit(1), F.least(width - rest, n).cast("int")))
    trail = piece(F.floor(end / width), end - over, F.slice("tail", (F.size("tail") - over + 1).cast("int"), over.cast("int")))
    # A split inside of one row is its lead alone.
    pieces = F.array_compact(F.array(
        F.when((at > 0) & (rest != 0) & (n > 0), lead), F.when((end > 0) & (over != 0) & (over <= n), trail)
    ))
    return (
        splits.select("file", F.explode(pieces).alias("p")).select("file", "p.*").groupBy("file", "row")
        .agg(F.array_sort(F.collect_list(F.struct("place", "cells"))).alias("pieces"))
        .select("file", F.flatten(F.transform("pieces", lambda p: p["cells"])).alias("cells"))
    )


def section(
    spark: SparkSession, paths: str | Sequence[str], *, marker: str, width: int, header_after: int, rows_after_header: int
) -> tuple[DataFrame, DataFrame]:
    """Rows ``(file, cells)`` of the section after ``marker``, and ``(file, names)``, its header.

    A first scan makes a small row per file split.  Running sums of the tokens of a file's splits say where in a row each
    split starts, so the second scan cuts its lines into rows as they come; rows over a split's end come from the small rows.
    A quoted cell may hold line breaks and run over splits; files with such a cell are put in records first.
    """
    if rows_after_header < width:
        raise ValueError("rows must start after the header")
    lines = scan_lines(spark, paths)
    header_end = header_after + width
    splits = split_summary(lines, marker, width, header_end)
    records = whole_records(lines, splits)
    if records is not None:
        lines = records.repartition(*SPLIT)
        splits = split_summary(lines.sortWithinPartitions(*SPLIT, "line"), marker, width, header_end)
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    started = splits.withColumn("__start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    first = started.filter("mark IS NOT NULL").groupBy("file").agg(
        F.min(F.struct("block", (F.col("__start") + F.col("mark")).alias("place"))).alias("__first")
    )
    placed = stored(
        started.join(first, "file").filter(F.col("block") >= F.col("__first.block"))
        .withColumn("__place", F.col("__start") - F.col("__first.place"))
        .withColumn("at", F.col("__place") - header_after - rows_after_header)
        .select("file", "block", "n", "at", "head", "tail", "__place", F.when(F.col("block") == F.col("__first.block"), F.col("after")).alias("after"))
    )
    # The marker has place 0.  The header is in what follows it, and in the first tokens of the next splits.
    start = F.greatest("__place", F.lit(0))
    cells = F.coalesce("after", "head")
    skipped = F.greatest(header_after - start, F.lit(0))
    kept = F.slice(cells, (skipped + 1).cast("int"), F.greatest(header_end - start - skipped, F.lit(0)).cast("int"))
    names = stored(
        placed.filter(start < header_end).groupBy("file")
        .agg(F.array_sort(F.collect_list(F.struct(start.alias("place"), kept.alias("cells")))).alias("p"))
        .select("file", F.flatten(F.transform("p", lambda p: p["cells"])).alias("names"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, skip, held = None, 0, None
        for row, here, _ in split_tokens(batches):
            if row != split:
                # Tokens up to the first whole row of the split are skipped.
                split, skip, held = row, -row["at"] if row["at"] < 0 else -row["at"] % width, None
            dropped = min(skip, len(here))
            skip, here = skip - dropped, here.slice(dropped)
            if held is not None:
                here = pa.concat_arrays([held, here])
            n = len(here) // width
            held = here.slice(n * width)
            if n:
                ends = pa.array(np.arange(0, (n + 1) * width, width), pa.int32())
                cells = pa.ListArray.from_arrays(ends, here.slice(0, n * width))
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(row["file"], pa.string()), n), cells], names=["file", "cells"])

    offsets = placed.select("file", "block", "at")
    if records is None and offsets.count() <= MOST_BROADCAST:
        # One short row per split, and not more than the bound: lines stay in the order of the scan.
        ordered = lines.join(F.broadcast(offsets), SPLIT)
    else:
        # A partitioning of one's own is not cut for skew, so a split's lines stay in one task.
        ordered = lines.repartition(*SPLIT).join(offsets, SPLIT).sortWithinPartitions(*SPLIT, "line")
    inside = map_batches(ordered.select("file", "block", "at", "value"), run, "file string, cells array<string>")
    return inside.unionByName(_straddling(placed, width)), names


def scan_section(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    marker: str = MARKER,
    width: int = WIDTH,
    header_after: int = HEADER_AFTER,
    rows_after_header: int = ROWS_AFTER_HEADER,
) -> DataFrame:
    """Rows ``(file, cells, names)`` of the section after ``marker``.

    The header is ``width`` tokens from ``header_after`` tokens past the marker;
    rows start ``rows_after_header`` tokens after the header's first token.
    """
    rows, names = section(
        spark, paths, marker=marker, width=width, header_after=header_after, rows_after_header=rows_after_header
    )
    return rows.join(names, "file")


def read_catch_report(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    names: Mapping[str, str] = REPORT_NAMES,
    marker: str = MARKER,
    width: int = WIDTH,
    header_after: int = HEADER_AFTER,
    rows_after_header: int = ROWS_AFTER_HEADER,
) -> DataFrame:
    """Catch-and-sample table of the report: named columns, weights and numbers typed.

    ``others`` has the cells under all other names, so that lines that differ in one of them stay apart.
    """
    rows, header = section(
        spark, paths, marker=marker, width=width, header_after=header_after, rows_after_header=rows_after_header
    )
    # Where each name stands is looked up once per file, not per row.
    known = F.array(*[F.lit(n) for n in names])
    at = [F.array_position("names", old).cast("int").alias(f"__at{i}") for i, old in enumerate(names)]
    other = F.filter(F.sequence(F.lit(1), F.size("names")), lambda i: ~F.array_contains(known, F.coalesce(F.element_at("names", i), F.lit(""))))
    places = stored(header.select("file", *at, other.alias("__others")))
    # A row cut short at the end of its file lacks its last cells.
    cells = [F.get("cells", F.when(F.col(f"__at{i}") > 0, F.col(f"__at{i}") - 1)).alias(new) for i, new in enumerate(names.values())]
    others = F.transform("__others", lambda i: F.get("cells", i - 1)).alias("others")
    wide = rows.join(places, "file").select("file", *cells, others)
    numeric = [c for c in ("caton", "canum", "weca", "age_or_length") if c in wide.columns]
    return wide.withColumns({c: to_double(c) for c in numeric})
