"""Delimited files: all columns are scanned as text and typed afterwards."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchframe import codes
from catchframe.functions import to_double, to_int
from catchframe.sources.lines import Paths, file_splits, first_lines, quoted_records, scan_lines

# Wanted column -> header names that may carry it, the first one present wins.
PRELIMINARY = {
    "year": ("Year",),
    "species_latin": ("Species.Latin.Name",),
    "area": ("Area",),
    "country": ("Country",),
    "ams": ("AMS_Catch", "AMS.Catch.TLW."),
    "bms": ("BMS_Catch", "BMS.Catch.TLW."),
}


def header_name(text: str) -> str:
    """Header text as a plain name: punctuation to dots, an ``X`` before a leading digit."""
    name = re.sub(r"[^A-Za-z0-9._]", ".", text.strip().strip('"'))
    return f"X{name}" if name[:1].isdigit() or not name else name


def header_cells(header: str, sep: str, mangle: bool) -> list[str]:
    """Names in a header line; blank ones and repeated ones get their position."""
    cells = next(csv.reader([header], delimiter=sep), [])
    names = [header_name(c) if mangle else c.strip() for c in cells]
    return [n if n and n not in names[:i] else f"{n or '_c'}{i}" for i, n in enumerate(names)]


def scan_with_files(
    spark: SparkSession,
    paths: Paths,
    *,
    sep: str = ",",
    na: str = "NA",
    mangle: bool = True,
    names: Callable[[list[str]], list[str | None]] | None = None,
    lines: DataFrame | None = None,
    constants: Sequence[str] = (),
    positions: bool = False,
) -> DataFrame:
    """Text columns of all files under each file's own header, and ``__file``.

    Only the different headers reach the driver.  The lines are parsed once, and a column
    is looked up in the place that the header of the line's file gives it; a file without
    the column has missing cells.  ``names`` turns a header's names into the wanted ones,
    ``None`` for a column to leave out, so that positions count in each file.

    Cells in quotes may hold separators, line breaks and doubled quotes.  A row with more cells than its header
    fails the job; a shorter one ends in missing cells.  For each name in ``constants`` the column ``__first_<name>``
    has the value of the file's first row: a check of a file's rows against it needs no join of the rows.
    ``lines`` replaces the scan of ``paths``; ``positions`` adds ``__block`` and ``__line``, a row's place in its file.
    """
    # Of lines from elsewhere the order is not known.
    ordered = lines is None
    lines = scan_lines(spark, paths) if lines is None else lines
    splits = file_splits(lines)
    tops = first_lines(lines, splits, 2 if constants else 1)
    tops = tops.withColumn("header", F.regexp_replace(F.element_at("top", 1), "^\ufeff", ""))
    found = sorted(r["header"] for r in tops.select("header").distinct().collect())
    if not found:
        raise ValueError("no file with a header found")
    if any(h.count('"') % 2 for h in found):
        raise ValueError("a header runs over several lines")
    wanted: dict[str, dict[str, int]] = {}
    sizes: dict[str, int] = {}
    for header in found:
        plain = header_cells(header, sep, mangle)
        sizes[header] = len(plain)
        for i, name in enumerate(names(plain) if names else plain):
            if name is not None:
                wanted.setdefault(name, {})[header] = i
    width = max(sizes.values())
    schema = ", ".join(f"c{i} string" for i in range(width + 1))
    # Quotes inside of a quoted cell are doubled.
    options = {"sep": sep, "nullValue": na, "quote": '"', "escape": '"', "maxCharsPerColumn": "-1"}

    def at_header(values: Mapping[str, Column]) -> Column:
        """A value that depends on the file's header."""
        if len(set(map(str, values.values()))) == 1 and len(values) == len(found):
            return next(iter(values.values()))
        out = F
        for header, value in values.items():
            out = out.when(F.col("header") == header, value)
        return out

    def cell(row: str, places: Mapping[str, int]) -> Column:
        return at_header({header: F.col(f"{row}.c{i}") for header, i in places.items()})

    firsts = []
    if constants:
        tops = tops.withColumn("row", F.from_csv(F.coalesce(F.get("top", F.lit(1)), F.lit("")), schema, options))
        firsts = [cell("row", wanted.get(name, {})).alias(f"__first_{name}") if name in wanted else F.lit(None).cast("string").alias(f"__first_{name}") for name in constants]
    # The table of first lines is stored: Spark knows its size, and the lines are not shuffled to look up their header.
    small = tops.select(F.col("file").alias("__file"), "first", "header", *firsts)
    placed = quoted_records(lines, splits, ordered=ordered).join(small, F.col("file") == F.col("__file"))
    placed = placed.filter(~((F.col("block") == 0) & (F.col("line") == F.col("first"))) & (F.trim("value") != ""))
    parsed = placed.withColumn("row", F.from_csv("value", schema, options))
    beyond = at_header({h: reduce(or_, [F.col(f"row.c{i}").isNotNull() for i in range(n, width + 1)]) for h, n in sizes.items()})
    text = F.concat(F.lit("a row has more cells than the header of "), F.col("__file"))
    checked = F.when(beyond, F.raise_error(text).cast("string")).otherwise(F.col("__file"))
    kept = [f"__first_{name}" for name in constants]
    if positions:
        kept += [F.col("block").alias("__block"), F.col("line").alias("__line")]
    return parsed.select(*[cell("row", places).alias(name) for name, places in wanted.items()], *kept, checked.alias("__file")).filter(
        F.col("__file").isNotNull()
    )


def scan_text_table(spark: SparkSession, paths: Paths, **options) -> DataFrame:
    """Text columns named by each file's header; blank cells and ``na`` are missing (see ``scan_with_files``)."""
    return scan_with_files(spark, paths, **options).drop("__file")


def read_historical(spark: SparkSession, paths: Paths) -> DataFrame:
    """Historical wide file: species, division, country and one text column per year."""
    return _lower(scan_text_table(spark, paths), ("Species", "Division", "Country"))


def read_dataset(spark: SparkSession, paths: Paths, *, na: str = codes.NA_TOKEN) -> DataFrame:
    """Catch data set: species, area, units, country and one text column per year."""
    wide = scan_text_table(spark, paths, na=na, mangle=False)
    return _lower(wide, ("Species", "Area", "Units", "Country"))


def read_preliminary(
    spark: SparkSession,
    paths: Paths,
    *,
    one_year_per_file: bool = True,
    columns: Mapping[str, Sequence[str]] = PRELIMINARY,
    lines: DataFrame | None = None,
) -> DataFrame:
    """Preliminary landings; files may use either naming of the weight columns.

    With ``one_year_per_file`` a file with another number of years than one fails the job: every row is
    held against the year of its file's first row.  ``lines`` replaces the scan of ``paths``.
    """
    def names(header: list[str]) -> list[str | None]:
        return [next((new for new, old in columns.items() if name == pick(header, old)), None) for name in header]

    raw = scan_with_files(spark, paths, names=names, lines=lines, constants=("year",) if one_year_per_file else ())
    year = to_int("year")
    if one_year_per_file:
        year = one_value(year, to_int("__first_year"), F.concat(F.col("__file"), F.lit(" does not hold exactly one year")))
    return raw.select(
        year.alias("year"),
        *[F.col(c) for c in ("species_latin", "area", "country")],
        to_double("ams").alias("ams"),
        to_double("bms").alias("bms"),
    )


def pick(names: Sequence[str], candidates: Sequence[str]) -> str:
    """The first candidate that is a name."""
    for name in candidates:
        if name in names:
            return name
    raise ValueError(f"none of the columns {', '.join(candidates)} in {', '.join(names)}")


def one_value(value: Column, first: Column, message: Column) -> Column:
    """``value`` where it is known and that of the first row of its file; elsewhere the job fails."""
    same = F.coalesce(value == first, F.lit(False))
    return F.when(same, value).otherwise(F.raise_error(message).cast("int"))


def read_quota(spark: SparkSession, paths: Paths, tac: str, *, mangle: bool = False) -> DataFrame:
    """Agreed quota per year; ``tac`` is the header of the quota column."""
    raw = scan_text_table(spark, paths, mangle=mangle)
    return raw.select(to_int("Year").alias("year"), to_double(F.col(f"`{tac}`")).alias("tac"))


def read_clean_table(
    spark: SparkSession,
    paths: Paths,
    schema: T.StructType,
    *,
    rename: Mapping[str, str] | None = None,
    drop_first: bool = False,
    sep: str = ",",
    na: str = "NA",
) -> DataFrame:
    """Clean table, typed by ``schema``; ``drop_first`` leaves out a row-number column."""
    def names(header: list[str]) -> list[str | None]:
        new = [(rename or {}).get(n, n) for n in header]
        return [None, *new[1:]] if drop_first else new

    raw = scan_text_table(spark, paths, sep=sep, na=na, names=names)
    return raw.select(*[typed(f"`{f.name}`", f.dataType).alias(f.name) for f in schema.fields])


def typed(name: str, kind: T.DataType) -> Column:
    """A text column under a type; text that does not fit is missing."""
    if isinstance(kind, T.DoubleType):
        return to_double(F.col(name))
    if isinstance(kind, T.IntegerType):
        return to_int(F.col(name))
    return F.col(name).try_cast(kind)


def named_at(names: Mapping[int, str], *, last: bool = True) -> Callable[[list[str]], list[str | None]]:
    """Renaming by position, counted from 1 in each header; ``last=False`` leaves out the last column."""
    def change(header: list[str]) -> list[str | None]:
        new: list[str | None] = [names.get(i, c) for i, c in enumerate(header, start=1)]
        return new if last else [*new[:-1], None]

    return change


def _lower(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({n: n.lower() for n in names})
